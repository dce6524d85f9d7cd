"""The queries against their SQL, and the pipeline against a brute-force version."""

from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from presslens.llm import decontaminate, pieces, toxicity
from presslens.llm.queries import ORACLES, QUERIES
from text_rows import similar

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_each_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_toxicity", "op5_substring_dedup", "op6_simhash_near_dedup", "op7_language_id", "op10_piece_dropout"])
def test_every_document_has_its_row(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).select(F.col("row.doc_id").alias("doc_id"), "score").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] < 0.3]
    by_text = defaultdict(list)
    for d, t in rows:
        by_text[t].append(d)
    rows = [(max(ids), t) for t, ids in by_text.items()]
    texts = dict(rows)
    kept = {c for _, c in similar(sorted(rows))}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    automaton = decontaminate.Automaton(bench, 10)
    cut = {d: decontaminate.cut(texts[d], [automaton], 0.5) for d in kept}
    want = {d: t for d, t in cut.items() if t is not None}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.text for r in pieces.decoded(got).collect()} == want
    assert got.where("not lossless").count() == 0


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(40), SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0
    assert np.isin([n for n, _ in corpus_pipeline.STAGES], ["toxicity", "exact_dedup", "near_dedup", "decontamination", "pieces"]).all()
