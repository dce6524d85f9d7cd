"""The near-copy rule of the pipeline: five-word Jaccard similarity of at least 0.8."""

import random

import numpy as np

import corpus_pipeline
from presslens.llm import near_texts, simhash
from text_rows import AWKWARD, frame, similar


def test_groups_equal_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for k in range(60):
        base = [word() for _ in range(rng.randint(40, 300))]
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    want = similar(rows)
    got = {(r.doc_id, r.component_id) for r in near_texts.similar_groups(frame(spark, rows, False)).collect()}
    assert got == want and len({c for _, c in want}) < len(rows)
    kept = corpus_pipeline.near_stage(spark, frame(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want}
    # The four-bit rule the stage had before leaves near copies.
    assert simhash.drop_near(frame(spark, rows)).count() > kept.count()


def test_stage_takes_the_groups_of_simhash(spark, monkeypatch):
    """What SimHash groups is compared even where no MinHash bucket holds it, and only links if it is similar."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(8):
        line = " ".join(word() for _ in range(5))
        rows += [(len(rows) + j, f"{line} " * 100 + " ".join(word() for _ in range(20))) for j in range(3)]
    for _ in range(20):
        base = [word() for _ in range(300)]
        for _ in range(3):
            rows.append((len(rows), " ".join([*base, word()])))
    want = similar(rows)
    docs = frame(spark, rows, False)
    grouped = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    assert all(grouped[d] == d - d % 3 for d in range(24)) and all((d, d) in want for d in range(24))
    monkeypatch.setattr(near_texts, "band_keys", lambda own: np.zeros(0, np.int64))
    alone = {(r.doc_id, r.component_id) for r in near_texts.similar_groups(docs).collect()}
    assert alone == {(d, d) for d, _ in rows}
    kept = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()}

    assert kept == {d for d, c in want if d == c or grouped[c] != grouped[d]} and len(kept) < len(rows) - 20


def test_awkward_rows_with_groups(spark, awkward, nothing):
    got = near_texts.similar_groups(awkward, groups=simhash.near_groups)
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (4, 4)} <= {(r.doc_id, r.component_id) for r in got.collect()} and got.count() == len(AWKWARD)
    assert near_texts.similar_groups(nothing, groups=simhash.near_groups).count() == 0


def test_awkward_rows(spark, awkward, nothing):
    got = {(r.doc_id, r.component_id) for r in near_texts.similar_groups(awkward).collect()}
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (4, 4)} <= got and near_texts.similar_groups(awkward).count() == len(AWKWARD)
    assert near_texts.similar_groups(nothing).count() == 0


def test_pipeline_by_similarity(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage in (corpus_pipeline.toxicity_stage, corpus_pipeline.exact_stage):
        docs = stage(spark, docs, folder)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = corpus_pipeline.near_stage(spark, docs, folder)
    assert {r.doc_id for r in got.collect()} == {c for _, c in similar(rows)}
