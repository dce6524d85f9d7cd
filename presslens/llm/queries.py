"""One query per operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm import decontaminate, divergence, exact_dedup, hard_negatives, language_id, license_scan, multi_index, pieces, secret_scan, simhash, substring_dedup, toxicity, url_filter
from presslens.llm.common import Query, fit_part, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["z"] - s["a"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda k: k.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


ORACLES["op1_decontamination"] = """
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, words(text) AS w FROM documents),
     items AS (SELECT item_id, words(text) AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
     wins AS (
         SELECT DISTINCT item_id, least(len(w), 10) AS n,
                array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
         FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM wins),
     grams AS (
         SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
         FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM rows, sizes WHERE len(w) >= n)),
     found AS (SELECT r, i, n, item_id FROM grams JOIN wins USING (n, gram)),
     hits AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM found) GROUP BY r),
     ids AS (SELECT r, count(DISTINCT item_id) AS n_items,
                    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed FROM found GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM rows LEFT JOIN hits USING (r) LEFT JOIN ids USING (r)
""".replace("words(text)", r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')""")


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", " AND ").alias("licenses"),
    )


ORACLES["op2_license_scan"] = license_scan.oracle()


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


ORACLES["op3_secret_scan"] = secret_scan.ORACLE


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    bare = docs.select("doc_id", "text")
    found = toxicity.score(bare, model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), (~fit_part(F.col("row.doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("offending"),
    )


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = language_id.train(docs.where(fit_part(F.col("doc_id"))))
    found = language_id.identify(docs, models)
    return found.select("doc_id", (~fit_part(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


ORACLES["op9_url_filter"] = url_filter.oracle()


@query
def op10_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), digest=True)


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = divergence.ORACLE


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


ORACLES["op12_hard_negatives"] = hard_negatives.ORACLE


@query
def op13_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
