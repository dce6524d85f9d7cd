"""The training-text pipeline: every stage works on what the one before it kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm import decontaminate, exact_dedup, near_texts, pieces, simhash, toxicity
from presslens.llm.common import keep, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays.

    Candidates are the groups of ``simhash.near_groups`` and MinHash buckets, which also hold near
    copies whose fingerprints lie further apart; a five-word Jaccard similarity of 0.8 or more links.
    """
    return simhash.drop_near(docs, groups=partial(near_texts.similar_groups, groups=simhash.near_groups))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly benchmark goes."""
    cleaned = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, with a check that they decode to its very text."""
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("pieces", piece_stage),
]

#: A stage cannot be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, name)
    return docs
