"""Classification quality from label counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.numbers import safe_ratio


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(label, precision, recall, f_score, support)``, 0 where a ratio is undefined.

    Rows are reduced to the confusion counts (classes x classes) before anything else; each count
    then adds to its actual and its predicted label.
    """
    counts = (
        df.select(F.col(actual).cast("string").alias("a"), F.col(predicted).cast("string").alias("p"))
        .groupBy("a", "p")
        .agg(F.count("*").alias("n"))
    )
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("a").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"), hit.alias("hit")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hit")),
    )
    sums = (
        counts.select(F.explode(sides).alias("s"))
        .select("s.*")
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hit")])
    )
    precision = safe_ratio(F.col("hit"), F.col("guessed"), 0.0)
    recall = safe_ratio(F.col("hit"), F.col("support"), 0.0)
    return sums.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(2 * precision * recall, precision + recall, 0.0).alias("f_score"),
        F.col("support"),
    )
