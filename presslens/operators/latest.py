"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """Rows with ``RANK() = k`` per key, ties kept.

    A rank compared with a constant lets Spark drop all but the first ``k`` ranks of a key before
    the shuffle, so a busy key does not move its history.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == k).drop("__rank")


def latest_by(df: DataFrame, keys: Sequence[str], order: Column, values: Sequence[str]) -> DataFrame:
    """One row per key with ``values`` of the row that has the largest ``order``.

    An aggregate, so partial maxima are combined before the shuffle.
    """
    picked = F.max_by(F.struct(*values), order).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{v}").alias(v) for v in values])
