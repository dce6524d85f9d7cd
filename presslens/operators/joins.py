"""Joins whose key is not simply equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    span_days: int,
    condition: Column,
) -> DataFrame:
    """LEFT join where ``right_time`` lies in ``[left_time, left_time + span_days]``.

    Both sides are cut into buckets of ``span_days`` days.  A match is in the bucket of the left
    row or in the next one, so each right row is offered to its own bucket and the one before, and
    the join becomes an equi-join on ``(on, bucket)``.  A busy key is thereby split by time and
    never compared with its whole history.  ``condition`` is the exact test, in terms of ``l.`` and
    ``r.`` columns; left rows without a match are kept once.
    """
    width = max(int(span_days), 1)

    def bucket(column: str) -> Column:
        return F.floor(F.unix_date(F.to_date(column)) / F.lit(width))

    l = left.withColumn("__bucket", bucket(left_time)).alias("l")
    r = (
        right.withColumn("__own", bucket(right_time))
        .withColumn("__bucket", F.explode(F.array(F.col("__own"), F.col("__own") - 1)))
        .drop("__own")
        .alias("r")
    )
    equal = F.col("l.__bucket") == F.col("r.__bucket")
    for key in on:
        equal = equal & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    return l.join(r, equal & condition, "left")


def spread_nulls(key: Column, by: Column, buckets: int = 1024) -> Column:
    """``key`` with nulls replaced by one of ``buckets`` texts that match nothing.

    Keeps the unmatched rows of a LEFT join spread over the cluster instead of in one task.
    """
    filler = F.concat(F.lit("~none-"), F.pmod(F.xxhash64(by), F.lit(buckets)).cast("string"))
    return F.coalesce(key.cast("string"), filler)
