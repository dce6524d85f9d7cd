"""Positions inside a key, and what is built on them: numbered chunks of long lists.

No operator here gathers a key in one task, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.session import scratch_dir
from presslens.sources.sinks import stored


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: the position (from 0) of a row within its key, by ``order``.

    Rows are range-partitioned by key and order, so a long key is cut into ranges; they are counted
    inside each range, and a range adds the rows that its key has in earlier ones.  Only the first
    key of a range can have any, so what is broadcast has at most one row per range.  Ties of
    ``order`` get different positions.  The frame is narrow by intent: it is stored once.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id())
    rows = stored(ranges, scratch_dir(spark, "ranges"))
    inside = Window.partitionBy("__range", *keys).orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.sum("__n").over(earlier)).where("__before > 0")
        .select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__range").alias("__of_range"), "__before")
    )
    same = F.col("__range") == F.col("__of_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    position = F.row_number().over(inside).cast("long") - 1
    return (
        rows.withColumn("__position", position)
        .join(F.broadcast(before), same, "left")
        .withColumn(name, F.col("__position") + F.coalesce("__before", F.lit(0)))
        .select(*df.columns, name)
    )


def chunked(pairs: DataFrame, key: str, value: str, size: int = 1000) -> DataFrame:
    """``key, chunk, n, values``: the sorted distinct values of a key in chunks of ``size``, numbered from 0.

    A cell never holds more than ``size`` values, so a key with any number of them is only more
    rows.  Null values are left out; a key with nothing but nulls has no chunk.
    """
    distinct = pairs.where(F.col(value).isNotNull()).select(key, value).distinct()
    placed = numbered(distinct, [key], [value], "__position")
    return (
        placed.groupBy(key, F.floor(F.col("__position") / size).cast("long").alias("chunk"))
        .agg(F.array_sort(F.collect_list(value)).alias("values"))
        .select(key, "chunk", F.size("values").cast("long").alias("n"), "values")
    )


def chunk_summary(chunks: DataFrame, key: str) -> DataFrame:
    """``key, n, n_chunks, head``: number of values, of chunks, and the first chunk; one bounded row per key."""
    return chunks.groupBy(key).agg(
        F.sum("n").alias("n"), F.count("*").alias("n_chunks"),
        F.max(F.when(F.col("chunk") == 0, F.col("values"))).alias("head"),
    )


def unchunked(chunks: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` rows back from chunks."""
    return chunks.select(key, F.explode("values").alias(value))
