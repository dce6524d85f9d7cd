"""Ordered operators that stay distributed when one key owns a large share of the rows.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task.  The operators here cut
every key into blocks of its ordering column, work inside a block, and pass only one summary row
per block to its successor.  The per-key window then runs over block summaries, whose number is
bounded by the calendar and not by the traffic of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "__block"


def time_block(time: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide block that holds ``time``."""
    micros = F.unix_micros(time.cast("timestamp"))
    return F.floor(micros / F.lit(seconds * 1_000_000))


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    block: Column,
    prefix: str = "previous_",
) -> DataFrame:
    """Add ``values`` of the row before, per key, in ``order``.

    ``block`` must not decrease along ``order``, and ``order`` should be unique per key.
    """
    keys, order = list(keys), list(order)
    row = F.struct(*order, *[F.col(v).alias(f"value_{v}") for v in values])
    blocked = df.withColumn(BLOCK, block)
    last = blocked.groupBy(*keys, BLOCK).agg(F.max(row).alias("__last"))
    carried = last.select(
        *keys,
        BLOCK,
        F.lag("__last").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("__carry"),
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    joined = blocked.withColumn("__inside", F.lag(row).over(inside)).join(
        carried, [*keys, BLOCK], "left"
    )
    before = F.coalesce("__inside", "__carry")
    return joined.select(
        *df.columns, *[before[f"value_{v}"].alias(f"{prefix}{v}") for v in values]
    )


def next_distinct(
    df: DataFrame, keys: Sequence[str], column: str, block: Column, out: str
) -> DataFrame:
    """``(keys, column, out)``: for every distinct value the next larger one of the same key."""
    keys = list(keys)
    points = df.select(*keys, column).where(F.col(column).isNotNull()).distinct()
    points = points.withColumn(BLOCK, block)
    first = points.groupBy(*keys, BLOCK).agg(F.min(column).alias("__first"))
    following = first.select(
        *keys,
        BLOCK,
        F.lead("__first").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("__following"),
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(column)
    return (
        points.withColumn("__next", F.lead(column).over(inside))
        .join(following, [*keys, BLOCK], "left")
        .select(*keys, column, F.coalesce("__next", "__following").alias(out))
    )


def last_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    marked: Column,
    values: Sequence[str],
    seconds: int,
    prefix: str = "last_",
) -> DataFrame:
    """Add ``values`` of the latest earlier row where ``marked`` holds, at most ``seconds`` older.

    As-of look-back with an inclusive tolerance.  The first column of ``order`` is a time.  Blocks
    are as wide as the tolerance, so a row can only see marked rows of its own block and of the
    one before; of the latter only the newest matters and is copied forward.
    """
    keys, order = list(keys), list(order)
    time = order[0]
    row = F.struct(*order, *[F.col(v).alias(f"value_{v}") for v in values])
    blocked = df.withColumn(BLOCK, time_block(F.col(time), seconds)).withColumn(
        "__mark", F.when(marked, row)
    )
    newest = (
        blocked.where(F.col("__mark").isNotNull())
        .groupBy(*keys, BLOCK)
        .agg(F.max("__mark").alias("__mark"))
        .select(
            *keys,
            (F.col(BLOCK) + 1).alias(BLOCK),
            *[F.col(f"__mark.{c}").alias(c) for c in order],
            "__mark",
            F.lit(True).alias("__copy"),
        )
    )
    stacked = blocked.withColumn("__copy", F.lit(False)).unionByName(
        newest, allowMissingColumns=True
    )
    before = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = stacked.withColumn("__seen", F.last("__mark", ignorenulls=True).over(before)).where(
        ~F.col("__copy")
    )
    fresh = F.when(
        F.col(f"__seen.{time}") >= F.col(time) - F.expr(f"INTERVAL {int(seconds)} SECONDS"),
        F.col("__seen"),
    )
    return seen.select(
        *df.columns,
        fresh[time].alias(f"{prefix}{time}"),
        *[fresh[f"value_{v}"].alias(f"{prefix}{v}") for v in values],
    )


def hash_order(*ids: str, seed: int) -> Column:
    """A repeatable random ordering key: the MD5 text of the ids and a seed."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ids], F.lit(str(seed))))


#: Rows of one bucket that may be ranked in one task.
FEW = 50_000


def order_cut(
    df: DataFrame, key: str, prefix: int, quota: Column, group: Sequence[str] = (), few: int = FEW
) -> DataFrame:
    """The largest ``key`` among the first ``quota`` rows of each group, as ``(group, cut)``.

    ``key`` is a unique sortable text.  A histogram over its first ``prefix`` characters finds the
    one bucket per group that holds the limit.  While such a bucket has more than ``few`` rows, the
    histogram is repeated inside it on the next characters, so the rows that are ranked in the end
    fit one task whatever the size of the input.  ``quota`` may use ``total`` (rows of the group)
    and ``smallest`` (rows of the smallest group).  Selecting the rows is then a comparison with
    one value per group: no sort, no shuffle of ``df``.  The histograms run while the plan is
    built; they bring one row per group to the driver.
    """
    group = list(group)
    per_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    # The windows below see a histogram only: at most 16 ** 3 buckets per group (and per day for
    # keys that start with a date).
    running = per_group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)

    def bucketed(rows: DataFrame, length: int) -> DataFrame:
        return rows.withColumn("__bucket", F.substring(F.col(key), 1, length))

    def edges(sizes: DataFrame, wanted: Column) -> DataFrame:
        counted = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(running), F.lit(0)))
        counted = counted.withColumn("__quota", wanted.cast("long"))
        inside = (F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__n") >= F.col("__quota"))
        return counted.where(inside).select(
            *group, "__bucket", (F.col("__quota") - F.col("__before")).alias("__take"), "__n"
        )

    sizes = bucketed(df, prefix).groupBy(*group, "__bucket").agg(F.count("*").alias("__n"))
    totals = sizes.withColumn("total", F.sum("__n").over(per_group))
    totals = totals.withColumn("smallest", F.min("total").over(Window.partitionBy(F.lit(0))))
    found = edges(totals, quota)
    schema, length = found.schema, prefix
    rows = found.collect()  # one row per group
    while True:
        edge = F.broadcast(df.sparkSession.createDataFrame(rows, schema).drop("__n"))
        inner = bucketed(df.select(*group, key), length).join(edge, [*group, "__bucket"])
        if length >= 64 or all(r["__n"] <= few for r in rows):
            break
        length += 3
        finer = bucketed(inner, length).groupBy(*group, "__bucket", "__take").agg(F.count("*").alias("__n"))
        rows = edges(finer, F.col("__take")).collect()
    rank = F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy(key))
    return (
        inner.withColumn("__rank", rank)
        .where(F.col("__rank") == F.col("__take"))
        .select(*group, F.col(key).alias("cut"))
    )
