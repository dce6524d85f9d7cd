"""Writers and table maintenance.

A day is re-run by overwriting its partition, so running a job twice leaves the same table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from presslens.session import scratch_dir
from presslens.spec import PROFILE_KEYS


def write_partitions(df: DataFrame, path: str, by: Sequence[str], rebalance: bool = True) -> int:
    """Replace exactly the partitions that occur in ``df``; returns the number of rows written.

    ``rebalance`` lets adaptive execution merge small and split large output partitions, so a
    heavy day becomes several files of a sane size and a light one does not become hundreds.
    """
    seen = Observation("rows")
    counted = (df.hint("rebalance", *by) if rebalance else df).observe(seen, F.count(F.lit(1)).alias("n"))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return seen.get["n"]


def replace_partition(df: DataFrame, path: str, partition: Mapping[str, object]) -> None:
    """Replace one named partition, also when ``df`` is empty (delete and insert)."""
    folder = "/".join(f"{k}={v}" for k, v in partition.items())
    df.drop(*partition).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def write_profiles(packed: DataFrame, path: str, rebalance: bool = True) -> int:
    """Store packed profiles, replacing rows of the same day, window, aggregates and version."""
    return write_partitions(packed, path, PROFILE_KEYS, rebalance)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back.

    For frames that several later steps use: they are computed once, survive lost executors, and
    the plans that follow start from a scan instead of the whole history of the frame.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; arrays stay arrays."""
    df.write.mode("overwrite").json(path)


def ensure_table(spark: SparkSession, name: str, schema, by: Sequence[str] = ()) -> bool:
    """Create a partitioned catalog table unless it exists; True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return True


def high_water_mark(target: DataFrame | None, column: str = "created_at"):
    """Largest value of the target's time column, None for an empty or absent target."""
    return None if target is None else target.agg(F.max(column)).first()[0]


def incremental_rows(
    source: DataFrame, target: DataFrame | None, max_date: dt.date | str, column: str = "created_at"
) -> DataFrame:
    """Source rows newer than the target's last day and not after ``max_date``.

    The mark is a single value read beforehand, so the range reaches the scan of the source.
    """
    last = F.lit(str(max_date)).cast("date")
    rows = source.where(F.to_date(column) <= last)
    mark = high_water_mark(target, column)
    if mark is None:
        return rows
    day = mark.date() if isinstance(mark, dt.datetime) else mark
    return rows.where(F.to_date(column) > F.lit(str(day)).cast("date"))


def incremental_sync(
    source: DataFrame, target: DataFrame | None, max_date: dt.date | str, column: str = "created_at"
) -> DataFrame:
    """The target as it is after appending the new rows."""
    fresh = incremental_rows(source, target, max_date, column)
    return fresh if target is None else target.unionByName(fresh)


def sync_stored(
    source: DataFrame, path: str, max_date: dt.date | str, column: str = "created_at", by_day: bool = True,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """Append what is newer than the stored target at ``path`` and return the target as read back.

    The first run writes everything.  With ``ids``, a unique key of the rows, the mark is the newest day of the
    target *with the ids it has of that day*: rows that were created later on that day arrive
    with the next run, once.  Only that day is compared, whatever the size of the target.  Without
    ``ids`` the mark is the day alone, and such rows are missed; with ``by_day=False`` it is the
    newest time itself, and rows with an earlier time that arrive late are missed.
    """
    spark = source.sparkSession
    target = spark.read.parquet(path) if exists(spark, path) else None
    mark = high_water_mark(target, column)
    fresh = incremental_rows(source, target, max_date, column)
    if not by_day and mark is not None:
        fresh = source.where((F.to_date(column) <= F.lit(str(max_date)).cast("date")) & (F.col(column) > F.lit(mark)))
    elif ids and mark is not None:
        day = F.lit(str(mark.date() if isinstance(mark, dt.datetime) else mark)).cast("date")
        of_day = (F.to_date(column) == day) & (day <= F.lit(str(max_date)).cast("date"))
        held = target.where(F.to_date(column) == day).select(*ids)
        fresh = fresh.unionByName(source.where(of_day).join(held, list(ids), "left_anti").select(*fresh.columns))
    append(fresh, path)
    return spark.read.parquet(path)


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _path(spark, path)
    return files.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty partition: it was computed and has no rows."""
    place, files = _path(spark, path)
    files.mkdirs(place)


def drop_expired(spark: SparkSession, path: str, today: dt.date | str, days: int = 365, column: str = "date") -> list[str]:
    """Remove the day partitions of a table that have expired; returns their days.

    Only folders ``column=YYYY-MM-DD`` before the limit are removed, nothing is rewritten.
    """
    limit = str(dt.date.fromisoformat(str(today)) - dt.timedelta(days=days))
    place, files = _path(spark, path)
    gone = []
    for status in files.listStatus(place):
        name, _, day = status.getPath().getName().partition("=")
        if name == column and day < limit and status.isDirectory():
            files.delete(status.getPath(), True)
            gone.append(day)
    return sorted(gone)


def append_unique(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Append rows to a table with a unique index: keys that are stored already are left out."""
    rows, spark = unique_rows(df, keys, newest), df.sparkSession
    if exists(spark, path):
        stored_keys = spark.read.parquet(path).select(*keys)
        rows = rows.join(stored_keys, list(keys), "left_anti").select(*df.columns)
    append(rows, path)
    return spark.read.parquet(path)


def upsert(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Merge rows into a table with a unique index: of a key's rows, old and new, the newest is kept.

    ``newest`` orders the rows of a key, whole rows break its ties, so the stored row does not depend on
    partitioning and a re-run changes nothing.  The columns ``by`` are part of the key; only
    the partitions that occur in ``df`` are read and rewritten, through a copy in the scratch folder.
    """
    if not set(by) <= set(keys):
        raise ValueError(f"partition columns {by} have to be part of the key {keys}")
    spark = df.sparkSession
    rows = df
    if exists(spark, path):
        touched = df.select(*by).distinct()
        rows = rows.unionByName(spark.read.parquet(path).join(touched, list(by), "left_semi").select(*df.columns))
    merged = stored(unique_rows(rows, keys, newest), scratch_dir(spark, "merged"))
    write_partitions(merged, path, by)
    return spark.read.parquet(path)


def retained(df: DataFrame, today: dt.date | str, days: int = 365, column: str = "date") -> DataFrame:
    """Rows of day partitions that have not expired."""
    return df.where(F.col(column) >= F.date_sub(F.lit(str(today)).cast("date"), days))


def unique_rows(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key, for tables with a unique index: the last by ``newest``, ties by the whole row.

    An aggregate, so a key with many rows is combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = F.struct(*newest, *[F.col(c) for c in rest if c not in newest])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*[c if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would break a unique index, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)
