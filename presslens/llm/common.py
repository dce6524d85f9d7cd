"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import scratch_dir
from presslens.sources.sinks import stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow frame to the shared folder and read it back; survives lost executors."""
    return stored(df, scratch_dir(df.sparkSession, name))


def in_small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df`` itself; texts are long, so its session hands them to Python in batches of fewer rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > rows:
        df.sparkSession.conf.set(key, rows)
    return df


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can clash with a name of the input."""
    return F.struct(*[column(c) for c in df.columns])


def unwrapped(df: DataFrame, names: list[str], struct: str = "row") -> DataFrame:
    """The columns of a ``whole_row`` struct, back under their own names."""
    return df.select(*[F.col(struct).getField(n).alias(n) for n in names])


def fit_part(doc_id: Column) -> Column:
    """True for rows that models may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], size: str, top: int = 1000) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row per key and the key's number of rows.

    The ``top`` most frequent keys are joined by broadcast, the others by a shuffle: what is
    broadcast has a fixed bound, and no key that is shuffled holds more than 1/top of all rows.
    Both sides are read several times, so they should be stored or cheap.
    """
    hot = right.where(F.col(size) > 100).orderBy(F.desc(size), *keys).limit(top)
    names = F.broadcast(hot.select(*keys))
    rest = left.join(names, keys, "left_anti").join(right.join(names, keys, "left_anti"), keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)
