"""Vectors for the searches: which rows take part, packing for tasks, and the best of many."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import column


def finite(vector: Column, limit: float = float("inf")) -> Column:
    """True for vectors whose components are all there, finite and of magnitude below ``limit``."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < limit, F.lit(False))), F.lit(False))


def usable(rows: DataFrame, vec_id: str, vector: str, *more: str, limit: float = float("inf")) -> DataFrame:
    """id, vector and the columns ``more``, all of them present; one row per id.

    Of several rows of an id the one with the least (vector, more) counts, so equal rows count once.
    """
    names = ["id", "vector", *more]
    taken = rows.select(column(vec_id).cast("long").alias("id"), column(vector).alias("vector"), *[column(m).alias(m) for m in more])
    taken = taken.where(finite(F.col("vector"), limit)).dropna(subset=["id", *more])
    twice = taken.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    if twice.isEmpty():  # looks at ids only, so that vectors stay where they are
        return taken
    least = taken.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct(*names[1:])).alias("v"))
    return taken.join(twice, "id", "left_anti").select(*names).unionByName(least.select("id", *[F.col(f"v.{n}").alias(n) for n in names[1:]]))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of doubles; shorter rows are filled with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of an Arrow batch while frames of large rows are written; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def best_of(scores: np.ndarray, ids: np.ndarray, many: int, *more: np.ndarray) -> Sequence[np.ndarray]:
    """The ``many`` highest scores of each row with their ids, ties by smaller id, and what belongs to them."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :many]
    return [np.take_along_axis(x, order, -1) for x in (scores, ids, *more)]
