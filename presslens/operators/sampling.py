"""Exact, repeatable samples and splits without a global sort."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.operators.ordered import hash_order, order_cut


def undersample(df: DataFrame, label: str, id_cols: list[str], seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest one, drawn without replacement.

    The draw takes the rows with the smallest hash of their ids, so it does not depend on
    partitioning.  ``id_cols`` must identify a row.
    """
    keyed = df.where(F.col(label).isNotNull()).withColumn("__draw", hash_order(*id_cols, seed=seed))
    cuts = order_cut(keyed, "__draw", 3, F.col("smallest"), [label])
    kept = keyed.join(F.broadcast(cuts), label)  # one row per class
    return kept.where(F.col("__draw") <= F.col("cut")).select(*df.columns)


def _rounded(ratio: float) -> Column:
    return F.bround(F.col("total") * F.lit(ratio), 0)


def _flagged(df: DataFrame, fresh: Column, key: Column, prefix: int, ratio: float) -> DataFrame:
    keyed = df.withColumn("__fresh", fresh).withColumn("__key", key)
    cut = order_cut(keyed.where("__fresh"), "__key", prefix, _rounded(ratio))
    # One value at most: the key of the last training row.  No row means an empty training part.
    limit = cut.agg(F.max("cut").alias("cut")).first()["cut"]
    train = ~F.col("__fresh")
    if limit is not None:
        train = train | (F.col("__key") <= F.lit(limit))
    return keyed.withColumn("is_train", train).drop("__fresh", "__key")


def _is_fresh(min_date: dt.date | str | None, date_col: str) -> Column:
    if min_date is None:
        return F.lit(True)
    return F.coalesce(F.col(date_col) >= F.lit(str(min_date)).cast("date"), F.lit(False))


def random_split(
    df: DataFrame, id_cols: list[str], ratio: float, min_date=None, seed: int = 42,
    outcome_date: str = "outcome_date",
) -> DataFrame:
    """Flag ``is_train`` on a random ``ratio`` of the rows; rows older than ``min_date`` all train."""
    key = hash_order(*id_cols, seed=seed)
    return _flagged(df, _is_fresh(min_date, outcome_date), key, 3, ratio)


def time_split(
    df: DataFrame, id_cols: list[str], ratio: float, min_date=None, date_col: str = "date",
    outcome_date: str = "outcome_date", seed: int = 42,
) -> DataFrame:
    """Flag ``is_train`` on the earliest ``ratio`` of the rows, hash order within a day.

    Rows whose outcome is older than ``min_date`` all train and do not count for the ratio.
    """
    day = F.date_format(F.col(date_col), "yyyy-MM-dd")
    key = F.concat_ws(":", day, hash_order(*id_cols, seed=seed))
    return _flagged(df, _is_fresh(min_date, outcome_date), key, len("yyyy-mm-dd:") + 2, ratio)
