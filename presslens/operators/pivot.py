"""Pivots over fixed key lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import name, text
from presslens.spec import sanitize


def key_sums(
    key_col: str, value: str, keys: Sequence[str], prefix: str, where: str | None = None
) -> list[Column]:
    """One conditional sum per key: 0 for a key that does not occur, null without any row.

    ``where`` restricts the rows that count as rows at all.
    """

    def total(key: str) -> Column:
        hit = f"CASE WHEN {name(key_col)} = {text(key)} THEN {name(value)} ELSE 0 END"
        term = hit if where is None else f"CASE WHEN {where} THEN {hit} END"
        return F.expr(f"CAST(sum({term}) AS BIGINT) AS {name(sanitize(f'{prefix}_{key}'))}")

    return [total(k) for k in keys]


def profile_pivot(
    table: DataFrame, id_col: str, key_col: str, keys: Sequence[str], start=None, end=None
) -> DataFrame:
    """Long ``(date, id, key, pageviews)`` to one row per (id, date) with a column per listed key."""
    if start is not None:
        table = table.where(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        table = table.where(F.col("date") <= F.lit(str(end)).cast("date"))
    return table.groupBy(id_col, "date").agg(*key_sums(key_col, "pageviews", keys, key_col))
