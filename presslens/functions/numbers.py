"""Ratios, changes and row shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """``numerator / denominator``; a zero or missing denominator gives ``default`` (null if None)."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def row_shares(names: Sequence[str]) -> list[Column]:
    """Each column divided by the sum of the set, 0 where that is undefined."""
    total = reduce(lambda a, b: a + b, [F.col(n).cast("double") for n in names])
    return [safe_ratio(F.col(n), total, 0.0) for n in names]


def daily_price(amount: Column, additional: Column, length: Column) -> Column:
    """Price per day of a subscription without its additional (donation) part."""
    return safe_ratio(amount - additional, length)


def discount_flag(price: Column, average: Column, threshold: float = 0.2) -> Column:
    """1.0 when the daily price is at least ``threshold`` below the average of its price band."""
    return (
        F.when(average == 0, F.lit(0.0))
        .when(F.lit(1.0) - safe_ratio(price, average) >= F.lit(threshold), F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
