"""Fit / apply pairs for model inputs.

``fit`` steps return small driver-side facts (two numbers per column, the values that name the
columns of a wide table); ``apply`` steps are projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import filled, indicator, name, number, scaled

# Fixed value: bucket for null and unseen categories.
UNKNOWN = "Unknown"


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)``: distinct values per categorical column plus the Unknown bucket."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    unknown = [F.struct(F.lit(c).alias("feature"), F.lit(UNKNOWN).alias("value")) for c in columns]
    found = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
    extra = df.sparkSession.range(1).select(F.explode(F.array(*unknown)).alias("p")).select("p.*")
    return found.where(F.col("value").isNotNull()).union(extra).distinct()


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted values per column, for a wide table with a named column per value.

    Models do not use this: their categories are indexed and encoded as sparse vectors.
    """
    found = category_values(df, columns).collect()
    values: dict[str, list[str]] = {c: [] for c in columns}
    for feature, value in found:
        if value != UNKNOWN:
            values[feature].append(value)
    return {c: sorted(v) for c, v in values.items()}


def known_category(column: Column, values: Sequence[str]) -> Column:
    """The value itself when known, else Unknown."""
    text = column.cast("string")
    return F.when(text.isin(*values), text).otherwise(F.lit(UNKNOWN))


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each categorical column by 0/1 columns ``{column}_{value}``.

    The Unknown bucket gets no column: null and unseen values are the all-zero row.
    """
    kept = [name(c) for c in df.columns if c not in categories]
    dummies = [
        f"{indicator(c, v)} AS {name(f'{c}_{v}')}" for c, values in categories.items() for v in values
    ]
    return df.selectExpr(*kept, *dummies)


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum per column, nulls counted as 0, in one pass."""
    parts = [F.expr(f"{agg}({filled(c)})") for c in columns for agg in ("min", "max")]
    values = [v or 0.0 for v in df.agg(*parts).first()]
    return {c: (values[2 * i], values[2 * i + 1]) for i, c in enumerate(columns)}


def min_max(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale to [0, 1] by fitted limits; a constant column becomes its distance from the constant."""
    return df.selectExpr(
        *[f"{scaled(c, *limits[c])} AS {name(c)}" if c in limits else name(c) for c in df.columns]
    )


def align_columns(
    df: DataFrame, expected: Iterable[str], keep: Sequence[str] = (), fill: float = 0.0
) -> DataFrame:
    """``keep`` first, then the expected columns in alphabetical order.

    Missing ones are added as ``fill``, nulls are filled, columns that are not expected are dropped.
    """
    present = set(df.columns)
    aligned = [
        f"{filled(c, fill) if c in present else number(fill)} AS {name(c)}" for c in sorted(expected)
    ]
    return df.selectExpr(*[name(c) for c in keep], *aligned)
