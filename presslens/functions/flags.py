"""One reading of boolean-like text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for "true" in logs, day tables and CRM exports.
TRUE_TEXTS = ("t", "true", "1", "1.0")


def is_true(column: Column) -> Column:
    """True for any spelling in ``TRUE_TEXTS``; null and everything else is false."""
    return F.coalesce(F.lower(column.cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def bool_to_int(column: Column) -> Column:
    return is_true(column).cast("int")
