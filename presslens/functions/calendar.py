"""Calendar arithmetic on dates, all closed-form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_label(hour: Column) -> Column:
    """``7`` -> ``07:00-07:59``."""
    two = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(two, F.lit(":00-"), two, F.lit(":59"))


def day_number(date: Column) -> Column:
    """Days since 1970-01-01, the ordering of every day-range frame."""
    return F.unix_date(date.cast("date"))


def weekday_flag(date: Column, index: int, base: int = 1) -> Column:
    """1 on the weekday ``index`` else 0.

    ``dayofweek`` counts Sunday as 1.  ``base=1`` makes index 0 Sunday and 6 Saturday;
    ``base=0`` compares the raw number, so index 0 never matches and Saturday is never flagged.
    """
    return F.coalesce((F.dayofweek(date) == index + base).cast("int"), F.lit(0))
