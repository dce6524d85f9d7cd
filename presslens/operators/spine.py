"""Gap-free daily series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, id_col: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per distinct id and day of ``[start, end]``; days come from a sequence, not a join."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return df.select(id_col).distinct().withColumn("date", F.explode(days))


def spine_join(
    spine: DataFrame, days: DataFrame, id_col: str, devices: DataFrame | None = None
) -> DataFrame:
    """Spine with the day data (and device data) of the same id and day, null on gap days.

    ``date_w_gaps`` is the day of the activity row and null on gap days; ``is_active_on_date`` is
    null there too.
    """
    marked = days.withColumn("date_w_gaps", F.col("date"))
    joined = spine.join(marked, [id_col, "date"], "left")
    if devices is not None:
        joined = joined.join(devices, [id_col, "date"], "left")
    return joined.withColumn("day_of_week", F.dayofweek("date").cast("string")).withColumn(
        "is_active_on_date", F.col("pageviews") > 0
    )
