"""Audience segments from the latest predictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.ids import clean_ids, split_ids
from presslens.functions.labels import segment_for

# The segment group and its members.
GROUP_ID = 1
GROUP_CODE = "conversion_probability"
GROUP_NAME = "Conversion probability (based on machine learned model)"
GROUP_SORTING = 100
SEGMENTS = (
    (1, "high_conversion", "High conversion probability"),
    (2, "medium_conversion", "Medium conversion probability"),
    (3, "low_conversion", "Low conversion probability"),
    (4, "no_conversion", "Probably will not convert"),
    (5, "shared_account_login",
     "Sharing account (logged to account with active subscription recently)"),
)


def segments(spark: SparkSession) -> DataFrame:
    """The segment catalogue."""
    rows = [(i, c, n, True, GROUP_ID, GROUP_CODE, GROUP_NAME, GROUP_SORTING) for i, c, n in SEGMENTS]
    schema = (
        "id int, code string, name string, active boolean, "
        "group_id int, group_code string, group_name string, group_sorting int"
    )
    return spark.createDataFrame(rows, schema)


def segment(spark: SparkSession, code: str) -> DataFrame:
    """One catalogue row; an unknown code is an error."""
    if code not in {c for _, c, _ in SEGMENTS}:
        raise ValueError(f"segment {code!r} not found")
    return segments(spark).where(F.col("code") == code)


def assigned(predictions: DataFrame) -> DataFrame:
    """Predictions with their segment."""
    rule = segment_for(F.col("predicted_outcome"), F.col("conversion_probability"))
    return predictions.withColumn("segment", rule)


def latest_predictions(predictions: DataFrame, job_log: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Predictions of the last processed day up to ``as_of``.

    The day is one row, joined on the partition column of the predictions, so other days are
    pruned before they are read.
    """
    day = job_log.where(F.col("date") <= F.lit(str(as_of)).cast("date")).agg(F.max("date").alias("date"))
    return predictions.join(F.broadcast(day), "date")


def segment_members(
    predictions: DataFrame, job_log: DataFrame, as_of: dt.date | str, id_col: str
) -> DataFrame:
    """Distinct ``(segment, id)`` of users or browsers.

    Users come from ``user_id`` or, when the predictions carry ``user_ids`` (array or comma list),
    from every id in it.
    """
    rows = assigned(latest_predictions(predictions, job_log, as_of))
    if id_col == "user_id" and "user_ids" in rows.columns:
        ids = F.col("user_ids")
        if dict(rows.dtypes)["user_ids"] == "string":
            ids = split_ids(ids)
        rows = rows.withColumn("user_id", F.explode(clean_ids(ids)))
    kept = rows.where(F.col(id_col).isNotNull() & (F.col(id_col) != ""))
    return kept.select("segment", id_col).distinct()


def check_members(members: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """For every asked ``(segment, id)`` whether it is a member."""
    hits = members.select("segment", id_col).distinct().withColumn("__hit", F.lit(True))
    asked = ids.join(hits, ["segment", id_col], "left")
    return asked.select(*ids.columns, F.coalesce("__hit", F.lit(False)).alias("is_member"))


def segment_sizes(members: DataFrame) -> DataFrame:
    """The catalogue with the number of members of each segment."""
    sizes = members.groupBy(F.col("segment").alias("code")).agg(F.count("*").alias("members"))
    listed = segments(members.sparkSession).join(sizes, "code", "left")
    return listed.withColumn("members", F.coalesce("members", F.lit(0)))
