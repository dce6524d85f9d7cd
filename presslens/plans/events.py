"""Conversion, shared-login, churn and renewal events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.flags import is_true
from presslens.operators.joins import range_left_join
from presslens.operators.ordered import last_within
from presslens.plans.daily import with_date

EVENT_COLUMNS = ("user_id", "browser_id", "time", "type", "computed_for_date")


def conversion_events(commerce: DataFrame, tolerance_seconds: int = 300) -> DataFrame:
    """Purchases with an earlier payment of the same user and day within the tolerance.

    The browser is the one of the payment.  Rows without a browser are ignored; equal times keep
    file order (``event_id``).
    """
    rows = (
        with_date(commerce)
        .where((F.col("browser_id") != "") & (F.col("user_id") != ""))
        .where(F.col("step").isin("payment", "purchase"))
        .select("date", "user_id", "time", "event_id", "browser_id", "step")
    )
    seen = last_within(
        rows, ["date", "user_id"], ["time", "event_id"],
        F.col("step") == "payment", ["browser_id"], tolerance_seconds, prefix="payment_",
    )
    return seen.where((F.col("step") == "purchase") & F.col("payment_time").isNotNull()).select(
        "user_id",
        F.col("payment_browser_id").alias("browser_id"),
        "time",
        F.lit("conversion").alias("type"),
        F.col("date").alias("computed_for_date"),
    )


def shared_login_events(pageviews: DataFrame) -> DataFrame:
    """Browsers seen anonymous and later logged in by a subscriber on the same day.

    Time and user are those of the last login of the day.  Whether a login follows an anonymous
    view is decided by the first anonymous and the last login position, so this is one aggregate.
    """
    rows = with_date(pageviews)
    subscriber, known = is_true(F.col("subscriber")), F.col("user_id") != ""
    position = F.struct("time", "event_id")
    login = F.struct(position.alias("position"), "user_id")
    days = rows.groupBy("date", "browser_id").agg(
        F.min(F.when(~subscriber & ~known, position)).alias("anonymous"),
        F.max(F.when(subscriber & known, login)).alias("login"),
    )
    return days.where(F.col("login.position") > F.col("anonymous")).select(
        F.col("login.user_id").alias("user_id"),
        "browser_id",
        F.col("login.position.time").alias("time"),
        F.lit("shared_account_login").alias("type"),
        F.col("date").alias("computed_for_date"),
    )


def churn_renewal_events(
    subscriptions: DataFrame,
    types: DataFrame,
    threshold: int = 2,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    min_length: int = 5,
) -> DataFrame:
    """Outcome of every subscription ``threshold`` days after its end, for one day or a range.

    A follow-up of the same user starts in ``[end, end + threshold]`` and still runs at
    ``end + threshold``.  With one the event is a renewal at each follow-up's start, without one a
    churn at the end.  Types of at most ``min_length`` days do not count.  ``start`` / ``end``
    restrict the days the events are computed for.
    """
    long_types = types.where(F.col("length") > min_length).select(
        F.col("id").alias("subscription_type_id")
    )
    running = subscriptions.select("user_id", "subscription_type_id", "start_time", "end_time").join(
        long_types, "subscription_type_id"
    )
    ended = running.select(
        "user_id", "end_time", F.date_add(F.to_date("end_time"), threshold).alias("computed_for_date")
    )
    if start is not None:
        ended = ended.where(F.col("computed_for_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        ended = ended.where(F.col("computed_for_date") <= F.lit(str(end)).cast("date"))
    grace = F.expr(f"l.end_time + INTERVAL {int(threshold)} DAYS")
    follows = (
        (F.col("r.start_time") >= F.col("l.end_time"))
        & (F.col("r.start_time") <= grace)
        & (F.col("r.end_time") >= grace)
    )
    # A follow-up starts at most ``threshold`` days before the day its event is computed for.
    later = running.select("user_id", "start_time", "end_time")
    if start is not None:
        later = later.where(F.col("start_time") >= F.date_sub(F.lit(str(start)).cast("date"), threshold).cast("timestamp_ntz"))
    if end is not None:
        later = later.where(F.col("start_time") < F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz"))
    pairs = range_left_join(ended, later, ["user_id"], "end_time", "start_time", threshold, follows)
    renewed = F.col("r.start_time").isNotNull()
    return pairs.select(
        F.col("l.user_id").cast("string").alias("user_id"),
        F.coalesce("r.start_time", "l.end_time").alias("time"),
        F.when(renewed, F.lit("renewal")).otherwise(F.lit("churn")).alias("type"),
        F.col("l.computed_for_date").alias("computed_for_date"),
    )


def events_union(*parts: DataFrame) -> DataFrame:
    """All event kinds in one table; kinds without a browser carry null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first.select(*EVENT_COLUMNS)
