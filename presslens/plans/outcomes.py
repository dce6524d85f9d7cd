"""Outcome labels for profiles and the list of expiring users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.labels import (
    ACCEPTED_STATUSES,
    CHURN_LABELS,
    CONVERSION_LABELS,
    labels_of,
)
from presslens.functions.text import name
from presslens.operators.joins import range_left_join
from presslens.operators.ordered import next_distinct, time_block

# Days a subscription may still run when its end is predicted, shared-login history.
EVENT_LOOKAHEAD = 33
SHARED_LOGIN_DAYS = 30
_BLOCK_SECONDS = 30 * 86_400


def expiring_users(
    subscriptions: DataFrame,
    payments: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    lookahead: int = EVENT_LOOKAHEAD,
    statuses: tuple[str, ...] = ACCEPTED_STATUSES,
) -> DataFrame:
    """``(date, user_id, outcome_date)`` of users with a paid subscription about to end.

    For each day of ``[start, end]``: the subscription ends 1 to ``lookahead`` days later and no
    later one started by then, that is in ``(its start, its end]`` and not after the day.  The
    anti-join on that range only needs the *next* start of the user, found with a blocked scan.
    """
    first = F.lit(str(start)).cast("date")
    last = F.lit(str(end if end is not None else start)).cast("date")
    paid = payments.where(F.col("status").isin(*statuses)).select(
        F.col("subscription_id").alias("id")
    )
    ends = F.to_date("end_time")
    near = subscriptions.where(
        (ends > first) & (ends <= F.date_add(last, lookahead))
    ).select("id", "user_id", "start_time", "end_time")
    relevant = near.join(paid, "id", "left_semi")
    # Only users with such an end, and no start after the period: later ones renew nothing in it.
    starts = (
        subscriptions.where(F.col("start_time") <= last.cast("timestamp_ntz"))
        .select("user_id", "start_time")
        .join(relevant.select("user_id").distinct(), "user_id", "left_semi")
    )
    following = next_distinct(
        starts, ["user_id"], "start_time",
        time_block(F.col("start_time"), _BLOCK_SECONDS), "next_start",
    )
    relevant = relevant.join(following, ["user_id", "start_time"], "left")
    days = F.sequence(
        F.greatest(first, F.date_sub(ends, lookahead)), F.least(last, F.date_sub(ends, 1))
    )
    per_day = relevant.withColumn("date", F.explode(days))
    renewed = (F.col("next_start") <= F.col("end_time")) & (
        F.col("next_start") <= F.col("date").cast("timestamp_ntz")
    )
    return (
        per_day.where(~F.coalesce(renewed, F.lit(False)))
        .groupBy("date", "user_id")
        .agg(F.max(F.to_date("end_time")).alias("outcome_date"))
        .select("date", F.col("user_id").cast("string").alias("user_id"), "outcome_date")
    )


def churn_labels(events: DataFrame) -> DataFrame:
    """One ``(user_id, event_date, outcome)`` per user and day; any churn makes it a churn."""
    (negative,) = labels_of(CHURN_LABELS, "negative")
    (positive,) = labels_of(CHURN_LABELS, "positive")
    churned = F.bool_or(F.col("type") == negative)
    return (
        events.where(F.col("type").isin(*CHURN_LABELS))
        .groupBy("user_id", F.to_date("time").alias("event_date"))
        .agg(F.when(churned, F.lit(negative)).otherwise(F.lit(positive)).alias("outcome"))
    )


def churn_outcome(
    features: DataFrame, events: DataFrame, lookahead: int = EVENT_LOOKAHEAD
) -> DataFrame:
    """Features with ``outcome`` and ``outcome_date`` of events in ``(date, date + lookahead]``.

    One row per event day, so a user with events on two days appears twice.  Without an event the
    outcome is null and the date stays the end of the subscription.
    """
    within = (F.col("r.event_date") > F.col("l.date")) & (
        F.col("r.event_date") <= F.date_add(F.col("l.date"), lookahead)
    )
    pairs = range_left_join(
        features, churn_labels(events), ["user_id"], "date", "event_date", lookahead, within
    )
    kept = [c for c in features.columns if c != "outcome_date"]
    return pairs.selectExpr(
        *[f"l.{name(c)} AS {name(c)}" for c in kept],
        "r.outcome AS outcome",
        "coalesce(r.event_date, l.outcome_date) AS outcome_date",
    )


def conversion_outcome(features: DataFrame, events: DataFrame) -> DataFrame:
    """Features with the labelled event of the browser on the next day.

    The interval test ``date in [event - 1, event)`` over whole days is equality with the day
    before, so this is an equi-join.  Several events of a day give several rows.
    """
    positive = labels_of(CONVERSION_LABELS, "positive")
    (negative,) = labels_of(CONVERSION_LABELS, "negative")
    labelled = events.where(F.col("type").isin(*CONVERSION_LABELS)).select(
        F.col("browser_id"),
        F.date_sub(F.to_date("time"), 1).alias("date"),
        F.col("type").alias("event_type"),
    )
    is_positive = F.coalesce(F.col("event_type").isin(*positive), F.lit(False))
    joined = features.join(labelled, ["browser_id", "date"], "left")
    return joined.select(
        *features.columns,
        F.date_add("date", 1).alias("outcome_date"),
        F.when(is_positive, F.col("event_type")).otherwise(F.lit(negative)).alias("outcome"),
    )


def shared_login_counts(events: DataFrame, days: int = SHARED_LOGIN_DAYS) -> DataFrame:
    """``(browser_id, date, shared_account_logins_past_30_days)`` for every day that has a count.

    Logins are counted per browser and day first; each count then reaches the ``days`` following
    days, so one pass serves any number of profile days.
    """
    name = "shared_account_logins_past_30_days"
    daily = (
        events.where((F.col("type") == "shared_account_login") & F.col("browser_id").isNotNull())
        .groupBy("browser_id", F.to_date("time").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    reach = F.sequence(F.col("day"), F.date_add("day", days))
    spread = daily.withColumn("date", F.explode(reach))
    return spread.groupBy("browser_id", "date").agg(F.sum("n").alias(name))


def with_shared_logins(features: DataFrame, events: DataFrame) -> DataFrame:
    """Features with the shared-login count of the past 30 days, null when there is none."""
    return features.join(shared_login_counts(events), ["browser_id", "date"], "left")
