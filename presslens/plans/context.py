"""Daily publisher context and payment history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.ids import first_numeric_id
from presslens.functions.labels import ACCEPTED_STATUSES
from presslens.operators.joins import spread_nulls

CONTEXT_COLUMNS = ("article_pageviews_count", "sum_paid", "avg_price")
# Fixed value: days since the last subscription when there is none before the profile day.
NO_SUBSCRIPTION_DAYS = 1000.0


def global_context(
    payments: DataFrame,
    article_pageviews: DataFrame,
    n: int,
    statuses: Sequence[str] = ACCEPTED_STATUSES,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    pageviews_col: str = "sum",
) -> DataFrame:
    """Payment count, paid sum, average price and article pageviews over the last ``n`` rows.

    Both sides are reduced to one row per calendar day before they meet.  The window runs over
    that calendar (365 rows a year whatever the traffic), so a single partition is enough.
    """

    def period(df: DataFrame) -> DataFrame:
        if start is not None:
            df = df.where(F.col("date") >= F.lit(str(start)).cast("date"))
        return df if end is None else df.where(F.col("date") <= F.lit(str(end)).cast("date"))

    paid = (
        period(payments.withColumn("date", F.to_date("created_at")))
        .where(F.col("status").isin(*statuses))
        .groupBy("date")
        .agg(F.count("id").alias("payment_count"), F.sum("amount").alias("sum_paid"))
    )
    viewed = (
        period(article_pageviews.withColumn("date", F.to_date("time_from")))
        .groupBy("date")
        .agg(F.sum(pageviews_col).alias("article_pageviews_count"))
    )
    last_n = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(-(n - 1), 0)
    daily = paid.join(viewed, "date")
    rolled = daily.select(
        "date",
        *[F.sum(c).over(last_n).alias(c)
          for c in ("payment_count", "sum_paid", "article_pageviews_count")],
    )
    return rolled.withColumn("avg_price", F.try_divide("sum_paid", "payment_count"))


def with_context(profiles: DataFrame, context: DataFrame | None) -> DataFrame:
    """Profiles with the context of their day; without a context the columns are 0."""
    if context is None:
        return profiles.select("*", *[F.lit(0.0).alias(c) for c in CONTEXT_COLUMNS])
    # One row per calendar day: small enough to send to every task.
    return profiles.join(F.broadcast(context.select("date", *CONTEXT_COLUMNS)), "date", "left")


def payment_history(payments: DataFrame, subscriptions: DataFrame, end: dt.datetime | str) -> DataFrame:
    """Lifetime value of paying users and the days since their last finished subscription."""
    until = F.lit(str(end)).cast("timestamp_ntz")
    value = (
        payments.where((F.col("created_at") <= until) & (F.col("status") == "paid"))
        .groupBy("user_id")
        .agg(F.sum("amount").alias("clv"))
    )
    finished = (
        subscriptions.where(F.col("end_time") <= until)
        .groupBy("user_id")
        .agg(F.max("end_time").alias("last_subscription_end"))
        .withColumn(
            "days_since_last_subscription",
            F.datediff(F.to_date(until), F.to_date("last_subscription_end")).cast("double"),
        )
    )
    return value.join(finished, "user_id", "left")


def with_payment_history(profiles: DataFrame, history: DataFrame | None) -> DataFrame:
    """Profiles with the payment history of their first numeric user id.

    A last end on or after the profile day would look ahead and counts as no history.  Profiles
    without a user id are spread over the cluster, they match nothing.
    """
    none = F.lit(NO_SUBSCRIPTION_DAYS)
    if history is None:
        return profiles.select(
            "*", F.lit(0.0).alias("clv"), F.lit(0.0).alias("days_since_last_subscription")
        )
    keyed = profiles.withColumn(
        "__user", spread_nulls(first_numeric_id(F.col("user_ids")), F.col("browser_id"))
    )
    known = history.select(
        F.col("user_id").cast("string").alias("__user"),
        F.col("clv").alias("__clv"),
        F.col("days_since_last_subscription").alias("__days"),
        F.to_date("last_subscription_end").alias("__end"),
    )
    ahead = F.coalesce(F.col("__end") >= F.col("date"), F.lit(False))
    return keyed.join(known, "__user", "left").select(
        *profiles.columns,
        F.when(ahead, F.lit(0.0)).otherwise(F.coalesce(F.col("__clv").cast("double"), F.lit(0.0))).alias("clv"),
        F.when(ahead, none).otherwise(F.coalesce("__days", none)).alias("days_since_last_subscription"),
    )
