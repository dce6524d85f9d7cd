"""Subscription history and the features derived from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.flags import bool_to_int
from presslens.functions.labels import ACCEPTED_STATUSES, web_access_level
from presslens.functions.numbers import daily_price, discount_flag
from presslens.functions.text import relative_change
from presslens.operators.latest import ranked
from presslens.operators.ordered import previous_row, time_block
from presslens.spec import COMPARED

# The attributes that define a price band, the first day of usable history.
BAND_KEYS = ("web_access_level", "length", "is_paid", "sub_print_access", "sub_print_friday_access")
HISTORY_START = "2015-01-01"
_BLOCK_SECONDS = 90 * 86_400


#: The day a row of the history is known on; steps group by it wherever it is present.
AS_OF = "as_of"


class Days(NamedTuple):
    """A period whose days each have a state of the history of their own."""

    start: dt.date | str
    end: dt.date | str


def _by(df: DataFrame) -> list[str]:
    return [AS_OF] if AS_OF in df.columns else []


def created_between(df: DataFrame, upto, after=None) -> DataFrame:
    """Rows created after the day ``after`` (open when None) and up to the day ``upto``."""
    day = F.to_date("created_at")
    kept = df.where(day <= F.lit(str(upto)).cast("date"))
    return kept if after is None else kept.where(day > F.lit(str(after)).cast("date"))


def payments_by_subscription(payments: DataFrame, upto, after=None) -> DataFrame:
    """Count, sums, recurrence and sorted status list of the payments of each subscription.

    Payments are first reduced to one row per subscription and status, so the status list is built
    from counts and no task collects the payments of a busy subscription.
    """
    rows = created_between(payments, upto, after).where(F.col("subscription_id").isNotNull())
    by_status = rows.groupBy("subscription_id", "status").agg(
        F.count("id").alias("n"),
        F.sum("amount").alias("amount"),
        F.sum("additional_amount").alias("additional_amount"),
        F.sum("recurrent_charge").alias("charges"),
    )
    statuses = F.array_sort(F.collect_list(F.struct("status", F.col("n").cast("int").alias("n"))))
    repeated = F.flatten(F.transform(statuses, lambda s: F.array_repeat(s["status"], s["n"])))
    return by_status.groupBy("subscription_id").agg(
        F.sum("n").alias("payment_count"),
        F.sum("amount").alias("amount"),
        F.sum("additional_amount").alias("additional_amount"),
        (F.sum("charges") > 0).alias("is_recurrent_charge"),
        F.array_join(repeated, ",").alias("payment_status"),
    )


def upgrade_flags(upgrades: DataFrame, upto, after=None) -> DataFrame:
    """``(base_subscription_id, is_upgraded)`` for subscriptions that were upgraded."""
    rows = created_between(upgrades, upto, after)
    return rows.groupBy("base_subscription_id").agg((F.count("id") > 0).alias("is_upgraded"))


def upgrade_links(upgrades: DataFrame, upto, after=None) -> DataFrame:
    """Distinct (base, upgraded, type) with ``is_upgrade``."""
    rows = created_between(upgrades, upto, after)
    return rows.groupBy(
        "base_subscription_id", "upgraded_subscription_id", F.col("type").alias("upgrade_type")
    ).agg((F.count("id") > 0).alias("is_upgrade"))


def subscription_data(
    subscriptions: DataFrame,
    payments: DataFrame,
    types: DataFrame,
    upgrades: DataFrame,
    upto: dt.date | str,
    after: dt.date | str | None = None,
    statuses: Sequence[str] = ACCEPTED_STATUSES,
    keep_unpaid: bool = False,
) -> DataFrame:
    """One row per subscription with its payments, type attributes and upgrade facts.

    Kept are subscriptions whose payments all have an accepted status, that start in the usable
    history and do not end at their start.  ``keep_unpaid`` also keeps those without a payment.
    Three joins are on the subscription id, one is on the type.
    """
    paid = payments_by_subscription(payments, upto, after)
    upgraded = upgrade_flags(upgrades, upto, after).withColumnRenamed(
        "base_subscription_id", "subscription_id"
    )
    links = upgrade_links(upgrades, upto, after).withColumnRenamed(
        "upgraded_subscription_id", "subscription_id"
    )
    joined = (
        _usable(created_between(subscriptions, upto, after))
        .join(paid, "subscription_id", "left")
        .where(_accepted(statuses, keep_unpaid))
        .join(upgraded, "subscription_id", "left")
        .join(links, "subscription_id", "left")
    )
    return _described(joined, types)


def _usable(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions of the usable history that do not end at their start."""
    return (
        subscriptions.where(F.col("start_time") != F.col("end_time"))
        .where(F.col("start_time") >= F.lit(HISTORY_START).cast("timestamp_ntz"))
        .withColumnsRenamed({"id": "subscription_id", "type": "subscription_type"})
    )


def _accepted(statuses: Sequence[str], keep_unpaid: bool) -> Column:
    """All payments of the row have an accepted status."""
    allowed = F.array(*[F.lit(s) for s in statuses])
    accepted = (
        F.size(F.array_except(F.split("payment_status", ","), allowed)) == 0
    ) & F.col("payment_status").isNotNull()
    return accepted | F.col("payment_status").isNull() if keep_unpaid else accepted


def _described(joined: DataFrame, types: DataFrame, *more: str) -> DataFrame:
    """The columns of the subscription data, with the attributes of its type."""
    kinds = types.where(~F.coalesce(F.col("no_subscription"), F.lit(False))).select(
        F.col("id").alias("subscription_type_id"),
        F.col("name").alias("sub_type_name"),
        F.col("code").alias("sub_type_code"),
        F.col("length").alias("sub_type_length"),
        F.col("price").alias("sub_type_price"),
        F.col("web").alias("sub_web_access"),
        F.col("mobile").alias("sub_standard_access"),
        F.col("club").alias("sub_club_access"),
        F.col("print").alias("sub_print_access"),
        F.col("print_friday").alias("sub_print_friday_access"),
    )
    flags = ("is_recurrent", "is_paid", "is_recurrent_charge", "is_upgraded", "is_upgrade")
    return joined.join(kinds, "subscription_type_id", "left").select(
        *more, "user_id", "subscription_id", "subscription_type_id", "subscription_type",
        "created_at", "start_time", "end_time",
        F.col("length").cast("int").alias("length"),
        *[bool_to_int(F.col(f)).cast("double").alias(f) for f in flags],
        F.coalesce("payment_count", F.lit(0)).cast("long").alias("payment_count"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.coalesce(F.col("additional_amount").cast("double"), F.lit(0.0)).alias("additional_amount"),
        F.coalesce("payment_status", F.lit("no_payment")).alias("payment_status"),
        "sub_type_name", "sub_type_code",
        F.col("sub_type_length").cast("int").alias("sub_type_length"),
        F.col("sub_type_price").cast("double").alias("sub_type_price"),
        *[F.col(f"sub_{k}_access").cast("double").alias(f"sub_{k}_access")
          for k in ("web", "standard", "club", "print", "print_friday")],
        F.coalesce("base_subscription_id", "subscription_id").alias("base_subscription_id"),
        F.coalesce("upgrade_type", F.lit("none")).alias("upgrade_type"),
    )


# ---- the history of a period, from its changes ----------------------------------------------------
def _since(days: Days) -> Column:
    """Day from which a row is known, not before the period: earlier changes are one."""
    return F.greatest(F.to_date("created_at"), F.lit(str(days.start)).cast("date"))


def _paid_by_day(payments: DataFrame, days: Days, statuses: Sequence[str] | None = None) -> DataFrame:
    """``(subscription_id, paid)``: what each day of the period added, oldest first.

    Sums and status counts of a day are aggregated before a subscription's days come together, so
    a list has an entry per day with payments and no more.  With ``statuses`` a subscription whose
    first payments have another status is left out: no later day makes it an accepted one.
    """
    rows = created_between(payments, days.end).where(F.col("subscription_id").isNotNull())
    by_status = rows.groupBy("subscription_id", _since(days).alias("day"), "status").agg(
        F.count("id").alias("n"),
        F.sum("amount").cast("double").alias("amount"),
        F.sum("additional_amount").cast("double").alias("additional_amount"),
        F.sum("recurrent_charge").alias("charges"),
    )
    status = F.struct("status", F.col("n").cast("int").alias("n"))
    # Payments without an id do not list their status, one with a comma counts as several: both are judged later.
    refused = F.lit(False) if statuses is None else (
        (F.col("n") > 0) & F.col("status").isNotNull() & ~F.contains("status", F.lit(",")) & ~F.col("status").isin(*statuses)
    )
    by_day = by_status.groupBy("subscription_id", "day").agg(
        F.collect_list(status).alias("statuses"),
        F.bool_or(refused).alias("refused"),
        *[F.sum(c).alias(c) for c in ("n", "amount", "additional_amount", "charges")],
    )
    entry = F.struct("day", "statuses", "n", "amount", "additional_amount", "charges")
    listed = by_day.groupBy("subscription_id").agg(
        F.sort_array(F.collect_list(entry)).alias("paid"), F.min_by("refused", "day").alias("refused")
    )
    return listed.where(~F.col("refused")).drop("refused")


def subscription_versions(
    subscriptions: DataFrame,
    payments: DataFrame,
    types: DataFrame,
    upgrades: DataFrame,
    days: Days,
    statuses: Sequence[str] = ACCEPTED_STATUSES,
    keep_unpaid: bool = False,
) -> DataFrame:
    """``subscription_data`` of every day of a period, as rows that hold from ``valid_from`` to ``valid_to``.

    A subscription has a new version on the days something about it changes: a payment, an
    upgrade, a link to the subscription it came from.  The number of rows follows the changes within
    the period, not its length, and each day sees what was created up to it and nothing later.
    """
    last = F.lit(str(days.end)).cast("date")
    known = created_between(upgrades, days.end)
    counted = F.min(F.when(F.col("id").isNotNull(), _since(days)))
    upgraded = known.groupBy(F.col("base_subscription_id").alias("subscription_id")).agg(
        F.min(_since(days)).alias("upgrade_known"), counted.alias("upgraded_since")
    )
    linked = known.groupBy(
        "base_subscription_id", F.col("upgraded_subscription_id").alias("subscription_id"), "type"
    ).agg(F.min(_since(days)).alias("since"), counted.alias("yes"))
    link = F.struct(F.col("base_subscription_id").alias("base"), F.col("type").alias("kind"), "since", "yes")
    links = linked.groupBy("subscription_id").agg(F.collect_list(link).alias("links"))
    own = _usable(created_between(subscriptions, days.end)).withColumn("__since", _since(days))
    rows = (
        own.join(_paid_by_day(payments, days, None if keep_unpaid else statuses), "subscription_id", "left" if keep_unpaid else "inner")
        .join(upgraded, "subscription_id", "left")
        .join(links, "subscription_id", "left")
    )
    # Until its first link a subscription stands alone, from then on there is a row per link.
    alone = F.struct(
        F.lit(None).cast(dict(linked.dtypes)["base_subscription_id"]).alias("base"), F.lit(None).cast("string").alias("kind"),
        F.col("__since").alias("since"), F.lit(None).cast("date").alias("yes"), F.array_min(F.col("links.since")).alias("until"),
    )
    joined = F.transform("links", lambda k: F.struct(
        k["base"].alias("base"), k["kind"].alias("kind"), F.greatest(k["since"], F.col("__since")).alias("since"),
        k["yes"].alias("yes"), F.lit(None).cast("date").alias("until"),
    ))
    rows = rows.withColumn("__link", F.explode(F.concat(F.array(alone), F.coalesce(joined, F.array().cast(f"array<{_link_type(linked)}>")))))
    since, until = F.col("__link.since"), F.col("__link.until")
    changes = F.concat(
        F.coalesce(F.col("paid.day"), F.array().cast("array<date>")), F.array("upgrade_known", "upgraded_since", "__link.yes")
    )
    inside = F.filter(changes, lambda d: (d > since) & (until.isNull() | (d < until)))
    rows = rows.where(until.isNull() | (since < until)).withColumn(
        "__days", F.sort_array(F.array_distinct(F.concat(F.array(since), inside)))
    )
    version = F.transform("__days", lambda d, i: F.struct(
        d.alias("valid_from"), F.coalesce(F.date_sub(F.get("__days", i + 1), 1), F.date_sub(until, 1), last).alias("valid_to"),
    ))
    rows = rows.withColumn("__version", F.explode(version)).withColumns({"valid_from": F.col("__version.valid_from"), "valid_to": F.col("__version.valid_to")})
    # An empty list is as good as none: the subscription has no payment yet.
    rows = rows.withColumn("__paid", F.filter("paid", lambda p: p["day"] <= F.col("valid_from")))

    def total(column: str, kind: str) -> Column:
        def add(held: Column, entry: Column) -> Column:
            return F.when(entry[column].isNull(), held).otherwise(F.coalesce(held, F.lit(0).cast(kind)) + entry[column].cast(kind))

        return F.aggregate("__paid", F.lit(None).cast(kind), add)

    repeated = F.flatten(F.transform(F.flatten(F.col("__paid.statuses")), lambda s: F.array_repeat(s["status"], s["n"])))
    state = rows.withColumns({
        "payment_count": total("n", "long"),
        "amount": total("amount", "double"),
        "additional_amount": total("additional_amount", "double"),
        "is_recurrent_charge": total("charges", "double") > 0,
        "payment_status": F.when(F.size("__paid") > 0, F.array_join(F.sort_array(repeated), ",")),
        "is_upgraded": F.when(F.col("upgrade_known") <= F.col("valid_from"), F.coalesce(F.col("upgraded_since") <= F.col("valid_from"), F.lit(False))),
        "is_upgrade": F.when(F.col("__link.base").isNotNull(), F.coalesce(F.col("__link.yes") <= F.col("valid_from"), F.lit(False))),
        "base_subscription_id": F.col("__link.base"),
        "upgrade_type": F.col("__link.kind"),
    })
    return _described(state.where(_accepted(statuses, keep_unpaid)), types, "valid_from", "valid_to")


def versions_within(versions: DataFrame, days: Days) -> DataFrame:
    """The versions that hold on some day of ``days``, cut to them."""
    first, last = (F.lit(str(d)).cast("date") for d in days)
    held = versions.where((F.col("valid_from") <= last) & (F.col("valid_to") >= first))
    return held.withColumns({"valid_from": F.greatest("valid_from", first), "valid_to": F.least("valid_to", last)})


def _link_type(linked: DataFrame) -> str:
    base = dict(linked.dtypes)["base_subscription_id"]
    return f"struct<base: {base}, kind: string, since: date, yes: date, until: date>"


def bands_by_day(versions: DataFrame, days: Days) -> DataFrame:
    """``price_bands`` of every day, from prefix sums of what each day added to a band or took from it.

    Prices are added as decimals, so taking one away leaves what was there before it.
    """
    first, last = (F.lit(str(d)).cast("date") for d in days)
    price = F.col("daily_price").cast("decimal(38,18)")
    one = F.when(price.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    begins = F.struct(F.col("valid_from").alias("day"), price.alias("price"), one.alias("n"), F.lit(1).cast("long").alias("rows"))
    ends = F.struct(F.date_add("valid_to", 1).alias("day"), (-price).cast("decimal(38,18)").alias("price"), (-one).alias("n"), F.lit(-1).cast("long").alias("rows"))
    moved = with_price(versions).select(*BAND_KEYS, F.explode(F.array(begins, ends)).alias("c")).where(F.col("c.day") <= last)
    by_day = moved.groupBy(*BAND_KEYS, F.col("c.day").alias("day")).agg(
        F.sum("c.price").alias("price"), F.sum("c.n").alias("n"), F.sum("c.rows").alias("rows")
    )
    order = Window.partitionBy(*BAND_KEYS).orderBy("day")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = by_day.select(
        *BAND_KEYS, "day", F.date_sub(F.coalesce(F.lead("day").over(order), F.date_add(last, 1)), 1).alias("to"),
        *[F.sum(c).over(running).alias(c) for c in ("price", "n", "rows")],
    )
    average = F.when(F.col("n") > 0, F.col("price").cast("double") / F.col("n"))
    return state.where("rows > 0").select(
        F.explode(F.sequence(F.greatest("day", first), F.col("to"))).alias(AS_OF), *BAND_KEYS, average.alias("average_price")
    )


def known_on(versions: DataFrame, points: DataFrame) -> DataFrame:
    """The history of each (user_id, as_of) of ``points`` as known on that day."""
    wanted = points.select(F.col("user_id").cast("string").alias("user_id"), AS_OF).distinct()
    rows = versions.withColumn("user_id", F.col("user_id").cast("string")).join(wanted, "user_id")
    return rows.where(F.col(AS_OF).between(F.col("valid_from"), F.col("valid_to"))).drop("valid_from", "valid_to")


def with_price(data: DataFrame) -> DataFrame:
    """Add ``web_access_level`` and ``daily_price``."""
    level = web_access_level(*[F.col(f"sub_{k}_access") for k in ("web", "standard", "club")])
    price = daily_price(F.col("amount"), F.col("additional_amount"), F.col("length"))
    return data.withColumns({"web_access_level": level, "daily_price": price})


def price_bands(data: DataFrame) -> DataFrame:
    """Average daily price per access level, length, paid flag and print access."""
    return with_price(data).groupBy(*_by(data), *BAND_KEYS).agg(F.avg("daily_price").alias("average_price"))


def band_join(priced: DataFrame, bands: DataFrame) -> DataFrame:
    """Priced subscriptions with the average of their band and the discount flag.

    Subscriptions with a missing band attribute have no band and are dropped.
    """
    joined = priced.join(bands, [*_by(priced), *BAND_KEYS])
    return joined.withColumn("is_discount", discount_flag(F.col("daily_price"), F.col("average_price")))


def started_by(data: DataFrame, max_date: dt.date | str | None) -> DataFrame:
    """Subscriptions that started by a day, or by their own day in a day-by-day history."""
    if AS_OF in data.columns:
        return data.where(F.to_date("start_time") <= F.col(AS_OF))
    return data.where(F.to_date("start_time") <= F.lit(str(max_date)).cast("date"))


def subscription_gaps(data: DataFrame) -> DataFrame:
    """Add ``previous_end_time`` and ``gap_days`` to the user's subscription before, by start."""
    before = previous_row(
        data, [*_by(data), "user_id"], ["start_time", "subscription_id", "base_subscription_id"], ["end_time"],
        time_block(F.col("start_time"), _BLOCK_SECONDS),
    )
    gap = F.datediff(F.to_date("start_time"), F.to_date("previous_end_time"))
    return before.withColumn("gap_days", gap)


def user_subscription_stats(
    data: DataFrame, max_date: dt.date | str | None, bands: DataFrame | None = None
) -> DataFrame:
    """Twelve history measures per user."""
    bands = price_bands(data) if bands is None else bands
    rows = band_join(subscription_gaps(with_price(data)), bands)
    rows = started_by(rows, max_date)

    def total(test: Column, value: Column | None = None) -> Column:
        amount = F.lit(1.0) if value is None else value.cast("double")
        return F.sum(F.when(test, amount).otherwise(F.lit(0.0)))

    paid, free = F.col("is_paid") == 1, F.col("is_paid") == 0
    created = F.to_date("created_at")
    return rows.groupBy(*_by(rows), "user_id").agg(
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
        F.count_distinct("subscription_id").alias("count_subs"),
        total(paid).alias("paid_subs"),
        total(free).alias("free_subs"),
        F.datediff(F.max(created), F.min(created)).alias("number_of_days_since_the_first_paid_sub"),
        F.avg("gap_days").alias("average_gap"),
        F.max("gap_days").alias("max_gap"),
        total(paid, F.col("length")).alias("total_days_paid_sub"),
        total(free, F.col("length")).alias("total_days_free_sub"),
        total(F.col("is_upgraded") == 1).alias("upgraded_subs"),
        F.sum("is_discount").alias("discount_subs"),
    )


def _start_order(latest_first: bool) -> Column:
    return F.col("start_time").desc() if latest_first else F.col("start_time").asc()


def kth_last_subscription(
    data: DataFrame, k: int, max_date: dt.date | str, latest_first: bool = True
) -> DataFrame:
    """The k-th subscription per user by start (ties kept) with its discount flag.

    ``latest_first=False`` counts from the oldest.
    """
    kth = ranked(started_by(with_price(data), max_date), [*_by(data), "user_id"], [_start_order(latest_first)], k)
    return band_join(kth, price_bands(data))


#: Compared by ratio and by difference; the discount flag is compared but is no model input.
NUMERIC_DIFFS = tuple(c for c, (_, change) in COMPARED.items() if change == "number")
PLAIN_DIFFS = (*[c for c, (_, change) in COMPARED.items() if change == "text"], "is_discount")


def last_vs_previous(
    data: DataFrame, max_date: dt.date | str | None, latest_first: bool = True,
    bands: DataFrame | None = None,
) -> DataFrame:
    """Last and previous subscription side by side with differences; users with one are dropped.

    The two newest ranks are cut out first and meet the price bands once.  A row of rank 2 exists
    only when rank 1 is unique, so the last subscription is the first row of the user's window and
    no self-join is needed.
    """
    by = _by(data)
    bands = price_bands(data) if bands is None else bands
    order = Window.partitionBy(*by, "user_id").orderBy(_start_order(latest_first))
    newest = (
        started_by(with_price(data), max_date)
        .withColumn("__rank", F.rank().over(order))
        .where(F.col("__rank") <= 2)
    )
    banded = band_join(newest, bands)
    columns = [c for c in banded.columns if c not in ("user_id", "__rank", *by)]
    by_rank = Window.partitionBy(*by, "user_id").orderBy("__rank")
    first = F.first(F.struct("__rank", *columns)).over(
        by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pairs = banded.withColumn("__last", first).where(
        (F.col("__rank") == 2) & (F.col("__last.__rank") == 1)
    )
    # Grouping by the row itself changes nothing and needs no shuffle, rows of a user are together.
    # It keeps the optimizer from deriving every combination of the doubled columns as a constraint.
    row = [*by, "user_id", "subscription_id", "base_subscription_id", "upgrade_type"]
    single = pairs.groupBy(*row).agg(
        F.first("__last").alias("__last"), F.first(F.struct(*columns)).alias("__previous")
    )
    sides = single.select(
        *by, "user_id",
        *[F.col(f"__last.{c}").alias(f"{c}_last") for c in columns],
        *[F.col(f"__previous.{c}").alias(f"{c}_previous") for c in columns],
    )
    return sides.select(
        "*",
        *[F.expr(relative_change(f"{c}_last", f"{c}_previous")).alias(f"{c}_diff")
          for c in NUMERIC_DIFFS],
        *[(F.col(f"{c}_last") - F.col(f"{c}_previous")).alias(f"{c}_diff") for c in PLAIN_DIFFS],
    )


def subscription_features(
    data: DataFrame, max_date: dt.date | str | None, users: DataFrame | None = None
) -> DataFrame:
    """History measures and last-versus-previous columns per user (id as text).

    ``users`` restricts the result to a list of user ids.  Price bands come from everybody, all
    else only from the histories asked for.
    """
    bands = price_bands(data)
    rows = data.withColumn("user_id", F.col("user_id").cast("string"))
    if users is not None:
        wanted = users.select(F.col("user_id").cast("string").alias("user_id"))
        rows = rows.join(wanted.distinct(), "user_id", "left_semi")
    return _features_of(rows, max_date, bands)


def features_by_day(versions: DataFrame, days: Days, points: DataFrame) -> DataFrame:
    """The same for every (user_id, as_of) of ``points``, each with the history known on its day.

    ``versions`` are read twice, so they should be stored.  Only the histories of the points are laid
    out by day; bands of all days come from the versions themselves.  ``days`` may be a part of the
    period the versions were made for.
    """
    versions = versions_within(versions, days)
    return _features_of(known_on(versions, points), None, bands_by_day(versions, days))


def _features_of(rows: DataFrame, max_date: dt.date | str | None, bands: DataFrame) -> DataFrame:
    stats = user_subscription_stats(rows, max_date, bands)
    return stats.join(last_vs_previous(rows, max_date, bands=bands), [*_by(rows), "user_id"])


def churn_profile(transactional: DataFrame, behavioural: DataFrame) -> DataFrame:
    """Every (user, day) of the subscription features with the behavioural features of that day.

    Both sides know nothing later than the day, so a later subscription or payment leaves the
    profiles of earlier days as they are.
    """
    return transactional.withColumnRenamed(AS_OF, "date").join(behavioural, ["user_id", "date"], "left")
