"""Subscriptions, payments, publisher context and the combined churn profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.catalog.inputs import FIRST_DAY, LAST_DAY
from presslens.catalog.registry import TABLES, load, query
from presslens.catalog.rolling import expiring, rounded, user_outcomes
from presslens.functions.labels import ACCEPTED_STATUSES
from presslens.operators import numbering
from presslens.plans import context, daily, packing
from presslens.plans import subscriptions as subs
from presslens.session import scratch_dir
from presslens.sources import sinks

UPTO = LAST_DAY
_ACCEPTED = ", ".join(f"'{s}'" for s in ACCEPTED_STATUSES)
END = f"{LAST_DAY} 23:59:59"

_GAP = "date_diff('day', CAST(previous_end_time AS DATE), CAST(start_time AS DATE))"
_FLAG = """CASE WHEN average_price = 0 THEN 0.0 WHEN 1 - daily_price / average_price >= 0.2
    THEN 1.0 ELSE 0.0 END::DOUBLE"""
_SHOWN = ("subscription_id", *subs.COMPARED, "is_discount")
_BAND = "web_access_level, length, is_paid, sub_print_access, sub_print_friday_access"


def _change(c: str) -> str:
    return f"""round(CASE WHEN l.{c} = 0 THEN -1.0 WHEN r.{c} = 0 THEN 1.0
        ELSE l.{c}::DOUBLE / NULLIF(r.{c}, 0) END::DOUBLE, 6) AS {c}_diff"""


def _history_tables(p: str, day: str) -> dict[str, str]:
    """Oracle tables of the subscription history, names starting with ``p``.

    Without ``day`` they hold the state on the last day; with ``as_of, `` the state on every day,
    from what was created up to that day.
    """
    created, of_day = "CAST(created_at AS DATE)", "as_of" if day else f"DATE '{UPTO}'"

    def known(table: str) -> str:
        if not day:
            return f"(SELECT * FROM {table} WHERE {created} <= DATE '{UPTO}')"
        days = f"(SELECT unnest(generate_series(DATE '{FIRST_DAY}', DATE '{UPTO}', INTERVAL 1 DAY))::DATE AS as_of)"
        return f"(SELECT * FROM {table}, {days} WHERE {created} <= as_of)"

    def same(left: str, right: str) -> str:
        return f"AND {left}.as_of = {right}.as_of" if day else ""

    started = f"CAST(start_time AS DATE) <= {of_day}"
    own = f"EXCLUDE ({day}user_id)"
    listed = "(user_id, as_of) IN (SELECT user_id, date FROM expiring)" if day else "user_id IN (SELECT user_id FROM expiring)"
    tables = {
        "paid_subs": f"""
            SELECT {day}subscription_id, count(id) AS payment_count, sum(amount) AS amount,
              sum(additional_amount) AS additional_amount, sum(recurrent_charge) > 0 AS is_recurrent_charge,
              string_agg(status, ',' ORDER BY status) AS payment_status,
              bool_and(status IN ({_ACCEPTED})) AS all_accepted
            FROM {known("fx_payments")} WHERE subscription_id IS NOT NULL GROUP BY ALL""",
        "upgraded": f"""SELECT {day}base_subscription_id, count(id) > 0 AS is_upgraded
            FROM {known("fx_subscription_upgrades")} GROUP BY ALL""",
        "upgrade_pairs": f"""SELECT {day}base_subscription_id, upgraded_subscription_id, type AS upgrade_type,
            count(id) > 0 AS is_upgrade FROM {known("fx_subscription_upgrades")} GROUP BY ALL""",
        "sub_data": f"""
            SELECT {"s.as_of, " if day else ""}s.user_id, s.id AS subscription_id, s.subscription_type_id, s.type AS subscription_type,
              s.created_at, s.start_time, s.end_time, s.length,
              s.is_recurrent::DOUBLE AS is_recurrent, s.is_paid::DOUBLE AS is_paid,
              p.is_recurrent_charge::INT::DOUBLE AS is_recurrent_charge,
              coalesce(u.is_upgraded, FALSE)::INT::DOUBLE AS is_upgraded,
              coalesce(g.is_upgrade, FALSE)::INT::DOUBLE AS is_upgrade,
              p.payment_count, p.amount, p.additional_amount, p.payment_status,
              t.name AS sub_type_name, t.code AS sub_type_code, t.length AS sub_type_length,
              t.price AS sub_type_price, t.web::DOUBLE AS sub_web_access, t.mobile::DOUBLE AS sub_standard_access,
              t.club::DOUBLE AS sub_club_access, t.print::DOUBLE AS sub_print_access,
              t.print_friday::DOUBLE AS sub_print_friday_access,
              coalesce(g.base_subscription_id, s.id) AS base_subscription_id,
              coalesce(g.upgrade_type, 'none') AS upgrade_type
            FROM {known("fx_subscriptions")} s
            LEFT JOIN {p}paid_subs p ON s.id = p.subscription_id {same("s", "p")}
            LEFT JOIN (SELECT * FROM fx_subscription_types WHERE NOT no_subscription) t ON s.subscription_type_id = t.id
            LEFT JOIN {p}upgraded u ON s.id = u.base_subscription_id {same("s", "u")}
            LEFT JOIN {p}upgrade_pairs g ON s.id = g.upgraded_subscription_id {same("s", "g")}
            WHERE p.all_accepted AND s.start_time <> s.end_time AND s.start_time >= TIMESTAMP '2015-01-01'""",
        "priced": f"""
            SELECT *, CASE WHEN sub_web_access <> 1 THEN -1
                ELSE (sub_web_access + sub_standard_access + sub_club_access)::INT END AS web_access_level,
              (amount - additional_amount) / NULLIF(length, 0) AS daily_price FROM {p}sub_data""",
        "bands": f"SELECT {day}{_BAND}, avg(daily_price) AS average_price FROM {p}priced GROUP BY ALL",
        "banded": f"""
            SELECT p.*, b.average_price, CASE WHEN b.average_price = 0 THEN 0.0
              WHEN 1 - p.daily_price / b.average_price >= 0.2 THEN 1.0 ELSE 0.0 END AS is_discount
            FROM (SELECT *, lag(end_time) OVER (PARTITION BY {day}user_id
                ORDER BY start_time, subscription_id, base_subscription_id) AS previous_end_time FROM {p}priced) p
            JOIN {p}bands b USING ({day}{_BAND})""",
        "user_stats": f"""
            SELECT {day}user_id, round(sum(amount), 2) AS total_amount, round(avg(amount), 6) AS average_amount,
              count(DISTINCT subscription_id) AS count_subs,
              sum(CASE WHEN is_paid = 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS paid_subs,
              sum(CASE WHEN is_paid = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS free_subs,
              date_diff('day', min({created}), max({created}))::INT AS number_of_days_since_the_first_paid_sub,
              round(avg({_GAP}), 6) AS average_gap, max({_GAP})::INT AS max_gap,
              sum(CASE WHEN is_paid = 1 THEN length ELSE 0 END)::DOUBLE AS total_days_paid_sub,
              sum(CASE WHEN is_paid = 0 THEN length ELSE 0 END)::DOUBLE AS total_days_free_sub,
              sum(CASE WHEN is_upgraded = 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS upgraded_subs,
              sum(is_discount)::DOUBLE AS discount_subs
            FROM {p}banded WHERE {started} GROUP BY ALL""",
        "by_recency": f"""
            SELECT * FROM (SELECT *, rank() OVER (PARTITION BY {day}user_id ORDER BY start_time DESC) AS k
              FROM {p}priced WHERE {started}) p
            JOIN {p}bands b USING ({day}{_BAND})""",
        "last_two": f"""
            SELECT {"l.as_of, " if day else ""}l.user_id, {', '.join(f'l.{c} AS {c}_last, r.{c} AS {c}_previous' for c in _SHOWN)},
              {', '.join(_change(c) for c in subs.NUMERIC_DIFFS)},
              {', '.join(f'l.{c} - r.{c} AS {c}_diff' for c in subs.PLAIN_DIFFS)}
            FROM (SELECT *, {_FLAG} AS is_discount FROM {p}by_recency WHERE k = 1) l
            JOIN (SELECT *, {_FLAG} AS is_discount FROM {p}by_recency WHERE k = 2) r
              ON l.user_id = r.user_id {same("l", "r")}""",
        "sub_features": f"""
            SELECT * FROM (
              SELECT {"s.as_of, " if day else ""}CAST(s.user_id AS VARCHAR) AS user_id, s.* {own}, t.* {own}
              FROM {p}user_stats s JOIN {p}last_two t ON s.user_id = t.user_id {same("s", "t")})
            WHERE {listed}""",
    }
    return {f"{p}{k}": v for k, v in tables.items()}


TABLES.update(_history_tables("", ""))
TABLES.update(_history_tables("daily_", "as_of, "))


def sub_data(spark, sf):
    return subs.subscription_data(
        load(spark, sf, "fx_subscriptions"), load(spark, sf, "fx_payments"),
        load(spark, sf, "fx_subscription_types"), load(spark, sf, "fx_subscription_upgrades"), UPTO,
    )


def stored_sub_data(spark, sf):
    """Subscription data as the stored table that the feature steps read several times."""
    return sinks.stored(sub_data(spark, sf), scratch_dir(spark, "sub_data"))


@query(
    "payments_by_subscription",
    """SELECT subscription_id, payment_count, round(amount, 2) AS amount,
    round(additional_amount, 2) AS additional_amount, is_recurrent_charge, payment_status FROM paid_subs""",
)
def payments_by_subscription(spark, sf):
    return rounded(subs.payments_by_subscription(load(spark, sf, "fx_payments"), UPTO), 2)


@query("upgrade_flags", "SELECT * FROM upgraded")
def upgrade_flags(spark, sf):
    return subs.upgrade_flags(load(spark, sf, "fx_subscription_upgrades"), UPTO)


@query(
    "subscription_data",
    "SELECT * REPLACE (round(amount, 2) AS amount, round(additional_amount, 2) AS additional_amount) FROM sub_data",
)
def subscription_data(spark, sf):
    return rounded(sub_data(spark, sf), 2)


@query("web_access_level", "SELECT subscription_id, base_subscription_id, web_access_level FROM priced")
def web_access(spark, sf):
    rows = subs.with_price(sub_data(spark, sf))
    return rows.select("subscription_id", "base_subscription_id", "web_access_level")


@query("price_bands", "SELECT * REPLACE (round(average_price, 6) AS average_price) FROM bands")
def price_bands(spark, sf):
    return rounded(subs.price_bands(sub_data(spark, sf)))


@query(
    "price_band_join",
    """SELECT user_id, subscription_id, base_subscription_id, round(daily_price, 6) AS daily_price,
    round(average_price, 6) AS average_price, is_discount::DOUBLE AS is_discount FROM banded""",
)
def price_band_join(spark, sf):
    data = stored_sub_data(spark, sf)
    joined = subs.band_join(subs.with_price(data), subs.price_bands(data))
    return rounded(
        joined.select("user_id", "subscription_id", "base_subscription_id", "daily_price",
                      "average_price", "is_discount")
    )


@query(
    "subscription_gaps",
    f"""SELECT user_id, subscription_id, base_subscription_id, previous_end_time, {_GAP}::INT AS gap_days
    FROM (SELECT *, lag(end_time) OVER (PARTITION BY user_id
      ORDER BY start_time, subscription_id, base_subscription_id) AS previous_end_time FROM sub_data)""",
)
def subscription_gaps(spark, sf):
    rows = subs.subscription_gaps(sub_data(spark, sf))
    return rows.select("user_id", "subscription_id", "base_subscription_id", "previous_end_time", "gap_days")


@query("user_subscription_stats", "SELECT * FROM user_stats")
def user_subscription_stats(spark, sf):
    stats = subs.user_subscription_stats(stored_sub_data(spark, sf), UPTO)
    return rounded(stats.withColumn("total_amount", F.round("total_amount", 2)))


@query(
    "kth_last_subscription",
    f"""SELECT user_id, subscription_id, base_subscription_id, start_time, {_FLAG} AS is_discount
    FROM by_recency WHERE k = 2""",
)
def kth_last_subscription(spark, sf):
    rows = subs.kth_last_subscription(stored_sub_data(spark, sf), 2, UPTO)
    return rows.select("user_id", "subscription_id", "base_subscription_id", "start_time", "is_discount")


PAIR_COLUMNS = [f"{c}_{s}" for c in _SHOWN for s in ("last", "previous")]
DIFF_COLUMNS = [f"{c}_diff" for c in (*subs.NUMERIC_DIFFS, *subs.PLAIN_DIFFS)]
_AMOUNTS = ", ".join(f"round(amount_{s}, 2) AS amount_{s}" for s in ("last", "previous"))


@query("last_vs_previous", f"SELECT * REPLACE ({_AMOUNTS}) FROM last_two")
def last_vs_previous(spark, sf):
    pairs = subs.last_vs_previous(stored_sub_data(spark, sf), UPTO)
    return rounded(pairs.select("user_id", *PAIR_COLUMNS, *DIFF_COLUMNS))


def features(spark, sf, users):
    return subs.subscription_features(stored_sub_data(spark, sf), UPTO, users)


STAT_COLUMNS = [
    "total_amount", "average_amount", "count_subs", "paid_subs", "free_subs",
    "number_of_days_since_the_first_paid_sub", "average_gap", "max_gap",
    "total_days_paid_sub", "total_days_free_sub", "upgraded_subs", "discount_subs",
]


def _feature_columns(df, *more):
    kept = df.select("user_id", *more, *STAT_COLUMNS, *PAIR_COLUMNS, *DIFF_COLUMNS)
    return rounded(kept.withColumn("total_amount", F.round("total_amount", 2)))


@query("subscription_features", f"SELECT * REPLACE ({_AMOUNTS}) FROM sub_features")
def subscription_features(spark, sf):
    return _feature_columns(features(spark, sf, expiring(spark, sf)))


@query(
    "churn_profile",
    f"""SELECT s.* EXCLUDE (as_of) REPLACE ({_AMOUNTS}), s.as_of AS date, o.* EXCLUDE (user_id, date)
    FROM daily_sub_features s LEFT JOIN u_outcome o ON s.user_id = o.user_id AND s.as_of = o.date""",
)
def churn_profile(spark, sf):
    """Profiles of every day of the month, each with the subscription history known on that day."""
    rows = user_rows(spark, sf, FIRST_DAY, LAST_DAY)
    more = [c for c in rows.columns if c not in ("user_id", "date") and not c.endswith(("_last", "_previous")) and c not in STAT_COLUMNS]
    return _feature_columns(rows, "date", *[c for c in more if c not in DIFF_COLUMNS])


def user_history(spark, sf, start, end):
    """Expiring users and subscription versions of a period, stored; any part of it can be built from them."""
    points = sinks.stored(expiring(spark, sf, start, end), scratch_dir(spark, "expiring"))
    versions = subs.subscription_versions(
        load(spark, sf, "fx_subscriptions"), load(spark, sf, "fx_payments"),
        load(spark, sf, "fx_subscription_types"), load(spark, sf, "fx_subscription_upgrades"), subs.Days(start, end),
    )
    return points, sinks.stored(versions, scratch_dir(spark, "sub_versions"))


def user_rows(spark, sf, start, end, history=None):
    """Complete user profiles of a period: subscription history, behaviour and outcome.

    ``history`` is the ``user_history`` of a period that holds this one.
    """
    points, versions = history or user_history(spark, sf, start, end)
    points = points.where(F.col("date").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
    known = subs.features_by_day(versions, subs.Days(start, end), points.select("user_id", F.col("date").alias(subs.AS_OF)))
    return subs.churn_profile(known, user_outcomes(spark, sf, points, start, end))


# ---- context -----------------------------------------------------------------------------------
def _context_sql(n: int) -> str:
    over = f"OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
    SELECT *, sum_paid / payment_count AS avg_price FROM (
      SELECT date, sum(payment_count) {over} AS payment_count,
        sum(sum_paid) {over} AS sum_paid, sum(views) {over} AS article_pageviews_count
      FROM (SELECT CAST(created_at AS DATE) AS date, count(id) AS payment_count, sum(amount) AS sum_paid
          FROM fx_payments WHERE status IN ({_ACCEPTED}) GROUP BY 1)
      JOIN (SELECT CAST(time_from AS DATE) AS date, sum(pv_sum) AS views
          FROM fx_article_pageviews GROUP BY 1) USING (date))"""


TABLES["publisher_context"] = _context_sql(30)
TABLES["pay_history"] = f"""
    SELECT user_id, clv, last_subscription_end,
      date_diff('day', CAST(last_subscription_end AS DATE), DATE '{LAST_DAY}')::DOUBLE AS days_since_last_subscription
    FROM (SELECT user_id, sum(amount) AS clv FROM fx_payments
      WHERE created_at <= TIMESTAMP '{END}' AND status = 'paid' GROUP BY 1)
    LEFT JOIN (SELECT user_id, max(end_time) AS last_subscription_end FROM fx_subscriptions
      WHERE end_time <= TIMESTAMP '{END}' GROUP BY 1) USING (user_id)"""


def publisher_context(spark, sf):
    return context.global_context(
        load(spark, sf, "fx_payments"), load(spark, sf, "fx_article_pageviews"), 30, pageviews_col="pv_sum"
    )


def _steady(rows):
    """Sums in cents and the average of those, so that the order of addition cannot show."""
    cents = rows.withColumn("sum_paid", F.round("sum_paid", 2))
    return cents.withColumn("avg_price", F.round(F.col("sum_paid") / F.col("payment_count"), 6))


def history(spark, sf):
    return context.payment_history(
        load(spark, sf, "fx_payments"), load(spark, sf, "fx_subscriptions"), END
    )


@query(
    "global_context",
    """SELECT date, payment_count::BIGINT AS payment_count, round(sum_paid, 2) AS sum_paid,
    article_pageviews_count::BIGINT AS article_pageviews_count, round(round(sum_paid, 2) / payment_count, 6) AS avg_price
    FROM publisher_context""",
)
def global_context(spark, sf):
    return _steady(publisher_context(spark, sf))


@query("payment_history", "SELECT * REPLACE (round(clv, 2) AS clv) FROM pay_history")
def payment_history(spark, sf):
    return rounded(history(spark, sf), 2)


TABLES["browser_user_sets"] = """SELECT browser_id, string_agg(user_id, ',' ORDER BY user_id) AS user_ids
    FROM (SELECT DISTINCT browser_id, user_id FROM dim_browser_users) GROUP BY 1"""


def browser_rows(spark, sf):
    return daily.visitor_views(load(spark, sf, "fx_pageviews")).select("browser_id", "date").distinct()


def rows_with_users(spark, sf):
    pairs = daily.browser_users(load(spark, sf, "fx_pageviews"))
    return packing.profile_user_ids(browser_rows(spark, sf), pairs, FIRST_DAY, LAST_DAY)


@query(
    "profile_user_ids",
    "SELECT b.browser_id, b.date, user_ids FROM b_days b LEFT JOIN browser_user_sets USING (browser_id)",
)
def profile_user_ids(spark, sf):
    return rows_with_users(spark, sf).withColumn("user_ids", F.array_join("user_ids", ","))


#: Users of one cell; small, so that browsers of the test tables have several chunks.
CHUNK = 5

TABLES["browser_user_chunks"] = f"""SELECT browser_id, (k // {CHUNK})::BIGINT AS chunk, count(*)::BIGINT AS n,
      string_agg(user_id, ',' ORDER BY user_id) AS values
    FROM (SELECT *, row_number() OVER (PARTITION BY browser_id ORDER BY user_id) - 1 AS k
          FROM (SELECT DISTINCT browser_id, user_id FROM dim_browser_users))
    GROUP BY 1, 2"""


def user_chunks(spark, sf):
    return numbering.chunked(daily.browser_users(load(spark, sf, "fx_pageviews")), "browser_id", "user_id", CHUNK)


@query("browser_user_lists", "SELECT * FROM browser_user_chunks")
def browser_user_lists(spark, sf):
    return user_chunks(spark, sf).withColumn("values", F.array_join("values", ","))


@query(
    "profile_user_chunks",
    """SELECT b.browser_id, b.date, coalesce(u.n, 0)::BIGINT AS n, coalesce(u.n_chunks, 0)::BIGINT AS n_chunks, head
    FROM b_days b LEFT JOIN (
        SELECT browser_id, sum(n) AS n, count(*) AS n_chunks, max(values) FILTER (chunk = 0) AS head
        FROM browser_user_chunks GROUP BY 1) u USING (browser_id)""",
)
def profile_user_chunks(spark, sf):
    pairs = daily.browser_users(load(spark, sf, "fx_pageviews"))
    rows = packing.profile_user_chunks(browser_rows(spark, sf), pairs, FIRST_DAY, LAST_DAY, CHUNK)
    return rows.withColumn("head", F.array_join("head", ","))


@query(
    "payment_history_join",
    """SELECT b.browser_id, b.date,
      CASE WHEN CAST(h.last_subscription_end AS DATE) >= b.date THEN 0.0
        ELSE round(coalesce(h.clv, 0.0), 2) END::DOUBLE AS clv,
      CASE WHEN CAST(h.last_subscription_end AS DATE) >= b.date THEN 1000.0
        ELSE coalesce(h.days_since_last_subscription, 1000.0) END::DOUBLE AS days_since_last_subscription
    FROM b_days b LEFT JOIN browser_user_sets s USING (browser_id)
    LEFT JOIN pay_history h ON CAST(h.user_id AS VARCHAR) = split_part(s.user_ids, ',', 1)""",
)
def payment_history_join(spark, sf):
    pairs = daily.browser_users(load(spark, sf, "fx_pageviews"))
    rows = packing.profile_first_user(browser_rows(spark, sf), pairs, FIRST_DAY, LAST_DAY)
    joined = context.with_payment_history(rows, history(spark, sf))
    return rounded(joined.drop("user_ids"), 2)


@query(
    "profile_context",
    """SELECT b.browser_id, b.date, c.article_pageviews_count::BIGINT AS article_pageviews_count,
    round(c.sum_paid, 2) AS sum_paid, round(round(c.sum_paid, 2) / c.payment_count, 6) AS avg_price
    FROM b_days b LEFT JOIN publisher_context c USING (date)""",
)
def profile_context(spark, sf):
    steady = _steady(publisher_context(spark, sf))
    return context.with_context(browser_rows(spark, sf), steady)
