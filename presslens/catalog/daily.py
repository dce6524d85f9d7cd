"""Day tables and event detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.catalog.inputs import ANDROID, IPAD, IPHONE, LAST_DAY, WINDOWS
from presslens.catalog.registry import TABLES, load, query
from presslens.functions.agents import FIELDS
from presslens.functions.calendar import weekday_flag
from presslens.plans import daily, events
from presslens.spec import HOUR_COLUMNS, HOUR_RANGES, HOURS, RANGE_COLUMNS, WEEKDAYS

_HOURS_SQL = ",\n".join(
    [f"count(*) FILTER (hour(time) = {h}) AS {c}" for h, c in zip(HOURS, HOUR_COLUMNS, strict=True)]
    + [
        f"count(*) FILTER (hour(time) >= {a} AND hour(time) < {b}) AS {c}"
        for (a, b), c in zip(HOUR_RANGES, RANGE_COLUMNS, strict=True)
    ]
)
TABLES["u_views"] = """
    SELECT * FROM fx_pageviews
    WHERE user_id <> '' AND lower(subscriber) = 'true' AND derived_referer_medium <> ''"""
TABLES["b_views"] = """
    SELECT * FROM fx_pageviews WHERE lower(subscriber) <> 'true' AND derived_referer_medium <> ''"""


def _day_sql(views: str, id_col: str, spent_filter: str) -> str:
    return f"""
    SELECT d.*, coalesce(s.timespent, 0)::BIGINT AS timespent FROM (
      SELECT date, {id_col}, count(*) AS pageviews, count(DISTINCT session_id) AS sessions,
        count(DISTINCT session_id) FILTER (derived_referer_medium = 'direct') AS sessions_without_ref,
        {_HOURS_SQL}
      FROM {views} GROUP BY 1, 2) d
    LEFT JOIN (SELECT date, {id_col}, sum(timespent) AS timespent FROM fx_timespent
      WHERE {spent_filter} GROUP BY 1, 2) s USING (date, {id_col})"""


def _long_sql(views: str, id_col: str, key: str) -> str:
    column = {"referer_mediums": "derived_referer_medium", "categories": "category"}.get(key)
    if key == "tags":
        return f"""SELECT date, {id_col}, tags, count(*) AS pageviews FROM (
            SELECT date, {id_col}, unnest(string_split(tags, ',')) AS tags FROM {views})
            WHERE tags <> '' GROUP BY 1, 2, 3"""
    return f"SELECT date, {id_col}, {column} AS {key}, count(*) AS pageviews FROM {views} GROUP BY 1, 2, 3"


def _json_sql(table: str, id_col: str, key: str, name: str) -> str:
    return f"""(SELECT date, {id_col}, '{{' || string_agg('"' || {key} || '":' || pageviews, ',' ORDER BY {key})
      || '}}' AS {name} FROM {table} GROUP BY 1, 2)"""


TABLES["u_days"] = _day_sql("u_views", "user_id", "user_id <> ''")
TABLES["b_days"] = _day_sql("b_views", "browser_id", "TRUE")
for _v, _id, _p in (("u_views", "user_id", "u"), ("b_views", "browser_id", "b")):
    for _key in daily.LONG_TABLES:
        TABLES[f"{_p}_{_key}"] = _long_sql(_v, _id, _key)
    TABLES[f"{_p}_hours"] = f"""SELECT date, {_id},
        printf('%02d:00-%02d:59', hour(time), hour(time)) AS hours, count(*) AS pageviews
        FROM {_v} GROUP BY 1, 2, 3"""

# The fields of the four user agents of the test views.
_AGENTS = {
    IPHONE: ("Mobile Safari", "13.0", "iOS", "13.3", "iPhone", "Apple", "iPhone", False, False, True),
    WINDOWS: ("Chrome", "80.0.3987", "Windows", "10", "Other", None, None, True, False, False),
    ANDROID: ("Chrome Mobile", "79.0.3945", "Android", "9", "Samsung SM-G960F", "Samsung", "SM-G960F",
              False, False, True),
    IPAD: ("Mobile Safari", "12.1", "iOS", "12.2", "iPad", "Apple", "iPad", False, True, False),
}


def _lit(value) -> str:
    return "NULL" if value is None else str(value).upper() if isinstance(value, bool) else f"'{value}'"


TABLES["agent_facts"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{ua}', {', '.join(_lit(v) for v in row)})" for ua, row in _AGENTS.items()
) + f") AS t(user_agent, {', '.join(FIELDS)})"


def _last_agent(views: str) -> str:
    return f"""SELECT date, browser_id, arg_max(user_agent, struct_pack(t := time, e := event_id)) AS user_agent
        FROM {views} GROUP BY 1, 2"""


TABLES["browsers_raw"] = _last_agent("fx_pageviews")
TABLES["b_agents"] = _last_agent("b_views")
TABLES["dim_browsers"] = (
    f"SELECT date, browser_id, {', '.join(FIELDS)} FROM browsers_raw JOIN agent_facts USING (user_agent)"
)
TABLES["dim_browser_users"] = (
    "SELECT DISTINCT date, browser_id, user_id FROM fx_pageviews WHERE user_id <> ''"
)
TABLES["steps"] = """SELECT date, browser_id,
    count(*) FILTER (step = 'checkout') AS commerce_checkouts,
    count(*) FILTER (step = 'payment') AS commerce_payments,
    count(*) FILTER (step = 'purchase') AS commerce_purchases,
    count(*) FILTER (step = 'refund') AS commerce_refunds
    FROM fx_commerce WHERE browser_id <> '' GROUP BY 1, 2"""

_MAPS = (
    ("referer_mediums", "referer_mediums_pageviews"),
    ("categories", "article_categories_pageviews"),
    ("tags", "article_tags_pageviews"),
    ("hours", "hour_interval_pageviews"),
)


def _full_day_sql(prefix: str, id_col: str, others: str, other_col: str, views: str, more: str = "", columns: str = "") -> str:
    joins = "\n".join(
        f"LEFT JOIN {_json_sql(f'{prefix}_{key}', id_col, key, name)} USING (date, {id_col})"
        for key, name in _MAPS
    )
    maps = ", ".join(f"coalesce({name}, '{{}}') AS {name}" for _, name in _MAPS)
    hours = ", ".join((*HOUR_COLUMNS, *RANGE_COLUMNS))
    return f"""
    SELECT date, {id_col}, coalesce({others}, '') AS {others}, pageviews, timespent, sessions,
      sessions_without_ref, {maps}, {hours}{columns}
    FROM {prefix}_days {joins}
    LEFT JOIN (SELECT date, {id_col}, string_agg(v, ',' ORDER BY v) AS {others} FROM (
      SELECT DISTINCT date, {id_col}, {other_col} AS v FROM {views} WHERE {other_col} <> '')
      GROUP BY 1, 2) USING (date, {id_col}) {more}"""


def pageviews(spark, sf):
    return load(spark, sf, "fx_pageviews")


def user_day_table(spark, sf):
    return daily.user_days(pageviews(spark, sf), load(spark, sf, "fx_timespent"))


def browser_day_table(spark, sf):
    return daily.browser_days(
        pageviews(spark, sf), load(spark, sf, "fx_timespent"), load(spark, sf, "fx_commerce")
    )


def _flat(day, others):
    return daily.counters_to_json(day).withColumn(others, F.array_join(others, ","))


@query("user_days", _full_day_sql("u", "user_id", "browser_ids", "browser_id", "u_views"))
def user_days(spark, sf):
    return _flat(user_day_table(spark, sf), "browser_ids")


@query(
    "browser_days",
    _full_day_sql(
        "b", "browser_id", "user_ids", "user_id", "b_views",
        more="""LEFT JOIN b_agents USING (date, browser_id) LEFT JOIN agent_facts USING (user_agent)
            LEFT JOIN steps USING (date, browser_id)""",
        columns=", " + ", ".join(FIELDS) + ", "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in daily.COMMERCE_COLUMNS),
    ),
)
def browser_days(spark, sf):
    return _flat(browser_day_table(spark, sf), "user_ids")


def _register_long(prefix: str, id_col: str, key: str) -> None:
    level = id_col.removesuffix("_id")

    @query(f"{level}_{key}", f"SELECT * FROM {prefix}_{key}")
    def long_table(spark, sf):
        return daily.key_counts(pageviews(spark, sf), id_col, key)


for _prefix, _id in (("u", "user_id"), ("b", "browser_id")):
    for _key in daily.LONG_TABLES:
        _register_long(_prefix, _id, _key)


@query(
    "hour_buckets",
    f"SELECT date, user_id, {', '.join((*HOUR_COLUMNS, *RANGE_COLUMNS))} FROM u_days",
)
def hour_buckets(spark, sf):
    return daily.hour_buckets(pageviews(spark, sf), "user_id")


@query(
    "counter_maps",
    " UNION ALL ".join(
        f"SELECT date, browser_id, '{name}' AS counter, {key} AS key, pageviews AS n FROM b_{key}"
        for key, name in _MAPS
    ),
)
def counter_maps(spark, sf):
    day = daily.day_table(daily.facet_counts(pageviews(spark, sf), "browser_id"), "browser_id")
    counters = F.array(
        *[F.struct(F.lit(c).alias("counter"), F.col(c).alias("m")) for c in daily.COUNTER_MAPS]
    )
    one = day.select("date", "browser_id", F.explode(counters).alias("c"))
    return one.select(
        "date", "browser_id", F.col("c.counter").alias("counter"), F.explode("c.m").alias("key", "n")
    )


@query(
    "timespent_sum",
    "SELECT date, user_id, sum(timespent)::BIGINT AS timespent FROM fx_timespent WHERE user_id <> '' GROUP BY 1, 2",
)
def timespent_sum(spark, sf):
    return daily.timespent_sums(load(spark, sf, "fx_timespent"), "user_id")


@query(
    "user_browsers",
    """SELECT date, user_id, string_agg(browser_id, ',' ORDER BY browser_id) AS browser_ids
    FROM (SELECT DISTINCT date, user_id, browser_id FROM u_views WHERE browser_id <> '') GROUP BY 1, 2""",
)
def user_browsers(spark, sf):
    facets = daily.facet_counts(pageviews(spark, sf), "user_id", ("ids",))
    day = daily.day_table(facets, "user_id")
    return day.select("date", "user_id", F.array_join("browser_ids", ",").alias("browser_ids"))


@query("commerce_steps", "SELECT * FROM steps")
def commerce_steps(spark, sf):
    return daily.commerce_steps(load(spark, sf, "fx_commerce"))


@query("browsers_dim", "SELECT * FROM browsers_raw")
def browsers_dim(spark, sf):
    return daily._last_agent(pageviews(spark, sf))


@query("user_agent_dim", "SELECT * FROM dim_browsers")
def user_agent_dim(spark, sf):
    return daily.browsers_dim(pageviews(spark, sf))


@query("browser_users", "SELECT * FROM dim_browser_users")
def browser_users(spark, sf):
    return daily.browser_users(pageviews(spark, sf))


@query(
    "device_brands",
    f"""SELECT DISTINCT lower(device_brand) AS device_brand FROM dim_browsers
    WHERE date >= DATE '{LAST_DAY}' - 90 AND date <= DATE '{LAST_DAY}'""",
)
def device_brands(spark, sf):
    return daily.device_brands(daily.browsers_dim(pageviews(spark, sf)), LAST_DAY)


@query(
    "dow_flags",
    "SELECT date, user_id, "
    + ", ".join(f"CASE WHEN dayofweek(date) = {i} THEN 1 ELSE 0 END AS dow_{i}" for i in WEEKDAYS)
    + " FROM u_days",
)
def dow_flags(spark, sf):
    views = daily.subscriber_views(pageviews(spark, sf)).select("date", "user_id").distinct()
    return views.select(
        "date", "user_id", *[weekday_flag(F.col("date"), i).alias(f"dow_{i}") for i in WEEKDAYS]
    )


# ---- events ------------------------------------------------------------------------------------
def _conversion_sql(seconds: int) -> str:
    return f"""
    SELECT user_id, last_browser AS browser_id, time, 'conversion' AS type, date AS computed_for_date
    FROM (
      SELECT *, last_value(CASE WHEN step = 'payment' THEN time END IGNORE NULLS) OVER w AS last_time,
        last_value(CASE WHEN step = 'payment' THEN browser_id END IGNORE NULLS) OVER w AS last_browser
      FROM fx_commerce WHERE browser_id <> '' AND user_id <> ''
      WINDOW w AS (PARTITION BY date, user_id ORDER BY time, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    WHERE step = 'purchase' AND last_time >= time - INTERVAL {seconds} SECOND"""


TABLES["ev_conversion"] = _conversion_sql(6 * 3600)
TABLES["ev_shared"] = """
    SELECT arg_max(user_id, pos) FILTER (login) AS user_id, browser_id,
      max(time) FILTER (login) AS time, 'shared_account_login' AS type, date AS computed_for_date
    FROM (SELECT *, struct_pack(t := time, e := event_id) AS pos,
        lower(subscriber) = 'true' AND user_id <> '' AS login,
        lower(subscriber) <> 'true' AND user_id = '' AS anon FROM fx_pageviews)
    GROUP BY date, browser_id
    HAVING max(pos) FILTER (login) > min(pos) FILTER (anon)"""


def _churn_sql(k: int) -> str:
    return f"""
    SELECT CAST(s1.user_id AS VARCHAR) AS user_id, coalesce(s2.start_time, s1.end_time) AS time,
      CASE WHEN s2.user_id IS NULL THEN 'churn' ELSE 'renewal' END AS type,
      CAST(s1.end_time AS DATE) + {k} AS computed_for_date
    FROM fx_subscriptions s1
    JOIN fx_subscription_types st ON s1.subscription_type_id = st.id AND st.length > 5
    LEFT JOIN (SELECT s.* FROM fx_subscriptions s JOIN fx_subscription_types t
        ON s.subscription_type_id = t.id AND t.length > 5) s2
      ON s1.user_id = s2.user_id AND s1.end_time <= s2.start_time
      AND s1.end_time + INTERVAL {k} DAY >= s2.start_time AND s1.end_time + INTERVAL {k} DAY <= s2.end_time"""


TABLES["ev_churn"] = _churn_sql(30)
TABLES["all_events"] = """
    SELECT user_id, browser_id, time, type, computed_for_date FROM ev_conversion
    UNION ALL SELECT user_id, browser_id, time, type, computed_for_date FROM ev_shared
    UNION ALL SELECT user_id, NULL, time, type, computed_for_date FROM ev_churn"""


@query("conversion_events", _conversion_sql(300))
def conversion_events(spark, sf):
    return events.conversion_events(load(spark, sf, "fx_commerce"))


@query("conversion_events_6h", "SELECT * FROM ev_conversion")
def conversion_events_6h(spark, sf):
    return events.conversion_events(load(spark, sf, "fx_commerce"), 6 * 3600)


@query("shared_login_events", "SELECT * FROM ev_shared")
def shared_login_events(spark, sf):
    return events.shared_login_events(pageviews(spark, sf))


def churn_events(spark, sf, threshold):
    return events.churn_renewal_events(
        load(spark, sf, "fx_subscriptions"), load(spark, sf, "fx_subscription_types"), threshold
    )


@query("churn_renewal_events", _churn_sql(2))
def churn_renewal_events(spark, sf):
    return churn_events(spark, sf, 2)


@query("churn_renewal_events_30d", "SELECT * FROM ev_churn")
def churn_renewal_events_30d(spark, sf):
    return churn_events(spark, sf, 30)


def event_table(spark, sf):
    return events.events_union(
        conversion_events_6h(spark, sf), shared_login_events(spark, sf), churn_events(spark, sf, 30)
    )


@query("events_union", "SELECT * FROM all_events")
def events_union(spark, sf):
    return event_table(spark, sf)
