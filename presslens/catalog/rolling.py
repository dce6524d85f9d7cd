"""Gap-free series, rolling profiles and outcome labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.catalog.daily import event_table, pageviews, user_day_table
from presslens.catalog.inputs import FIRST_DAY, LAST_DAY
from presslens.catalog.registry import TABLES, load, query
from presslens.functions.labels import ACCEPTED_STATUSES
from presslens.operators.pivot import profile_pivot
from presslens.operators.rolling import AGGREGATES, rolling_features
from presslens.operators.spine import date_spine, spine_join
from presslens.plans import daily, outcomes, profiles
from presslens.session import scratch_dir
from presslens.sources import sinks
from presslens.spec import (
    CATEGORIES,
    DEVICE_TYPES,
    HOUR_RANGES,
    OLDER_HALF,
    RECENT_HALF,
    REFERER_MEDIUMS,
    WEEKDAYS,
    WINDOW_SUFFIXES,
    FeatureSpec,
    change_column,
    range_column,
    sanitize,
)

#: The brands of the test tables, for the oracles; the plans read theirs from the data.
BRANDS = ("apple", "samsung")
USER_WINDOW, BROWSER_WINDOW = 30, 7
SPECS = {"u": FeatureSpec("user", device_brands=BRANDS), "b": FeatureSpec("browser")}


def rounded(df, digits: int = 6, skip: tuple[str, ...] = ()):
    """Doubles rounded for comparison."""
    return df.selectExpr(
        *[
            f"round(`{c}`, {digits}) AS `{c}`" if t == "double" and c not in skip else f"`{c}`"
            for c, t in df.dtypes
        ]
    )


# ---- oracle tables -----------------------------------------------------------------------------
def _pivot_sql(table: str, id_col: str, key: str, keys) -> str:
    sums = ", ".join(
        f"sum(CASE WHEN {key} = '{k}' THEN pageviews ELSE 0 END)::BIGINT AS {sanitize(f'{key}_{k}')}"
        for k in keys
    )
    return f"SELECT {id_col}, date, {sums} FROM {table} GROUP BY 1, 2"


_RENAMES = ", ".join(
    f"{range_column(a, b)} AS {range_column(a, b, 'pvs')}" for a, b in HOUR_RANGES
)
for _p, _id in (("u", "user_id"), ("b", "browser_id")):
    TABLES[f"{_p}_pivot_mediums"] = _pivot_sql(
        f"{_p}_referer_mediums", _id, "referer_mediums", REFERER_MEDIUMS
    )
    TABLES[f"{_p}_pivot_categories"] = _pivot_sql(f"{_p}_categories", _id, "categories", CATEGORIES)
    _extra = "" if _p == "u" else ", coalesce(commerce_checkouts, 0) AS commerce_checkouts, coalesce(commerce_payments, 0) AS commerce_payments"
    _steps = "" if _p == "u" else "LEFT JOIN steps USING (date, browser_id)"
    TABLES[f"{_p}_input"] = f"""SELECT date, {_id}, pageviews, timespent, sessions, sessions_without_ref,
        {_RENAMES}{_extra} FROM {_p}_days {_steps}"""
    TABLES[f"{_p}_spine"] = f"""SELECT {_id}, unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}',
        INTERVAL 1 DAY))::DATE AS date FROM (SELECT DISTINCT {_id} FROM {_p}_days)"""
TABLES["u_devices"] = "SELECT user_id, date, " + ", ".join(
    [f"sum(CASE WHEN is_{d} THEN 1.0 ELSE 0.0 END)::DOUBLE AS {d}_device" for d in DEVICE_TYPES]
    + [f"sum(CASE WHEN lower(device_brand) = '{b}' THEN 1.0 ELSE 0.0 END)::DOUBLE AS {b}_device_brand" for b in BRANDS]
) + " FROM dim_browsers JOIN dim_browser_users USING (browser_id, date) GROUP BY 1, 2"
for _p, _id in (("u", "user_id"), ("b", "browser_id")):
    _devices = f"LEFT JOIN u_devices USING ({_id}, date)" if _p == "u" else ""
    TABLES[f"{_p}_dense"] = f"""
        SELECT s.{_id}, s.date, d.date AS date_w_gaps, d.* EXCLUDE (date, {_id}),
          p.* EXCLUDE (date, {_id}), c.* EXCLUDE (date, {_id})
          {', v.* EXCLUDE (date, user_id)' if _p == 'u' else ''}
        FROM {_p}_spine s LEFT JOIN {_p}_input d ON s.{_id} = d.{_id} AND s.date = d.date
        LEFT JOIN {_p}_pivot_mediums p ON s.{_id} = p.{_id} AND s.date = p.date
        LEFT JOIN {_p}_pivot_categories c ON s.{_id} = c.{_id} AND s.date = c.date
        {f'LEFT JOIN u_devices v ON s.{_id} = v.{_id} AND s.date = v.date' if _p == 'u' else ''}"""

_SQL_AGG = {"avg": "avg", "count": "sum", "min": "min", "max": "max"}


#: Frames of the windows the queries use, written out so that the oracles do not share a
#: definition with the plans: rows before the current one, first and last.
_FRAMES = {
    (5, "_first_window_half"): "2 PRECEDING AND CURRENT ROW",
    (5, "_last_window_half"): "5 PRECEDING AND 1 PRECEDING",
    (5, ""): "5 PRECEDING AND CURRENT ROW",
    (7, "_first_window_half"): "4 PRECEDING AND CURRENT ROW",
    (7, "_last_window_half"): "7 PRECEDING AND 3 PRECEDING",
    (7, ""): "7 PRECEDING AND CURRENT ROW",
    (30, "_first_window_half"): "15 PRECEDING AND CURRENT ROW",
    (30, "_last_window_half"): "30 PRECEDING AND 15 PRECEDING",
    (30, ""): "30 PRECEDING AND CURRENT ROW",
}


def _frame(id_col: str, n: int, suffix: str) -> str:
    return f"(PARTITION BY {id_col} ORDER BY date ROWS BETWEEN {_FRAMES[n, suffix]})"


def rolled_sql(prefix: str, n: int, aliases=("avg",), dense: str | None = None) -> str:
    """Row frames over the explicit spine, the definition the Spark plan is checked against."""
    spec = SPECS[prefix]
    id_col = spec.id_column
    columns = []
    for suffix in WINDOW_SUFFIXES:
        over = f"OVER {_frame(id_col, n, suffix)}"
        for alias in aliases:
            agg = _SQL_AGG[alias]
            for stem, source in spec.rolled_sources().items():
                columns.append(f"{agg}({source}) {over} AS {stem}_{alias}{suffix}")
            for i in WEEKDAYS:
                columns.append(f"{agg}(CASE WHEN dayofweek(date) = {i} THEN 1 ELSE 0 END) {over} AS dow_{i}_{alias}{suffix}")
        columns.append(f"sum(CASE WHEN date_w_gaps IS NULL THEN 0 ELSE 1 END) {over} AS days_active_count{suffix}")
    full = f"OVER {_frame(id_col, n, '')}"
    columns.append(f"date_diff('day', max(date_w_gaps) {full}, date)::INT AS days_since_last_active")
    if prefix == "u":
        names = [f"{d}_device" for d in DEVICE_TYPES] + [f"{b}_device_brand" for b in BRANDS]
        columns += [f"sum({c}) {full} AS {c}_sum" for c in names]
    return f"SELECT {id_col}, date, pageviews, {', '.join(columns)} FROM {dense or prefix + '_dense'}"


def profile_sql(prefix: str, rolled: str, extra: str, source: str, where: str) -> str:
    spec = SPECS[prefix]
    ratios = ", ".join(
        f"coalesce({d.numerator}{s} / NULLIF({d.denominator}{s}, 0), 0.0) AS {d.name}{s}"
        for d in spec.derived()
        for s in WINDOW_SUFFIXES
    )
    stems = spec.windowed_stems()
    changes = ", ".join(
        f"""round(CASE WHEN {s}{OLDER_HALF} = 0 THEN -1.0 WHEN {s}{RECENT_HALF} = 0 THEN 1.0
            ELSE {s}{OLDER_HALF} / NULLIF({s}{RECENT_HALF}, 0) END::DOUBLE, 6) AS {change_column(s)}"""
        for s in stems
    )
    values = ", ".join(f"round({s}{w}::DOUBLE, 6) AS {s}{w}" for s in stems for w in WINDOW_SUFFIXES)
    sums = "" if prefix == "b" else ", ".join(
        f"{c}_sum" for c in [f"{d}_device" for d in DEVICE_TYPES] + [f"{b}_device_brand" for b in BRANDS]
    ) + ","
    return f"""
    SELECT {spec.id_column}, date, (dayofweek(date) + 1)::VARCHAR AS day_of_week,
      coalesce(pageviews > 0, FALSE) AS is_active_on_date, {extra} days_since_last_active,
      {sums} {values}, {changes}
    FROM (SELECT *, {ratios} FROM {rolled}) {source} WHERE {where}"""


_STATUSES = ", ".join(f"'{s}'" for s in ACCEPTED_STATUSES)
TABLES["agg_days"] = f"SELECT unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY))::DATE AS date"
TABLES["expiring"] = f"""
    SELECT date, CAST(user_id AS VARCHAR) AS user_id, max(CAST(end_time AS DATE)) AS outcome_date FROM (
      SELECT d.date, s.user_id, s.start_time, s.end_time FROM agg_days d
      JOIN fx_subscriptions s ON date_diff('day', d.date, s.end_time::DATE) BETWEEN 1 AND 33
      WHERE s.id IN (SELECT subscription_id FROM fx_payments WHERE status IN ({_STATUSES}))) r
    WHERE NOT EXISTS (SELECT 1 FROM fx_subscriptions x WHERE x.user_id = r.user_id
      AND x.start_time > r.start_time AND x.start_time <= r.end_time AND x.start_time <= r.date)
    GROUP BY 1, 2"""
TABLES["u_rolled"] = rolled_sql("u", USER_WINDOW)
TABLES["b_rolled"] = rolled_sql("b", BROWSER_WINDOW)
TABLES["u_profile"] = profile_sql(
    "u", "u_rolled", "outcome_date,", "JOIN expiring USING (user_id, date)", "days_active_count > 0"
)
TABLES["b_profile"] = profile_sql(
    "b", "b_rolled",
    "coalesce(device_brand, 'Desktop') AS device, browser_family AS browser, os_family AS os, "
    "is_desktop, is_mobile, is_tablet,",
    "LEFT JOIN dim_browsers USING (browser_id, date)", "pageviews > 0",
)


# ---- inputs ------------------------------------------------------------------------------------
def expiring(spark, sf, start=FIRST_DAY, end=LAST_DAY):
    return outcomes.expiring_users(
        load(spark, sf, "fx_subscriptions"), load(spark, sf, "fx_payments"), start, end
    )


def long_table(spark, sf, id_col, key):
    return daily.key_counts(pageviews(spark, sf), id_col, key)


#: Brand lists already read, by application and input.
_FOUND: dict[tuple[str, str], list[str]] = {}


def brands_of(spark, sf) -> list[str]:
    """Device brands that occur in the period; they name columns, so they are read beforehand."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOUND:
        seen = daily.device_brands(daily.browsers_dim(pageviews(spark, sf)), LAST_DAY)
        _FOUND[key] = sorted(r["device_brand"] for r in seen.where("device_brand is not null").collect())
    return _FOUND[key]


def devices_of_users(spark, sf):
    return profiles.devices_by_user(daily.agents_of_users(pageviews(spark, sf)), brands_of(spark, sf))


def user_profile(spark, sf, start=FIRST_DAY, end=LAST_DAY, n=USER_WINDOW, spine_start=FIRST_DAY, points=None):
    """``points`` are the stored expiring users, if there are any yet."""
    counts = daily.log_counts(pageviews(spark, sf), "user_id", load(spark, sf, "fx_timespent"))
    if points is None:
        points = sinks.stored(expiring(spark, sf, start, end), scratch_dir(spark, "expiring"))
    return profiles.user_profile_of_log(
        counts, points, start, end, n, devices_of_users(spark, sf), spec=SPECS["u"], spine_start=spine_start
    )


def browser_profile(spark, sf, start=FIRST_DAY, end=LAST_DAY, n=BROWSER_WINDOW):
    views = pageviews(spark, sf)
    counts = daily.log_counts(views, "browser_id", load(spark, sf, "fx_timespent"), load(spark, sf, "fx_commerce"))
    return profiles.browser_profile_of_log(
        counts, daily.browsers_dim(views), start, end, n, spec=SPECS["b"], spine_start=FIRST_DAY
    )


def spined(spark, sf):
    days = profiles.window_input(user_day_table(spark, sf), "user_id", FIRST_DAY, LAST_DAY, 0)
    spine = date_spine(days, "user_id", FIRST_DAY, LAST_DAY)
    return spine_join(spine, days, "user_id")


# ---- queries -----------------------------------------------------------------------------------
@query("expiring_users", "SELECT * FROM expiring")
def expiring_users(spark, sf):
    return expiring(spark, sf)


@query("user_rolling", "SELECT * FROM u_profile")
def user_rolling(spark, sf):
    return rounded(user_profile(spark, sf))


@query("user_rolling_one_day", f"SELECT * FROM u_profile WHERE date = DATE '{LAST_DAY}'")
def user_rolling_one_day(spark, sf):
    return rounded(user_profile(spark, sf, LAST_DAY, LAST_DAY))


@query("browser_rolling", "SELECT * FROM b_profile")
def browser_rolling(spark, sf):
    return rounded(browser_profile(spark, sf))


@query("window_input", "SELECT * FROM u_input")
def window_input(spark, sf):
    return profiles.window_input(user_day_table(spark, sf), "user_id", FIRST_DAY, LAST_DAY, USER_WINDOW)


@query("date_spine", "SELECT * FROM u_spine")
def spine(spark, sf):
    views = daily.subscriber_views(pageviews(spark, sf))
    return date_spine(views, "user_id", FIRST_DAY, LAST_DAY)


@query(
    "spine_join",
    """SELECT user_id, date, date_w_gaps, (dayofweek(date) + 1)::VARCHAR AS day_of_week,
    pageviews > 0 AS is_active_on_date, pageviews, timespent, sessions, sessions_without_ref FROM u_dense""",
)
def spine_join_query(spark, sf):
    return spined(spark, sf).select(
        "user_id", "date", "date_w_gaps", "day_of_week", "is_active_on_date", *profiles.MEASURES
    )


@query(
    "profile_pivot",
    "SELECT * FROM u_pivot_categories JOIN u_pivot_mediums USING (user_id, date)",
)
def pivot_query(spark, sf):
    categories = profile_pivot(
        long_table(spark, sf, "user_id", "categories"), "user_id", "categories", CATEGORIES
    )
    mediums = profile_pivot(
        long_table(spark, sf, "user_id", "referer_mediums"), "user_id", "referer_mediums", REFERER_MEDIUMS
    )
    return categories.join(mediums, ["user_id", "date"])


_ROLL = {"pageviews": "pageviews", "timespent": "timespent"}
_ROLL_SQL = ", ".join(
    f"round(({agg}({c}) OVER {_frame('user_id', n, s)})::DOUBLE, 6) AS {c}_{a}{s}"
    for n in (5,)
    for a, agg in _SQL_AGG.items()
    for c in _ROLL
    for s in WINDOW_SUFFIXES
)


@query("rolling_windows", f"SELECT user_id, date, {_ROLL_SQL} FROM u_dense")
def rolling_windows(spark, sf):
    rolled = rolling_features(spined(spark, sf), "user_id", 5, _ROLL, AGGREGATES)
    names = [f"{c}_{a}{s}" for a in _SQL_AGG for c in _ROLL for s in WINDOW_SUFFIXES]
    return rounded(rolled.select("user_id", "date", *names))


def _active_rolled(spark, sf, n=BROWSER_WINDOW):
    active = F.col("date_w_gaps").isNotNull()
    return rolling_features(
        spined(spark, sf), "user_id", n, {"pageviews": "pageviews"}, active=active, spine_start=FIRST_DAY
    )


_ACTIVE_SQL = ", ".join(
    f"sum(CASE WHEN date_w_gaps IS NULL THEN 0 ELSE 1 END) OVER {_frame('user_id', 7, s)}::DOUBLE AS days_active_count{s}"
    .replace(")::DOUBLE AS", ") AS")
    for s in WINDOW_SUFFIXES
)


@query(
    "days_active",
    "SELECT user_id, date, "
    + ", ".join(f"days_active_count{s}::DOUBLE AS days_active_count{s}" for s in WINDOW_SUFFIXES)
    + f" FROM (SELECT user_id, date, {_ACTIVE_SQL} FROM u_dense)",
)
def days_active(spark, sf):
    names = [f"days_active_count{s}" for s in WINDOW_SUFFIXES]
    return _active_rolled(spark, sf).select("user_id", "date", *names)


@query(
    "days_since_last_active",
    f"""SELECT user_id, date, date_diff('day', max(date_w_gaps) OVER {_frame('user_id', 7, '')}, date)::INT
    AS days_since_last_active FROM u_dense""",
)
def days_since_last_active(spark, sf):
    return _active_rolled(spark, sf).select("user_id", "date", "days_since_last_active")


_DEVICE_COLUMNS = [f"{d}_device" for d in DEVICE_TYPES] + [f"{b}_device_brand" for b in BRANDS]


@query("user_devices", "SELECT * FROM u_devices")
def user_devices(spark, sf):
    return devices_of_users(spark, sf)


@query(
    "device_rolling",
    "SELECT user_id, date, "
    + ", ".join(f"sum({c}) OVER {_frame('user_id', 7, '')} AS {c}_sum" for c in _DEVICE_COLUMNS)
    + " FROM u_dense",
)
def device_rolling(spark, sf):
    views = pageviews(spark, sf)
    days = daily.subscriber_views(views)
    spine_rows = date_spine(days, "user_id", FIRST_DAY, LAST_DAY)
    joined = spine_rows.join(devices_of_users(spark, sf), ["user_id", "date"], "left")
    sums = {f"{c}_sum": c for c in joined.columns if c not in ("user_id", "date")}
    rolled = rolling_features(joined, "user_id", 7, {}, sums=sums)
    return rolled.select("user_id", "date", *sums)


_METRIC_COLUMNS = [d.name + s for d in SPECS["b"].derived() for s in WINDOW_SUFFIXES]


@query("derived_metrics", f"SELECT browser_id, date, {', '.join(_METRIC_COLUMNS)} FROM b_profile")
def derived_metrics(spark, sf):
    return rounded(browser_profile(spark, sf).select("browser_id", "date", *_METRIC_COLUMNS))


_CHANGE_COLUMNS = [change_column(s) for s in SPECS["b"].windowed_stems()]


@query("half_change", f"SELECT browser_id, date, {', '.join(_CHANGE_COLUMNS)} FROM b_profile")
def half_change(spark, sf):
    return rounded(browser_profile(spark, sf).select("browser_id", "date", *_CHANGE_COLUMNS))


@query(
    "expiring_user_days",
    """SELECT e.date AS profile_date, d.date, d.user_id, d.pageviews, e.outcome_date
    FROM u_days d JOIN expiring e ON d.user_id = e.user_id AND d.date BETWEEN e.date - 30 AND e.date""",
)
def expiring_user_days(spark, sf):
    days = profiles.window_input(user_day_table(spark, sf), "user_id", FIRST_DAY, LAST_DAY, USER_WINDOW)
    rows = profiles.expiring_user_days(days, expiring(spark, sf), USER_WINDOW)
    return rows.select("profile_date", "date", "user_id", "pageviews", "outcome_date")


@query(
    "latest_device",
    """SELECT browser_id, date, coalesce(device_brand, 'Desktop') AS device, browser_family AS browser,
    os_family AS os, is_desktop, is_mobile, is_tablet FROM dim_browsers
    QUALIFY row_number() OVER (PARTITION BY browser_id ORDER BY date DESC) = 1""",
)
def latest_device(spark, sf):
    return profiles.latest_device(daily.browsers_dim(pageviews(spark, sf)))


# ---- outcomes ----------------------------------------------------------------------------------
TABLES["churn_days"] = """
    SELECT user_id, CAST(time AS DATE) AS event_date,
      CASE WHEN bool_or(type = 'churn') THEN 'churn' ELSE 'renewal' END AS outcome
    FROM all_events WHERE type IN ('churn', 'renewal') GROUP BY 1, 2"""
TABLES["u_outcome"] = """
    SELECT f.* EXCLUDE (outcome_date), e.outcome, coalesce(e.event_date, f.outcome_date) AS outcome_date
    FROM u_profile f LEFT JOIN churn_days e
      ON f.user_id = e.user_id AND e.event_date > f.date AND e.event_date <= f.date + 33"""
TABLES["b_outcome"] = """
    SELECT f.*, f.date + 1 AS outcome_date, CASE WHEN e.type IN ('conversion', 'shared_account_login')
      THEN e.type ELSE 'no_conversion' END AS outcome
    FROM b_profile f LEFT JOIN all_events e ON f.browser_id = e.browser_id
      AND f.date >= CAST(e.time AS DATE) - 1 AND f.date < CAST(e.time AS DATE)"""
TABLES["login_counts"] = """
    SELECT d.date, e.browser_id, count(*) AS shared_account_logins_past_30_days
    FROM agg_days d JOIN all_events e ON e.type = 'shared_account_login'
      AND CAST(e.time AS DATE) <= d.date AND CAST(e.time AS DATE) >= d.date - 30
    GROUP BY 1, 2"""


def user_outcomes(spark, sf, points=None, start=FIRST_DAY, end=LAST_DAY):
    return outcomes.churn_outcome(user_profile(spark, sf, start, end, points=points), event_table(spark, sf))


def browser_outcomes(spark, sf):
    events = event_table(spark, sf)
    labelled = outcomes.conversion_outcome(browser_profile(spark, sf), events)
    return outcomes.with_shared_logins(labelled, events)


@query("churn_outcome", "SELECT * FROM u_outcome")
def churn_outcome(spark, sf):
    return rounded(user_outcomes(spark, sf))


@query("conversion_outcome", "SELECT * FROM b_outcome")
def conversion_outcome(spark, sf):
    return rounded(outcomes.conversion_outcome(browser_profile(spark, sf), event_table(spark, sf)))


@query(
    "shared_login_count",
    """SELECT b.browser_id, b.date, c.shared_account_logins_past_30_days::BIGINT AS shared_account_logins_past_30_days
    FROM b_days b LEFT JOIN login_counts c ON b.browser_id = c.browser_id AND b.date = c.date""",
)
def shared_login_count(spark, sf):
    rows = daily.visitor_views(pageviews(spark, sf)).select("browser_id", "date").distinct()
    return outcomes.with_shared_logins(rows, event_table(spark, sf))
