"""Rolling reader profiles: day tables to one wide feature row per id and day.

Everything that belongs to one (id, day) is *stacked* instead of joined: day rows, long category
and medium rows, device rows and the points to evaluate are unioned, partitioned by id once, and
reduced with conditional sums.  Rolling frames need the same partitioning by id, so the whole
profile, for any number of days at once, costs one shuffle.  Day tables hold at most one row per
id, day and listed key, which bounds the rows of an id by the length of the period.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.calendar import day_number
from presslens.functions.flags import is_true
from presslens.functions.labels import COMMERCE_STEPS
from presslens.functions.text import name, ratio, relative_change
from presslens.operators.joins import range_left_join
from presslens.operators.latest import latest_by
from presslens.operators.pivot import key_sums
from presslens.operators.rolling import (
    DEFAULT_AGGREGATES,
    Rolled,
    point_features,
    rolling_features,
)
from presslens.spec import (
    DEVICE_TYPES,
    HOUR_RANGES,
    OLDER_HALF,
    RECENT_HALF,
    WINDOW_SUFFIXES,
    FeatureSpec,
    change_column,
    range_column,
    sanitize,
)

MEASURES = ("pageviews", "timespent", "sessions", "sessions_without_ref")
COMMERCE_MEASURES = ("commerce_checkouts", "commerce_payments")


def _date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def window_input(
    days: DataFrame, id_col: str, start: dt.date | str, end: dt.date | str, n: int
) -> DataFrame:
    """The columns a profile needs for days ``[start - n, end]``, four-hour counts renamed.

    A projection and a range on the partition column: both reach the scan.
    """
    extra = COMMERCE_MEASURES if id_col == "browser_id" else ()
    ranges = [F.col(range_column(a, b)).alias(range_column(a, b, "pvs")) for a, b in HOUR_RANGES]
    period = F.col("date").between(F.date_sub(_date(start), n), _date(end))
    return days.where(period).select("date", id_col, *MEASURES, *extra, *ranges)


def expiring_user_days(days: DataFrame, expiring: DataFrame, n: int) -> DataFrame:
    """Day rows of each expiring user within the window of its profile day, with the outcome date."""
    points = expiring.select(F.col("date").alias("profile_date"), "user_id", "outcome_date")
    inside = F.col("r.date").between(F.date_sub("l.profile_date", n), F.col("l.profile_date"))
    looked = points.withColumn("__from", F.date_sub("profile_date", n))
    joined = range_left_join(looked, days, ["user_id"], "__from", "date", n, inside)
    kept = [F.col(f"r.{c}") for c in days.columns]
    return joined.where(F.col("r.date").isNotNull()).select(*kept, "l.profile_date", "l.outcome_date")


def user_devices(
    browsers: DataFrame, browser_users: DataFrame, brands: Sequence[str] = ()
) -> DataFrame:
    """Browsers per device type and brand for each (user, day)."""
    return devices_by_user(browsers.join(browser_users, ["browser_id", "date"]), brands)


def devices_by_user(used: DataFrame, brands: Sequence[str] = ()) -> DataFrame:
    """The same from rows of (user, browser, day) that carry the device fields."""

    def hits(test: Column, name: str) -> Column:
        return F.sum(F.when(test, 1.0).otherwise(0.0)).alias(name)

    used = used.select(
        "user_id", "date", F.lower("device_brand").alias("brand"),
        *[is_true(F.col(f"is_{d}")).alias(f"is_{d}") for d in DEVICE_TYPES],
    )
    return used.groupBy("user_id", "date").agg(
        *[hits(F.col(f"is_{d}"), f"{d}_device") for d in DEVICE_TYPES],
        *[hits(F.col("brand") == b, f"{sanitize(b)}_device_brand") for b in brands],
    )


def browser_devices(browsers: DataFrame) -> DataFrame:
    """Device description of each (browser, day); an unknown brand is a Desktop."""
    return browsers.select(
        "browser_id",
        "date",
        F.coalesce("device_brand", F.lit("Desktop")).alias("device"),
        F.col("browser_family").alias("browser"),
        F.col("os_family").alias("os"),
        *[F.col(f"is_{d}") for d in DEVICE_TYPES],
    )


def latest_device(browsers: DataFrame) -> DataFrame:
    """Device description of each browser on its last day."""
    rows = browser_devices(browsers)
    values = [c for c in rows.columns if c != "browser_id"]
    return latest_by(rows, ["browser_id"], F.col("date"), values)


def stack_days(
    days: DataFrame,
    id_col: str,
    pivots: Mapping[str, tuple[DataFrame, Sequence[str]]],
    devices: DataFrame | None = None,
    points: DataFrame | None = None,
) -> DataFrame:
    """One row per (id, date) from all inputs.

    ``pivots`` maps a key column to its long table and the listed keys.  Pivot columns are null on
    days without any row of that table and 0 for listed keys that do not occur.  ``is_point`` marks
    (id, date) pairs of ``points``.
    """
    measures = [c for c in days.columns if c not in (id_col, "date")]
    stacked = days.withColumn("__kind", F.lit("day"))
    for key_col, (table, _) in pivots.items():
        long = table.select(
            id_col, "date", F.col(key_col).alias("__key"), F.col("pageviews").alias("__views"),
            F.lit(key_col).alias("__kind"),
        )
        stacked = stacked.unionByName(long, allowMissingColumns=True)
    device_columns: list[str] = []
    if devices is not None:
        device_columns = [c for c in devices.columns if c not in (id_col, "date")]
        stacked = stacked.unionByName(
            devices.withColumn("__kind", F.lit("device")), allowMissingColumns=True
        )
    if points is not None:
        stacked = stacked.unionByName(
            points.withColumn("__kind", F.lit("point")), allowMissingColumns=True
        )
    kind = F.col("__kind")
    aggs = [F.sum(c).alias(c) for c in (*measures, *device_columns)]
    for key_col, (_, keys) in pivots.items():
        aggs += key_sums("__key", "__views", keys, key_col, where=f"__kind = '{key_col}'")
    aggs.append(F.max(kind == "day").alias("has_activity"))
    if points is not None:
        aggs.append(F.max(kind != "point").alias("has_data"))
        aggs.append(F.max(kind == "point").alias("is_point"))
        extra = [c for c in points.columns if c not in (id_col, "date")]
        aggs += [F.max(c).alias(c) for c in extra]
    # One exchange by id serves this sum and the frames below; adaptive execution chooses the
    # number of partitions.  An (id, day) has at most a row per listed key, so combining before the
    # exchange would save less than the second exchange that it needs.
    return stacked.repartition(id_col).groupBy(id_col, "date").agg(*aggs)


def stack_counts(
    counts: DataFrame,
    id_col: str,
    pivots: Mapping[str, Sequence[str]],
    devices: DataFrame | None = None,
    points: DataFrame | None = None,
) -> DataFrame:
    """What ``stack_days`` returns, straight from ``daily.log_counts``.

    The counts are long already, so day measures, pivots, seconds and commerce steps are conditional sums
    over one frame.  With ``points`` only their ids are kept, by one semi-join over everything.
    """
    stacked, device_columns, extra = counts, [], []
    if devices is not None:
        device_columns = [c for c in devices.columns if c not in (id_col, "date")]
        stacked = stacked.unionByName(devices.withColumn("facet", F.lit("device")), allowMissingColumns=True)
    if points is not None:
        extra = [c for c in points.columns if c not in (id_col, "date")]
        stacked = stacked.join(points.select(id_col).distinct(), id_col, "left_semi")
        stacked = stacked.unionByName(points.withColumn("facet", F.lit("point")), allowMissingColumns=True)

    def views(facet: str, test: str = "TRUE") -> str:
        return f"sum(CASE WHEN facet = '{facet}' THEN CASE WHEN {test} THEN pageviews ELSE 0 END END)"

    # Seconds and steps of days without a pageview do not count, nor do they make a row.
    active = "max(facet = 'hours')"
    measures = {
        "timespent": f"coalesce({views('timespent')}, 0)",
        "sessions": "count_if(facet = 'sessions')",
        "sessions_without_ref": "count_if(facet = 'sessions' AND is_direct)",
    }
    if id_col == "browser_id":
        steps = zip(COMMERCE_MEASURES, COMMERCE_STEPS[:2], strict=True)
        measures |= {c: f"coalesce({views('commerce', f"key = '{step}'")}, 0)" for c, step in steps}
    aggs = [F.expr(f"{views('hours')} AS pageviews")]
    aggs += [F.expr(f"CASE WHEN {active} THEN {sql} END AS {c}") for c, sql in measures.items()]
    for a, b in HOUR_RANGES:
        hours = ", ".join(f"'{h}'" for h in range(a, b))
        aggs.append(F.expr(f"{views('hours', f'key IN ({hours})')} AS {range_column(a, b, 'pvs')}"))
    for key_col, keys in pivots.items():
        aggs += key_sums("key", "pageviews", keys, key_col, where=f"facet = '{key_col}'")
    aggs += [F.sum(c).alias(c) for c in device_columns]
    aggs.append(F.expr(f"{active} AS has_activity"))
    aggs.append(F.expr("max(facet NOT IN ('point', 'timespent', 'commerce')) AS has_data"))
    if points is not None:
        aggs.append(F.expr("max(facet = 'point') AS is_point"))
        aggs += [F.max(c).alias(c) for c in extra]
    rows = stacked.repartition(id_col).groupBy(id_col, "date").agg(*aggs)
    return rows.where("has_data OR is_point" if points is not None else "has_data")


def derived_metrics(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Ratios of rolled columns for the full window and both halves, 0 where undefined."""
    ratios = [
        f"{ratio(d.numerator + s, d.denominator + s)} AS {name(d.name + s)}"
        for d in spec.derived()
        for s in WINDOW_SUFFIXES
    ]
    return df.selectExpr("*", *ratios)


def half_change(df: DataFrame, stems: Sequence[str]) -> DataFrame:
    """Change between the window halves for each stem that has both."""
    present = set(df.columns)
    changes = [
        f"{relative_change(s + OLDER_HALF, s + RECENT_HALF)} AS {name(change_column(s))}"
        for s in stems
        if s + OLDER_HALF in present and s + RECENT_HALF in present
    ]
    return df.selectExpr("*", *changes)


def _finish(rolled: DataFrame, spec: FeatureSpec) -> DataFrame:
    full = half_change(derived_metrics(rolled, spec), spec.windowed_stems())
    return full.withColumns(
        {
            "day_of_week": F.dayofweek("date").cast("string"),
            "is_active_on_date": F.coalesce(F.col("pageviews") > 0, F.lit(False)),
        }
    )


def _long_tables(spec, mediums, categories, start, end, n):
    def part(table: DataFrame, key: str, keys: Sequence[str]):
        period = F.col("date").between(F.date_sub(_date(start), n), _date(end))
        return table.where(period), keys

    return {
        "referer_mediums": part(mediums, "referer_mediums", spec.mediums),
        "categories": part(categories, "categories", spec.categories),
    }


def user_profile(
    days: DataFrame,
    mediums: DataFrame,
    categories: DataFrame,
    expiring: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    n: int = 30,
    devices: DataFrame | None = None,
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    spec: FeatureSpec | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
) -> DataFrame:
    """Features of every expiring user with activity in the window, for all days of a period.

    ``expiring`` holds (date, user_id, outcome_date).  A single day is computed without windows.
    """
    spec = spec or FeatureSpec("user", tuple(aggs))
    points = expiring.where(F.col("date").between(_date(start), _date(end)))
    wanted = points.select("user_id").distinct()
    rows = window_input(days, "user_id", start, end, n).join(wanted, "user_id", "left_semi")
    pivots = {
        key: (table.join(wanted, "user_id", "left_semi"), keys)
        for key, (table, keys) in _long_tables(spec, mediums, categories, start, end, n).items()
    }
    sums: dict[str, str] = {}
    if devices is not None:
        period = F.col("date").between(F.date_sub(_date(start), n), _date(end))
        devices = devices.where(period).join(wanted, "user_id", "left_semi")
        sums = {f"{c}_sum": c for c in devices.columns if c not in ("user_id", "date")}
    stacked = stack_days(rows, "user_id", pivots, devices, points)
    return _user_features(stacked, spec, start, end, n, sums, aggs, dow_base, spine_start)


def user_profile_of_log(
    counts: DataFrame,
    expiring: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    n: int = 30,
    devices: DataFrame | None = None,
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    spec: FeatureSpec | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
) -> DataFrame:
    """``user_profile`` from the counts of the logs instead of day tables.

    ``expiring`` is read twice, so it should be stored or cheap.
    """
    spec = spec or FeatureSpec("user", tuple(aggs))
    period = F.col("date").between(F.date_sub(_date(start), n), _date(end))
    sums: dict[str, str] = {}
    if devices is not None:
        devices = devices.where(period)
        sums = {f"{c}_sum": c for c in devices.columns if c not in ("user_id", "date")}
    points = expiring.where(F.col("date").between(_date(start), _date(end)))
    stacked = stack_counts(counts.where(period), "user_id", _pivots(spec), devices, points)
    return _user_features(stacked, spec, start, end, n, sums, aggs, dow_base, spine_start)


def _pivots(spec: FeatureSpec) -> dict[str, Sequence[str]]:
    return {"referer_mediums": spec.mediums, "categories": spec.categories}


def _user_features(stacked, spec, start, end, n, sums, aggs, dow_base, spine_start) -> DataFrame:
    rolled = _roll(stacked, "user_id", start, end, n, spec, aggs, sums, dow_base, spine_start)
    rolled = rolled.where(F.col("is_point") & (F.col("days_active_count") > 0))
    return _tidy(_finish(rolled, spec), spec, ["outcome_date"])


def browser_profile(
    days: DataFrame,
    mediums: DataFrame,
    categories: DataFrame,
    browsers: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    n: int = 30,
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    spec: FeatureSpec | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
) -> DataFrame:
    """Features of every browser with pageviews on the day, for all days of a period."""
    spec = spec or FeatureSpec("browser", tuple(aggs))
    rows = window_input(days, "browser_id", start, end, n)
    pivots = _long_tables(spec, mediums, categories, start, end, n)
    stacked = stack_days(rows, "browser_id", pivots)
    return _browser_features(stacked, browsers, spec, start, end, n, aggs, dow_base, spine_start)


def browser_profile_of_log(
    counts: DataFrame,
    browsers: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    n: int = 30,
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    spec: FeatureSpec | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
) -> DataFrame:
    """``browser_profile`` from the counts of the logs instead of day tables."""
    spec = spec or FeatureSpec("browser", tuple(aggs))
    period = F.col("date").between(F.date_sub(_date(start), n), _date(end))
    stacked = stack_counts(counts.where(period), "browser_id", _pivots(spec))
    return _browser_features(stacked, browsers, spec, start, end, n, aggs, dow_base, spine_start)


def _browser_features(stacked, browsers, spec, start, end, n, aggs, dow_base, spine_start) -> DataFrame:
    rolled = _roll(stacked, "browser_id", start, end, n, spec, aggs, {}, dow_base, spine_start)
    rolled = rolled.where(F.col("pageviews") > 0)
    devices = browser_devices(browsers).where(F.col("date").between(_date(start), _date(end)))
    full = _finish(rolled, spec).join(devices, ["browser_id", "date"], "left")
    return _tidy(full, spec, ["device", "browser", "os", *[f"is_{d}" for d in DEVICE_TYPES]])


def _roll(stacked, id_col, start, end, n, spec, aggs, sums, dow_base, spine_start) -> DataFrame:
    active = F.col("has_activity")
    if str(start) == str(end):
        today = [c for c in ("pageviews", "is_point", "outcome_date") if c in stacked.columns]
        return point_features(
            stacked, id_col, end, n, spec.rolled_sources(), aggs, sums, active, dow_base,
            spine_start, today,
        )
    if "is_point" in stacked.columns:
        stacked = _reachable(stacked, id_col, n)
    rolled = rolling_features(
        stacked, id_col, n, spec.rolled_sources(), aggs, sums, active, dow_base, spine_start
    )
    return rolled.where(F.col("date").between(_date(start), _date(end)))


def _reachable(stacked: DataFrame, id_col: str, n: int) -> DataFrame:
    """Drop bare points without activity in their window before the wide frames are computed.

    Partitioning and order are those of the frames, so this costs one narrow pass and no sort.
    """
    past = Window.partitionBy(id_col).orderBy("__day").rangeBetween(-n, 0)
    keyed = stacked.withColumn("__day", day_number(F.col("date")))
    recent = keyed.withColumn("__recent", F.max("has_activity").over(past))
    return recent.where(F.col("has_data") | F.col("__recent")).drop("__day", "__recent")


def _tidy(df: DataFrame, spec: FeatureSpec, extra: Sequence[str]) -> DataFrame:
    head = [spec.id_column, "date", "day_of_week", "is_active_on_date", *extra]
    features = [f"{stem}{suffix}" for stem in spec.windowed_stems() for suffix in WINDOW_SUFFIXES]
    features += [change_column(stem) for stem in spec.windowed_stems()]
    sums = [c for c in df.columns if c.endswith(("_device_sum", "_device_brand_sum"))]
    return df.selectExpr(*map(name, [*head, "days_since_last_active", *sums, *features]))
