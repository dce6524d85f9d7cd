"""Rolling frames against explicit loops; one pass over many days against single days."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslens.functions.calendar import weekday_flag
from presslens.functions.text import weekdays_between
from presslens.operators.rolling import AGGREGATES, frames, point_features, rolling_features
from presslens.operators.spine import date_spine, spine_join
from presslens.plans import profiles
from presslens.spec import FULL, OLDER_HALF, RECENT_HALF, FeatureSpec

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i - 1)


def test_frames_as_defined():
    assert frames(7) == {RECENT_HALF: (-4, 0), OLDER_HALF: (-7, -3), FULL: (-7, 0)}
    assert frames(30) == {RECENT_HALF: (-15, 0), OLDER_HALF: (-30, -15), FULL: (-30, 0)}
    assert frames(5) == {RECENT_HALF: (-2, 0), OLDER_HALF: (-5, -1), FULL: (-5, 0)}
    with pytest.raises(ValueError):
        frames(1)


@pytest.fixture(scope="module")
def activity():
    rng = random.Random(11)
    return [(u, day(i), rng.randrange(0, 9)) for u in "abc" for i in range(1, 21) if rng.random() < 0.4]


AGG = {"count": sum, "avg": lambda v: sum(v) / len(v), "min": min, "max": max}


@pytest.mark.parametrize("n", [5, 7, 10])
def test_sparse_frames_equal_loops(spark, activity, n):
    df = spark.createDataFrame(activity, "user_id string, date date, pv int")
    got = rolling_features(df, "user_id", n, {"p": "pv"}, AGGREGATES, spine_start=D0).collect()
    values = {(u, d): v for u, d, v in activity}
    for row in got:
        for suffix, (low, high) in frames(n).items():
            days = [row.date + dt.timedelta(days=k) for k in range(low, high + 1)]
            days = [d for d in days if d >= D0]
            found = [values[row.user_id, d] for d in days if (row.user_id, d) in values]
            for alias, f in AGG.items():
                assert row[f"p_{alias}{suffix}"] == (f(found) if found else None)
                flags = [int(d.isoweekday() % 7 == 3) for d in days]
                want = f(flags) if flags else None
                assert row[f"dow_3_{alias}{suffix}"] == (pytest.approx(want) if days else None)
            assert row[f"days_active_count{suffix}"] == (len(found) if days else None)
        assert row.days_since_last_active == 0


@pytest.mark.parametrize("n", [5, 7])
def test_sparse_equals_dense_and_point(spark, activity, n):
    df = spark.createDataFrame(activity, "user_id string, date date, pv int").withColumnRenamed("pv", "pageviews")
    dense = spine_join(date_spine(df, "user_id", D0, day(20)), df, "user_id")
    active = F.col("date_w_gaps").isNotNull()
    over_dense = rolling_features(dense, "user_id", n, {"p": "pageviews"}, active=active, spine_start=D0)
    names = ["user_id", "date", "p_avg", "p_avg_first_window_half", "p_avg_last_window_half",
             "days_active_count", "days_since_last_active", "dow_0_avg", "dow_6_avg_last_window_half"]
    sparse = rolling_features(df, "user_id", n, {"p": "pageviews"}, spine_start=D0)
    at_active = over_dense.where(active).select(names)
    assert sorted(at_active.collect()) == sorted(sparse.select(names).collect())
    for target in (day(8), day(20)):
        one = point_features(df, "user_id", target, n, {"p": "pageviews"}, spine_start=D0).select(names)
        many = over_dense.where((F.col("date") == F.lit(target)) & (F.col("days_active_count") > 0)).select(names)
        assert sorted(one.collect()) == sorted(many.collect())


def test_gap_days(spark):
    """Active on days 1 and 5: averages skip the gap, an empty half is null."""
    df = spark.createDataFrame([("u", day(1), 2), ("u", day(5), 4)], "user_id string, date date, pv int")
    (row,) = rolling_features(df, "user_id", 5, {"p": "pv"}).where(F.col("date") == F.lit(day(5))).collect()
    assert row.p_avg == 3.0 and row.p_avg_first_window_half == 4.0 and row.p_avg_last_window_half == 2.0
    (row,) = rolling_features(df, "user_id", 5, {"p": "pv"}).where(F.col("date") == F.lit(day(1))).collect()
    assert row.p_avg_last_window_half is None


@pytest.mark.parametrize("base", [0, 1])
def test_weekday_counts(spark, base):
    numbers = spark.range(19700, 19760).select(F.col("id").cast("int").alias("u"), F.expr("date_from_unix_date(CAST(id AS INT))").alias("d"))
    for index in range(7):
        flags = {r.u: r.f for r in numbers.select("u", weekday_flag(F.col("d"), index, base).alias("f")).collect()}
        counts = numbers.selectExpr("u", f"{weekdays_between('(u - 9)', 'u', index, base)} AS n").collect()
        for row in counts:
            if row.u - 9 >= 19700:
                assert row.n == sum(flags[k] for k in range(row.u - 9, row.u + 1))
    if base == 0:
        assert set(flags.values()) <= {0, 1} and weekdays_between("0", "6", 0, 0) == "0"


def test_half_change(spark):
    rows = [(0.0, 0.0), (0.0, 4.0), (3.0, 0.0), (3.0, 4.0), (None, 4.0)]
    df = spark.createDataFrame(rows, f"x{OLDER_HALF} double, x{RECENT_HALF} double")
    got = [r[0] for r in profiles.half_change(df, ["x"]).select("relative_x_change_first_and_second_half").collect()]
    assert got == [-1.0, -1.0, 1.0, 0.75, None]


def tables(spark):
    spec = FeatureSpec("user", device_brands=("apple",))
    days, long = [], []
    rng = random.Random(2)
    for u in ("1", "2", "3"):
        for i in range(1, 13):
            if rng.random() < 0.5:
                days.append((day(i), u, 3, 10, 2, 1, 1, 0, 2, 0, 0, 0))
                long.append((day(i), u, "direct", 2))
    ranges = ", ".join(f"pageviews_{a}h_{a + 4}h long" for a in range(0, 24, 4))
    days = spark.createDataFrame(
        days, f"date date, user_id string, pageviews long, timespent long, sessions long, sessions_without_ref long, {ranges}"
    )
    mediums = spark.createDataFrame(long, "date date, user_id string, referer_mediums string, pageviews long")
    categories = spark.createDataFrame([], "date date, user_id string, categories string, pageviews long")
    points = [(day(i), u, day(20)) for i in range(1, 13) for u in ("1", "2", "9")]
    expiring = spark.createDataFrame(points, "date date, user_id string, outcome_date date")
    devices = spark.createDataFrame(
        [(day(3), "1", 1.0, 0.0, 0.0, 1.0)],
        "date date, user_id string, desktop_device double, mobile_device double, tablet_device double, apple_device_brand double",
    )
    return spec, days, mediums, categories, expiring, devices


def test_user_profile_one_pass_equals_single_days(spark):
    spec, days, mediums, categories, expiring, devices = tables(spark)
    args = (days, mediums, categories, expiring)
    many = profiles.user_profile(*args, day(1), day(12), 5, devices, spec=spec, spine_start=D0)
    columns = many.columns
    singles = []
    for i in range(1, 13):
        one = profiles.user_profile(*args, day(i), day(i), 5, devices, spec=spec, spine_start=D0)
        singles += one.select(columns).collect()
    assert sorted(map(repr, many.collect())) == sorted(map(repr, singles))
    assert {r.user_id for r in singles} == {"1", "2"}
    assert all(r.outcome_date == day(20) for r in singles)


def test_pivot_null_versus_zero(spark):
    """No row of a table on any day of the window is null, a listed key that is absent is 0."""
    spec, days, mediums, categories, expiring, devices = tables(spark)
    row = profiles.user_profile(days, mediums, categories, expiring, day(12), day(12), 10, spec=spec).first()
    assert row["referer_mediums_direct_avg"] == 2.0
    assert row["referer_mediums_email_avg"] == 0.0
    assert row["categories_blog_avg"] is None


def test_profile_shuffles_once(spark):
    """Day rows and long tables meet in a single exchange by id."""
    spec, days, mediums, categories, _, _ = tables(spark)
    stacked = profiles.stack_days(
        profiles.window_input(days, "user_id", day(1), day(12), 5), "user_id",
        {"referer_mediums": (mediums, spec.mediums), "categories": (categories, spec.categories)},
    )
    rolled = rolling_features(stacked, "user_id", 5, spec.rolled_sources(), active=F.col("has_activity"))
    plan = rolled._jdf.queryExecution().sparkPlan().toString()
    executed = rolled._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange ") == 1 and "SortMergeJoin" not in plan


def test_every_brand_of_the_data_gets_a_column(spark):
    """Brands come from the data: a third one is counted like the others."""
    from presslens.plans import daily, profiles

    browsers = spark.createDataFrame(
        [(f"b{k}", "2024-01-10", brand, "true", "false", "false") for k, brand in enumerate(["Apple", "Samsung", "Nokia X", None])],
        "browser_id string, date string, device_brand string, is_mobile string, is_desktop string, is_tablet string",
    ).withColumn("date", F.to_date("date"))
    users = browsers.select("browser_id", "date", F.lit("u").alias("user_id"))
    brands = sorted(r[0] for r in daily.device_brands(browsers, "2024-01-30").where("device_brand is not null").collect())
    assert brands == ["apple", "nokia x", "samsung"]
    row = profiles.user_devices(browsers, users, brands).first()
    assert [row[f"{b}_device_brand"] for b in ("apple", "nokia_x", "samsung")] == [1.0, 1.0, 1.0]
