"""Outcome labels, subscriptions and payment history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslens.plans import context, outcomes
from presslens.plans import subscriptions as subs
from presslens.sources import sinks


def d(n, base=dt.datetime(2024, 1, 1)):
    return base + dt.timedelta(days=n)


def test_expiring_users(spark):
    rows = [(1, 1, d(0), d(30)), (2, 2, d(0), d(30)), (3, 2, d(10), d(60)), (4, 3, d(0), d(30)), (5, 3, d(29), d(90)), (6, 4, d(0), d(30))]
    s = spark.createDataFrame(rows, "id long, user_id long, start_time timestamp_ntz, end_time timestamp_ntz")
    p = spark.createDataFrame([(1, "paid"), (1, "refund"), (2, "paid"), (3, "paid"), (4, "paid"), (6, "form")], "subscription_id long, status string")
    one = {(r.user_id, r.outcome_date) for r in outcomes.expiring_users(s, p, "2024-01-20").collect()}
    # user 2 renewed before the day (the later one is too far away), user 3 only after it, user 4 never paid
    assert one == {("1", d(30).date()), ("3", d(30).date())}
    many = outcomes.expiring_users(s, p, "2024-01-15", "2024-02-05")
    assert many.where("date = DATE'2024-01-20'").count() == 2
    per_day = {r.date: r["count"] for r in many.groupBy("date").count().collect()}
    for i in (14, 20, 28, 30):
        day = d(i).date()
        assert outcomes.expiring_users(s, p, day).count() == per_day.get(day, 0)


def test_churn_outcome_dedup_and_fan_out(spark):
    e = spark.createDataFrame(
        [("1", d(5), "renewal"), ("1", d(5), "churn"), ("2", d(5), "renewal"), ("2", d(6), "churn"), ("3", d(0), "churn"), ("4", d(33), "churn"), ("5", d(34), "churn")],
        "user_id string, time timestamp_ntz, type string",
    )
    f = spark.createDataFrame([(str(u), d(0).date(), d(20).date()) for u in range(1, 6)], "user_id string, date date, outcome_date date")
    got = sorted((r.user_id, r.outcome, (r.outcome_date - d(0).date()).days) for r in outcomes.churn_outcome(f, e).collect() if r.outcome)
    assert got == [("1", "churn", 5), ("2", "churn", 6), ("2", "renewal", 5), ("4", "churn", 33)]
    rest = {r.user_id: r.outcome_date for r in outcomes.churn_outcome(f, e).collect() if not r.outcome}
    assert rest == {"3": d(20).date(), "5": d(20).date()}


def test_conversion_outcome_and_shared_logins(spark):
    e = spark.createDataFrame(
        [("a", d(1), "conversion"), ("b", d(2), "conversion"), ("a", d(-3), "shared_account_login"), ("a", d(-30), "shared_account_login"), ("a", d(-31), "shared_account_login"), (None, d(1), "churn")],
        "browser_id string, time timestamp_ntz, type string",
    )
    f = spark.createDataFrame([("a", d(0).date()), ("b", d(0).date())], "browser_id string, date date")
    out = {r.browser_id: (r.outcome, r.outcome_date) for r in outcomes.conversion_outcome(f, e).collect()}
    assert out == {"a": ("conversion", d(1).date()), "b": ("no_conversion", d(1).date())}
    logins = {r.browser_id: r.shared_account_logins_past_30_days for r in outcomes.with_shared_logins(f, e).collect()}
    assert logins == {"a": 2, "b": None}


@pytest.fixture(scope="module")
def crm(spark):
    s = spark.createDataFrame(
        [(1, 1, 1, d(0), d(0), d(30), 30, 1, 1, "regular"), (2, 1, 1, d(40), d(40), d(70), 30, 0, 1, "regular"),
         (3, 2, 1, d(0), d(0), d(30), 30, 1, 1, "regular"), (4, 3, 1, d(0), d(0), d(0), 0, 1, 1, "regular"),
         (5, 4, 9, d(0), d(0), d(30), 30, 1, 0, "regular"), (6, 5, 1, d(0), d(0), d(30), 30, 1, 1, "regular")],
        "id long, user_id long, subscription_type_id int, created_at timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz, length int, is_recurrent int, is_paid int, type string",
    )
    p = spark.createDataFrame(
        [(1, 1, 1, 30.0, 0.0, 1, "paid", d(0)), (2, 1, 1, 30.0, 0.0, 0, "prepaid", d(1)), (3, 2, 1, 15.0, 0.0, 0, "paid", d(40)),
         (4, 3, 2, 10.0, 0.0, 0, "paid", d(0)), (5, 3, 2, 10.0, 0.0, 0, "refund", d(2)), (6, 4, 3, 1.0, 0.0, 0, "paid", d(0)),
         (7, 5, 4, 60.0, 0.0, 0, "paid", d(0)), (8, 2, 1, 15.0, 0.0, 0, "paid", d(90))],
        "id long, subscription_id long, user_id long, amount double, additional_amount double, recurrent_charge int, status string, created_at timestamp_ntz",
    )
    t = spark.createDataFrame(
        [(1, "n", "c", 31, 10.0, 1, 1, 0, 0, 0, False), (9, "x", "y", 31, 10.0, 0, 1, 0, 0, 0, True)],
        "id int, name string, code string, length int, price double, web int, mobile int, club int, print int, print_friday int, no_subscription boolean",
    )
    u = spark.createDataFrame([(1, 1, 2, "paid", d(39))], "id long, base_subscription_id long, upgraded_subscription_id long, type string, created_at timestamp_ntz")
    return s, p, t, u


def test_subscription_data(spark, crm):
    s, p, t, u = crm
    rows = {r.subscription_id: r for r in subs.subscription_data(s, p, t, u, d(80).date()).collect()}
    # 3 has a refund, 4 ends at its start, 6 has no payment
    assert set(rows) == {1, 2, 5}
    assert (rows[1].payment_status, rows[1].payment_count, rows[1].amount) == ("paid,prepaid", 2, 60.0)
    assert (rows[1].is_recurrent_charge, rows[1].is_upgraded, rows[1].base_subscription_id) == (1.0, 1.0, 1)
    assert (rows[2].upgrade_type, rows[2].base_subscription_id, rows[2].is_upgrade, rows[2].amount) == ("paid", 1, 1.0, 15.0)
    assert rows[5].sub_type_name is None
    unpaid = {r.subscription_id: r for r in subs.subscription_data(s, p, t, u, d(80).date(), keep_unpaid=True).collect()}
    assert set(unpaid) == {1, 2, 5, 6} and unpaid[6].payment_status == "no_payment" and unpaid[6].amount == 0.0
    later = subs.subscription_data(s, p, t, u, d(80).date(), d(10).date())
    assert [r.subscription_id for r in later.collect()] == [2]


def test_prices_and_pairs(spark, crm, tmp_path):
    s, p, t, u = crm
    data = sinks.stored(subs.subscription_data(s, p, t, u, d(80).date()), str(tmp_path / "sub_data"))
    bands = {r.web_access_level: r.average_price for r in subs.price_bands(data).collect()}
    assert bands[2] == pytest.approx((2.0 + 0.5) / 2) and None in bands
    stats = {r.user_id: r for r in subs.user_subscription_stats(data, d(80).date()).collect()}
    assert set(stats) == {1}  # no band without a type
    assert (stats[1].count_subs, stats[1].average_gap, stats[1].max_gap, stats[1].discount_subs) == (2, 10.0, 10, 1.0)
    (pair,) = subs.last_vs_previous(data, d(80).date()).collect()
    assert (pair.subscription_id_last, pair.subscription_id_previous, pair.amount_diff) == (2, 1, 0.25)
    assert (pair.is_recurrent_diff, pair.is_discount_last, pair.is_discount_diff) == (-1.0, 1.0, 1.0)
    (oldest,) = subs.last_vs_previous(data, d(80).date(), latest_first=False).collect()
    assert oldest.subscription_id_last == 1
    first = subs.kth_last_subscription(data, 1, d(80).date(), latest_first=False).collect()
    assert [r.subscription_id for r in first if r.user_id == 1] == [1]
    users = spark.createDataFrame([("1",), ("7",)], "user_id string")
    assert [r.user_id for r in subs.subscription_features(data, d(80).date(), users).collect()] == ["1"]


def test_context_rows_and_defaults(spark):
    p = spark.createDataFrame([(i, 10.0 * i, "paid", d(n)) for i, n in ((1, 0), (2, 1), (3, 5), (4, 6))], "id long, amount double, status string, created_at timestamp_ntz")
    a = spark.createDataFrame([(d(n), 100) for n in (0, 1, 5)], "time_from timestamp_ntz, sum long")
    got = {r.date.day: r for r in context.global_context(p, a, 2).collect()}
    assert set(got) == {1, 2, 6}  # inner join, and two rows rather than two days
    assert (got[6].payment_count, got[6].sum_paid, got[6].avg_price, got[6].article_pageviews_count) == (2, 50.0, 25.0, 200)
    rows = spark.createDataFrame([(d(0).date(),)], "date date")
    assert context.with_context(rows, None).first().avg_price == 0.0


def test_payment_history_join(spark):
    h = spark.createDataFrame([(7, 50.0, d(-10), 40.0), (8, 20.0, d(5), 1.0), (9, 5.0, None, None)], "user_id long, clv double, last_subscription_end timestamp_ntz, days_since_last_subscription double")
    rows = [("a", ["x7", "8"]), ("b", ["8"]), ("c", ["9"]), ("d", []), ("e", None), ("f", ["none"])]
    p = spark.createDataFrame([(b, d(0).date(), u) for b, u in rows], "browser_id string, date date, user_ids array<string>")
    got = {r.browser_id: (r.clv, r.days_since_last_subscription) for r in context.with_payment_history(p, h).collect()}
    none = (0.0, 1000.0)
    assert got == {"a": (50.0, 40.0), "b": none, "c": (5.0, 1000.0), "d": none, "e": none, "f": none}
    assert context.with_payment_history(p, None).first().days_since_last_subscription == 0.0


def _at(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def _history(spark, subscriptions, payments=None, upgrades=()):
    """Frames of a subscription history; by default each subscription is paid when it is made."""
    made = spark.createDataFrame(subscriptions, "id long, user_id long, subscription_type_id long, created_at timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz")
    made = made.withColumns({
        "type": F.lit("t"), "length": F.datediff("end_time", "start_time"), "is_recurrent": F.lit(True), "is_paid": F.lit(True),
    })
    if payments is None:
        payments = [(s[0], s[0], "paid", s[0] * 10.0, 0.0, 0, s[3]) for s in subscriptions]
    paid = spark.createDataFrame(payments, "id long, subscription_id long, status string, amount double, additional_amount double, recurrent_charge int, created_at timestamp_ntz")
    kinds = spark.range(1, 3).select(
        "id", F.lit("n").alias("name"), F.lit("c").alias("code"), F.lit(30).alias("length"), F.lit(5.0).alias("price"), F.lit(False).alias("no_subscription"),
        *[F.lit(1).alias(c) for c in ("web", "mobile", "club", "print", "print_friday")],
    )
    linked = spark.createDataFrame(list(upgrades), "id long, base_subscription_id long, upgraded_subscription_id long, type string, created_at timestamp_ntz")
    return made, paid, kinds, linked


def test_a_later_subscription_leaves_earlier_profiles_unchanged(spark):
    """Features of a day come from what was created up to that day."""
    rows = [(1, 7, 1, _at(-60), _at(-60), _at(-30)), (2, 7, 1, _at(-30), _at(-30), _at(20)), (3, 8, 1, _at(-40), _at(-40), _at(-10)), (4, 8, 1, _at(-10), _at(-10), _at(20))]
    later = [*rows, (5, 7, 1, _at(10), _at(10), _at(40)), (6, 9, 1, _at(10), _at(10), _at(40))]
    days = subs.Days("2024-01-05", "2024-01-15")
    points = spark.createDataFrame([(str(u), _at(d).date()) for u in (7, 8, 9) for d in range(4, 15)], "user_id string, as_of date")

    def features(listed):
        versions = subs.subscription_versions(*_history(spark, listed), days)
        return {(r.user_id, r.as_of.day): r.asDict() for r in subs.features_by_day(versions, days, points).collect()}

    before, after = features(rows), features(later)
    early = {k: v for k, v in before.items() if k[1] <= 10}
    assert len(early) == 12 and early == {k: after[k] for k in early}
    assert before["7", 12]["subscription_id_last"] == 2 and after["7", 12]["subscription_id_last"] == 5


def _busy_history(seed):
    """Subscriptions with late and refused payments, late and repeated upgrades, and gaps in the data."""
    rng = random.Random(seed)
    made = [(k, rng.randint(1, 6), rng.randint(1, 3), at, _at(rng.randint(-400, 30)), _at(rng.randint(31, 90))) for k in range(1, 40) for at in [_at(rng.randint(-300, 25))]]
    paid, upgrades = [], []
    for k, *_, at, _, _ in made:
        for _ in range(rng.randint(0, 4)):
            status = rng.choice(["paid", "paid", "prepaid", "form", "refund"] if rng.random() < 0.3 else ["paid", "prepaid"])
            amount = None if rng.random() < 0.1 else rng.randint(1, 900) / 7
            paid.append((len(paid) + 1, k, status, amount, rng.choice([0.0, 1.5, None]), rng.choice([0, 0, 1, None]), at + dt.timedelta(days=rng.randint(0, 60))))
        for _ in range(rng.choice([0, 0, 1, 2])):
            upgrades.append((rng.choice([None, k]), k, rng.randint(1, 40), rng.choice(["paid", "free"]), at + dt.timedelta(days=rng.randint(0, 40))))
    return made, paid, upgrades


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_hold_the_state_of_every_day(spark, seed):
    """A version that is valid on a day is the row that day's history has."""
    frames = _history(spark, *_busy_history(seed))
    days = subs.Days("2024-01-03", "2024-01-24")
    for keep_unpaid in (False, True):
        versions = subs.subscription_versions(*frames, days, keep_unpaid=keep_unpaid).collect()
        names = [c for c in versions[0].asDict() if c not in ("valid_from", "valid_to")]
        plain = lambda rows: sorted((tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in names) for r in rows), key=repr)
        for day in (3, 11, 24):
            date = dt.date(2024, 1, day)
            want = subs.subscription_data(*frames, date, keep_unpaid=keep_unpaid)
            assert plain(want.collect()) == plain([v for v in versions if v.valid_from <= date <= v.valid_to]), date


def test_bands_of_days_are_the_bands_of_each_day(spark):
    frames = _history(spark, *_busy_history(3))
    days = subs.Days("2024-01-03", "2024-01-24")
    versions = subs.subscription_versions(*frames, days)
    found = {(r.as_of, *[r[k] for k in subs.BAND_KEYS]): r.average_price for r in subs.bands_by_day(versions, days).collect()}
    seen = 0
    for day in (3, 11, 24):
        date = dt.date(2024, 1, day)
        for r in subs.price_bands(subs.subscription_data(*frames, date)).collect():
            assert found[(date, *[r[k] for k in subs.BAND_KEYS])] == (r.average_price if r.average_price is None else pytest.approx(r.average_price, rel=1e-12))
            seen += 1
    assert seen == sum(k[0].day in (3, 11, 24) for k in found)


def test_versions_follow_changes_and_not_days(spark):
    """A period ten times as long in which nothing more happens has the same rows."""
    frames = _history(spark, *_busy_history(4))
    short = subs.subscription_versions(*frames, subs.Days("2024-01-01", "2024-05-01")).count()
    assert short == subs.subscription_versions(*frames, subs.Days("2024-01-01", "2027-05-01")).count() > 0
    nothing = _history(spark, [], [], [])
    assert subs.subscription_versions(*nothing, subs.Days("2024-01-01", "2024-05-01")).count() == 0


def test_part_of_a_period_from_the_versions_of_all_of_it(spark):
    """Versions made for a period serve any days within it: the same features as versions of those days alone."""
    frames = _history(spark, *_busy_history(3))
    points = spark.createDataFrame([(str(u), dt.date(2024, 1, day)) for u in range(1, 7) for day in (20, 24)], "user_id string, as_of date")
    plain = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    all_days, part = subs.Days("2024-01-03", "2024-01-24"), subs.Days("2024-01-20", "2024-01-24")
    versions = subs.subscription_versions(*frames, all_days)
    want = plain(subs.features_by_day(subs.subscription_versions(*frames, part), part, points).collect())
    assert want and plain(subs.features_by_day(versions, part, points).collect()) == want
    bands = subs.bands_by_day(subs.versions_within(versions, part), part).groupBy("as_of", *subs.BAND_KEYS).count()
    assert bands.where("count > 1 OR as_of < '2024-01-20'").count() == 0


def test_subscriptions_refused_by_their_first_payments_make_no_lists(spark):
    """A payment without an id does not list its status, so it refuses nothing."""
    rows = [(k, 7, 1, _at(-60), _at(-60), _at(20)) for k in (1, 2, 3, 4)]
    paid = [(1, 1, "refund", 1.0, 0.0, 0, _at(-50)), (2, 1, "paid", 1.0, 0.0, 0, _at(5)), (3, 2, "paid", 1.0, 0.0, 0, _at(-50)),
            (4, 2, "refund", 1.0, 0.0, 0, _at(5)), (None, 3, "refund", 1.0, 0.0, 0, _at(-50)), (5, 3, "paid", 1.0, 0.0, 0, _at(-50)),
            (6, 4, "paid,prepaid", 1.0, 0.0, 0, _at(-50))]
    days, frames = subs.Days("2024-01-01", "2024-01-20"), _history(spark, rows, paid)
    kept = subs._paid_by_day(frames[1], days, subs.ACCEPTED_STATUSES)
    assert sorted(r.subscription_id for r in kept.collect()) == [2, 3, 4]
    held = {(r.subscription_id, r.valid_to.day) for r in subs.subscription_versions(*frames, days).collect()}
    assert held == {(2, 5), (3, 20), (4, 20)}
