"""Day tables and events on hand-made logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from presslens.functions.agents import agent_fields
from presslens.plans import daily, events

DAY = dt.datetime(2024, 3, 1)
PV = ("event_id long, user_id string, browser_id string, subscriber string, derived_referer_medium string, "
      "category string, tags string, time timestamp_ntz, session_id string, user_agent string")  # fmt: skip


def view(i, user="", browser="b1", sub="False", medium="direct", category="sport", tags="a", minute=0, session="s", ua="x"):
    return (i, user, browser, sub, medium, category, tags, DAY + dt.timedelta(minutes=minute), session, ua)


def frame(spark, rows):
    return spark.createDataFrame(rows, PV)


def test_user_days_counts(spark):
    rows = [
        view(1, "u", sub="True", minute=10, session="s1"),
        view(2, "u", sub="true", minute=70, session="s1", medium="email", tags="a,,b,a", browser="b2"),
        view(3, "u", sub="True", minute=1439, session="s2", medium="search", browser=""),
        view(4, "u", sub="True", medium=""),
        view(5, "", sub="True"),
        view(6, "u", sub="False"),
    ]
    spent = spark.createDataFrame(
        [(DAY.date(), "u", "b1", 30), (DAY.date(), "u", "b2", 12), (DAY.date(), "other", "b1", 99), (DAY.date(), "", "b1", 5)],
        "date date, user_id string, browser_id string, timespent long",
    )
    (row,) = daily.user_days(frame(spark, rows), spent).collect()
    assert (row.pageviews, row.sessions, row.sessions_without_ref, row.timespent) == (3, 2, 1, 42)
    assert row.browser_ids == ["b1", "b2"]
    assert (row.pageviews_0h, row.pageviews_1h, row.pageviews_23h) == (1, 1, 1)
    assert (row.pageviews_0h_4h, row.pageviews_20h_24h) == (2, 1)
    assert row.article_tags_pageviews == {"a": 4, "b": 1}
    assert row.hour_interval_pageviews == {"00:00-00:59": 1, "01:00-01:59": 1, "23:00-23:59": 1}
    assert row.referer_mediums_pageviews == {"direct": 1, "email": 1, "search": 1}


def test_timespent_is_optional(spark):
    (row,) = daily.user_days(frame(spark, [view(1, "u", sub="True")])).collect()
    assert row.timespent == 0


def test_tags_missing_empty_and_repeated(spark):
    df = frame(spark, [view(1, tags=""), view(2, tags="a"), view(3, tags="a,,a")])
    assert {(r.tags, r.pageviews) for r in daily.key_counts(df, "browser_id", "tags").collect()} == {("a", 3)}
    without = daily.key_counts(df.drop("tags"), "browser_id", "tags").collect()
    assert [(r.tags, r.pageviews) for r in without] == [("", 3)]
    with pytest.raises(ValueError):
        daily.key_counts(df, "browser_id", "hours")


def test_browser_days(spark):
    rows = [view(1, "u1", minute=1, ua="old"), view(2, "u2", minute=2, ua="Windows NT 10.0 Chrome/80.0.1"), view(3, "u3", sub="True", minute=3)]
    commerce = spark.createDataFrame(
        [(1, "b1", DAY, "u", "payment"), (2, "b1", DAY, "u", "payment"), (3, "zz", DAY, "u", "refund"), (4, "", DAY, "u", "refund")],
        "event_id long, browser_id string, time timestamp_ntz, user_id string, step string",
    )
    (row,) = daily.browser_days(frame(spark, rows), None, commerce).collect()
    assert row.user_ids == ["u1", "u2"] and row.pageviews == 2 and row.browser_family == "Chrome"
    assert (row.commerce_payments, row.commerce_refunds, row.commerce_checkouts) == (2, 0, 0)
    (row,) = daily.browser_days(frame(spark, rows)).collect()
    assert row.commerce_purchases == 0
    assert daily.browser_users(frame(spark, rows)).count() == 3


def test_unknown_commerce_step_raises(spark):
    bad = spark.createDataFrame([(1, "b", DAY, "u", "gift")], "event_id long, browser_id string, time timestamp_ntz, user_id string, step string")
    with pytest.raises(Exception, match="unknown commerce step: gift"):
        daily.commerce_steps(bad).collect()


def test_last_agent_breaks_ties_by_row(spark):
    df = frame(spark, [view(1, ua="first"), view(2, ua="second")])
    assert daily._last_agent(daily.with_date(df)).first().user_agent == "second"


@pytest.mark.parametrize(
    ("agent", "expected"),
    [
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_3) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/13.0.5 Safari/605.1.15",
         ("Safari", "13.0.5", "Mac OS X", "10.15.3", "Mac", "Apple", "Mac", True, False, False)),
        ("Mozilla/5.0 (X11; Linux x86_64; rv:73.0) Gecko/20100101 Firefox/73.0",
         ("Firefox", "73.0", "Linux", "", "Other", None, None, True, False, False)),
        ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko",
         ("IE", "11.0", "Windows", "7", "Other", None, None, True, False, False)),
        ("Mozilla/5.0 (Linux; Android 8.1.0; Redmi 6 Build/O11019) AppleWebKit/537.36 Chrome/79.0.3945.136 Mobile Safari/537.36",
         ("Chrome Mobile", "79.0.3945", "Android", "8.1.0", "XiaoMi Redmi 6", "XiaoMi", "Redmi 6", False, False, True)),
        ("Mozilla/5.0 (Linux; Android 9; SM-T510) AppleWebKit/537.36 Chrome/79.0.3945.136 Safari/537.36",
         ("Chrome", "79.0.3945", "Android", "9", "Samsung SM-T510", "Samsung", "SM-T510", False, True, False)),
        ("", ("Other", "", "Other", "", "Other", None, None, False, False, False)),
    ],
)
def test_agents(spark, agent, expected):
    fields = agent_fields(F.col("ua"))
    row = spark.createDataFrame([(agent,)], "ua string").select(*[c.alias(n) for n, c in fields.items()]).first()
    assert tuple(row) == expected


# ---- events --------------------------------------------------------------------------------------
CM = "event_id long, browser_id string, time timestamp_ntz, user_id string, step string"


def test_conversion_tolerance_and_ties(spark):
    def at(m, s=0):
        return DAY + dt.timedelta(hours=1, minutes=m, seconds=s)

    rows = [
        (1, "p1", at(0), "in", "payment"), (2, "q1", at(4, 59), "in", "purchase"),
        (3, "p2", at(0), "edge", "payment"), (4, "q2", at(5), "edge", "purchase"),
        (5, "p3", at(0), "late", "payment"), (6, "q3", at(5, 1), "late", "purchase"),
        (7, "p4", at(0), "two", "payment"), (8, "p5", at(1), "two", "payment"), (9, "q", at(2), "two", "purchase"),
        (10, "", at(0), "nobrowser", "payment"), (11, "q", at(1), "nobrowser", "purchase"),
        (12, "q", at(0), "after", "purchase"), (13, "p", at(1), "after", "payment"),
        (14, "p6", at(3), "tie", "payment"), (15, "q", at(3), "tie", "purchase"),
        (16, "q", at(3), "eit", "purchase"), (17, "p7", at(3), "eit", "payment"),
        (18, "p8", at(0), "", "payment"), (19, "q", at(1), "", "purchase"),
    ]
    found = events.conversion_events(spark.createDataFrame(rows, CM)).collect()
    assert {(r.user_id, r.browser_id) for r in found} == {("in", "p1"), ("edge", "p2"), ("two", "p5"), ("tie", "p6")}
    assert all(r.type == "conversion" and r.computed_for_date == DAY.date() for r in found)


def test_conversion_does_not_cross_midnight(spark):
    rows = [(1, "p", DAY - dt.timedelta(minutes=1), "u", "payment"), (2, "q", DAY + dt.timedelta(minutes=1), "u", "purchase")]
    assert events.conversion_events(spark.createDataFrame(rows, CM)).count() == 0


def test_shared_login(spark):
    rows = [
        view(1, "u1", "only", "True", minute=1),
        view(2, "", "twice", minute=1), view(3, "u2", "twice", "True", minute=2), view(4, "u3", "twice", "True", minute=9),
        view(5, "u4", "before", "True", minute=1), view(6, "", "before", minute=2),
        view(7, "", "none", minute=2), view(8, "u5", "none", "False", minute=3),
    ]
    (row,) = events.shared_login_events(frame(spark, rows)).collect()
    assert (row.browser_id, row.user_id, row.time) == ("twice", "u3", DAY + dt.timedelta(minutes=9))


def test_churn_and_renewal(spark):
    def d(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    subs = [
        (1, 1, 1, d(0), d(30)), (2, 1, 1, d(30), d(60)),      # followed at once
        (3, 2, 1, d(0), d(30)), (4, 2, 1, d(32), d(62)),      # after 2 days
        (5, 3, 1, d(0), d(30)), (6, 3, 1, d(33), d(63)),      # after 3 days
        (7, 4, 2, d(0), d(30)),                               # short type
        (8, 5, 1, d(0), d(30)), (9, 5, 1, d(31), d(61)), (10, 5, 1, d(32), d(62)),  # two followers
        (11, 6, 1, d(0), d(30)), (12, 6, 1, d(30), d(31)),    # follower ends too early
    ]
    s = spark.createDataFrame(subs, "id long, user_id long, subscription_type_id int, start_time timestamp_ntz, end_time timestamp_ntz")
    t = spark.createDataFrame([(1, 31), (2, 5)], "id int, length int")
    found = events.churn_renewal_events(s, t, 2, "2024-02-02", "2024-02-02").collect()
    got = sorted((r.user_id, r.type, (r.time - d(0)).days) for r in found)
    want = [("1", "renewal", 30), ("2", "renewal", 32), ("3", "churn", 30), ("5", "renewal", 31), ("5", "renewal", 32), ("6", "churn", 30)]
    assert got == want
    union = events.events_union(events.shared_login_events(frame(spark, [view(1)])), events.churn_renewal_events(s, t))
    assert union.columns == list(events.EVENT_COLUMNS)
