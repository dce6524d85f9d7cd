"""Ordered operators against brute force, with one key that owns most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslens.operators import sampling
from presslens.operators.joins import range_left_join
from presslens.operators.latest import ranked
from presslens.operators.ordered import last_within, next_distinct, order_cut, previous_row, time_block

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(400):
        key = "hot" if rng.random() < 0.7 else rng.choice("abc")
        at = T0 + dt.timedelta(seconds=rng.randrange(0, 4000))
        out.append((key, at, i, rng.random() < 0.4, f"v{i}"))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, i long, m boolean, v string")


@pytest.mark.parametrize("seconds", [1, 60, 300, 5000])
def test_last_within(frame, rows, seconds):
    found = last_within(frame, ["k"], ["t", "i"], F.col("m"), ["v"], seconds)
    got = {r.i: r.last_v for r in found.collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    want, seen = {}, {}
    for key, at, i, marked, value in ordered:
        before = seen.get(key)
        fresh = before and (at - before[0]).total_seconds() <= seconds
        want[i] = before[1] if fresh else None
        if marked:
            seen[key] = (at, value)
    assert got == want


@pytest.mark.parametrize("seconds", [30, 900])
def test_previous_row(frame, rows, seconds):
    found = previous_row(frame, ["k"], ["t", "i"], ["v"], time_block(F.col("t"), seconds))
    got = {r.i: r.previous_v for r in found.collect()}
    want, seen = {}, {}
    for key, _, i, _, value in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = seen.get(key)
        seen[key] = value
    assert got == want


def test_previous_row_keeps_null_values(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("a", 30, None), ("a", 31, "y")], "k string, o int, v string"
    )
    found = previous_row(df, ["k"], ["o"], ["v"], F.floor(F.col("o") / 10))
    assert {r.o: r.previous_v for r in found.collect()} == {1: None, 2: None, 30: "x", 31: None}


def test_next_distinct(frame, rows):
    found = next_distinct(frame, ["k"], "t", time_block(F.col("t"), 200), "n").collect()
    times = {}
    for key, at, *_ in rows:
        times.setdefault(key, set()).add(at)
    want = set()
    for key, values in times.items():
        ordered = sorted(values)
        want |= set(zip([key] * len(ordered), ordered, [*ordered[1:], None], strict=True))
    assert {tuple(r) for r in found} == want


def test_range_left_join(spark):
    rng = random.Random(3)

    def day(n):
        return T0 + dt.timedelta(days=n, hours=rng.randrange(24))

    left = [(rng.choice(["hot", "hot", "a"]), day(rng.randrange(60)), i) for i in range(80)]
    right = [(rng.choice(["hot", "hot", "b"]), day(rng.randrange(60)), i) for i in range(80)]
    l = spark.createDataFrame(left, "k string, e timestamp_ntz, i int")
    r = spark.createDataFrame(right, "k string, s timestamp_ntz, j int")
    for span in (0, 1, 2, 7, 30):
        test = (F.col("r.s") >= F.col("l.e")) & (F.col("r.s") <= F.expr(f"l.e + INTERVAL {span} DAYS"))
        got = range_left_join(l, r, ["k"], "e", "s", span, test).select("i", "j").collect()
        want = []
        for k, e, i in left:
            hits = [j for k2, s, j in right if k2 == k and e <= s <= e + dt.timedelta(days=span)]
            want += [(i, j) for j in hits] or [(i, None)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_ranked_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2)], "k string, o int")
    assert sorted(map(tuple, ranked(df, ["k"], [F.col("o").desc()]).collect())) == [("a", 3), ("a", 3), ("b", 2)]
    assert ranked(df, ["k"], [F.col("o").desc()], 2).count() == 0
    assert [tuple(r) for r in ranked(df, ["k"], [F.col("o").desc()], 3).collect()] == [("a", 1)]


def test_undersample_sizes_and_repeatability(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 50 == 0, "rare").otherwise("common").alias("y"))
    first = sampling.undersample(df, "y", ["id"], 1)
    assert {r.y: r["count"] for r in first.groupBy("y").count().collect()} == {"rare": 100, "common": 100}
    again = sampling.undersample(df.repartition(7), "y", ["id"], 1)
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    other = sampling.undersample(df, "y", ["id"], 2)
    assert {r.id for r in first.collect()} != {r.id for r in other.collect()}


@pytest.mark.parametrize("ratio", [0.0, 0.35, 0.5, 1.0])
def test_splits_have_exact_sizes(spark, ratio):
    df = spark.range(1001).select(
        "id",
        F.expr("date_add(DATE'2024-01-01', CAST(id % 10 AS INT))").alias("date"),
        F.expr("date_add(DATE'2024-01-02', CAST(id % 10 AS INT))").alias("outcome_date"),
    )
    fresh = df.where("outcome_date >= DATE'2024-01-05'").count()
    for split in (sampling.random_split, sampling.time_split):
        flagged = split(df, ["id"], ratio, "2024-01-05")
        train = flagged.where("is_train").count()
        assert train == (1001 - fresh) + round(fresh * ratio)
    ordered = sampling.time_split(df, ["id"], ratio, "2024-01-05").where("outcome_date >= DATE'2024-01-05'")
    limits = ordered.groupBy("is_train").agg(F.min("date").alias("a"), F.max("date").alias("b")).collect()
    sides = {r.is_train: r for r in limits}
    if len(sides) == 2:
        assert sides[True].b <= sides[False].a


def test_order_cut_when_keys_share_a_prefix(spark):
    keys = [f"{'a' * 20}{i:06d}" for i in range(3000)]
    df = spark.createDataFrame([(k, "x" if i % 3 else "y") for i, k in enumerate(keys)], "k string, g string")
    cut = order_cut(df, "k", 3, F.lit(700), few=10).first()["cut"]
    assert cut == keys[699]
    by_group = {r.g: r.cut for r in order_cut(df, "k", 3, F.col("smallest") / 2, ["g"], few=10).collect()}
    assert by_group == {g: [k for i, k in enumerate(keys) if (i % 3 == 0) == (g == "y")][499] for g in "xy"}
