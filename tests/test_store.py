"""The profile store, marks with ids, and ordered upserts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from presslens.plans.store import ProfileStore
from presslens.sources import sinks
from presslens.spec import FeatureSpec

SPEC = FeatureSpec("user", device_brands=("apple",), mediums=("direct",), categories=("sport",))


def day(n):
    return dt.date(2024, 1, n)


def wide(spark, start, end, seen=None, empty=()):
    """Two users a day with one number; outcomes follow three days later."""
    if seen is not None:
        seen.append((start, end))
    days = [start + dt.timedelta(k) for k in range((end - start).days + 1)]
    rows = [(u, d, "churn" if u == "a" else "renewal", d + dt.timedelta(3), d.day + 0.5, 2.0) for d in days if d not in empty for u in "ab"]
    return spark.createDataFrame(rows, "user_id string, date date, outcome string, outcome_date date, pageviews_avg double, apple_device_brand_sum double")


def test_backfill_resumes_and_rewrites_only_its_days(spark, tmp_path):
    store, seen = ProfileStore(spark, str(tmp_path / "p"), SPEC, 7, "1"), []
    build = lambda a, b: wide(spark, a, b, seen, empty=[day(4)])
    assert store.backfill(build, day(2), day(3)) == [(day(2), day(3))]
    assert store.backfill(build, day(1), day(6)) == [(day(1), day(1)), (day(4), day(6))]
    assert store.backfill(build, day(1), day(6)) == [] and len(seen) == 3  # the empty day counts as done
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "p").rglob("*.parquet")}
    before = files()
    assert store.backfill(build, day(5), day(5), again=True) == [(day(5), day(5))] and seen[-1] == (day(5), day(5))
    changed = {f.parts[len(tmp_path.parts) + 1] for f, _ in set(before.items()) ^ set(files().items())}
    assert changed == {"date=2024-01-05"}
    assert store.read().count() == 10 and store.missing(day(1), day(8)) == [(day(7), day(8))]


def test_rows_of_an_older_version_lack_newer_fields(spark, tmp_path):
    path = str(tmp_path / "p")
    older = ProfileStore(spark, path, FeatureSpec("user", mediums=("direct",), categories=("sport",)), 7, "1")
    newer = ProfileStore(spark, path, SPEC, 7, "2")
    older.backfill(lambda a, b: wide(spark, a, b), day(1), day(3))
    newer.backfill(lambda a, b: wide(spark, a, b), day(4), day(6))
    ProfileStore(spark, path, SPEC, 30, "2").backfill(lambda a, b: wide(spark, a, b), day(1), day(2))
    got = {(r.user_id, r.date.day): (r.pageviews_avg, r.apple_device_brand_sum) for r in newer.profiles(day(8), day(30), ["churn"]).collect()}
    # The period holds days 5 and 6, history adds the churns of all older days.
    want = {("a", d): (d + 0.5, 0.0 if d < 4 else 2.0) for d in range(1, 7)} | {("b", d): (d + 0.5, 2.0) for d in (5, 6)}
    assert got == want
    latest = newer.profiles(day(1), day(8)).collect()
    assert {(r.user_id, r.date.day) for r in latest} == {("a", 5), ("b", 5)}


def test_rows_created_later_on_the_day_of_the_mark_arrive_once(spark, tmp_path):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    frame = lambda rows: spark.createDataFrame(rows, "id long, created_at timestamp_ntz")
    path, rows = str(tmp_path / "t"), [(1, at(1, 5)), (2, at(2, 6))]
    sinks.sync_stored(frame(rows), path, "2024-01-05", ids=["id"])
    rows += [(3, at(2, 9)), (4, at(3, 1)), (5, at(9, 1))]
    assert {r.id for r in sinks.sync_stored(frame(rows), path, "2024-01-05", ids=["id"]).collect()} == {1, 2, 3, 4}
    rows += [(6, at(3, 2))]
    for _ in range(2):
        assert sorted(r.id for r in sinks.sync_stored(frame(rows), path, "2024-01-05", ids=["id"]).collect()) == [1, 2, 3, 4, 6]
    assert sorted(r.id for r in sinks.sync_stored(frame(rows), path, "2024-01-09", ids=["id"]).collect()) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("parts", [1, 7])
def test_the_newest_row_of_a_key_is_stored_under_any_partitioning(spark, tmp_path, parts):
    rows = spark.range(200).select(
        (F.col("id") % 5).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"),
        (F.col("id") % 10).alias("at"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("value"),
    )
    path = str(tmp_path / "u")
    sinks.upsert(rows.where("id < 90").repartition(parts), path, ["k", "date"], ["at"], ["date"])
    old = sinks.upsert(rows.repartition(parts), path, ["k", "date"], ["at"], ["date"]).select(*rows.columns).collect()
    want = {}
    for r in rows.collect():
        key = (r.at, r.value is not None, r.value or 0)
        want[r.k, r.date] = max(want.get((r.k, r.date), key), key)
    assert {(r.k, r.date): (r.at, r.value is not None, r.value or 0) for r in old} == want
    # A re-run and older rows change nothing; a day that is not offered is not touched.
    again = sinks.upsert(rows.where("at < 5 AND date = DATE'2024-01-02'"), path, ["k", "date"], ["at"], ["date"])
    assert sorted(again.select(*rows.columns).collect()) == sorted(old)
    with pytest.raises(ValueError):
        sinks.upsert(rows, path, ["k"], ["at"], ["date"])


def test_rows_of_a_table_are_packed_without_another_copy(spark, tmp_path, monkeypatch):
    copies, own = [], sinks.stored
    monkeypatch.setattr(sinks, "stored", lambda df, path: copies.append(path) or own(df, path))
    rows = spark.createDataFrame(wide(spark, day(1), day(3)).collect())
    once, again = (ProfileStore(spark, str(tmp_path / p), SPEC, 7, "1", dt.datetime(2024, 2, 1)) for p in ("a", "b"))
    assert once.write(rows, day(1), day(3), stored=True) == 6 and copies == []
    assert again.write(rows, day(1), day(3)) == 6 and len(copies) == 1
    plain = lambda store: sorted(map(str, store.read().collect()))
    assert plain(once) == plain(again)
