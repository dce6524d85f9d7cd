"""Files, sinks and the stored form of profiles."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from presslens.plans import packing
from presslens.session import scratch_dir
from presslens.sources import files, relational, sinks
from presslens.spec import FeatureSpec, sanitize

HEADER = "user_agent;browser_id;user_id;subscriber;derived_referer_medium;category;tags;time;shop_session_id"
D1, D2, D3 = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "pageviews"
    folder.mkdir()
    lines = [HEADER, '"a ""quoted"" agent";b1;;False;direct;;x;2024-03-01T23:30:00+02:00;s1', "ua;b2;u1;True;email;c;;2024-03-01 10:00:00;s2"]
    (folder / "pageviews_20240301.csv").write_text("\n".join(lines) + "\n")
    with gzip.open(folder / "pageviews_20240302.csv.gz", "wt") as out:
        out.write("\n".join([HEADER, "ua;b3;u2;True;direct;c;t;2024-03-02 01:00:00;s3"]) + "\n")
    return str(tmp_path)


def test_read_day_csv(spark, logs):
    df = files.read_day_csv(spark, logs, "pageviews", [D1, D2], session_column="shop_session_id")
    rows = {r.browser_id: r for r in df.collect()}
    assert rows["b1"].date == D1 and rows["b3"].date == D2
    assert rows["b1"].time == dt.datetime(2024, 3, 1, 21, 30)  # to UTC
    assert rows["b1"].user_id == "" and rows["b1"].user_agent == 'a "quoted" agent'
    assert rows["b1"].session_id == "s1" and rows["b1"].event_id < rows["b2"].event_id


def test_missing_days(spark, logs):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_day_csv(spark, logs, "pageviews", [D1, D3]).collect()
    assert files.read_day_csv(spark, logs, "pageviews", [D1, D3], missing="skip", session_column="shop_session_id").count() == 2
    assert files.read_day_csv(spark, logs, "pageviews_time_spent", [D1], missing="none") is None
    with pytest.raises(ValueError):
        files.read_day_csv(spark, logs, "clicks", [D1])


def test_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "commerce").mkdir()
    day = tmp_path / "commerce" / "commerce_20240301.csv"
    day.write_text("user_id;browser_id;time;step\nu1;b1;2024-03-01 10:00:00;payment\n")
    (tmp_path / "commerce" / "commerce_20240302.csv").write_text("browser_id;extra;user_id;time;step\nb2;x;u2;2024-03-02 10:00:00;checkout\n")
    with gzip.open(tmp_path / "commerce" / "commerce_20240303.csv.gz", "wt") as out:
        out.write("step;time;user_id;browser_id\npurchase;2024-03-03 10:00:00;u3;b3\n")
    got = files.read_day_csv(spark, str(tmp_path), "commerce", [D1, D2, D3]).orderBy("date").collect()
    assert [(r.date, r.user_id, r.browser_id, r.step) for r in got] == [(D1, "u1", "b1", "payment"), (D2, "u2", "b2", "checkout"), (D3, "u3", "b3", "purchase")]
    assert len({r.event_id for r in got}) == 3


def test_missing_columns(spark, tmp_path):
    (tmp_path / "commerce").mkdir()
    (tmp_path / "commerce" / "commerce_20240301.csv").write_text("user_id,time,step\nu,2024-03-01 10:00:00,payment\n")
    with pytest.raises(ValueError, match="browser_id"):
        files.read_day_csv(spark, str(tmp_path), "commerce", [D1], sep=",")
    df = files.read_day_csv(spark, str(tmp_path), "commerce", [D1], sep=",", ignore_empty_browser_id=True)
    assert df.first().browser_id == ""


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D1, 1), (D1, 2), (D2, 3)], "date date, v int")
    assert sinks.write_partitions(df, path, ["date"]) == 3
    assert sinks.write_partitions(df.where(F.col("date") == F.lit(D2)).withColumn("v", F.lit(9)), path, ["date"]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 9]
    sinks.replace_partition(df.limit(0), path, {"date": D2})
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2]
    sinks.append(df, path, ["date"])
    assert spark.read.parquet(path).count() == 5


def test_incremental(spark):
    source = spark.createDataFrame([(i, dt.datetime(2024, 3, i, 12)) for i in range(1, 8)], "id int, created_at timestamp_ntz")
    target = source.where("id <= 3")
    assert sorted(r.id for r in sinks.incremental_rows(source, target, "2024-03-05").collect()) == [4, 5]
    assert sinks.incremental_rows(source, source, "2024-03-05").count() == 0
    assert sinks.incremental_rows(source, None, "2024-03-05").count() == 5
    assert sinks.incremental_rows(source, target.limit(0), "2024-03-05").count() == 5
    assert sinks.incremental_sync(source, target, "2024-03-05").count() == 5


def test_keys_tables_and_retention(spark):
    df = spark.createDataFrame([(D1, "a"), (D1, "a"), (D2, "b")], "date date, id string")
    assert [tuple(r) for r in sinks.duplicate_keys(df, ["date", "id"]).collect()] == [(D1, "a", 2)]
    assert sinks.unique_rows(df, ["date", "id"]).count() == 2
    assert sinks.retained(df, D3, 1).count() == 1
    assert sinks.ensure_table(spark, "day_table_x", df.schema, ["date"]) is True
    assert sinks.ensure_table(spark, "day_table_x", df.schema, ["date"]) is False
    spark.sql("DROP TABLE day_table_x")


def test_param_query(spark):
    df = spark.range(5)
    assert relational.param_query(spark, "SELECT * FROM {t} WHERE id < :n", {"n": 3}, {"t": df}).count() == 3
    with pytest.raises(ValueError):
        relational.param_query(spark, "SELECT * FROM {t} WHERE id < :n", {"n": 0}, {"t": df}, require_rows=True)


def test_scratch_uses_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spec_names():
    assert sanitize("rodina-a-vztahy") == "rodina_a_vztahy" and sanitize(None) == "" and sanitize("a.b c") == "ab_c"
    user, browser = FeatureSpec("user", ("avg", "max"), ("apple",)), FeatureSpec("browser")
    assert "categories__avg" in browser.pivot_features()["categories"]
    assert "relative_visit_max_change_first_and_second_half" in user.window_variants()
    assert "features__device_based_columns" in user.stored_columns()
    assert "shared_account_logins_past_30_days" in browser.numeric_features()
    assert {"clv", "sum_paid"} <= set(user.numeric_features(context=True, payments=True))
    assert "dow_1_avg_normalized" in user.numeric_features("add") and "dow_1_avg" not in user.numeric_features("replace")
    for spec in (user, browser):
        names = spec.numeric_features("add")
        assert len(names) == len(set(names))
    with pytest.raises(ValueError):
        FeatureSpec("page")


def test_pack_and_unpack(spark):
    spec = FeatureSpec("browser")
    df = spark.createDataFrame(
        [(D1, "b", "conversion", D2, 1.5, None, "Apple", True)],
        "date date, browser_id string, outcome string, outcome_date date, pageviews_avg double, visit_avg double, device string, is_desktop boolean",
    )
    packed = packing.pack_features(df, spec, 7, "1.01")
    assert [c for c in packed.columns if c.startswith("features__")] == spec.stored_columns()
    row = packing.unpack_features(packed, spec).first()
    assert (row.pageviews_avg, row.visit_avg, row.timespent_avg) == (1.5, 0.0, 0.0)
    assert (row.device, row.os, row.is_desktop, row.is_mobile, row.window_days) == ("Apple", "", "true", "False", 7)


def test_retrieval(spark):
    rows = [("a", D1, D1, "no"), ("a", D2, D2, "no"), ("b", D1, D1, "yes"), ("c", D3, D3, "yes")]
    df = spark.createDataFrame(rows, "browser_id string, date date, outcome_date date, outcome string").withColumn("window_days", F.lit(7))
    got = packing.retrieve_profiles(df, "browser_id", 7, D1, D2)
    assert sorted((r.browser_id, r.date) for r in got.collect()) == [("a", D2), ("b", D1)]
    got = packing.retrieve_profiles(df, "browser_id", 7, D2, D2, ["yes"])
    assert sorted((r.browser_id, r.date) for r in got.collect()) == [("a", D2), ("b", D1)]
    assert packing.retrieve_profiles(df, "browser_id", 30, D1, D3).count() == 0


def test_sync_of_a_stored_target(spark, tmp_path):
    path = str(tmp_path / "synced")
    rows = spark.createDataFrame([(k, dt.datetime(2024, 3, 1 + k // 2, 6 * (k % 2))) for k in range(8)], "id int, created_at timestamp_ntz")
    assert sinks.sync_stored(rows, path, "2024-03-02").count() == 4
    late = rows.union(spark.createDataFrame([(99, dt.datetime(2024, 3, 2, 23))], rows.schema))
    assert sinks.sync_stored(late, path, "2024-03-02", by_day=False).count() == 5
    assert sorted(r.id for r in sinks.sync_stored(late, path, "2024-03-09").collect()) == [*range(8), 99]
    assert sinks.sync_stored(late, path, "2024-03-09").count() == 9


def test_expired_partitions_are_dropped_and_keys_stay_unique(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(D1, 1), (D2, 2), (D3, 3)], "date date, v int")
    sinks.write_partitions(rows, path, ["date"])
    assert sinks.drop_expired(spark, path, D3, 1) == ["2024-03-01"]
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]
    table = str(tmp_path / "unique")
    sinks.append_unique(rows.union(rows), table, ["date"])
    assert sinks.append_unique(rows.withColumn("v", F.lit(9)), table, ["date"]).count() == 3
