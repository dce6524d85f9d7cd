"""Encoders, training, experiments, segments and small functions."""

import datetime as dt

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from presslens.functions import flags, ids
from presslens.functions.labels import web_access_level
from presslens.operators import encoding
from presslens.operators.metrics import class_metrics
from presslens.plans import experiments, segments, training
from presslens.sources import sinks
from presslens.spec import FeatureSpec


def test_one_hot_unseen_and_null(spark):
    seen = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    categories = encoding.fit_categories(seen, ["c"])
    assert categories == {"c": ["a", "b"]}
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [tuple(r) for r in encoding.one_hot(rows, categories).collect()] == [(1, 0), (0, 0), (0, 0)]
    assert {tuple(r) for r in encoding.category_values(seen, ["c"]).collect()} == {("c", "a"), ("c", "b"), ("c", "Unknown")}
    known = rows.select(encoding.known_category(F.col("c"), ["a", "b"]).alias("k"))
    assert [r.k for r in known.collect()] == ["a", "Unknown", "Unknown"]


def test_min_max(spark):
    fit = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (None, 5.0)], "x double, k double")
    limits = encoding.fit_min_max(fit, ["x", "k"])
    rows = spark.createDataFrame([(5.0, 5.0), (20.0, 7.0)], "x double, k double")
    assert [tuple(r) for r in encoding.min_max(rows, limits).collect()] == [(0.5, 0.0), (2.0, 2.0)]


def test_align(spark):
    df = spark.createDataFrame([("i", 1, 2.0, None)], "id string, z int, extra double, a double")
    out = encoding.align_columns(df, {"z", "a", "m"}, ["id"])
    assert out.columns == ["id", "a", "m", "z"] and tuple(out.first()) == ("i", 0.0, 0.0, 1.0)


def test_metrics_undefined_is_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    got = {r.label: (r.precision, r.recall, r.f_score, r.support) for r in class_metrics(df, "y", "p").collect()}
    assert got["a"] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert got["b"] == (pytest.approx(1 / 3), 1.0, 0.5, 1)
    assert got["c"] == (0.0, 0.0, 0.0, 1)


def test_small_functions(spark):
    df = spark.createDataFrame([("True",), ("t",), ("1",), ("f",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(flags.bool_to_int(F.col("x"))).collect()] == [1, 1, 1, 0, 0, 0]
    one = spark.createDataFrame([("{a,b}", "{}", "")], "p string, e string, s string")
    row = one.select(ids.parse_pg_array(F.col("p")), ids.parse_pg_array(F.col("e")), ids.split_ids(F.col("s"))).first()
    assert tuple(row) == (["a", "b"], [], [])
    arrays = spark.createDataFrame([(["b", "a", "", "b", None, "empty_user_id"],)], "u array<string>")
    assert arrays.select(ids.clean_ids(F.col("u"))).first()[0] == ["b", "a"]
    levels = spark.createDataFrame([(0, 1, 1), (1, 1, 1), (1, 0, 0)], "w int, m int, c int")
    assert [r[0] for r in levels.select(web_access_level(F.col("w"), F.col("m"), F.col("c"))).collect()] == [-1, 3, 1]


@pytest.fixture(scope="module")
def profiles(spark):
    df = spark.range(400).select(
        F.col("id").cast("string").alias("browser_id"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 20 AS INT))").alias("date"),
        (F.col("id") % 7).cast("double").alias("pageviews_avg"),
        F.when(F.col("id") % 3 == 0, "Apple").otherwise("Samsung").alias("device"),
        F.lit("true").alias("is_desktop"),
        F.when(F.col("id") % 7 > 4, "conversion").when(F.col("id") % 7 == 4, "shared_account_login")
        .otherwise("no_conversion").alias("outcome"),
    )
    return df.withColumn("outcome_date", F.date_add("date", 1))


def test_train_save_load_predict(spark, profiles, tmp_path):
    spec = FeatureSpec("browser")
    prepared = training.prepare(profiles, spec)
    forest = RandomForestClassifier(numTrees=5, maxDepth=6, featureSubsetStrategy="all", seed=1)
    model = training.train(prepared, spec.numeric_features(), ["device"], ["is_desktop"], estimator=forest)
    assert model.labels == ["conversion", "no_conversion", "shared_account_login"]
    assert model.features == sorted(model.features) and "device_Apple" in model.features
    sinks.write_partitions(prepared.select("date", "outcome"), str(tmp_path / "observed"), ["date"])
    assert len(training.predict(model, prepared, ["browser_id"]).collect()) == 400
    unseen = prepared.withColumn("device", F.lit("Nokia")).drop("is_desktop")
    predicted = training.predict(model, unseen, ["browser_id"])
    assert predicted.columns == ["browser_id", *[f"{x}_probability" for x in model.labels], "predicted_outcome"]
    model.save(str(tmp_path / "m"))
    again = training.OutcomeModel.load(spark, str(tmp_path / "m"))
    keep = ["browser_id", "outcome"]
    assert training.predict(again, prepared, keep).collect() == training.predict(model, prepared, keep).collect()
    scores = {r.label: r for r in training.outcome_frame(model, prepared).collect()}
    assert sum(r.support for r in scores.values()) == 400 and scores["no_conversion"].f_score > 0.9
    importances = model.importances()
    assert abs(sum(importances.values()) - 1) < 1e-9 and max(importances, key=importances.get) == "pageviews_avg"
    row = training.registry_row(spark, model, spec, {"model_type": "conversion", "window_days": 7}).first()
    assert "pageviews_avg" in row["importances__numeric_columns"] and "device_Apple" in row["importances__categorical_columns"]
    flagged = prepared.withColumn("is_train", F.col("date") < F.lit("2024-01-15").cast("date"))
    assert {r.part for r in training.train_test_frames(model, flagged).collect()} == {"train", "test"}
    assert training.model_date(profiles).first()[0] == dt.date(2024, 1, 22)


def test_prepare_normalization(spark):
    spec = FeatureSpec("browser")
    df = spark.createDataFrame([(3.0, 1.0, 0.0)], "pvs_0h_4h_avg double, pvs_4h_8h_avg double, dow_0_avg double")
    added = training.prepare(df, spec, "add").first()
    assert (added.pvs_0h_4h_avg, added.pvs_0h_4h_avg_normalized, added.dow_0_avg_normalized) == (3.0, 0.75, 0.0)
    assert "pvs_0h_4h_avg" not in training.prepare(df, spec, "replace").columns
    with pytest.raises(ValueError):
        training.prepare(df, spec, "other")


def test_latest_model_ties(spark):
    at = dt.datetime(2024, 1, 10, 5, 0, 10)
    rows = [(at, dt.date(2024, 1, 9), 1), (at + dt.timedelta(seconds=20), dt.date(2024, 1, 9), 2), (at, dt.date(2024, 1, 20), 3), (at - dt.timedelta(days=1), dt.date(2024, 1, 8), 4)]
    df = spark.createDataFrame(rows, "train_date timestamp_ntz, max_date date, id int").select(
        "*", F.lit("churn").alias("model_type"), F.lit("1.0").alias("model_version"), F.lit(30).alias("window_days")
    )
    found = training.latest_model(df, "churn", "1.0", 30, "2024-01-15", "2024-01-31 00:00:00")
    assert sorted(r.id for r in found.collect()) == [1, 2]
    assert training.latest_model(df, "conversion", "1.0", 30, "2024-01-15", "2024-01-31").count() == 0


# ---- experiments -----------------------------------------------------------------------------------
ARMS = "experiment string, arm string, conversions long, total long"


def test_all_variants_and_clear_winner(spark):
    arms = spark.createDataFrame(
        [("x", "variant-a", 10, 10000), ("x", "variant-b", 5, 10000), ("y", "variant-a", 10, 10000), ("y", "variant-b", 100, 10000)], ARMS
    )
    got = {(r.experiment, r.arm): r.win_probability for r in experiments.win_probabilities(arms).collect()}
    assert len(got) == 4
    assert got["x", "variant-a"] + got["x", "variant-b"] == pytest.approx(1)
    assert 0.8 < got["x", "variant-a"] < 0.95
    assert got["y", "variant-b"] > 0.99 > got["y", "variant-a"]
    again = experiments.win_probabilities(arms.repartition(3)).collect()
    assert {(r.experiment, r.arm): r.win_probability for r in again} == got


def test_beta_draws_have_the_right_mean(spark):
    arms = spark.createDataFrame([("x", "a", 30, 100)], ARMS)
    row = experiments.beta_draws(arms, 20_001, seed=3).agg(F.count("*"), F.avg("value"), F.min("draw"), F.max("draw")).first()
    assert (row[0], row[2], row[3]) == (20_001, 0, 20_000) and abs(row[1] - 0.3) < 0.002


def test_experiment_validation(spark):
    arms = spark.createDataFrame([("one", "a", 1, 2), ("two", "a", 3, 2), ("two", "b", 1, 2)], ARMS)
    bad = {(r.experiment, r.arm): r.reason for r in experiments.invalid_arms(arms).collect()}
    assert bad == {("one", "a"): "not enough arms", ("two", "a"): "more conversions than total"}
    zero = spark.createDataFrame([("x", "a", 0, 10), ("x", "b", 1, 10)], ARMS)
    with pytest.raises(Exception, match="must be positive"):
        experiments.win_probabilities(zero, 100).collect()
    assert experiments.win_probabilities(zero, 100, prior=(1.0, 1.0)).count() == 2


# ---- segments --------------------------------------------------------------------------------------
def test_segments(spark):
    day = dt.date(2024, 1, 2)
    rows = [("b1", "u1,u2", "no_conversion", 0.2), ("b2", "", "no_conversion", 0.1), ("b3", None, "no_conversion", 0.0999),
            ("b4", "u3", "conversion", 0.0), ("b5", "u1", "shared_account_login", 0.05)]
    p = spark.createDataFrame([(day, *r) for r in rows] + [(dt.date(2024, 1, 5), "b9", "u9", "conversion", 1.0)],
                              "date date, browser_id string, user_ids string, predicted_outcome string, conversion_probability double")
    log = spark.createDataFrame([(dt.date(2024, 1, 1),), (day,), (dt.date(2024, 1, 5),)], "date date")
    found = {tuple(r) for r in segments.segment_members(p, log, dt.date(2024, 1, 4), "browser_id").collect()}
    assert found == {("medium_conversion", "b1"), ("low_conversion", "b2"), ("no_conversion", "b3"), ("high_conversion", "b4"), ("shared_account_login", "b5")}
    users = segments.segment_members(p, log, dt.date(2024, 1, 4), "user_id")
    assert {tuple(r) for r in users.collect()} == {("medium_conversion", "u1"), ("medium_conversion", "u2"), ("high_conversion", "u3"), ("shared_account_login", "u1")}
    asked = spark.createDataFrame([("medium_conversion", "u1"), ("medium_conversion", "zz")], "segment string, user_id string")
    assert {r.user_id: r.is_member for r in segments.check_members(users, asked, "user_id").collect()} == {"u1": True, "zz": False}
    assert segments.segments(spark).count() == 5 and segments.segment(spark, "low_conversion").first().id == 3
    with pytest.raises(ValueError):
        segments.segment(spark, "nope")


def test_twenty_thousand_categories(spark):
    """No cap on categories: they are indexed, and the vector is sparse."""
    df = spark.range(20_000).select(
        F.concat(F.lit("v"), F.col("id")).alias("c"), (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("outcome"),
    )
    model = training.train(df, ["x"], ["c"], estimator=RandomForestClassifier(numTrees=1, maxDepth=1, seed=1))
    assert len(model.features) == 20_001 and len(model.importances()) == 20_001
    unseen = training.predict(model, spark.createDataFrame([("new", 1.0), (None, 2.0)], "c string, x double"), ["c"])
    assert unseen.count() == 2
