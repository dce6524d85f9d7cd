"""Positions, chunks and dictionaries of keys of any size, and periods from footers."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslens.operators import dictionary, numbering
from presslens.sources.files import period_plan, stored_period


def test_numbered_equals_plain_positions(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), v) for v in rng.sample(range(10_000), 600)]
    got = numbering.numbered(spark.createDataFrame(rows, "k string, v long"), ["k"], ["v"], "at").collect()
    want = [(k, v, sum(1 for a, b in rows if a == k and b < v)) for k, v in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert numbering.numbered(spark.createDataFrame([], "k string, v long"), ["k"], ["v"], "at").count() == 0


def test_ties_get_different_positions(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 0)], "k string, v int")
    assert sorted((r.v, r.at) for r in numbering.numbered(df, ["k"], ["v"], "at").collect()) == [(0, 0), *[(1, i) for i in range(1, 6)]]


def test_a_browser_of_a_million_users(spark):
    """One key with a million values: many chunks of a fixed size, none of the ranges holds more than its share."""
    pairs = spark.range(1_000_000).select(F.lit("shared").alias("b"), F.format_string("u%07d", "id").alias("u"))
    pairs = pairs.union(spark.createDataFrame([("one", "x"), ("one", "x"), ("none", None)], "b string, u string"))
    chunks = numbering.chunked(pairs, "b", "u").cache()
    found = {r.b: (r.n, r.n_chunks, len(r["head"]), r["head"][0]) for r in numbering.chunk_summary(chunks, "b").collect()}
    assert found == {"shared": (1_000_000, 1000, 1000, "u0000000"), "one": (1, 1, 1, "x")}
    assert chunks.agg(F.max("n"), F.max("chunk")).first()[:] == (1000, 999)
    # Chunks follow each other, and nothing is lost.
    edges = chunks.where("b = 'shared'").select("chunk", F.col("values")[0].alias("a"), F.element_at("values", -1).alias("z")).orderBy("chunk").collect()
    assert all(e.a == f"u{1000 * e.chunk:07d}" and e.z == f"u{1000 * e.chunk + 999:07d}" for e in edges)
    assert numbering.unchunked(chunks, "b", "u").distinct().count() == 1_000_001


def test_dictionary_of_many_values(spark):
    """100,000 values: indexes are alphabetical, rare and frequent values, nulls and unseen ones are all told apart."""
    learned = spark.range(100_000).select(F.format_string("v%06d", "id").alias("c"), F.lit("x").alias("d"))
    hot = spark.range(5000).select(F.lit("v000007").alias("c"), F.lit(None).cast("string").alias("d"))
    known = dictionary.fit_dictionary(learned.union(hot), ["c", "d"])
    assert dictionary.sizes(known, ["c", "d", "absent"]) == {"c": 100_000, "d": 1, "absent": 0}
    assert known.where("feature = 'c' AND value != format_string('v%06d', index)").count() == 0
    rows = spark.createDataFrame(
        [(1, "v000007", "x"), (2, "v099999", None), (3, None, "y"), (4, "new", "x"), (4, "new", "x")], "id int, c string, d string"
    )
    got = dictionary.sparse_one_hot(rows, known, ["c", "d"]).collect()
    have = Counter((r.id, r.c_known, r.c_index, r.d_known, r.d_index) for r in got)
    new = (4, "Unknown", 100_000, "x", 0)
    assert have == Counter([(1, "v000007", 7, "x", 0), (2, "v099999", 99_999, "Unknown", 1), (3, "Unknown", 100_000, "Unknown", 1), new, new])
    vectors = {r.id: (r.c_hot.size, list(r.c_hot.indices), list(r.d_hot.indices)) for r in got}
    assert vectors == {1: (100_000, [7], [0]), 2: (100_000, [99_999], []), 3: (100_000, [], []), 4: (100_000, [], [0])}


def test_empty_dictionary(spark):
    nothing = spark.createDataFrame([], "c string")
    rows = spark.createDataFrame([("a",), (None,)], "c string")
    known = dictionary.fit_dictionary(nothing, ["c"])
    assert [tuple(r)[1:] for r in dictionary.with_indexes(rows, known, ["c"]).collect()] == [("Unknown", 0)] * 2
    assert dictionary.with_indexes(nothing, known, ["c"]).count() == 0


def test_period_from_footers(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.range(50).select(F.expr("date_add(DATE'2024-03-01', CAST(id AS INT))").alias("date"), F.lit("x").alias("other")).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert stored_period(spark, path) == (dt.date(2024, 3, 1), dt.date(2024, 4, 19))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = period_plan(own, path, "date")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MIN(date), MAX(date)]" in plan
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "date date").write.parquet(empty)
    with pytest.raises(ValueError, match="no date"):
        stored_period(spark, empty)
