"""Hard negatives and the inverted multi-index against all scores."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslens.llm import hard_negatives, multi_index, vectors

NAN, INF = float("nan"), float("inf")


def embeddings(spark, rows, kind=None):
    """Rows (vec_id, label, vector) with columns whose names clash with those used inside."""
    kind = kind or pa.float32()
    return spark.createDataFrame(pa.table({
        "vec_id": pa.array([r[0] for r in rows], pa.int64()), "label": pa.array([r[1] for r in rows], pa.int32()),
        "embedding": pa.array([r[2] for r in rows], pa.list_(kind)),
        "id": pa.array(["x"] * len(rows), pa.string()), "vector": pa.array([1.5] * len(rows), pa.float64()), "band": pa.array([7] * len(rows), pa.int32()),
        "score": pa.array([1] * len(rows), pa.int32()), "a.b": pa.array(["y"] * len(rows), pa.string()),
    }))


def made(n, dims, seed, groups=6):
    """Vectors about a few centers, with groups of copies, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dims))
    x = (centers[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * 0.7).astype(np.float32)
    x[rng.random(n) < 0.3] = x[0]
    rows = [(k, int(rng.integers(0, 4)), x[k].tolist()) for k in range(n)]
    odd = [[NAN] * dims, [INF] * dims, [-INF] + [0.0] * (dims - 1), [None] * dims, None, [0.5] * (dims - 1) + [NAN]]
    return rows + [(5000 + 50 * k, 1, v) for k, v in enumerate(odd)] + [(6000, None, x[1].tolist()), (None, 1, x[2].tolist())]


def negatives(rows, every=100, scale=256, n_positive=5, n_negative=10):
    taken = [(i, g, [math.floor(scale * float(c)) for c in v]) for i, g, v in rows
             if i is not None and g is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, g, v in taken:
        if i % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(v, w)), j, h) for j, h, w in taken if j != i)
        for p, j, _ in [b for b in best if b[2] == g][:n_positive]:
            found = [(n, b) for n, b, h in best if h != g and 30 * -p <= 100 * -n <= 90 * -p][:n_negative]
            out += [(i, j, k, b, -p, -n) for k, (n, b) in enumerate(found, 1)]
    return sorted(out)


@given(st.integers(1, 20), st.integers(1, 12), st.integers(1, 40), st.sampled_from([1, 200, 2**20, 2**28 - 1]), st.integers(0, 999))
@settings(max_examples=60, deadline=None)
def test_scores_by_tables(dims, anchors, rows, most, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-most, most + 1, (n, dims)) for n in (anchors, rows))
    b[0] = -most
    assert np.array_equal(hard_negatives.scores(hard_negatives.tables(a), hard_negatives.planes(b)), b @ a.T)


@pytest.mark.parametrize("seed,dims", [(1, 16), (2, 13)])
def test_negatives_equal_brute_force(spark, seed, dims, monkeypatch):
    rows = made(700, dims, seed)
    if seed == 2:  # many chunks, blocks and bands, and best rows that are given up early
        for name, value in (("CHUNK", 50), ("BLOCK", 2), ("HELD", 1)):
            monkeypatch.setattr(hard_negatives, name, value)
    got = hard_negatives.mine(embeddings(spark, rows).repartition(5), F.col("id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == negatives(rows, 50) and got.count()


def test_negatives_sql(spark):
    rows = [r for r in made(300, 8, 5) if r[0] is not None]
    con = duckdb.connect()
    con.register("embeddings", embeddings(spark, rows).toArrow())
    moved = [(i, (g + 1) % 10 if g is not None and i % 7 == 0 else g, v) for i, g, v in rows]
    assert sorted(con.execute(hard_negatives.ORACLE).fetchall()) == negatives(moved)


def test_negatives_of_awkward_rows(spark):
    mine = lambda rows: sorted(map(tuple, hard_negatives.mine(embeddings(spark, rows), F.col("id") % 100 == 0).collect()))
    assert mine([]) == [] and mine([(100, 1, [1.0])]) == []
    # Ties go to the smaller id; a repeated row counts once; of other rows of an id the least vector counts.
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 9.0]), (3, 2, [0.5, -9.0]), (4, 3, [0.5, 0.0]), (4, 3, [0.5, 0.0])]
    assert mine(rows + [(1, 1, [2.0, 0.0])]) == [(0, 1, k, k + 1, 65536, 32768) for k in (1, 2, 3)]
    # Shorter vectors are filled; a score of zero is a negative of a positive of score zero only.
    assert mine([(0, 1, [1.0, 1.0]), (7, 1, []), (8, 2, [-0.0]), (9, 2, [1.0])]) == [(0, 7, 1, 8, 0, 0)]
    # Components too large for 64 bits take no part.
    assert mine([(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [3e38]), (3, 2, [0.5])]) == [(0, 1, 1, 3, 65536, 32768)]


def nearest(rows, every=50, many=5):
    """{query: [(score, id), ...]} with all candidates, best first."""
    taken = [(i, np.array(v, float)) for i, _, v in rows if i is not None and v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    taken = [(i, v) for i, v in taken if v.any()]
    x = np.array([v / np.sqrt((v**2).sum()) for _, v in taken])
    out = {}
    for k, (i, _) in enumerate(taken):
        if i % every == 0:
            s = np.round(x @ x[k], 12)
            out[i] = sorted((-s[j], taken[j][0]) for j in range(len(taken)) if j != k)
    return out


@pytest.mark.parametrize("seed,kind", [(1, pa.float32()), (2, pa.float64())])
def test_search_finds_the_nearest(spark, seed, kind, monkeypatch):
    rows = made(1500, 24, seed)
    if seed == 2:
        for name, value in (("BUCKET", 90), ("CHUNK", 40), ("BLOCK", 3), ("HELD", 1)):
            monkeypatch.setattr(multi_index, name, value)
    got = multi_index.search(embeddings(spark, rows, kind).repartition(5), F.col("id") % 50 == 0).collect()
    want, found = nearest(rows), {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(want)
    hits = 0
    for q, mine in found.items():
        mine.sort()
        scores = {i: -s for s, i in want[q]}
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - scores[i]) < 1e-9 for _, i, s in mine)
        assert [(-scores[i], i) for _, i, _ in mine] == sorted((-scores[i], i) for _, i, _ in mine)
        hits += len({i for _, i, _ in mine} & {i for _, i in want[q][:5]})
    assert hits >= 0.9 * 5 * len(found)


def test_search_on_a_sample(spark, monkeypatch):
    """Fitted on a few rows only, the index still holds every row and finds the nearest."""
    monkeypatch.setattr(multi_index, "SAMPLE", 400)
    rows = made(3000, 16, 9, groups=20)
    got = multi_index.search(embeddings(spark, rows), F.col("id") % 50 == 0).collect()
    want = {(q, i) for q, best in nearest(rows).items() for _, i in best[:5]}
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)


def test_walk_is_in_order():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=7), rng.normal(size=5)
    pairs = list(multi_index.walk(a, b))
    sums = [a[i] + b[j] for i, j in pairs]
    assert len(set(pairs)) == 35 and sums == sorted(sums)


def test_search_of_awkward_rows(spark):
    find = lambda rows, **more: [tuple(r) for r in multi_index.search(embeddings(spark, rows), F.col("id") % 50 == 0, **more).orderBy("query_id", "rank").collect()]
    assert find([]) == [] and find([(50, 1, [1.0, 2.0])]) == [] and find([(50, 1, [0.0, 0.0]), (1, 1, [1.0, 0.0])]) == []
    # Copies: a query leaves out itself only, ties go to smaller ids, all candidates if there are fewer.
    copies = [(k, None, [3.0, 4.0]) for k in range(46, 54)]
    assert find(copies) == [(50, r, i, 1.0) for r, i in enumerate([46, 47, 48, 49, 51], 1)]
    assert find([(0, 1, [1.0, 0.0]), (1, 1, [0.0, 2.0]), (1, 1, [0.0, 2.0]), (2, 1, [-3.0])]) == [(0, 1, 1, 0.0), (0, 2, 2, -1.0)]
    # Scaled copies tie although they are different vectors.
    scaled = find([(0, 1, [1.0, 2.0])] + [(9 - k, 1, [2.0**k, 2.0 ** (k + 1)]) for k in range(8)])
    assert [r[2] for r in scaled] == [2, 3, 4, 5, 6]


def test_rows_that_take_part(spark):
    rows = [(1, 1, [1.0]), (1, 0, [1.0]), (2, None, [1.0]), (3, 1, None), (4, 1, [NAN]), (None, 1, [1.0]), (5, 1, [INF]), (6, 1, [None])]
    taken = vectors.usable(embeddings(spark, rows), "vec_id", "embedding", "label")
    assert sorted((r.id, r.label) for r in taken.collect()) == [(1, 0)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with vectors.arrow_rows(spark, 5):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "5"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
