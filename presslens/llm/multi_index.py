"""Approximate nearest neighbours by cosine with an inverted multi-index.

The two halves of a unit vector are quantised apart, with ``k`` centroids each, so ``k * k`` cells cost
no more centroids than ``2 * k``.  A query walks through the pairs of centroids by rising sum of the two
distances, from a heap, until the cells it has passed hold enough entries; those are scored exactly
on the original vectors.  How many are enough is learned with the centroids: on the sample, the share of
entries that has to be passed for ``recall`` of the true neighbours.

What is broadcast: the centroids and the sizes of cells, at most 2 * 1,024 centroids and 1,024**2 sizes.
The sample has at most ``SAMPLE`` rows (those with the least hash); every row is indexed.

Equal vectors are one entry that keeps its least ``many + 1`` ids.  That loses nothing: ties go to the smaller
id, and of its own copies a query leaves out only itself.  Entries of a first centroid lie in buckets of
about ``BUCKET`` entries, however many it has, and every bucket meets its queries block by block.

Defined cases: rows without id, without a vector, or with a component that is null or not finite
take no part, nor do zero vectors; shorter vectors are filled with zeros; of several rows of an id the least
vector counts; a table of fewer rows gives fewer neighbours, an empty one no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import keep
from presslens.llm.vectors import arrow_rows, matrix, usable

#: Rows the centroids and the share are learned from, and queries of those for the share.
SAMPLE, TRIALS = 65_536, 400
#: Centroids of a half at most, entries of a bucket and of one of its chunks, queries of a block.
MOST, BUCKET, CHUNK, BLOCK = 1024, 32_768, 1024, 64
#: Joined rows of an Arrow batch; blocks whose best rows a task holds back.
JOINED, HELD = 32, 64


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; very large and very small rows are scaled first."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (units.shape[1] + 1) // 2
    return units[:, :cut], units[:, cut:]


def _centroids(rows: np.ndarray, k: int, turns: int = 10) -> np.ndarray:
    """k-means from the first ``k`` rows, which are in the order of a hash."""
    centers = rows[:k].copy()
    for _ in range(turns if k else 0):
        own = nearest(rows, centers)
        sizes = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, rows)
        centers[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centers


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances without the part that is the same for all centroids."""
    return (centers**2).sum(axis=1) - 2 * rows @ centers.T


def nearest(rows: np.ndarray, centers: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """The centroid next to each row; a slice of the rows is looked at at a time."""
    parts = [distances(rows[a : a + at_once], centers).argmin(axis=1) for a in range(0, len(rows), at_once)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by rising sum of their distances to the two halves of a query."""
    by_first, by_second = first.argsort(kind="stable").tolist(), second.argsort(kind="stable").tolist()
    first, second = first[by_first].tolist(), second[by_second].tolist()
    heap = [(first[0] + second[0], 0, 0)]
    while heap:
        _, a, b = heapq.heappop(heap)
        yield by_first[a], by_second[b]
        # Each pair has one predecessor, so none enters twice.
        if b + 1 < len(second):
            heapq.heappush(heap, (first[a] + second[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(first):
            heapq.heappush(heap, (first[a + 1] + second[0], a + 1, 0))


class Index:
    """Centroids of both halves and the share of entries a query has to pass."""

    def __init__(self, sample: np.ndarray, n: int, many: int, recall: float):
        units = unit(sample)
        # About 36 entries to a cell, as far as the centroids go.
        k = min(MOST, len(units), max(4, 1 << max(0, round(np.log2(n**0.5 / 6))))) if n else 0
        self.centers = [_centroids(h, k) for h in halves(units)]
        self.share = self._share(units, many, recall) if k else 0.0

    def cells(self, units: np.ndarray) -> list[np.ndarray]:
        return [nearest(h, c) for h, c in zip(halves(units), self.centers)]

    def _share(self, units: np.ndarray, many: int, recall: float) -> float:
        k = len(self.centers[0])
        first, second = self.cells(units)
        cell = first * k + second
        sizes = np.bincount(cell, minlength=k * k)
        far = [distances(h, c) for h, c in zip(halves(units[:TRIALS]), self.centers)]
        passed = []
        for q in range(min(TRIALS, len(units))):
            scores = units @ units[q]
            scores[q] = -np.inf
            found = np.argpartition(-scores, min(many, len(units) - 1) - 1)[: min(many, len(units) - 1)]
            order = np.argsort((far[0][q][:, None] + far[1][q]).ravel(), kind="stable")
            before = np.empty(k * k)
            before[order] = np.cumsum(sizes[order]) - sizes[order]
            passed.append(before[cell[found]])
        passed = np.concatenate(passed)
        return float(np.quantile(passed, recall, method="higher")) / len(units) if len(passed) else 0.0

    def visited(self, units: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The cells (query, first, second) that each query looks into."""
        enough = self.share * sizes.sum()
        far = [distances(h, c) for h, c in zip(halves(units), self.centers)]
        out = np.zeros((len(units), *sizes.shape), bool)
        held = sizes.tolist()
        for q in range(len(units)):
            passed = 0
            for a, b in walk(far[0][q], far[1][q]):
                if passed > enough:
                    break
                out[q, a, b] = True
                passed += held[a][b]
        return out


def entries(taken: DataFrame, many: int) -> DataFrame:
    """(vector, ids): every different vector with its ``many + 1`` least ids."""
    least = Window.partitionBy("vector").orderBy("id")
    rows = taken.withColumn("k", F.row_number().over(least)).where(F.col("k") <= many + 1)
    return rows.groupBy("vector").agg(F.collect_list("id").alias("ids"))


def _indexed(index: Index, dims: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _filled(batch.column("vector"), dims)
            first, second = index.cells(unit(vectors))
            packed = pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), batch.column("ids"), packed], ["first", "second", "ids", "vector"])

    return run


def _filled(vectors: pa.Array, dims: int) -> np.ndarray:
    rows = matrix(vectors)
    return np.pad(rows, ((0, 0), (0, dims - rows.shape[1])))


def _walked(index: Index, sizes: np.ndarray, dims: int):
    """Queries in blocks: for each first centroid the queries that look there, and into which cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                ids, vectors = batch.column("id").to_numpy(), _filled(batch.column("vector"), dims)
                cells = index.visited(unit(vectors), sizes)
                out = {c: [] for c in ("first", "queries", "vectors", "cells")}
                for a in np.flatnonzero(cells.any(axis=(0, 2))).tolist():
                    here = np.flatnonzero(cells[:, a].any(axis=1))
                    for c, value in zip(out, (a, ids[here].tobytes(), vectors[here].tobytes(), cells[here, a].tobytes())):
                        out[c].append(value)
                yield pa.RecordBatch.from_pydict(out)

    return run


class _Block:
    """The queries of a block in one bucket, and their best entries so far."""

    def __init__(self, queries: bytes, vectors: bytes, cells: bytes, many: int):
        self.ids, self.many = np.frombuffer(queries, np.int64), many
        self.vectors = np.frombuffer(vectors, float).reshape(len(self.ids), -1)
        self.norms = _norms(self.vectors)
        self.cells = np.frombuffer(cells, bool).reshape(len(self.ids), -1)
        self.best = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    def see(self, second: np.ndarray, ids: pa.ListArray, vectors: np.ndarray) -> None:
        looked = self.cells[:, second]
        norms = _norms(vectors)
        near = np.where(looked, (self.vectors @ vectors.T) / norms / self.norms[:, None], -np.inf)
        # The product of matrices may round copies differently, so all that come close are scored again one by one.
        m = min(self.many + 1, near.shape[1])
        least = np.partition(near, near.shape[1] - m, axis=1)[:, near.shape[1] - m]
        q, e = np.nonzero(looked & (near >= least[:, None] - 1e-9))
        score = np.einsum("ij,ij->i", self.vectors[q], vectors[e]) / (self.norms[q] * norms[e])
        starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        many = np.diff(starts)[e]
        every = np.repeat(starts[e] - np.cumsum(many) + many, many) + np.arange(many.sum())
        q, score, found = np.repeat(q, many), np.repeat(score, many), flat[every]
        other = found != self.ids[q]
        q, score, found = (np.r_[a, b[other]] for a, b in zip(self.best, (q, score, found)))
        order = np.lexsort((found, -score, q))
        q, score, found = q[order], score[order], found[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.best = tuple(x[rank < self.many] for x in (q, score, found))

    def rows(self) -> pa.RecordBatch:
        q, score, found = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _scored(many: int, kind: str, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Block] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                key = tuple(batch.column(c)[k].as_py() for c in ("first", "salt", "queries"))
                if key not in held:
                    if len(held) >= HELD:
                        yield held.pop(next(iter(held))).rows()
                    held[key] = _Block(key[2], batch.column("vectors")[k].as_py(), batch.column("cells")[k].as_py(), many)
                chunk = batch.column("entries")[k].values
                second, ids, packed = (chunk.field(c) for c in range(3))
                vectors = np.frombuffer(b"".join(packed.to_pylist()), kind).reshape(-1, dims).astype(float)
                held[key].see(second.to_numpy(), ids, vectors)
        for block in held.values():
            yield block.rows()

    return run


def search(rows: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", many: int = 5, recall: float = 0.98) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for every row that fulfils ``is_query``.

    ``is_query`` is an expression of ``id``; the score is the cosine of the original vectors.
    """
    spark = rows.sparkSession
    taken = usable(rows, vec_id, vector).where(F.exists("vector", lambda x: x != 0))
    different = keep(entries(taken, many), "entries")
    n, dims = different.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    kind = "<f4" if dict(taken.dtypes)["vector"] == "array<float>" else "<f8"
    sample = different.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toArrow().column("vector")
    index = Index(_filled(sample, dims), n, many, recall)

    indexed = keep(different.mapInArrow(_indexed(index, dims, kind), "first long, second long, ids array<long>, vector binary"), "multi_index")
    k = len(index.centers[0])
    sizes = np.zeros((k, k), np.int64)
    for row in indexed.groupBy("first", "second").count().collect():  # at most one row for each cell
        sizes[row["first"], row["second"]] = row["count"]
    of_first = [(a, max(1, -(-s // BUCKET)), max(1, -(-s // CHUNK))) for a, s in enumerate(sizes.sum(axis=1).tolist())]
    buckets = F.broadcast(spark.createDataFrame(of_first, "first long, buckets long, pieces long"))
    # Pieces are numbered over the whole first centroid, and a piece lies in one bucket.
    piece = F.pmod(F.xxhash64("vector"), "pieces").alias("piece")
    dealt = indexed.join(buckets, "first").select("first", "second", "ids", "vector", piece, "buckets").withColumn("salt", F.pmod("piece", "buckets"))
    chunks = dealt.repartition("first", "salt").groupBy("first", "salt", "piece").agg(F.collect_list(F.struct("second", "ids", "vector")).alias("entries"))

    walked = taken.where(is_query).mapInArrow(_walked(index, sizes, dims), "first long, queries binary, vectors binary, cells binary")
    blocks = walked.join(buckets, "first").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    met = blocks.hint("merge").join(chunks, ["first", "salt"]).select("first", "salt", "queries", "vectors", "cells", "entries")
    with arrow_rows(spark, JOINED):
        found = keep(met.mapInArrow(_scored(many, kind, dims), "query_id long, vec_id long, score double"), "best_of_buckets")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= many)
    return ranked.select("query_id", "rank", "vec_id", "score")
