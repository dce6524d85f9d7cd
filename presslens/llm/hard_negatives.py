"""Hard-negative mining with exact integer scores from Four-Russians tables.

The components of an anchor are taken eight at a time, and for each of the 256 subsets of the eight
the sum of their components is kept (``tables``).  Candidates are stored as bit planes: the k-th bits of
eight components are one byte, and that byte is the number of a subset.  So a score is a sum of table
entries over the bytes of a plane, shifted by the plane's weight and added over all planes; the
top plane of two's complement counts negative.  No component is multiplied, and every score is exact.

Anchors come in blocks of about ``BLOCK`` rows and candidates in chunks of at most ``CHUNK`` rows.  Chunks lie in
bands, every block visits every band, and a band keeps no more than the best few of each anchor, which are
then compared between bands.  A first pass finds the positives, whose scores bound the second one.

Defined cases: rows without id or label, without a vector, or with a component that is null or
not finite take no part; nor do rows with a component of 2**20 or more, whose product would not fit
64 bits; shorter vectors are filled with zeros, so an empty one scores 0; of several rows of an id the least
(vector, label) counts; an anchor without positives, or a positive without negatives, has no rows;
ties go to the smaller id; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import keep
from presslens.llm.vectors import arrow_rows, best_of, matrix, usable

#: Candidates of a chunk, anchors of a block, bands at most.
CHUNK, BLOCK, BANDS = 2048, 128, 4096
#: Components as large as this, before they are scaled, take no part.
LIMIT = float(1 << 20)
#: Blocks whose best rows a task holds back, and joined rows of an Arrow batch.
HELD, JOINED = 16, 32
_LOWEST, _HIGHEST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
_BEST = "anchor_id long, positive_id long, positive_score long, id long, score long"


def planes(ints: np.ndarray) -> np.ndarray:
    """Bit planes (plane, row, group of eight components) of integers in two's complement."""
    width = int(max(ints.max(initial=0), -(ints.min(initial=0) + 1), 0)).bit_length() + 1
    bits = (ints[None] >> np.arange(width)[:, None, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums (group, subset, anchor) of the components of each anchor, eight to a group."""
    groups = -(-anchors.shape[1] // 8)
    filled = np.zeros((groups * 8, len(anchors)), np.int64)
    filled[: anchors.shape[1]] = anchors.T
    out = np.zeros((groups, 256, len(anchors)), np.int64)
    for bit in range(8):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + filled[bit::8, None]
    return out


def scores(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Inner products (row, anchor) by table look-ups, shifts and additions."""
    width, n, groups = bits.shape
    groups = min(groups, len(sums))
    # 32 bits do where no partial sum can leave them.
    bound = np.abs(sums).max(axis=1).sum(axis=0).max(initial=0) if sums.size else 0
    kind = np.int32 if int(bound) << width < 1 << 31 else np.int64
    sums = sums.astype(kind)
    total, looked = np.zeros((n, sums.shape[2]), kind), np.empty((n, sums.shape[2]), kind)
    for k in range(width):
        plane = np.zeros_like(total)
        for g in range(groups):
            plane += np.take(sums[g], bits[k, :, g], axis=0, out=looked, mode="clip")
        plane <<= k
        if k + 1 < width:
            total += plane
        else:
            total -= plane
    return total.astype(np.int64)


def _packed(scale: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
                order = np.argsort(ids, kind="stable")
                ints = np.floor(scale * matrix(batch.column("vector"))).astype(np.int64)[order]
                bits = planes(ints)
                yield pa.RecordBatch.from_pydict({
                    "band": [int(ids.min()) * 0x9E3779B1 % (1 << 32) % bands], "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()],
                    "bits": [bits.tobytes()], "width": [bits.shape[0]],
                })

    return run


def chunks(rows: DataFrame, scale: int, bands: int) -> DataFrame:
    """Candidates packed into bit planes, a chunk a row; ``rows`` are (id, label, vector)."""
    return rows.mapInArrow(_packed(scale, bands), "band long, ids binary, labels binary, bits binary, width long")


def blocks(anchors: DataFrame, n: int, bands: int) -> DataFrame:
    """Anchors (id, label, vector, positives) in blocks; every block once for each band."""
    number = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // BLOCK)))).alias("block")
    packed = anchors.groupBy(number).agg(F.collect_list(F.struct("id", "label", "vector", "positives")).alias("anchors"))
    return packed.withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bands - 1).cast("long"))))


class _Block:
    """Anchors of a block with the windows of scores that are wanted, and the best rows found so far."""

    def __init__(self, anchors: pa.StructArray, scale: int, same: bool, many: int, low: int, high: int):
        self.ids, self.labels = (anchors.field(k).to_numpy() for k in (0, 1))
        self.sums = tables(np.floor(scale * matrix(anchors.field(2))).astype(np.int64))
        self.same, self.many = same, many
        if same:
            self.of = np.arange(len(self.ids))
            self.positive = self.score = np.zeros(len(self.ids), np.int64)
            self.low, self.high = np.full(len(self.ids), _LOWEST + 1), np.full(len(self.ids), _HIGHEST)
        else:
            positives = anchors.field(3)
            self.of = np.repeat(np.arange(len(self.ids)), np.diff(positives.offsets.to_numpy()))
            self.positive, self.score = (positives.flatten().field(k).to_numpy() for k in (0, 1))
            # low * positive <= 100 * negative <= high * positive, rounded to whole scores.
            self.low, self.high = -(-low * self.score // 100), high * self.score // 100
        self.best = np.full((len(self.of), many), _LOWEST), np.full((len(self.of), many), _HIGHEST)

    def see(self, ids: np.ndarray, labels: np.ndarray, bits: np.ndarray) -> None:
        """Take in a chunk, sorted by id."""
        found = scores(self.sums, bits)
        alike = labels[:, None] == self.labels
        wanted = alike & (ids[:, None] != self.ids) if self.same else ~alike
        least = np.where(wanted, -found, _HIGHEST)
        order = np.argsort(least, axis=0, kind="stable")
        own = np.full((2, len(self.of), self.many), _HIGHEST)
        for w, a in enumerate(self.of.tolist()):
            column = order[:, a]
            down = least[column, a] if w == 0 or a != self.of[w - 1] else down  # noqa: F821
            start, end = np.searchsorted(down, -self.high[w]), np.searchsorted(down, -self.low[w], "right")
            rows = column[start : min(end, start + self.many)]
            own[0, w, : len(rows)], own[1, w, : len(rows)] = least[rows, a], ids[rows]
        self.best = best_of(np.hstack([self.best[0], -own[0]]), np.hstack([self.best[1], own[1]]), self.many)

    def rows(self) -> pa.RecordBatch:
        w, k = np.nonzero(self.best[1] < _HIGHEST)
        columns = [self.ids[self.of[w]], self.positive[w], self.score[w], self.best[1][w, k], self.best[0][w, k]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "positive_score", "id", "score"])


def _scored(scale: int, same: bool, many: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], _Block] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                band, number, width = (batch.column(c)[k].as_py() for c in ("band", "block", "width"))
                if (band, number) not in held:
                    if len(held) >= HELD:
                        yield held.pop(next(iter(held))).rows()
                    held[band, number] = _Block(batch.column("anchors")[k].values, scale, same, many, low, high)
                ids, labels = (np.frombuffer(batch.column(c)[k].as_py(), np.int64) for c in ("ids", "labels"))
                bits = np.frombuffer(batch.column("bits")[k].as_py(), np.uint8).reshape(width, len(ids), -1)
                held[band, number].see(ids, labels, bits)
        for block in held.values():
            yield block.rows()

    return run


def _best(anchors: DataFrame, packed: DataFrame, scale: int, same: bool, many: int, low: int = 0, high: int = 0) -> DataFrame:
    """The best candidates of every anchor, or of every anchor and positive, with their ranks."""
    # Blocks are streamed and the chunks of their band read again for each: the best rows of a block stay in memory.
    met = anchors.hint("merge").join(packed, "band")
    wanted = met.select("band", "block", "anchors", "ids", "labels", "bits", "width")
    spark = anchors.sparkSession
    with arrow_rows(spark, JOINED):
        found = keep(wanted.mapInArrow(_scored(scale, same, many, low, high), _BEST), "best_of_bands")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def mine(
    rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    n_positive: int = 5, n_negative: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the components times ``scale``, rounded down.  The positives of an
    anchor, a row that fulfils ``is_anchor`` (an expression of id and label), are its best rows of the
    same label.  Negatives have another label and a score of ``low`` to ``high`` per cent of the positive's.
    """
    taken = usable(rows, vec_id, vector, label, limit=LIMIT).select("id", F.col(label).cast("long").alias("label"), "vector")
    anchors = taken.where(is_anchor)
    n, n_anchors = taken.count(), anchors.count()
    bands = max(1, min(-(-n // CHUNK), BANDS))
    packed = keep(chunks(taken, scale, bands), "bit_planes")
    none = F.array().cast("array<struct<id: bigint, score: bigint>>").alias("positives")
    positives = _best(blocks(anchors.select("*", none), n_anchors, bands), packed, scale, True, n_positive)
    listed = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    negatives = _best(blocks(anchors.join(listed, "id"), n_anchors, bands), packed, scale, False, n_negative, low, high)
    return negatives.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH taken AS (
         SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS ints
         FROM embeddings
         WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     pairs AS (
         SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
                list_sum(list_transform(range(1, len(a.ints) + 1), lambda i: a.ints[i] * b.ints[i]))::BIGINT AS score
         FROM taken a JOIN taken b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     positives AS (
         SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE alike
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""
