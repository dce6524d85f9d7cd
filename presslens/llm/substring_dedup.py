"""Removal of long repeated byte strings with run-length compressed suffix indexes.

Every window of ``WINDOW`` bytes has an owner: the gram of ``GRAM`` bytes inside it with the least
hash.  Equal windows have equal owners at the same place, so only places with the same owner need
to meet.  Consecutive windows with one owner form a segment, and what travels of a segment is its
place, the hash of its owner and the hash of its bytes:

* segments that occur twice are repeated throughout, which settles copies of any number by counts;
* owners with one kind of segment are settled as well;
* only the kinds of segments that share an owner with other kinds fetch their bytes, once per kind.

Those bytes go to shards of bounded size.  A shard builds the Burrows-Wheeler transform of its
segments, compresses it to runs and keeps samples at run heads and run ends only: there the length
of the match with the neighbour in suffix order is measured.  Between samples it falls by one per
byte, so streaming once over the text gives the matching statistics of every position against all
others, and windows whose statistic reaches ``WINDOW`` are repeated.

An owner with very many kinds of segments (a passage that a third of all documents hold, in
different surroundings) does not go to a shard.  Its segments are halved round by round: a part all
of which occurs elsewhere is settled, so is a part whose common core is unique, others are halved
again.  A round is a count of hashes, so no group is gathered anywhere.

Hashes are 64-bit polynomials; equal bytes always meet, and only a chance collision of 64 bits could
add a match outside the shards.

Defined cases: a null text is empty; texts below the window length keep every byte; a row that
repeats is a copy like any other; matches never span documents; overlaps count; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, join_hot, keep

WINDOW, GRAM = 400, 128
#: Bytes of a shard, and kinds of segments beyond which an owner is settled by halving.
SHARD_BYTES, MOST_KINDS = 2_000_000, 4_000
#: Bytes hashed at once.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_NULL_ID = -(1 << 63)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 21)
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            _POWERS.append(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64))
        del _POWERS[:-2]
    return _POWERS


class Hashes:
    """Polynomial hashes of all substrings of some bytes."""

    def __init__(self, data: bytes):
        letters = _LETTER[np.frombuffer(data, np.uint8)]
        self.up, self.down = _powers(len(letters) + 1)
        self.sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(letters * self.up[: len(letters)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return _mix(raw + np.asarray(end - start).astype(np.uint64))


def segments(parts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(part, start, windows, distance of the owner, owner hash, segment hash) of every segment of the parts."""
    ends = np.cumsum([len(p) for p in parts])
    data = b"".join(parts)
    if len(data) < window:
        return (np.zeros(0, np.int64),) * 6
    hashes = Hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = hashes.of(at, at + gram)
    # The least hash is the least number here, the leftmost among equals; the place is in the low bits.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: -(width - span)], least[width - span :])
    part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[: len(least)]
    inside = np.arange(len(least)) + window <= ends[part]
    changes = inside & np.r_[True, (least[1:] != least[:-1]) | (part[1:] != part[:-1])]
    start = np.flatnonzero(changes)
    part = part[start]
    stop = np.minimum(np.r_[start[1:], len(data)], ends[part] - window + 1)
    place = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = grams[place]
    begins = np.r_[0, ends[:-1]]
    return part, start - begins[part], stop - start, place - start, owner.view(np.int64), hashes.of(start, stop + window - 1).view(np.int64)


def _segment_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            parts, owner_row, offset, held = [], [], [], 0

            def out():
                part, start, windows, shift, anchor, seg = segments(parts, window, gram)
                row = np.array(owner_row, int)[part]
                return pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[row], keys[row], anchor, seg, np.array(offset, np.int64)[part] + start, windows, shift)],
                    ["id", "key", "anchor", "seg", "lo", "n", "shift"],
                )

            for k, text in enumerate(batch.column("text").to_pylist()):
                data = (text or "").encode()
                for at in range(0, len(data) - window + 1, PIECE):
                    part = data[at : at + PIECE + window - 1]
                    parts.append(part)
                    owner_row.append(k)
                    offset.append(at)
                    held += len(part)
                    if held >= PIECE:
                        yield out()
                        parts, owner_row, offset, held = [], [], [], 0
            if parts:
                yield out()

    return run


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, sampled at run heads and run ends."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts])
        self.starts = np.r_[0, np.cumsum(sizes)[:-1]]
        n = int(sizes.sum())
        # Every text ends in a sign of its own, below all bytes, so no match can pass it.
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + len(texts)
        symbols[self.starts + sizes - 1] = np.arange(len(texts))
        self.ranks = [symbols]
        rank, span = symbols.astype(np.int64), 1
        longest = int(sizes.max())
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[:-span] = rank[span:] + 1
            pair = rank * (max(n, 256 + len(texts)) + 2) + ahead
            order = np.argsort(pair, kind="stable")
            ordered = pair[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            if span * 2 >= longest or rank[order[-1]] == n - 1:
                break
            span *= 2
            self.ranks.append(rank.astype(np.int32))
        self.order = order.astype(np.int32)
        before = np.where(self.order > 0, symbols[self.order - 1], -1)
        change = before[1:] != before[:-1]
        #: Places in suffix order where a run of the transform begins or ends.
        self.heads, self.tails = np.flatnonzero(np.r_[True, change]), np.flatnonzero(np.r_[change, True])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        length, last = np.zeros(len(a), np.int64), len(self.order) - 1
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks = self.ranks[k]
            # A step may succeed twice at the top, where the table ends.
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                same = (ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)]) & (a <= last) & (b <= last) & (a != b)
                length += same << k
                a, b = a + (same << k), b + (same << k)
        return length

    def matching_statistics(self) -> np.ndarray:
        """For every position the longest match that also starts elsewhere, streamed from the samples."""
        n = len(self.order)
        out = np.zeros(n, np.int64)
        for places, step in ((self.heads, -1), (self.tails, 1)):
            inner = places[(places + step >= 0) & (places + step < n)]
            sample = np.zeros(n, np.int64)
            marked = np.zeros(n, bool)
            at = self.order[places]
            marked[at] = True
            sample[self.order[inner]] = self.common(self.order[inner], self.order[inner + step])
            last = np.maximum.accumulate(np.where(marked, np.arange(n), 0))
            np.maximum(out, sample[last] - (np.arange(n) - last), out=out)
        return out


def repeated_windows(texts: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """Per text the ranges of starts whose window also starts elsewhere in the texts."""
    index = RunLengthIndex(texts)
    long = index.matching_statistics() >= window
    found = []
    for start, text in zip(index.starts.tolist(), texts):
        edges = np.diff(np.r_[0, long[start : start + len(text)].astype(np.int8), 0])
        found.append(list(zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist())))
    return found


def _indexer(window: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        ranges = repeated_windows([bytes(b) for b in shard["bytes"]], window)
        rows = [
            (i, k, lo + a, lo + z + window - 1)
            for i, k, lo, single, spans in zip(shard["id"], shard["key"], shard["lo"], shard["single"], ranges) if single
            for a, z in spans
        ]
        return pd.DataFrame(rows, columns=["id", "key", "a", "z"])

    return run


def _cutter(window: int):
    """Bytes of the wanted segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in ("id", "key", *_WANTED, "bytes")}
            for i, k, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "text", "wanted"))):
                data = text.encode()
                for w in wanted:
                    for c, v in (("id", i), ("key", k), *w.items()):
                        columns[c].append(v)
                    columns["bytes"].append(data[w["lo"] : w["lo"] + w["n"] + window - 1])
            kinds = [pa.int64()] * 7 + [pa.bool_(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), kinds)], list(columns))

    return run


#: What is known of a wanted segment before its bytes are there.
_WANTED = ("anchor", "seg", "lo", "n", "shift", "single", "many")
_PART = ("id", "key", "anchor", "seg", "lo", "block", "settled", "a", "z", "first", "whole", "core")


def _halver(window: int, size: int):
    """Hash of each part (all its windows) and of its core (what all windows of its block share)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in _PART}
            names = ("id", "key", "anchor", "seg", "lo", "n", "shift", "bytes", "parts")
            for i, k, anchor, seg, lo, n, shift, data, parts in zip(*(batch.column(c).to_pylist() for c in names)):
                hashes = Hashes(data)
                for part in parts:
                    # Windows of the block begin block * size to (block + 1) * size - 1 before the owner.
                    near = part["block"] * size
                    a, z = max(0, shift - near - size + 1), min(n, shift - near + 1)
                    if a >= z:
                        continue
                    core = shift - near, shift - near - size + 1 + window
                    ends = np.array([a, core[0]]), np.array([z + window - 1, core[1]])
                    whole, middle = hashes.of(*ends).view(np.int64).tolist()
                    values = (i, k, anchor, seg, lo, part["block"], part["settled"], a, z, shift - a, whole, middle)
                    for c, v in zip(_PART, values):
                        columns[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.bool_() if c == "settled" else pa.int64()) for c, v in columns.items()], list(columns)
            )

    return run


def _halved(base: DataFrame, window: int, gram: int) -> DataFrame:
    """(id, key, a, z) of repeated windows of the owners with very many kinds of segments.

    Equal windows have their owner at the same distance, so parts are blocks of that distance, the
    same for all segments.  A block whose core no other segment has is settled; so is a part that
    another segment has as well; the rest is halved until a block is one window.
    """
    size = 1 << (window.bit_length() - 1)
    blocks = range(-(-(window - gram + 1) // size))
    parts = base.select("anchor", "seg", F.explode(F.array(*[F.lit(b).cast("long") for b in blocks])).alias("block"), (~F.col("single")).alias("settled"))
    found = None
    schema = ", ".join(f"{c} {'boolean' if c == 'settled' else 'long'}" for c in _PART)
    while True:
        held = parts.groupBy("anchor", "seg").agg(F.collect_list(F.struct("block", "settled")).alias("parts"))
        hashed = keep(base.join(held, ["anchor", "seg"]).mapInArrow(_halver(window, size), schema), "halves")
        core = ["anchor", "block", "core"]
        cores = keep(hashed.groupBy(*core).agg(F.count("*").alias("meets"), F.count_if(~F.col("settled")).alias("open")), "cores")
        active = keep(join_hot(hashed, cores, core, "meets").where("meets > 1 and open > 0").drop("meets", "open"), "active")
        last = size == 1
        same = core if last else ["anchor", "block", "first", "whole"]
        times = keep(active.groupBy(*same).agg(F.count("*").alias("times")), "times")
        judged = keep(join_hot(active, times, same, "times"), "judged")
        new = judged.where("times > 1 and not settled").select("id", "key", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("z") + window - 1).alias("z"))
        found = new if found is None else found.unionByName(new)
        if last or judged.isEmpty():
            return found
        halves = F.explode(F.array(F.col("block") * 2, F.col("block") * 2 + 1)).alias("block")
        parts = judged.select("anchor", "seg", halves, (F.col("settled") | (F.col("times") > 1)).alias("settled"))
        size //= 2


def repeated_ranges(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES, most_kinds: int = MOST_KINDS,
) -> tuple[DataFrame, DataFrame]:
    """The rows (id, key, text) and the byte ranges (id, key, a, z) of them that repeated windows cover."""
    rows = docs.select(
        F.coalesce(column(doc_id).cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64(column(text)).alias("key"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    place = "id long, key long, anchor long, seg long, lo long, n long, shift long"
    every = keep(in_small_batches(rows).mapInArrow(_segment_rows(window, gram), place), "segments")
    met = keep(every.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1"), "met-owners")
    meeting = keep(join_hot(every, met, ["anchor"], "rows").drop("rows"), "meeting")
    first = [F.first(c).alias(c) for c in ("id", "key", "lo", "n", "shift")]
    kinds = keep(meeting.groupBy("anchor", "seg").agg(F.count("*").alias("copies"), *first), "kinds")
    # Kinds that occur twice are repeated throughout, at every place.
    twice = kinds.where("copies > 1").select("anchor", "seg", "copies")
    whole = join_hot(meeting, twice, ["anchor", "seg"], "copies").select("id", "key", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + window - 1).alias("z"))
    # Owners with several kinds need the bytes, once per kind.
    several = keep(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "owners")
    wanted = join_hot(kinds, several, ["anchor"], "kinds").withColumns({"single": F.col("copies") == 1, "many": F.col("kinds") > most_kinds})
    wanted = wanted.groupBy("id", "key").agg(F.collect_list(F.struct(*_WANTED)).alias("wanted"))
    schema = "id long, key long, anchor long, seg long, lo long, n long, shift long, single boolean, many boolean, bytes binary"
    # A row that repeats would bring its segments twice, but a kind is wanted once.
    cut = keep(rows.join(wanted, ["id", "key"]).mapInArrow(_cutter(window), schema).dropDuplicates(["anchor", "seg"]), "wanted-bytes")
    sums = cut.groupBy("many").agg(F.sum(F.length("bytes") + 1).alias("n")).collect()
    volume = {r["many"]: r["n"] for r in sums}
    shards = -(-volume.get(False, 0) // shard_bytes) or 1
    few = cut.where("not many").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = whole.unionByName(few.groupBy("shard").applyInPandas(_indexer(window), "id long, key long, a long, z long"))
    if volume.get(True):
        found = found.unionByName(_halved(cut.where("many"), window, gram))
    return rows, found


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes that stay; rows without a range come with their results and no text."""
    for batch in batches:
        n_removed, n_spans, kept = [], [], []
        for text, ranges in zip(batch.column("cut").to_pylist(), batch.column("ranges").to_pylist()):
            if ranges is None:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(None)
                continue
            data, rest, at, spans, removed = text.encode(), [], 0, 0, 0
            end = -1
            for r in sorted(ranges, key=lambda r: r["a"]):
                if r["a"] > end:
                    spans += 1
                    rest.append(data[at : r["a"]] if at < r["a"] else b"")
                    removed += r["z"] - r["a"]
                    end = at = r["z"]
                elif r["z"] > end:
                    removed += r["z"] - end
                    end = at = r["z"]
            rest.append(data[at:])
            n_removed.append(removed)
            n_spans.append(spans)
            kept.append(b"".join(rest))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_bytes"), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array([None if k is None else hashlib.sha256(k).hexdigest() for k in kept], pa.string()), batch.column("whole_sha256"),
             pa.array(kept, pa.binary())],
            ["id", "n_bytes", "n_removed", "n_spans", "cut_sha256", "whole_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (remaining bytes, null where nothing is removed)."""
    rows, found = repeated_ranges(docs, text, doc_id, **options)
    ranges = found.groupBy("id", "key").agg(F.collect_set(F.struct("a", "z")).alias("ranges"))
    joined = rows.join(ranges, ["id", "key"], "left")
    ready = joined.select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.when(F.col("ranges").isNull(), F.sha2("text", 256)).alias("whole_sha256"),
        F.when(F.col("ranges").isNotNull(), F.col("text")).alias("cut"), "ranges",
    )
    schema = "id long, n_bytes long, n_removed long, n_spans long, cut_sha256 string, whole_sha256 string, kept binary"
    out = ready.mapInArrow(_remover, schema)
    return out.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"), "kept",
    )
