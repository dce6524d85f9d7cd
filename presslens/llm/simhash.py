"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are distinct before they meet: copies share one.  Two fingerprints that differ in at
most ``limit`` bits agree on one of ``limit + 1`` bit groups, so every fingerprint goes to one
bucket per group.  A bucket that is too full is split again on its remaining bits, which is exact
for the same reason; the number of levels follows the data.

Inside the buckets the rows are sorted by Gray rank.  Runs of neighbours become nodes: the bits all
of them share are factored into the node, children hold only what their parent does not.  A search
adds up the differences from the top node down and drops a whole group once they exceed the limit.
Only a spanning forest of the links of a bucket leaves the task, so a group of thousands of near
copies gives a link per member, not per pair.  Components come from star contraction on these
links, in rounds of joins and minima.

Defined cases: a null or empty text has fingerprint zero, which links like any other; rows with
equal id and text get equal rows of the result; a null id never is the smallest id of a component
unless all ids are null; other columns are carried along or ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, join_hot, keep, unwrapped, whole_row
from presslens.llm.components import connected, forest

WIDTH = 64
#: Children of a node.
FANOUT = 8
#: Pairs (row, node) that one step of a search may hold.
FRONT = 1_000_000


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(parts) >= words:
        ends, starts = ends[words - 1 :], starts[: len(parts) - words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    ones = np.zeros(WIDTH, np.int64)
    for k in range(0, len(hashes), 65536):
        block = hashes[k : k + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4) -> DataFrame:
    """doc_id, text_key (64-bit hash of the text) and fp (the fingerprint as a signed long)."""
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), F.xxhash64(column(text)).alias("text_key"), column(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    return in_small_batches(rows).mapInArrow(run, "doc_id long, text_key long, fp long")


def gray_rank(fp: Column) -> Column:
    """Position in Gray order, shifted so that signed order is right."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def sub_masks(mask: int, groups: int) -> list[int]:
    """``mask`` with one of ``groups`` near-equal parts of the free bits added."""
    free = [b for b in range(WIDTH) if not mask >> b & 1]
    cuts = [len(free) * k // groups for k in range(groups + 1)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def _choices(masks: list[int], groups: int) -> Column:
    """An array expression: the sub-masks of the row's own mask."""
    pairs = []
    for m in masks:
        pairs += [F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in sub_masks(m, groups)])]
    return F.element_at(F.create_map(*pairs), F.col("mask"))


def bucket_links(batch_keys: np.ndarray, fps: np.ndarray, limit: int) -> np.ndarray:
    """Spanning links, as pairs of row numbers, within equal keys; rows sorted by key and Gray rank."""
    n = len(fps)
    if n < 2:
        return np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(np.r_[True, batch_keys[1:] != batch_keys[:-1]])
    ends = np.r_[starts[1:], n]
    # levels[0] are the rows; a node above covers up to FANOUT neighbours of one bucket.
    value, mask = fps, np.full(n, ~np.uint64(0))
    levels = [(value, mask, np.arange(n), np.arange(1, n + 1))]
    lo, hi = starts, ends  # of each bucket in the level below
    while True:
        sizes = -(-(hi - lo) // FANOUT)
        first = np.r_[0, np.cumsum(sizes)]
        child = np.repeat(lo, sizes) + FANOUT * (np.arange(first[-1]) - np.repeat(first[:-1], sizes))
        last = np.minimum(child + FANOUT, np.repeat(hi, sizes))
        ones = np.bitwise_and.reduceat(value & mask, child)
        zeros = np.bitwise_and.reduceat(~value & mask, child)
        value, mask = ones, ones | zeros
        levels.append((value, mask, child, last))
        lo, hi = first[:-1], first[1:]
        if (hi - lo).max() <= 1:
            break
    top = np.repeat(lo, ends - starts)
    labels = np.arange(n)
    step = max(1, FRONT // int(max(1, (ends - starts).max())))
    for a in range(0, n, step):
        query = np.arange(a, min(n, a + step))
        node = top[query]
        known = np.zeros(len(query), np.uint64)
        differences = np.zeros(len(query), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            value, mask, child, last = levels[level]
            differences = differences + np.bitwise_count((fps[query] ^ value[node]) & mask[node] & ~known)
            near = differences <= limit
            if level == 0:
                near &= node > query
                labels = forest(labels, query[near], node[near])
                break
            query, node, differences = query[near], node[near], differences[near]
            many = last[node] - child[node]
            known = np.repeat(mask[node], many)
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            query, differences = np.repeat(query, many), np.repeat(differences, many)
            node = np.repeat(child[node], many) + offset
    linked = np.flatnonzero(labels != np.arange(n))
    return np.stack([linked, labels[linked]], axis=1)


def _linker(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            fps = rows[1].view(np.uint64)
            found = bucket_links(rows[0], fps, limit)
            return pa.RecordBatch.from_arrays([pa.array(rows[1][found[:, 0]]), pa.array(rows[1][found[:, 1]])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "fp")])
            # The last bucket may go on in the next batch.
            cut = int(np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])[-1])
            if cut:
                yield links(np.concatenate([*rest, rows[:, :cut]], axis=1))
                rest = [rows[:, cut:]]
            elif rest and rest[-1][0, -1] != rows[0, 0]:
                yield links(np.concatenate(rest, axis=1))
                rest = [rows]
            else:
                rest.append(rows)
        if rest:
            yield links(np.concatenate(rest, axis=1))

    return run


def links(distinct: DataFrame, limit: int = 4, full: int = 2048, deepest: int = 4) -> DataFrame:
    """Links (a, b) that span every component of fingerprints within ``limit`` differing bits.

    ``full`` is the number of rows beyond which a bucket is split on further bits; after
    ``deepest`` splits at most 26 bits are free, and no bucket can hold more than the 18,000 or so
    values that lie close to each other there, beside those the search prunes.
    """
    groups = limit + 1
    masks = sub_masks(0, groups)
    level = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    out = None
    for depth in range(1, deepest + 1):
        level = level.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sizes = level.groupBy("mask", "value").agg(F.count("*").alias("size"))
        over = keep(sizes.where(F.col("size") > full).select("mask", "value"), "full-buckets") if depth < deepest else None
        crowded = over is not None and not over.isEmpty()
        own = level.join(over, ["mask", "value"], "left_anti") if crowded else level
        searched = (
            own.select(F.xxhash64("mask", "value").alias("bucket"), "fp")
            .repartition("bucket")
            .withColumn("rank", gray_rank(F.col("fp")))
            .sortWithinPartitions("bucket", "rank")
            .select("bucket", "fp")
            .mapInArrow(_linker(limit), "a long, b long")
        )
        out = searched if out is None else out.unionByName(searched)
        if not crowded:
            break
        level = level.join(over, ["mask", "value"], "left_semi").select("fp", F.explode(_choices(masks, groups)).alias("mask")).distinct()
        masks = list(dict.fromkeys(x for m in masks for x in sub_masks(m, groups)))
    return out


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, limit: int = 4, full: int = 2048) -> DataFrame:
    """doc_id, text_key, fp, root (the component's own name), component_id (its smallest doc_id) for every row."""
    rows = keep(fingerprints(docs, text, doc_id, words), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows"))
    roots = connected(links(distinct.select("fp"), limit, full))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", "n_rows", F.coalesce("root", "fp").alias("root"))
    placed = keep(placed, "rooted")
    least = keep(placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size")), "least-ids")
    grouped = keep(join_hot(placed, least, ["root"], "size").select("fp", "root", "component_id", "n_rows"), "components")
    return join_hot(rows, grouped, ["fp"], "n_rows").drop("n_rows")


def drop_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", groups: Callable[..., DataFrame] = near_groups, **options) -> DataFrame:
    """One document of each group: the one with the smallest id, with all its columns.

    ``groups`` says what a group is: fingerprints within some bits, or ``near_texts.similar_groups``.

    Rows that repeat that id with the same text stay together; the exact stage removes those.
    """
    found = groups(docs, text, doc_id, **options)
    gone = found.where("doc_id <> component_id or doc_id is null and component_id is not null").select("doc_id", "text_key")
    gone = keep(gone.distinct(), "near-copies").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    rows = docs.select(whole_row(docs).alias("row"), column(doc_id).cast("long").alias("id"), F.xxhash64(column(text)).alias("key"))
    rest = rows.join(gone, (F.col("key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id")), "left_anti")
    return unwrapped(rest, docs.columns)
