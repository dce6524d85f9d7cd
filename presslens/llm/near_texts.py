"""Near copies by the Jaccard similarity of their sets of word shingles.

Texts whose sets of ``words``-word shingles have a Jaccard similarity of at least ``least`` are
linked; a group is a connected component.  Candidates come from MinHash: ``BANDS`` keys of ``ROWS``
minima each, so a pair of similarity 0.8 misses all of them with probability (1 - 0.8^4)^20, less
than 3 in 100,000, and a more similar pair with less.  Every candidate is confirmed on the sets
themselves, so no link is false.

``groups`` is an operator whose groups are candidates as well, each one more bucket: with
``simhash.near_groups`` the pipeline's near stage runs that method and confirms what it links.

Equal sets are one node from the start.  Buckets with the same members are one bucket.  A bucket is
searched from member to member: what is linked leaves the rest that is still compared, so a large
group of near copies costs a few passes over its sets, not one a pair.

Defined cases: words are split at blanks, lower case for A-Z; a text of fewer words than a shingle
is one shingle; texts without a word, null included, are one group; a null id never is the smallest
id of a group unless all ids are null; rows that repeat are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, join_hot, keep
from presslens.llm.components import connected

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 20, 4
_RNG = np.random.default_rng(5)
_TIMES = _RNG.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_FOLD = _RNG.integers(1, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 of the word shingles."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    span = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(parts) - span + 1].tolist(), ends[span - 1 :].tolist())
    return np.unique(np.array([digest(joined[a:b]) for a, b in pairs], np.uint64))


def band_keys(own: np.ndarray) -> np.ndarray:
    """One key a band; none for an empty set."""
    if not len(own):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(own), 1024):
        mixed = own[k : k + 1024, None] * _TIMES + _PLUS
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(axis=0))
    keys = (least.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64)
    return (keys ^ keys >> np.uint64(31)).view(np.int64)


def similar_links(sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """Pairs of positions with at least that similarity which span the components of all such pairs."""
    sizes = np.array([len(s) for s in sets])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    bounds = np.r_[0, np.cumsum(sizes)]
    marked = np.zeros(len(names), bool)
    rest = np.ones(len(sets), bool)  # not reached yet
    out, shingle, left = [], flat, owner
    for first in range(len(sets)):
        if not rest[first]:
            continue
        rest[first] = False
        front = [first]
        while front:
            at = front.pop()
            stays = rest[left]
            if 2 * stays.sum() < len(left):
                shingle, left = shingle[stays], left[stays]
            if not len(left):
                return out
            own = flat[bounds[at] : bounds[at + 1]]
            marked[own] = True
            shared = np.bincount(left[marked[shingle]], minlength=len(sets))
            marked[own] = False
            near = np.flatnonzero(rest & (shared > 0) & (shared >= least * (sizes[at] + sizes - shared) - 1e-9))
            rest[near] = False
            out += [(at, k) for k in near.tolist()]
            front += near.tolist()
    return out


def _links(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, nodes, sets = None, [], []

        def found() -> pa.RecordBatch:
            pairs = np.array(similar_links(sets, least), np.int64).reshape(-1, 2)
            own = np.array(nodes, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own[pairs[:, 0]]), pa.array(own[pairs[:, 1]])], ["a", "b"])

        for batch in batches:
            for key, node, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "node", "own"))):
                if key != bucket:
                    if len(nodes) > 1:
                        yield found()
                    bucket, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(np.frombuffer(packed, "<u8"))
        if len(nodes) > 1:
            yield found()

    return run


def similar_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, least: float = LEAST,
    groups: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """doc_id, text_key, component_id (the smallest doc_id of the group) for every row.

    ``groups(docs, text, doc_id)`` gives further candidates, as (text_key, root) for every row.
    """
    texts = docs.select(column(doc_id).cast("long").alias("doc_id"), F.xxhash64(column(text)).alias("text_key"), column(text).alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            keys = pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(nodes), keys], ["doc_id", "text_key", "node", "keys"])

    def own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "own"])

    rows = keep(in_small_batches(texts).mapInArrow(keyed, "doc_id long, text_key long, node long, keys array<bigint>"), "shingle-keys")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.first("keys").alias("keys"), F.count("*").alias("n_rows"))
    entries = nodes.select("node", F.posexplode("keys").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("bucket"))
    if groups is not None:
        own = rows.select("text_key", "node").distinct().join(groups(docs, text, doc_id).select("text_key", "root").distinct(), "text_key")
        entries = entries.unionByName(own.select("node", F.xxhash64(F.lit(BANDS), "root").alias("bucket")).distinct())
        entries = keep(entries, "bucket-entries")
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"))
    chosen = sizes.where("size > 1").groupBy("size", "members").agg(F.min("bucket").alias("bucket")).select("bucket")
    placed = keep(entries.join(chosen, "bucket", "left_semi"), "candidates")
    wanted = placed.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    one_text = texts.select("text_key", "text").join(wanted, "text_key").dropDuplicates(["node"]).select("node", "text")
    sets = keep(in_small_batches(one_text).mapInArrow(own_sets, "node long, own binary"), "shingle-sets")
    dealt = placed.join(sets, "node").repartition("bucket").sortWithinPartitions("bucket", "node").select("bucket", "node", "own")
    roots = connected(dealt.mapInArrow(_links(least), "a long, b long"))
    joined = nodes.select("node", "least", "n_rows").join(roots, "node", "left").select("node", "least", "n_rows", F.coalesce("root", "node").alias("root"))
    joined = keep(joined, "rooted")
    lowest = keep(joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size")), "least-ids")
    grouped = keep(join_hot(joined, lowest, ["root"], "size").select("node", "component_id", "n_rows"), "components")
    return join_hot(rows.select("doc_id", "text_key", "node"), grouped, ["node"], "n_rows").select("doc_id", "text_key", "component_id")
