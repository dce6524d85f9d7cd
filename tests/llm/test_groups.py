"""Exact dedup, SimHash groups, components and substring removal against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from presslens.llm import exact_dedup, simhash, substring_dedup
from presslens.llm.components import connected, forest
from text_rows import AWKWARD, frame


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def brute_exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = True
        for d in ids:
            stays = d == keep and left
            left = left and not stays
            out.append((d, keep, len(ids), stays, sha(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [16, 1])
def test_exact_groups(spark, awkward, bits):
    got = exact_dedup.exact_groups(awkward, bits_per_row=bits, max_bits=1 << 15).collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(AWKWARD)


def test_exact_filter_has_no_false_negative(spark):
    rows = [(k, f"text {k % 700}") for k in range(1500)]
    got = exact_dedup.exact_groups(frame(spark, rows), max_bits=1 << 15).collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(rows)


def test_unique_rows_are_not_suspected(spark):
    rows = frame(spark, [(k, f"text {k}") for k in range(2000)], extra=False)
    from pyspark.sql import functions as F

    tested = exact_dedup.with_suspicion(rows.withColumn("h", F.xxhash64("text")), 2000)
    assert tested.where("maybe").count() < 100


def test_ranges_keep_unique_rows_unsuspected(spark):
    """A filter of one block cannot hold all rows; cut into ranges it still lets unique rows pass."""
    from pyspark.sql import functions as F

    texts = [(k, f"text {k if k < 9000 else k % 50}") for k in range(10_000)]
    rows = frame(spark, texts, extra=False)
    tested = exact_dedup.with_suspicion(rows.withColumn("h", F.xxhash64("text")), 10_000, max_bits=1 << 15).cache()
    assert tested.count() == 10_000 and tested.where("not maybe").count() > 0.95 * 8950
    assert tested.where("not maybe").join(rows.where("doc_id >= 9000"), "text").count() == 0
    got = exact_dedup.drop_exact(rows, max_bits=1 << 15).collect()
    assert {(r.doc_id, r.text) for r in got} == set({t: (k, t) for k, t in texts}.values()) and len(got) == 9000


def test_drop_exact(spark, awkward, nothing):
    got = exact_dedup.drop_exact(awkward)
    assert got.columns == awkward.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        {(d, t) for (d, t) in AWKWARD if (d, sha(t)) in {(x[1], x[4]) for x in brute_exact(AWKWARD)}}
        - {(1, None)}, key=repr)
    assert exact_dedup.drop_exact(nothing).count() == 0
    assert exact_dedup.exact_groups(nothing).count() == 0


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def test_fingerprint_and_spark_hash_agree(spark):
    for text in [t for _, t in AWKWARD] + ["A b C d E", "a  b\x0bc d e f", "Ä b c d"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("one two three four"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"one two three four", 42)


def brute_components(fps, limit):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= limit:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def close_fingerprints(seed, n=160):
    rng = random.Random(seed)
    fps = set()
    for _ in range(8):
        center = rng.getrandbits(64)
        fps |= {center ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5]))) for _ in range(n // 8)}
    return sorted(fps | {0, (1 << 64) - 1})


@pytest.mark.parametrize("full", [2048, 4])
def test_links_span_the_same_components(spark, full):
    fps = close_fingerprints(full)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute_components(fps, 4)
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, full).collect()
    roots = brute_components_from(links, fps)
    assert partition(roots) == partition(want)
    if full == 2048:  # one level: a spanning forest for each of five bit groups
        assert len(links) <= 5 * len(fps)


def brute_components_from(links, fps):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a % (1 << 64)), root(b % (1 << 64))
        parent[max(a, b)] = min(a, b)
    return {f: root(f) for f in fps}


def partition(roots):
    out = defaultdict(set)
    for k, v in roots.items():
        out[v].add(k)
    return sorted(map(sorted, out.values()))


def test_bucket_links_need_few_rows():
    rng = np.random.default_rng(5)
    base = np.uint64(rng.integers(1 << 62))
    fps = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    found = simhash.bucket_links(np.zeros(len(fps), np.int64), fps, 4)
    assert len(found) == len(fps) - 1  # a spanning tree, not all pairs


def test_forest_and_components(spark):
    assert forest(np.arange(6), np.array([1, 3, 4]), np.array([0, 4, 5])).tolist() == [0, 0, 2, 3, 3, 3]
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups(spark, awkward, nothing):
    got = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in simhash.near_groups(awkward).collect()}
    fps = {slow_fingerprint(t) for _, t in AWKWARD}
    roots = brute_components(sorted(fps), 4)
    least = defaultdict(list)
    for d, t in AWKWARD:
        least[roots[slow_fingerprint(t)]].append(d)
    for d, t in AWKWARD:
        ids = [x for x in least[roots[slow_fingerprint(t)]] if x is not None]
        assert got[d, slow_fingerprint(t)] == min(ids, default=None)
    kept = simhash.drop_near(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, 4: 1, 5: 2, None: 1, 7: 1, 8: 1, 9: 1}
    assert simhash.near_groups(nothing).count() == 0 and simhash.drop_near(nothing).count() == 0


def brute_repeats(rows, window):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + window] for i in range(len(b) - window + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                hit[i : i + window] = b"\1" * window
        kept = bytes(x for x, y in zip(b, hit) if not y)
        spans = sum(1 for i, y in enumerate(hit) if y and (not i or not hit[i - 1]))
        out.append((d, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repetitive(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, line = make(90), make(45)
    rows = [(k, make(rng.randint(0, 60)) + passage[rng.randint(0, 30) :] + make(rng.randint(0, 80)) + line * rng.randint(0, 2)) for k in range(40)]
    return rows + [(50, passage), (51, passage), (51, passage), (52, None), (53, ""), (None, passage[10:70]), (54, "ab" * 100), (55, "a" * 75)]


@pytest.mark.parametrize("options", [{}, {"most_kinds": 1}, {"shard_bytes": 300}])
def test_substring_removal(spark, options):
    rows = repetitive(11)
    got = substring_dedup.remove_repeats(frame(spark, rows), window=40, gram=12, **options).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows, 40)


def test_substring_removal_of_awkward_rows(spark, awkward, nothing):
    got = substring_dedup.remove_repeats(awkward).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(AWKWARD, 400)
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_index_statistics():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(12)]
    index = substring_dedup.RunLengthIndex(texts)
    got = index.matching_statistics()
    for k, t in enumerate(texts):
        for i in range(len(t)):
            want = 0
            for j, u in enumerate(texts):
                for at in range(len(u)):
                    if (j, at) != (k, i):
                        n = 0
                        while i + n < len(t) and at + n < len(u) and t[i + n] == u[at + n]:
                            n += 1
                        want = max(want, n)
            assert got[index.starts[k] + i] == want
    assert len(index.heads) == len(index.tails) <= len(index.order)


def test_pieces_of_long_texts_do_not_change_the_segments(monkeypatch):
    data = bytes(random.Random(1).choice(b"abcdefgh") for _ in range(5000))
    whole = substring_dedup.segments([data], 60, 20)
    covered = np.zeros(5000, int)
    for lo, n in zip(whole[1], whole[2]):
        covered[lo : lo + n] += 1
    assert (covered[: 5000 - 59] == 1).all() and not covered[5000 - 59 :].any()
