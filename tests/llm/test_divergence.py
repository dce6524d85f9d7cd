"""The divergence audit against counts made one by one."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presslens.llm import divergence
from text_rows import frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=30, prior=5, unit=10**9, top=50):
    """(lang, source, part, item, value, rank) of documents (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(text.translate(SMALL))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in d.items() if n >= min_docs) for lang, d in docs.items()}

    def probs(own, terms):
        n, v = sum(own[t] for t in terms), len(terms)
        return [1 + unit * (own[t] + prior) // (n + prior * v) for t in terms]

    of = {g: probs(counts[g], kept[g[0]]) for g in groups}
    out = []
    for lang, source in groups:
        far = [(sum(abs(a - b) for a, b in zip(of[lang, source], of[lang, o])), o) for g, o in groups if g == lang and o != source]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        telling = [(p - q, t) for p, q, t in zip(of[lang, source], probs(whole, kept[lang]), kept[lang]) if p > q and counts[lang, source][t]]
        for part, found in (("pair", far), ("term", telling)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, t, v, k) for k, (v, t) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def documents(spark, rows):
    return spark.createDataFrame(pa.table({
        "doc_id": pa.array(range(len(rows)), pa.int64()), **{c: pa.array(v, pa.string()) for c, v in zip(("text", "lang", "source"), zip(*rows))},
        "p": pa.array([1] * len(rows)), "n": pa.array(["x"] * len(rows)),
    }))


def made(seed):
    rng = random.Random(seed)
    words = [f"{rng.choice('aBäé日')}{'xyz'[k % 3]}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(150)]
    rows = [(" ".join(rng.choices(words[: rng.randint(5, 150)], k=rng.randint(0, 60))) + rng.choice([" 7-up", "_A", ""]),
             rng.choice(["en", "en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "S2", None])) for _ in range(240)]
    return rows + [(None, "en", "s0"), ("", "fr", "s1"), ("only few", "fr", "s2"), (None, None, None)] + rows[:3] * 2


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    rows = made(seed)
    if seed == 2:  # texts in many slices, results in many parts
        monkeypatch.setattr(divergence, "SLICE", 40)
        monkeypatch.setattr(divergence, "GATHERED", 20)
        monkeypatch.setattr(divergence, "CELLS", 16)
    for least in (3, 30):
        got = divergence.audit(documents(spark, rows), min_docs=least)
        assert sorted(map(tuple, got.collect())) == brute(rows, least)


def test_cells_do_not_depend_on_their_division(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    source = np.array(sorted(f"s{k}" for k in rng.integers(0, 9, 200)), object)
    p, p0 = rng.integers(1, 10**9, 200), np.array([len(s) * int(s[1:]) for s in source])
    bits = rng.integers(0, 2**63, 200).astype(np.uint64)
    (_, whole), = divergence._cells(source, p, p0, bits)
    for cells in (1, 300, 5000):
        monkeypatch.setattr(divergence, "CELLS", cells)
        parts = list(divergence._cells(source, p, p0, bits))
        assert np.array_equal(np.vstack([m for _, m in parts]), whole)
        assert [a for a, _ in parts] == np.cumsum([0, *[len(m) for _, m in parts[:-1]]]).tolist()


def test_very_large_counts_are_exact(spark):
    n, total, terms = 9 * 10**14, 10**17, 10**9
    row = spark.range(1).select(divergence._probability(F.lit(n), F.lit(total), F.lit(terms).cast("long"), 5, 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_awkward_rows(spark, awkward, nothing):
    assert divergence.audit(nothing).count() == 0
    assert divergence.audit(awkward, min_docs=1).count() == 0  # one source alone: no others, and no term stands out
    halves = awkward.withColumn("source", F.when(F.col("doc_id") > 5, "s"))
    rows = [(r.text, r.lang, r.source) for r in halves.collect()]
    assert sorted(map(tuple, divergence.audit(halves, min_docs=1).collect())) == brute(rows, 1)
    long = documents(spark, [("a" * 3_000_000 + " B " * 500_000, "en", "s")])
    assert {(r.part, r.item) for r in divergence.audit(long, min_docs=1).collect()} == set()  # one source: p equals q
    assert sum(r.n for r in divergence.term_counts(long).collect()) == 500_001


def test_sql_of_the_query(spark):
    rows = made(4)
    con = duckdb.connect()
    con.register("documents", documents(spark, rows).toArrow())
    assert sorted(con.execute(divergence.ORACLE).fetchall()) == brute(rows)
    assert frame(spark, []).count() == 0
