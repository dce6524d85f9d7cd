"""Source divergence audit: how far the vocabularies of the sources of a language lie apart.

Term probabilities of a source depend on nothing but the term's count there, so the terms of a
source are kept as one bitmap per count (``levels``).  AND and a popcount of two levels give the
number of terms that one source has m times and another n times; that number times the difference of
the two probabilities is the cell's share of the distance.  Terms that one side or both lack have
no bits: their share follows by complement from the sizes of the levels and the vocabulary.

Bitmaps are cut into words of 64 terms, a row each, and only words with a bit exist.  Terms are numbered by
falling frequency, so counts that are alike stand in the same words.  The levels of a word meet in one task,
which adds up the shares of all its words; they are at most 64 for each source of the language.

Defined cases: a null text, language or source is empty; a source without terms is audited like any
other; a language without kept terms has distance 0 between all of its sources; repeated rows count
as often as they occur; ties are ordered by the UTF-8 bytes of the item; an empty table has no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import column, join_hot, keep

#: Every byte that belongs to no term becomes a blank, A to Z become small letters.
_TERMS = bytes((b | 32 if 65 <= b <= 90 else b) if chr(b).isalpha() or b > 127 else 32 for b in range(256))
#: Bytes of a text that are split at a time; entries a task gathers before it passes them on.
SLICE, GATHERED = 1 << 20, 200_000
#: Pairs of levels that are looked at at once.
CELLS = 1 << 20
_GROUP = ["lang", "source"]


def slices(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a slice of bounded size at a time; no term is cut."""
    at, text = 0, text.translate(_TERMS)
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), combined as far as memory allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in held.items():
            n = len(occurrences)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array([source] * n), pa.array(list(occurrences), pa.binary()).cast(pa.string()),
                     pa.array(list(occurrences.values()), pa.int64()), pa.array([documents[t] for t in occurrences], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in slices(text):
                occurrences.update(terms)
                seen.update(terms)
            documents.update(seen)
        if sum(len(o) for o, _ in held.values()) > GATHERED:
            yield from out()
    yield from out()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of a source."""
    filled = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    rows = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text"))
    found = rows.mapInArrow(_gathered, "lang string, source string, term string, n long, docs long")
    return found.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _probability(n: Column, total: Column, terms: Column, prior: int, unit: int) -> Column:
    """1 + floor(unit * (n + prior) / (total + prior * terms)), exact for counts of any size."""
    scaled = F.lit(unit).cast("decimal(18,0)") * (n + prior).cast("decimal(19,0)")
    return F.when(terms > 0, F.call_function("div", scaled, (total + terms * prior).cast("decimal(20,0)")) + 1)


def _apart(a: str, b: str) -> Column:
    return F.abs(F.col(a) - F.col(b))


def levels(present: DataFrame) -> DataFrame:
    """Bitmaps of term numbers by (lang, source, count): a row for each word of 64 numbers with a bit."""
    word, bit = F.shiftright("id", 6).alias("word"), F.expr("shiftleft(1L, cast(id & 63 AS int))")
    return present.groupBy(*_GROUP, "n", word, "p", "p0").agg(F.bit_or(bit).alias("bits"))


def _cells(source: np.ndarray, p: np.ndarray, p0: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """What the joint cells of one word add to the distances: a matrix of sources by sources, some rows at a time.

    The levels are sorted by source.  Rows of the matrix come with the number of the first.
    """
    first = np.flatnonzero(np.r_[True, source[1:] != source[:-1]])
    ends = np.r_[first[1:], len(source)]
    at = 0
    while at < len(first):
        # Whole sources, as many as keep the matrix of levels small.
        to = max(at + 1, int(np.searchsorted(ends, first[at] + max(1, CELLS // len(source)), "right")))
        own = slice(first[at], ends[to - 1])
        cells = np.bitwise_count(bits[own, None] & bits).astype(np.int64)
        mine, mine0 = p[own, None], p0[own, None]
        cells *= np.abs(mine - p) - np.abs(mine - p0) - np.abs(mine0 - p) + np.abs(mine0 - p0)
        yield at, np.add.reduceat(np.add.reduceat(cells, first, 1), first[at:to] - first[at], 0)
        at = to


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shares of all joint cells of (lang, source, item), source before item, added up over the words of a task.

    Rows are sorted by (lang, word, source), so a word ends where the next begins.
    """
    added: dict[tuple[str, str, str], int] = {}
    open_key, held = None, []

    def out() -> Iterator[pa.RecordBatch]:
        if added:
            names = [pa.array(c, pa.string()) for c in zip(*added)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(list(added.values()), pa.int64())], ["lang", "source", "item", "value"])
        added.clear()

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        names = [x for part in held for x in part[0]]
        p, p0, bits = (np.concatenate([part[k] for part in held]) for k in (1, 2, 3))
        source = np.array(names, object)
        each = list(dict.fromkeys(names))
        for start, values in _cells(source, p, p0, bits):
            for k, row in enumerate(values.tolist(), start):
                for j in range(k + 1, len(each)):
                    key = (open_key[0], each[k], each[j])
                    added[key] = added.get(key, 0) + row[j]
                if len(added) > GATHERED:
                    yield from out()
        held.clear()

    for batch in batches:
        keys = list(zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist()))
        names = batch.column("source").to_pylist()
        p, p0, bits = (batch.column(c).to_numpy() for c in ("p", "p0", "bits"))
        at = 0
        while at < len(keys):
            to = at
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            if keys[at] != open_key:
                yield from close()
                open_key = keys[at]
            held.append((names[at:to], p[at:to], p0[at:to], bits[at:to].view(np.uint64)))
            at = to
    yield from close()
    yield from out()


def distances(groups: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways.

    With p and q the probabilities of a cell and p0, q0 those of count zero, the sum over all terms
    is V*|p0-q0|, plus |p-q0|-|p0-q0| for the terms of either side, plus for the terms of both what
    makes up the difference to |p-q|.
    """
    own = groups.select("lang", "source", "p0", "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = own.join(other, "lang").where("source <> item")
    apart0 = _apart("p0", "q0")
    base = pairs.select("lang", "source", "item", (F.col("terms") * F.coalesce(apart0, F.lit(0))).alias("value"))
    sizes = bitmaps.groupBy(*_GROUP, "p").agg(F.sum(F.bit_count("bits")).alias("size"))
    alone = pairs.join(sizes, _GROUP).groupBy("lang", "source", "item").agg(
        F.sum(F.col("size") * (_apart("p", "q0") - apart0)).alias("value")
    )
    words = bitmaps.repartition("lang", "word").sortWithinPartitions("lang", "word", "source")
    met = words.select("lang", "word", "source", "p", "p0", "bits").mapInArrow(_met, "lang string, source string, item string, value long")
    both = met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = base.unionByName(alone).unionByName(turned(alone)).unionByName(both).unionByName(turned(both))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame) -> DataFrame:
    best = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(best))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, prior: int = 5,
    unit: int = 10**9, top: int = 50,
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources and telling terms.

    Part ``pair`` holds every other source of the language with the distance of the two
    distributions, part ``term`` the ``top`` terms that the source has more often than its language.
    Terms in fewer than ``min_docs`` documents of the language are left out.
    """
    filled = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    counts = keep(term_counts(docs, text, lang, source), "term_counts")
    common = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    # Numbers are written once; they need not be dense, only close together for close frequencies.
    order = ["lang", F.desc("all_n"), "term"]
    numbered = common.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = keep(numbered.select("lang", "term", "all_n", F.monotonically_increasing_id().alias("id")), "kept_terms")
    present = keep(counts.drop("docs").join(kept, ["lang", "term"]), "present_terms")

    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("lang_total"))
    of_source = present.groupBy(*_GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    every = docs.select(filled(lang).alias("lang"), filled(source).alias("source")).distinct()
    known = every.join(of_source, _GROUP, "left").join(of_lang, "lang", "left").na.fill(0, ["total", "rows", "terms", "lang_total"])
    p0 = _probability(F.lit(0), F.col("total"), F.col("terms"), prior, unit)
    groups = keep(known.withColumn("p0", p0), "groups")

    full = join_hot(present, groups, _GROUP, "rows").withColumns({
        "p": _probability(F.col("n"), F.col("total"), F.col("terms"), prior, unit),
        "q": _probability(F.col("all_n"), F.col("lang_total"), F.col("terms"), prior, unit),
    })
    pairs = _ranked(distances(groups, keep(levels(full), "levels")))
    telling = full.where("p > q").select(*_GROUP, F.col("term").alias("item"), _apart("p", "q").alias("value"))
    named = lambda df, part: df.select(*_GROUP, F.lit(part).alias("part"), "item", "value", "rank")
    return named(pairs, "pair").unionByName(named(_ranked(telling).where(F.col("rank") <= top), "term"))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
     words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
     kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
     sizes AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_total FROM kept GROUP BY lang),
     sources AS (SELECT DISTINCT lang, source FROM docs),
     counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
     cells AS (SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n, all_n::HUGEINT AS all_n
               FROM sources JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
     totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
     probs AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (total + 5 * v)::HUGEINT AS p,
                      1 + 1000000000 * (all_n + 5) // (lang_total + 5 * v)::HUGEINT AS q
               FROM cells JOIN totals USING (lang, source) JOIN sizes USING (lang)),
     far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
             FROM probs a JOIN probs b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
               FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
     terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM probs WHERE n > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
                FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
