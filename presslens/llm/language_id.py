"""Language ID by interpolated Kneser-Ney character models, one per language.

Counts of all four-letter sequences are taken from every text that may be learned from, combined
in the task and again by language before they are shuffled.  Lower orders follow from the distinct
sequences, as Kneser-Ney wants: a shorter sequence counts once for every letter seen before it.

A model is, per order, the sequences with their discounted probability and the contexts with their
weight for the lower order.  Four codes of 16 bits are a 64-bit key, so every sequence keeps its own
entry and the tables grow with the corpus.  Up to ``in_memory`` entries of all languages together
they are broadcast as sorted arrays; beyond that they stay in the shared folder, the costs of the
distinct sequences of the texts come from joins with them order by order, and texts are summed up
from their counted sequences.

A text goes to the language with the lowest cross-entropy per letter.  ``score`` is the posterior
of that choice, softened by the length of the text.  The rejection limit of a language is taken
from all of its own texts that were learned from: beyond ``mean + 4 sd`` of their cross-entropy a text is marked ``rejected``.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; ties go to
the language that sorts first; without any labelled text everything is ``und``; repeated rows are
judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, join_hot, keep

ORDER = 4
#: Entries (16 bytes each) of all languages up to which models are broadcast.
IN_MEMORY = 2_000_000
UNKNOWN = "und"
_MASK = [np.uint64((1 << 16 * n) - 1) for n in range(ORDER + 1)]


def _letter_table() -> np.ndarray:
    """Folded code of every character below 2^16: lower-case letters keep a code, others are 32."""
    table = np.full(1 << 16, 32, np.uint16)
    for code in range(1 << 16):
        low = chr(code).lower()
        if chr(code).isalpha():
            table[code] = ord(low[0]) & 0xFFFF
    return table


_TABLE = _letter_table()


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Folded codes of all texts in a row, a blank before and after each word, and the text of each code.

    Runs of anything but letters become one blank.  Letters beyond 2^16 fold to their low bits.
    """
    codes, owner = [], []
    for k, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
        if len(raw) and raw.max() >= 1 << 16:
            high = raw >= 1 << 16
            folded = _TABLE[raw & 0xFFFF]
            folded[high] = [(ord(c.lower()[0]) & 0xFFFF) | 1 if c.isalpha() else 32 for c in map(chr, raw[high].tolist())]
        else:
            folded = _TABLE[raw]
        codes += [np.array([32], np.uint16), folded, np.array([32], np.uint16)]
        owner.append(len(raw) + 2)
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint16)
    text_of = np.repeat(np.arange(len(texts)), owner)
    blank = flat == 32
    first = np.r_[True, text_of[1:] != text_of[:-1]] if len(flat) else blank
    stays = ~blank | first | ~np.r_[True, blank[:-1]]
    return flat[stays], text_of[stays]


def sequences(flat: np.ndarray, text_of: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every letter or closing blank: it and the ``order - 1`` codes before it, 16 bits each."""
    packed = flat.astype(np.uint64)
    grams = packed.copy()
    for back in range(1, order):
        before = np.r_[np.full(back, 32, np.uint64), packed[:-back]][: len(packed)]
        outside = np.r_[np.full(back, -1), text_of[:-back]][: len(packed)] != text_of
        before[outside] = 32
        grams |= before << np.uint64(16 * back)
    inner = np.r_[False, text_of[1:] == text_of[:-1]][: len(packed)]  # not the blank a text begins with
    return grams[inner], text_of[inner]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, sequence, n), combined over all batches of the task as long as they are few."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out(lang: str) -> pa.RecordBatch:
        grams, n = held.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs) if x == lang]
            for at in range(0, len(own), 1000):
                found, n = np.unique(sequences(*letters(own[at : at + 1000]))[0], return_counts=True)
                if lang in held:
                    found, where = np.unique(np.r_[held[lang][0], found], return_inverse=True)
                    n = np.bincount(where, np.r_[held[lang][1], n]).astype(np.int64)
                held[lang] = found, n.astype(np.int64)
                if len(found) > 1_000_000:
                    yield out(lang)
    for lang in sorted(held):
        yield out(lang)


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, order, gram, n: raw counts at the highest order, continuation counts below."""
    rows = docs.select(column(lang).cast("string").alias("lang"), column(text).alias("text")).where("lang is not null and text is not null")
    level = keep(
        in_small_batches(rows).mapInArrow(_counter, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "letter-counts"
    )
    every = level.select("lang", F.lit(ORDER).alias("level"), "gram", "n")
    for order in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")).agg(F.count("*").alias("n"))
        every = every.unionByName(level.select("lang", F.lit(order).alias("level"), "gram", "n"))
    return every


def entries(stats: DataFrame) -> DataFrame:
    """lang, level, kind ('seen' or 'below'), gram, value: the terms of the interpolation.

    seen: max(n - D, 0) / n(context); below: D * distinct(context) / n(context), for the context
    itself.  D is n1 / (n1 + 2 n2) of the language and order.
    """
    context = F.when(F.col("level") > 1, F.shiftrightunsigned("gram", 16)).otherwise(0)
    grams = stats.withColumn("context", context)
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    discounts = stats.groupBy("lang", "level").agg(F.when(once > 0, once / (once + 2 * twice)).otherwise(0.5).alias("d"))
    contexts = grams.groupBy("lang", "level", "context").agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
    contexts = contexts.join(discounts, ["lang", "level"])
    seen = grams.join(contexts, ["lang", "level", "context"]).select(
        "lang", "level", F.lit("seen").alias("kind"), "gram", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value")
    )
    below = contexts.select(
        "lang", "level", F.lit("below").alias("kind"), F.col("context").alias("gram"), (F.col("d") * F.col("distinct") / F.col("total")).alias("value")
    )
    return seen.unionByName(below)


class Models:
    """Kneser-Ney models of all languages: sorted arrays by (language, order, kind)."""

    def __init__(self, tables: dict[tuple[str, int, str], tuple[np.ndarray, np.ndarray]]):
        self.tables = tables
        self.langs = sorted({lang for lang, _, _ in tables})
        self.limits: dict[str, float] = {}

    def _lookup(self, key: tuple[str, int, str], grams: np.ndarray, default: float) -> np.ndarray:
        known, values = self.tables.get(key, (np.zeros(0, np.int64), np.zeros(0)))
        if not len(known):
            return np.full(len(grams), default)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return np.where(known[at] == grams, values[at], default)

    def costs(self, grams: np.ndarray, langs: list[str] | None = None) -> np.ndarray:
        """Nats of the last letter of every sequence, a row per language; ``langs`` restricts these."""
        langs = self.langs if langs is None else langs
        ends = {n: (grams & _MASK[n]).view(np.int64) for n in range(1, ORDER + 1)}
        before = {n: ((grams & _MASK[n]) >> np.uint64(16)).view(np.int64) for n in range(1, ORDER + 1)}
        out = np.empty((len(langs), len(grams)))
        for k, lang in enumerate(langs):
            p = np.full(len(grams), 1.0 / (1 + len(self.tables[lang, 1, "seen"][0])))
            for n in range(1, ORDER + 1):
                p = self._lookup((lang, n, "seen"), ends[n], 0.0) + self._lookup((lang, n, "below"), before[n], 1.0) * p
            out[k] = -np.log(np.maximum(p, 1e-12))
        return out

    def entropies(self, texts: list[str | None], langs: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per letter, a row per language, and the number of letters of every text."""
        flat, text_of = letters(texts)
        n_letters = np.bincount(text_of[flat != 32], minlength=len(texts))
        grams, owner = sequences(flat, text_of)
        found, where = np.unique(grams, return_inverse=True)
        cost = self.costs(found, langs)
        length = np.bincount(owner, minlength=len(texts))
        total = np.stack([np.bincount(owner, c[where], len(texts)) for c in cost]) if len(cost) else np.zeros((0, len(texts)))
        return total / np.maximum(length, 1), n_letters


class StoredModels:
    """The same models as a stored frame (lang, level, kind, gram, value), for any number of entries."""

    def __init__(self, terms: DataFrame, n_letters: dict[str, int]):
        self.terms, self.langs = terms, sorted(n_letters)
        self.uniform = [1.0 / (1 + n_letters[x]) for x in self.langs]
        self.limits: dict[str, float] = {}

    def _table(self, level: int, kind: str) -> DataFrame:
        """gram and a map from language to value."""
        rows = self.terms.where((F.col("level") == level) & (F.col("kind") == kind))
        return rows.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias("own"))

    def costs(self, grams: DataFrame) -> DataFrame:
        """gram, costs (nats of its last letter, an entry per language) of distinct sequences ``gram``.

        An order takes its probabilities from its own two tables and the order below; no key of a
        join has more rows than there are letters.
        """
        langs = F.array(*[F.lit(x) for x in self.langs])
        start = {r["lang"]: r["value"] for r in self.terms.where("level = 1 and kind = 'below'").collect()}
        lower = None
        for n in range(1, ORDER + 1):
            low = F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)) if n < ORDER else F.col("gram")
            own = grams.select(low.alias("gram")).distinct().join(self._table(n, "seen").withColumnRenamed("own", "seen"), "gram", "left")
            if n == 1:
                base = F.array(*[F.lit(start.get(x, 1.0) * u) for x, u in zip(self.langs, self.uniform)])
            else:
                below = self._table(n, "below").select(F.col("gram").alias("context"), F.col("own").alias("below"))
                own = own.withColumn("context", F.shiftrightunsigned("gram", 16)).join(below, "context", "left")
                own = own.withColumn("end", F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1)))
                own = own.join(lower.select(F.col("gram").alias("end"), F.col("p").alias("q")), "end")
                weight = F.transform(langs, lambda x: F.coalesce(F.element_at("below", x), F.lit(1.0)))
                base = F.zip_with(weight, F.col("q"), lambda w, q: w * q)
            seen = F.transform(langs, lambda x: F.coalesce(F.element_at("seen", x), F.lit(0.0)))
            lower = own.select("gram", F.zip_with(seen, base, lambda v, q: v + q).alias("p"))
        return lower.select("gram", F.transform("p", lambda p: -F.log(F.greatest(p, F.lit(1e-12)))).alias("costs"))

    def totals(self, texts: DataFrame) -> DataFrame:
        """text_key, total (nats, an entry per language) of the distinct rows (text_key, text) that have a sequence."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("text_key").to_numpy()
                grams, owner = sequences(*letters(batch.column("text").to_pylist()))
                order = np.lexsort((grams, owner))
                grams, owner = grams[order], owner[order]
                first = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])][: len(grams)])
                n = np.diff(np.r_[first, len(grams)])
                yield pa.RecordBatch.from_arrays([pa.array(keys[owner[first]]), pa.array(grams[first].view(np.int64)), pa.array(n)], ["text_key", "gram", "n"])

        counted = keep(in_small_batches(texts.dropDuplicates(["text_key"])).mapInArrow(run, "text_key long, gram long, n long"), "text-sequences")
        sizes = counted.groupBy("gram").agg(F.count("*").alias("size"))
        costs = keep(self.costs(sizes.select("gram")).join(sizes, "gram"), "sequence-costs")
        sums = [F.sum(F.col("n") * F.col("costs")[k]) for k in range(len(self.langs))]
        return join_hot(counted, costs, ["gram"], "size").groupBy("text_key").agg(F.array(*sums).alias("total"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", in_memory: int = IN_MEMORY) -> Models | StoredModels:
    """Models and rejection limits of all languages of ``docs``, every row of which is learned from."""
    terms = keep(entries(counts(docs, text, lang)), "language-models")
    sizes = {(r["lang"], r["level"], r["kind"]): r["n"] for r in terms.groupBy("lang", "level", "kind").agg(F.count("*").alias("n")).collect()}
    if sum(sizes.values()) > in_memory:
        models = StoredModels(terms, {x: n for (x, level, kind), n in sizes.items() if level == 1 and kind == "seen"})
    else:
        arrays = terms.groupBy("lang", "level", "kind").agg(F.array_sort(F.collect_list(F.struct("gram", "value"))).alias("e"))
        packed = arrays.select("lang", "level", "kind", F.col("e.gram").alias("gram"), F.col("e.value").alias("value")).toPandas()
        models = Models({(r.lang, r.level, r.kind): (np.array(r.gram, np.int64), np.array(r.value, np.float64)) for r in packed.itertuples()})
    models.limits = _limits(docs, models, text, lang)
    return models


def _entropies(rows: DataFrame, models: Models | StoredModels) -> tuple[DataFrame, Callable]:
    """Rows for the task, and what gives it (cross-entropies, letters) of a batch; ``rows`` has a column text.

    A second argument, a list of languages, restricts the cross-entropies to these.
    """
    if isinstance(models, Models):
        shared = rows.sparkSession.sparkContext.broadcast(models)
        return rows, lambda batch, langs=None: shared.value.entropies(batch.column("text").to_pylist(), langs)
    n_langs = len(models.langs)
    place = {x: k for k, x in enumerate(models.langs)}
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    totals = models.totals(keyed.select("text_key", "text").where("text is not null"))

    def found(batch: pa.RecordBatch, langs: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
        texts = batch.column("text").to_pylist()
        flat, text_of = letters(texts)
        length = np.bincount(sequences(flat, text_of)[1], minlength=len(texts))
        total = np.array([t or [0.0] * n_langs for t in batch.column("total").to_pylist()]).reshape(-1, n_langs).T
        total = total if langs is None else total[[place[x] for x in langs]]
        return total / np.maximum(length, 1), np.bincount(text_of[flat != 32], minlength=len(texts))

    return keyed.join(totals, "text_key", "left").drop("text_key"), found


def _limits(docs: DataFrame, models: Models | StoredModels, text: str, lang: str, rows_at_once: int = 1000) -> dict[str, float]:
    """Rejection limit of each language from all texts it was learned from, each judged by its own model only."""
    known = docs.select(column(lang).cast("string").alias("lang"), column(text).alias("text")).where("lang is not null and text is not null")
    known, entropies = _entropies(known, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                langs = np.array(batch.column("lang").to_pylist(), object)
                for one in sorted(set(langs)):
                    ce, n = entropies(batch.filter(pa.array(langs == one)), [one])
                    own = ce[0, n > 0]
                    yield pa.RecordBatch.from_arrays([pa.array([one] * len(own), pa.string()), pa.array(own)], ["lang", "ce"])

    own = in_small_batches(known).mapInArrow(run, "lang string, ce double")
    found = own.groupBy("lang").agg((F.avg("ce") + 4 * F.stddev_pop("ce")).alias("top")).collect()
    return {r["lang"]: r["top"] for r in found}


def identify(docs: DataFrame, models: Models | StoredModels, text: str = "text", doc_id: str = "doc_id", rows_at_once: int = 1000) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected for every row."""
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    rows, entropies = _entropies(rows, models)
    names, limits = models.langs, models.limits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array([*names, UNKNOWN], object)
        top = np.array([limits.get(x, np.inf) for x in names] + [-np.inf])
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                ce, n = entropies(batch)
                if len(ce):
                    best = np.where(n > 0, ce.argmin(axis=0), len(names))
                    least = ce.min(axis=0)
                    score = np.where(n > 0, 1 / np.exp((least - ce) * np.sqrt(n)).sum(axis=0), 0.0)
                else:
                    best, least, score = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n))
                bare = best == len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(langs[best].tolist(), pa.string()), pa.array(score),
                        pa.array(np.where(bare, 0.0, least), mask=bare), pa.array(bare | (least > top[best])),
                    ],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    return in_small_batches(rows).mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
