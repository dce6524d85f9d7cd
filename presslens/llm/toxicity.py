"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

Only documents carry labels.  A sentence with score z is offensive with probability
``sigmoid(z)``; a document is toxic when any sentence is, so the sentence probabilities are joined
by noisy-or, with a small leak for what no feature shows.  Weights are found by gradient ascent on
the likelihood of the document labels, and the sentence probabilities then show where the offence
is.

Features are words and their beginnings of 3 to 5 letters, hashed.  The fit uses a sample of at
most ``fit_rows`` labelled documents, the ones with the least hash of their id; from it come at
most ``features`` features that speak for the label.  Fitting cost is therefore bounded; scoring
reads every whole text once, without a shuffle.

Defined cases: a null or empty text, or one without a known feature, gets the leak as score; a
null label is ignored; if labels of one document differ it counts as toxic; with no label at all
every score is zero; repeated rows are scored alike; other columns are carried along or ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, fit_part, in_small_batches, keep, unwrapped, whole_row
from presslens.llm.decontaminate import words_of

FIT_ROWS = 20_000
FEATURES = 20_000
THRESHOLD = 0.3
#: Sentences end here.
_SENTENCE = re.compile(r"[^.!?\n]+")
#: Lengths of the beginnings used beside whole words.
_BEGINNINGS = (3, 4, 5)
_REMEMBERED = 200_000


def features_of(word: bytes) -> tuple[int, ...]:
    text = word.decode(errors="replace")
    return (crc32(word), *(crc32(text[:n].encode() + b"*") for n in _BEGINNINGS if len(text) >= n))


class _Memory(dict):
    """What ``make`` gives for a key; forgets all when it is full."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= _REMEMBERED:
            self.clear()
        self[key] = value = self.make(key)
        return value


def _sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label_id: str, label: str, fit_rows: int) -> DataFrame:
    """Text and label of at most ``fit_rows`` documents; only their ids are broadcast."""
    known = labels.select(column(label_id).cast("long").alias("id"), column(label).cast("int").alias("label"))
    known = known.where("label is not null").where(fit_part(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "label")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = _Memory(features_of)
    for batch in batches:
        seen = (Counter(), Counter())
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            found = {f for w in set(words_of((text or "").lower())) for f in memory[w]}
            seen[1 if label else 0].update(found)
        every = sorted(seen[0].keys() | seen[1].keys())
        columns = [pa.array(every, pa.int64()), pa.array([seen[0][f] for f in every], pa.int64()), pa.array([seen[1][f] for f in every], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["f", "n0", "n1"])


def bags_of(text: str, index: dict[int, int], memory: _Memory) -> Counter:
    """Feature sets of the sentences that have any, with how often each set occurs."""
    bags: Counter = Counter()
    for sentence in _SENTENCE.findall(text.lower()):
        held = [k for w in sorted(set(words_of(sentence))) for k in memory[w]]
        if held:
            bags[tuple(sorted(held))] += 1
    return bags


def fit_weights(bags: list[Counter], labels: np.ndarray, n_features: int, rounds: int = 300, penalty: float = 0.02) -> np.ndarray:
    """Feature weights, then the sentence bias, then the leak, by noisy-or likelihood."""
    doc, times, ids, sizes = [], [], [], []
    for k, bag in enumerate(bags):
        for held, n in bag.items():
            doc.append(k)
            times.append(n)
            ids += held
            sizes.append(len(held))
    doc, times, ids = np.array(doc, int), np.array(times, float), np.array(ids, int)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    weights = np.r_[np.ones(n_features), -2.0, -3.0]
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for turn in range(1, rounds + 1):
        z = np.bincount(sentence, weights[ids], len(sizes)) + weights[-2]
        rate = np.bincount(doc, times * np.logaddexp(0, z), len(bags)) + np.logaddexp(0, weights[-1])
        p = -np.expm1(-rate)
        slope = np.where(labels > 0, (1 - p) / np.maximum(p, 1e-12), -1.0) / len(bags)
        pull = slope[doc] * times / (1 + np.exp(-z))
        gradient = np.r_[np.bincount(ids, pull[sentence], n_features), pull.sum(), slope.sum() / (1 + np.exp(-weights[-1]))]
        gradient[:-2] -= penalty * weights[:-2] / len(bags)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights += 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-9)
    return weights


class Model:
    """Weights by hashed feature, sentence bias and leak rate."""

    def __init__(self, weights: dict[int, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak

    def value(self, word: bytes) -> float:
        return sum(self.weights.get(f, 0.0) for f in features_of(word))

    def known(self, word: bytes) -> bool:
        return any(f in self.weights for f in features_of(word))


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label_id: str = "doc_id", label: str = "toxic",
    fit_rows: int = FIT_ROWS, features: int = FEATURES,
) -> Model:
    """Select features by their chi-square with the label, then fit the noisy-or weights in one task."""
    sample = keep(_sample(docs, labels, text, doc_id, label_id, label, fit_rows), "toxicity-sample")
    n = dict(sample.groupBy("label").count().collect())
    n1 = sum(v for k, v in n.items() if k)
    n0 = sum(n.values()) - n1
    if not n0 + n1:
        return Model({}, 0.0, float("-inf"))
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    chi = (n0 + n1) * F.pow(a * (n0 - b) - b * (n1 - a), 2) / ((a + b) * (n0 + n1 - a - b) * n0 * n1)
    picked = (
        in_small_batches(sample).mapInArrow(_counts, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where((F.col("n1") >= 3) & (F.col("n1") * n0 > 2 * F.col("n0") * n1) & (F.col("n0") + F.col("n1") < n0 + n1))
        .withColumn("chi", chi).where("chi >= 10.83").orderBy(F.desc("chi"), "f").limit(features)
    )
    index = {r["f"]: k for k, r in enumerate(picked.select("f").collect())}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(lambda w: tuple(index[f] for f in features_of(w) if f in index))
        for batch in batches:
            held = [bags_of(t or "", index, memory) for t in batch.column("text").to_pylist()]
            packed = [[{"ids": list(k), "n": n} for k, n in sorted(b.items())] for b in held]
            kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(packed, kind)], ["label", "bags"])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, marks = [], []
        for batch in batches:
            marks += batch["label"].tolist()
            every += [Counter({tuple(s["ids"]): s["n"] for s in bag}) for bag in batch["bags"]]
        yield pd.DataFrame({"w": [fit_weights(every, np.array(marks), len(index)).tolist()]})

    instances = sample.mapInArrow(bags, "label int, bags array<struct<ids:array<int>,n:long>>")
    weights = instances.repartition(1).mapInPandas(fit, "w array<double>").first()["w"]
    return Model(dict(zip(index, weights)), weights[-2], weights[-1])


def score_text(text: str | None, model: Model, memory: _Memory) -> tuple[float, list[tuple[int, int, float]]]:
    """Noisy-or score of a text, and (start, end, probability) of the sentences with features."""
    rate = float(np.logaddexp(0, model.leak))
    found = []
    if text:
        low = text.lower()
        if any(map(memory.__getitem__, set(words_of(low)))):
            for match in _SENTENCE.finditer(text):
                values = [v for v in map(memory.__getitem__, set(words_of(match.group().lower()))) if v]
                if values:
                    z = sum(sorted(v[0] for v in values)) + model.bias
                    rate += float(np.logaddexp(0, z))
                    found.append((match.start(), match.end(), float(1 / (1 + np.exp(-z)))))
    return float(-np.expm1(-rate)), found


def score(docs: DataFrame, model: Model, text: str = "text", offending: float = THRESHOLD) -> DataFrame:
    """Struct ``row`` (all columns), score, and ``offending``: spans of sentences at or over a probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memory = _Memory(lambda w: (model.value(w),) if model.known(w) else ())
        for batch in batches:
            scored = [score_text(t, model, memory) for t in batch.column("text").to_pylist()]
            spans = [[{"start": a, "end": z, "p": p} for a, z, p in found if p >= offending] for _, found in scored]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), batch.column("text"), pa.array([s for s, _ in scored], pa.float64()), pa.array(spans, kind)],
                ["rest", "text", "score", "offending"],
            )

    # The text travels once, beside a struct of the other columns.
    others = docs.drop(text)
    rows = docs.select((whole_row(others) if others.columns else F.struct(F.lit(0))).alias("rest"), column(text).cast("string").alias("text"))
    schema = rows.withColumns({
        "score": F.lit(0.0), "offending": F.expr("cast(array() as array<struct<start:bigint,end:bigint,p:double>>)"),
    }).schema
    whole = F.struct(*[F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns])
    return in_small_batches(rows).mapInArrow(run, schema).select(whole.alias("row"), "score", "offending")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    scored = score(docs, train(docs, labels, text, **options), text)
    return unwrapped(scored.where(F.col("score") < threshold), docs.columns)
