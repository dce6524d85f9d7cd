"""Language models keep every sequence, and stored ones judge like those in memory."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.llm import language_id
from text_rows import frame


def test_every_sequence_has_its_own_entry(spark):
    rng = random.Random(3)
    rows = [(k, "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(2000))) for k in range(60)]
    models = language_id.train(frame(spark, rows))
    grams = np.unique(language_id.sequences(*language_id.letters([t for _, t in rows]))[0])
    known = models.tables["en", 4, "seen"][0]
    assert len(grams) > 100_000 and np.array_equal(np.sort(grams.view(np.int64)), known)


def test_stored_models_judge_alike(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(awkward.select("doc_id", "text", F.lit("en").alias("lang"))).unionByName(docs.limit(5))
    held, stored = language_id.train(docs), language_id.train(docs, in_memory=0)
    assert isinstance(held, language_id.Models) and isinstance(stored, language_id.StoredModels)
    assert stored.limits == pytest.approx(held.limits)
    order = lambda rows: sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, str(r.lang_pred)))
    want, got = (order(language_id.identify(docs, m).collect()) for m in (held, stored))
    assert len(want) == len(got) == docs.count()
    for a, b in zip(want, got):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected)
        assert a.score == pytest.approx(b.score) and a.cross_entropy == pytest.approx(b.cross_entropy)


@pytest.mark.parametrize("in_memory", [language_id.IN_MEMORY, 0])
def test_limits_come_from_every_text(spark, in_memory):
    """More texts than the 4,000 of the sample that once set the limits, and few strange ones among them."""
    rng = random.Random(11)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    rows = [(k, " ".join(word("aeiost") for _ in range(6)), "en") for k in range(6000)]
    rows += [(6000 + k, " ".join(word("bcdfghjklmnpqrvwxyz") for _ in range(8)), "en") for k in range(60)]
    rows += [(7000 + k, " ".join(word("äöüßei") for _ in range(6)), "de") for k in range(300)]
    rows += [(8000, None, "en"), (8001, "12", "de"), (8002, "no language", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    held = language_id.train(docs)
    want = {}
    for lang in ("en", "de"):
        ce, n = held.entropies([t for _, t, x in rows if x == lang and t])
        own = ce[held.langs.index(lang), n > 0]
        want[lang] = own.mean() + 4 * own.std()
    assert language_id.train(docs, in_memory=in_memory).limits == pytest.approx(want, rel=1e-9)
