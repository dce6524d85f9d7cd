from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts every operator must take: null, empty, blank, short, ties, repeats, long, other scripts.
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four five"), (5, "one two three four five"),
    (6, "one two three four five"), (None, "no id at all, but some words to read"), (7, "x" * 30_000), (8, "äöü ß é 日本語 𝔘 ▁ \u0000"),
    (9, "same words again and again " * 400),
]


def frame(spark, rows, extra=True):
    """Documents with columns whose names clash with those the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    if not extra:
        return df
    return df.withColumns({
        "lang": F.lit("en"), "source": F.lit(None).cast("string"), "row": F.lit("r"), "key": F.lit(1), "h": F.lit(2), "id": F.lit("x"),
        "score": F.lit(0.5), "kept": F.lit(True), "a.b": F.lit(3), "maybe": F.lit(4), "fp": F.lit(5), "n": F.lit(6), "spans": F.lit("s"),
    })


def similar(rows):
    """(doc_id, least doc_id of its component) by all pairs of five-word Jaccard similarity 0.8 or more."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                if label[i] != label[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return {(d, c) for (d, _), c in zip(rows, label)}
