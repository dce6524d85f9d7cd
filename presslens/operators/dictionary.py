"""Category dictionaries as tables: any number of values, nothing collected to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import name
from presslens.operators.encoding import UNKNOWN
from presslens.operators.numbering import numbered
from presslens.session import scratch_dir
from presslens.sources.sinks import stored

#: Values joined by broadcast: the most frequent ones of a column, so their bound is fixed.
HOT = 1000


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, index, n``: every value of every column, in alphabetical order from 0, and its rows.

    Nulls are not values.  A feature has the values 0 to k - 1; the index k is kept for null and unseen
    values and has no row here.  The table is stored.
    """
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(name(c)).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value IS NOT NULL")
        .groupBy("feature", "value").agg(F.count("*").alias("n"))
    )
    indexed = numbered(counts, ["feature"], ["value"], "index").select("feature", "value", "index", "n")
    return stored(indexed, scratch_dir(df.sparkSession, "dictionary"))


def sizes(dictionary: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of known values per column: one row per column reaches the driver."""
    found = dict(dictionary.groupBy("feature").agg(F.count("*")).collect())
    return {c: found.get(c, 0) for c in columns}


def with_indexes(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``{column}_known`` (the value or Unknown) and ``{column}_index`` (Unknown is the number of values).

    Frequent values meet their index by a broadcast of at most ``HOT`` rows.  Only rows with other
    values are shuffled, by the value; nulls, and frequent values the dictionary lacks, are no key of
    theirs: a null stays where it is, and the shuffle of the others is split by adaptive execution.
    """
    many = sizes(dictionary, columns)
    for c in columns:
        values = dictionary.where(F.col("feature") == c)
        hot = F.broadcast(values.orderBy(F.desc("n"), "value").limit(HOT).select(F.col("value").alias("__hot"), F.col("index").alias("__hot_index")))
        text = F.col(name(c)).cast("string")
        looked = df.join(hot, text == F.col("__hot"), "left")
        done = looked.where(F.col("__hot").isNotNull() | F.col(name(c)).isNull()).withColumn("__index", F.col("__hot_index"))
        if many[c] > HOT:
            others = values.select(F.col("value").alias("__value"), F.col("index").alias("__index"))
            rest = looked.where(F.col("__hot").isNull() & F.col(name(c)).isNotNull()).join(others, text == F.col("__value"), "left").drop("__value")
        else:
            rest = looked.where(F.col("__hot").isNull() & F.col(name(c)).isNotNull()).withColumn("__index", F.lit(None).cast("long"))
        known = F.when(F.col("__index").isNotNull(), text).otherwise(F.lit(UNKNOWN))
        df = done.unionByName(rest).select(
            *[F.col(name(k)) for k in df.columns], known.alias(f"{c}_known"),
            F.coalesce("__index", F.lit(many[c])).cast("long").alias(f"{c}_index"),
        )
    return df


def sparse_one_hot(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``with_indexes`` plus ``{column}_hot``: a sparse vector as wide as the dictionary; unknown is all zero.

    The encoder is told the widths, so it does not read the rows.
    """
    many = sizes(dictionary, columns)
    rows = with_indexes(df, dictionary, columns)
    inputs, outputs = [f"__{c}_at" for c in columns], [f"{c}_hot" for c in columns]
    widest = df.sparkSession.range(1).select(*[F.lit(float(many[c])).alias(i) for c, i in zip(columns, inputs)])
    encoder = OneHotEncoder(inputCols=inputs, outputCols=outputs, dropLast=True).fit(widest)
    placed = rows.withColumns({i: F.col(name(f"{c}_index")).cast("double") for c, i in zip(columns, inputs)})
    return encoder.transform(placed).drop(*inputs)
