"""Exact dedup with a two-pass Bloom filter.

Pass one builds a blocked Bloom filter of texts that may occur more than once: a bit is set only
when at least two rows hit it.  Pass two tests every row against it.  Rows that miss are unique
for certain and pass straight through without a shuffle; only the others are grouped, and what is
grouped is the 64-digit hash and the id, never the text.

Hot copies: counts of bits, of (hash, id) and of hashes are all combined before they are shuffled,
and the largest groups are joined with their ids by a broadcast of at most 1,000 rows.
A broadcast filter has at most ``max_bits`` bits whatever the input.  Where the rows need more, hashes
are cut into ranges with a filter each; a range is tested and stored before the filter of the next one
is built, so every filter keeps its share of bits a row and unique rows still pass without a shuffle.

Defined cases: a null text counts as empty; a null id is smaller than any other; of rows that
repeat both text and id exactly one stays; an empty table gives an empty result; other columns are
never looked at.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, join_hot, keep, unwrapped, whole_row

#: Bits of one block, the size of the bitmaps that ``bitmap_construct_agg`` builds.
BLOCK = 32768
#: Bound of the broadcast filter: 2^29 bits are 64 MB.
MAX_BITS = 1 << 29


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a block is set; null when there is no block."""
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, position.bitwiseAND(7)) == 1


def with_suspicion(rows: DataFrame, n_rows: int, bits_per_row: int = 16, max_bits: int = MAX_BITS) -> DataFrame:
    """``rows`` (with a 64-bit column ``h``) plus ``maybe``: false only for values of ``h`` that are unique.

    Every range of hashes reads the input once, and is written once when there are several.
    """
    ranges = max(1, -(-bits_per_row * n_rows // max_bits))
    if ranges == 1:
        return _tested(rows, bits_per_row * max(1, n_rows))
    number = F.pmod(F.xxhash64("h"), F.lit(ranges))
    parts = [keep(_tested(rows.where(number == k), max_bits), f"tested-{k}") for k in range(ranges)]
    return functools.reduce(DataFrame.unionByName, parts)


def _tested(rows: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``maybe`` from one filter of at least ``bits`` bits, rounded up to a power of two of blocks."""
    blocks = 1
    while blocks * BLOCK < bits:
        blocks *= 2
    h = F.col("h")
    placed = {
        "block": F.shiftrightunsigned(h, 40).bitwiseAND(blocks - 1).cast("int"),
        "p1": h.bitwiseAND(BLOCK - 1).cast("int"),
        "p2": F.shiftrightunsigned(h, 15).bitwiseAND(BLOCK - 1).cast("int"),
    }
    hits = rows.select(placed["block"].alias("block"), F.explode(F.array(placed["p1"], placed["p2"])).alias("p"))
    twice = hits.groupBy("block", "p").agg(F.count("*").alias("n")).where("n > 1")
    bitmaps = twice.groupBy("block").agg(F.expr("bitmap_construct_agg(cast(p as bigint))").alias("bitmap"))
    tested = rows.withColumns(placed).join(F.broadcast(bitmaps), "block", "left")
    maybe = F.coalesce(_bit(F.col("bitmap"), F.col("p1")) & _bit(F.col("bitmap"), F.col("p2")), F.lit(False))
    return tested.withColumn("maybe", maybe).drop("block", "bitmap", "p1", "p2")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **filter_options) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    body = F.coalesce(column(text), F.lit(""))
    rows = docs.select(column(doc_id).alias("doc_id"), F.sha2(body, 256).alias("text_sha256"), F.xxhash64(body).alias("h"))
    tested = with_suspicion(rows, docs.count(), **filter_options)
    unique = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    seen = keep(tested.where("maybe").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("times")), "repeated-hashes")
    groups = seen.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"))
    grouped = (
        join_hot(seen, groups, ["text_sha256"], "group_size")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("turn"))
        .select("doc_id", "keep_id", "group_size", (_same("doc_id", "keep_id") & (F.col("turn") == 1)).alias("kept"), "text_sha256")
    )
    return unique.unionByName(grouped)


def drop_exact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **filter_options) -> DataFrame:
    """The rows that stay, with all their columns.

    Texts that may be repeated are shuffled by (hash, id), so the copies of one text spread over
    all tasks; a row stays when its id is the largest of its hash.
    """
    body = F.coalesce(column(text), F.lit(""))
    rows = docs.select(whole_row(docs).alias("row"), column(doc_id).alias("id"), F.sha2(body, 256).alias("sha"), F.xxhash64(body).alias("h"))
    tested = with_suspicion(rows, docs.count(), **filter_options)
    keepers = (
        tested.where("maybe").groupBy("sha").agg(F.max("id").alias("keep_id")).withColumnRenamed("sha", "keep_sha")
    )
    kept = (
        tested.where("maybe")
        .join(keepers, (F.col("sha") == F.col("keep_sha")) & _same("id", "keep_id"), "left_semi")
        .dropDuplicates(["sha", "id"])
    )
    return unwrapped(tested.where(~F.col("maybe")).select("row").unionByName(kept.select("row")), docs.columns)
