"""Connected components by star contraction (large-star and small-star rounds)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import join_hot, keep


def forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of ``a[i]`` and ``b[i]``; a class is named by its least member."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        # Hook the larger root below the smaller, then let every label jump to its root.
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
    return labels


def _round(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on stored links (a, b) with a > b.

    Minima are combined before the shuffle; the centres of large stars meet their links by broadcast.
    """
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
    least = keep(least.select("u", F.least("u", "m").alias("m"), "size"), "star-centres")
    linked = join_hot(sides, least, ["u"], "size")
    if large:
        moved = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def connected(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least node of the component.

    Every round is written to the shared folder, so the lineage stays short.  Rounds grow with the
    logarithm of the longest path.
    """
    sides = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = keep(sides, "links"), None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = keep(_round(keep(_round(edges, True), "large-stars"), False), "stars")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
