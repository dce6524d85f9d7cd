"""Multi-arm experiments: which arm is best, and with what probability."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2_000


def arm_totals(events: DataFrame, experiment: Column, arm: Column, converted: Column) -> DataFrame:
    """``(experiment, arm, conversions, total)`` counted from raw events."""
    return events.groupBy(experiment.alias("experiment"), arm.alias("arm")).agg(
        F.count_if(converted).alias("conversions"), F.count("*").alias("total")
    )


def invalid_arms(arms: DataFrame, min_arms: int = 2) -> DataFrame:
    """Arms that cannot be evaluated, with the reason."""
    counts = arms.groupBy("experiment").agg(F.count("*").alias("n_arms"))
    reason = F.when(F.col("conversions") > F.col("total"), F.lit("more conversions than total")).when(
        F.col("n_arms") < min_arms, F.lit("not enough arms")
    )
    checked = arms.join(counts, "experiment").withColumn("reason", reason)
    return checked.where(F.col("reason").isNotNull()).select(*arms.columns, "reason")


def _checked(arms: DataFrame, prior: tuple[float, float]) -> DataFrame:
    """Add the Beta parameters ``a`` and ``b``; a parameter that is not positive is an error."""

    def positive(value: Column, name: str) -> Column:
        message = F.concat(F.lit(f"Beta parameter {name} must be positive for arm "), F.col("arm"))
        return F.when(value > 0, value).otherwise(F.raise_error(message).cast("double"))

    a = F.col("conversions").cast("double") + F.lit(float(prior[0]))
    b = (F.col("total") - F.col("conversions")).cast("double") + F.lit(float(prior[1]))
    return arms.select("experiment", "arm", positive(a, "a").alias("a"), positive(b, "b").alias("b"))


def beta_draws(arms: DataFrame, ndraws: int, seed: int = 0, prior=(0.0, 0.0)) -> DataFrame:
    """``(experiment, arm, draw, value)``: ``ndraws`` Beta draws per arm.

    Spark SQL has no Beta sampler, so blocks of draws are made with numpy on Arrow batches.  The
    generator of a block is seeded by experiment, arm and block, hence draws do not depend on how
    rows are partitioned or retried.
    """
    blocks = F.sequence(F.lit(0), F.lit((ndraws - 1) // BLOCK))
    work = _checked(arms, prior).withColumn("block", F.explode(blocks))
    work = work.withColumn("experiment_text", F.col("experiment").cast("string"))
    kind = dict(arms.dtypes)["experiment"]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                values = _block_of(seed, row.experiment_text, row.arm, row.a, row.b, row.block, ndraws)
                first = row.block * BLOCK
                places = np.arange(first, first + len(values))
                yield pd.DataFrame({"experiment": row.experiment, "arm": row.arm, "draw": places, "value": values})

    schema = f"experiment {kind}, arm string, draw long, value double"
    return work.mapInPandas(draw, schema)


def win_probabilities(
    arms: DataFrame, ndraws: int = 10_000, seed: int = 0, prior: tuple[float, float] = (0.0, 0.0)
) -> DataFrame:
    """``(experiment, arm, win_probability)`` for every arm, 0.0 for arms that never win.

    The winner of a draw is the arm with the largest value, the first arm by name on a tie.  The
    arms of an experiment travel as one short row; a block of draws is one matrix inside a task,
    and only its win counts leave it.
    """
    checked = _checked(arms, prior).withColumn("text", F.col("experiment").cast("string"))
    kind = dict(arms.dtypes)["experiment"]
    listed = F.array_sort(F.collect_list(F.struct("arm", "a", "b"))).alias("arms")
    blocks = F.sequence(F.lit(0), F.lit((ndraws - 1) // BLOCK))
    work = checked.groupBy("experiment", "text").agg(listed).withColumn("block", F.explode(blocks))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                names = [x["arm"] for x in row.arms]
                values = np.stack([_block_of(seed, row.text, x["arm"], x["a"], x["b"], row.block, ndraws) for x in row.arms])
                wins = np.bincount(values.argmax(axis=0), minlength=len(names))
                yield pd.DataFrame({"experiment": row.experiment, "arm": names, "wins": wins})

    counted = work.mapInPandas(count, f"experiment {kind}, arm string, wins long")
    wins = counted.groupBy("experiment", "arm").agg(F.sum("wins").alias("wins"))
    share = F.coalesce(F.col("wins") / F.lit(float(ndraws)), F.lit(0.0))
    return (
        arms.select("experiment", "arm")
        .join(wins, ["experiment", "arm"], "left")
        .select("experiment", "arm", share.alias("win_probability"))
    )


def win_integrals(arms: DataFrame, prior: tuple[float, float] = (0.0, 0.0), points: int = 2_000) -> DataFrame:
    """``(experiment, arm, win_probability)`` by integration instead of draws.

    An arm wins with probability ``integral f_i(x) prod F_j(x) dx`` over the other arms j.  The
    integral is a sum over the middles of ``points`` cells that span eight standard deviations
    around all means of the experiment; a distribution function at a middle counts half its cell.
    """
    a, b, x = F.col("a"), F.col("b"), F.col("x")
    mean = a / (a + b)
    reach = 8 * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    every = Window.partitionBy("experiment")
    spanned = _checked(arms, prior).withColumns({
        "low": F.greatest(F.lit(0.0), F.min(mean - reach).over(every)), "high": F.least(F.lit(1.0), F.max(mean + reach).over(every)),
    })
    cells = spanned.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(points))))
    cells = cells.withColumn("x", F.col("low") + (F.col("high") - F.col("low")) * (F.col("k") - 0.5) / points)
    arm = Window.partitionBy("experiment", "arm")
    logs = cells.withColumn("l", (a - 1) * F.log(x) + (b - 1) * F.log(1 - x))
    weights = logs.withColumn("w", F.exp(F.col("l") - F.max("l").over(arm)))
    mass = weights.withColumn("p", F.col("w") / F.sum("w").over(arm))
    below = F.sum("p").over(arm.orderBy("k")) - F.col("p") / 2
    mass = mass.withColumn("lf", F.log(F.greatest(below, F.lit(1e-300))))
    others = F.sum("lf").over(Window.partitionBy("experiment", "k")) - F.col("lf")
    won = mass.withColumn("won", F.col("p") * F.exp(others))
    return won.groupBy("experiment", "arm").agg(F.sum("won").alias("win_probability"))


def _block_of(seed: int, experiment: str, arm: str, a: float, b: float, block: int, ndraws: int) -> np.ndarray:
    """One block of Beta draws; its generator depends on experiment, arm and block alone."""
    rng = np.random.default_rng([seed, zlib.crc32(f"{experiment}\x00{arm}".encode()), block])
    return rng.beta(a, b, min(BLOCK, ndraws - block * BLOCK))
