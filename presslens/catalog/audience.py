"""Segments and experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.catalog.inputs import LAST_DAY
from presslens.catalog.registry import TABLES, load, query
from presslens.plans import experiments, segments
from presslens.functions.ids import clean_ids, split_ids

_RULE = """CASE WHEN predicted_outcome = 'conversion' THEN 'high_conversion'
    WHEN conversion_probability >= 0.2 THEN 'medium_conversion'
    WHEN conversion_probability >= 0.1 THEN 'low_conversion' ELSE predicted_outcome END"""
TABLES["job_days"] = "SELECT date, model_version, count(*) AS rows_predicted FROM fx_predictions GROUP BY 1, 2"
TABLES["latest_rows"] = f"""SELECT *, {_RULE} AS segment FROM fx_predictions
    WHERE date = (SELECT max(date) FROM job_days WHERE date <= DATE '{LAST_DAY}')"""
TABLES["members_b"] = "SELECT DISTINCT segment, browser_id FROM latest_rows WHERE browser_id <> ''"
TABLES["members_u"] = """SELECT DISTINCT segment, user_id FROM (
    SELECT segment, unnest(string_split(user_ids, ',')) AS user_id FROM latest_rows) WHERE user_id <> ''"""


def predictions(spark, sf):
    return load(spark, sf, "fx_predictions")


def log(spark, sf):
    return predictions(spark, sf).groupBy("date", "model_version").agg(F.count("*").alias("rows_predicted"))


def members(spark, sf, id_col):
    return segments.segment_members(predictions(spark, sf), log(spark, sf), LAST_DAY, id_col)


@query("segment_assign", f"SELECT event_id, {_RULE} AS segment FROM fx_predictions")
def segment_assign(spark, sf):
    return segments.assigned(predictions(spark, sf)).select("event_id", "segment")


@query("segment_browsers", "SELECT * FROM members_b")
def segment_browsers(spark, sf):
    return members(spark, sf, "browser_id")


@query("segment_users", "SELECT * FROM members_u")
def segment_users(spark, sf):
    return members(spark, sf, "user_id")


TABLES["segment_facts"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c}', '{n}')" for i, c, n in segments.SEGMENTS
) + ") AS t(id, code, name)"


@query(
    "segment_list",
    f"""SELECT f.code, f.id::INT AS id, f.name, TRUE AS active, {segments.GROUP_ID} AS group_id,
    '{segments.GROUP_CODE}' AS group_code, '{segments.GROUP_NAME}' AS group_name,
    {segments.GROUP_SORTING} AS group_sorting, coalesce(m.n, 0) AS members
    FROM segment_facts f LEFT JOIN (SELECT segment, count(*) AS n FROM members_b GROUP BY 1) m
      ON f.code = m.segment""",
)
def segment_list(spark, sf):
    return segments.segment_sizes(members(spark, sf, "browser_id"))


@query(
    "segment_check",
    """SELECT p.event_id, p.segment, p.browser_id, m.browser_id IS NOT NULL AS is_member
    FROM (SELECT event_id, 'medium_conversion' AS segment, browser_id FROM fx_predictions) p
    LEFT JOIN members_b m ON p.segment = m.segment AND p.browser_id = m.browser_id""",
)
def segment_check(spark, sf):
    asked = predictions(spark, sf).select(
        "event_id", F.lit("medium_conversion").alias("segment"), "browser_id"
    )
    return segments.check_members(members(spark, sf, "browser_id"), asked, "browser_id")


@query(
    "split_user_ids",
    "SELECT event_id, unnest(string_split(user_ids, ',')) AS user_id FROM fx_predictions",
)
def split_user_ids(spark, sf):
    arrays = predictions(spark, sf).withColumn("user_ids", split_ids(F.col("user_ids")))
    return arrays.select("event_id", F.explode("user_ids").alias("user_id"))


@query(
    "clean_user_ids",
    """SELECT event_id, CASE WHEN a = b THEN a ELSE a || '|' || b END AS user_ids FROM (
    SELECT event_id, split_part(user_ids, ',', 1) AS a, split_part(user_ids, ',', 2) AS b
    FROM fx_predictions WHERE user_ids IS NOT NULL)""",
)
def clean_user_ids(spark, sf):
    rows = predictions(spark, sf).where(F.col("user_ids").isNotNull())
    noisy = F.concat(F.split("user_ids", ","), F.array(F.lit(""), F.lit("empty_user_id"), F.lit(None)))
    return rows.select("event_id", F.array_join(clean_ids(noisy), "|").alias("user_ids"))


# ---- experiments -------------------------------------------------------------------------------
TABLES["arm_totals"] = """SELECT experiment, arm, count(*) FILTER (converted) AS conversions, count(*) AS total
    FROM fx_arms GROUP BY 1, 2"""


def arm_totals(spark, sf):
    rows = load(spark, sf, "fx_arms")
    return experiments.arm_totals(rows, F.col("experiment"), F.col("arm"), F.col("converted"))


@query("experiment_arm_totals", "SELECT * FROM arm_totals")
def experiment_arm_totals(spark, sf):
    return arm_totals(spark, sf)


@query(
    "experiment_invalid",
    """SELECT experiment, arm, conversions, total, CASE WHEN conversions > total
      THEN 'more conversions than total' ELSE 'not enough arms' END AS reason
    FROM (SELECT user_id AS experiment, event_type AS arm, count(*) FILTER (value > 20) AS conversions,
        count(*) FILTER (value < 30) AS total, count(*) OVER (PARTITION BY user_id) AS n_arms
      FROM events GROUP BY 1, 2) WHERE conversions > total OR n_arms < 2""",
)
def experiment_invalid(spark, sf):
    """Counts of two different conditions as arms, so that some are not usable."""
    counted = spark.read.parquet(f"{sf}/events.parquet").groupBy(
        F.col("user_id").alias("experiment"), F.col("event_type").alias("arm")
    )
    arms = counted.agg(
        F.count_if(F.col("value") > 20).alias("conversions"), F.count_if(F.col("value") < 30).alias("total")
    )
    return experiments.invalid_arms(arms)


POINTS = 2_000


@query(
    "experiment_win_probability",
    f"""SELECT * FROM (WITH beta AS (SELECT experiment, arm, conversions::DOUBLE AS a, (total - conversions)::DOUBLE AS b FROM arm_totals),
      reach AS (SELECT *, a / (a + b) AS mean, 8 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS r FROM beta),
      span AS (SELECT *, greatest(0.0, min(mean - r) OVER (PARTITION BY experiment)) AS low,
          least(1.0, max(mean + r) OVER (PARTITION BY experiment)) AS high FROM reach),
      cells AS (SELECT *, low + (high - low) * (k - 0.5::DOUBLE) / {POINTS} AS x FROM span, range(1, {POINTS + 1}) t(k)),
      logs AS (SELECT *, (a - 1) * ln(x) + (b - 1) * ln(1 - x) AS l FROM cells),
      mass AS (SELECT *, w / sum(w) OVER (PARTITION BY experiment, arm) AS p FROM (
          SELECT *, exp(l - max(l) OVER (PARTITION BY experiment, arm)) AS w FROM logs)),
      below AS (SELECT *, ln(greatest(sum(p) OVER (PARTITION BY experiment, arm ORDER BY k) - p / 2, 1e-300)) AS lf FROM mass)
    SELECT experiment, arm, round(sum(p * exp(others)), 4)::DOUBLE AS win_probability, TRUE AS draws_agree FROM (
      SELECT *, sum(lf) OVER (PARTITION BY experiment, k) - lf AS others FROM below) GROUP BY 1, 2)""",
)
def experiment_win_probability(spark, sf):
    """Exact probabilities, and whether the simulated ones lie within 0.02 of them."""
    arms = arm_totals(spark, sf)
    exact = experiments.win_integrals(arms, points=POINTS)
    drawn = experiments.win_probabilities(arms, 10_000, seed=7).withColumnRenamed("win_probability", "drawn")
    agree = F.abs(F.col("drawn") - F.col("win_probability")) < 0.02
    return exact.join(drawn, ["experiment", "arm"]).select(
        "experiment", "arm", F.round("win_probability", 4).alias("win_probability"), agree.alias("draws_agree")
    )
