"""Model inputs, training, prediction and the registry."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from presslens.catalog.audience import predictions
from presslens.catalog.crm import history, publisher_context, user_rows
from presslens.catalog.daily import pageviews, user_day_table
from presslens.catalog.inputs import FIRST_DAY, LAST_DAY
from presslens.catalog.registry import TABLES, load, query
from presslens.catalog.rolling import BROWSER_WINDOW, SPECS, browser_outcomes, long_table, rounded
from presslens.catalog.storage import user_store
from presslens.functions.flags import bool_to_int
from presslens.functions.labels import CHURN_LABELS, labels_of
from presslens.operators import dictionary, encoding, sampling
from presslens.operators.metrics import class_metrics
from presslens.operators.pivot import profile_pivot
from presslens.plans import context, daily, packing, training
from presslens.session import scratch_dir
from presslens.sources import sinks
from presslens.spec import HOUR_RANGES, REFERER_MEDIUMS, FeatureSpec, range_column, sanitize

CATEGORICAL = ("derived_referer_medium", "category")
SEED = 42

# ---- encoders ----------------------------------------------------------------------------------


@query(
    "bool_to_int",
    "SELECT event_id, CASE WHEN lower(subscriber) IN ('t', 'true', '1') THEN 1 ELSE 0 END AS subscriber FROM fx_pageviews",
)
def bools(spark, sf):
    return pageviews(spark, sf).select("event_id", bool_to_int(F.col("subscriber")).alias("subscriber"))


@query("label_index", """SELECT event_id, predicted_outcome,
    (dense_rank() OVER (ORDER BY predicted_outcome) - 1)::DOUBLE AS predicted_outcome_index
    FROM fx_predictions""")  # fmt: skip
def label_index(spark, sf):
    rows = predictions(spark, sf).select("event_id", "predicted_outcome")
    return training.label_index(rows, "predicted_outcome")


@query(
    "category_dict",
    " UNION ".join(
        f"SELECT '{c}' AS feature, {c} AS value FROM fx_pageviews UNION SELECT '{c}', 'Unknown'"
        for c in CATEGORICAL
    ),
)
def category_dict(spark, sf):
    return encoding.category_values(pageviews(spark, sf), CATEGORICAL)


#: A wide column next to the narrow ones.
WIDE = (*CATEGORICAL, "browser_id")
#: Dictionaries are learned up to this day and applied to all, so that unseen values occur.
LEARNED_UNTIL = "2024-01-01"

TABLES["category_index"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, value, (row_number() OVER (ORDER BY value) - 1)::BIGINT AS "index", n
    FROM (SELECT {c} AS value, count(*)::BIGINT AS n FROM fx_pageviews
          WHERE date <= DATE '{LEARNED_UNTIL}' AND {c} IS NOT NULL GROUP BY 1)"""
    for c in WIDE
)


def wide_dictionary(spark, sf):
    return dictionary.fit_dictionary(pageviews(spark, sf).where(F.col("date") <= F.lit(LEARNED_UNTIL).cast("date")), WIDE)


@query("category_table", "SELECT * FROM category_index")
def category_table(spark, sf):
    return wide_dictionary(spark, sf)


@query(
    "category_encode",
    "SELECT event_id, "
    + ", ".join(
        f"""coalesce(k_{c}.value, 'Unknown') AS {c}_known,
        coalesce(k_{c}.index, (SELECT count(*) FROM category_index WHERE feature = '{c}'))::BIGINT AS {c}_index"""
        for c in WIDE
    )
    + " FROM fx_pageviews p "
    + " ".join(f"LEFT JOIN category_index k_{c} ON k_{c}.feature = '{c}' AND k_{c}.value = p.{c}" for c in WIDE),
)
def category_encode(spark, sf):
    rows = pageviews(spark, sf).select("event_id", *WIDE)
    return dictionary.with_indexes(rows, wide_dictionary(spark, sf), WIDE).drop(*WIDE)


_VALUES = {
    "derived_referer_medium": ("", "direct", "email", "external", "internal", "search", "social"),
    "category": ("", "blog", "rodina-a-vztahy", "sport", "svet"),
}


@query(
    "one_hot",
    "SELECT event_id, "
    + ", ".join(
        f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}\""""
        for c, values in _VALUES.items()
        for v in values
    )
    + " FROM fx_pageviews",
)
def one_hot(spark, sf):
    rows = pageviews(spark, sf).select("event_id", *CATEGORICAL)
    return encoding.one_hot(rows, encoding.fit_categories(rows, CATEGORICAL))


_SCALED = ("pageviews", "timespent", "sessions", "sessions_without_ref")


@query(
    "min_max_scale",
    "SELECT date, user_id, "
    + ", ".join(
        f"""round(({c} - min({c}) OVER ()) / coalesce(NULLIF(max({c}) OVER () - min({c}) OVER (), 0), 1.0), 6)::DOUBLE AS {c}"""
        for c in _SCALED
    )
    + ", 0.0::DOUBLE AS constant FROM u_days",
)
def min_max_scale(spark, sf):
    rows = user_day_table(spark, sf).select("date", "user_id", *_SCALED, F.lit(3.0).alias("constant"))
    return rounded(encoding.min_max(rows, encoding.fit_min_max(rows, [*_SCALED, "constant"])))


_RANGES = [range_column(a, b) for a, b in HOUR_RANGES]
_MEDIUMS = [sanitize(f"referer_mediums_{k}") for k in REFERER_MEDIUMS]


def _share_sql(columns, table):
    total = " + ".join(columns)
    shares = ", ".join(f"round(coalesce({c} / NULLIF({total}, 0), 0.0), 6) AS {c}" for c in columns)
    return f"SELECT user_id, date, {shares} FROM {table}"


@query("row_normalize", _share_sql(_MEDIUMS, "u_pivot_mediums"))
def row_normalize(spark, sf):
    from presslens.functions.numbers import row_shares

    counts = profile_pivot(
        long_table(spark, sf, "user_id", "referer_mediums"), "user_id", "referer_mediums", REFERER_MEDIUMS
    )
    shares = [s.alias(c) for c, s in zip(_MEDIUMS, row_shares(_MEDIUMS), strict=True)]
    return rounded(counts.select("user_id", "date", *shares))


@query(
    "align_columns",
    """SELECT date, user_id, 0.0::DOUBLE AS clv, pageviews::DOUBLE AS pageviews,
    sessions::DOUBLE AS sessions FROM u_days""",
)
def align_columns(spark, sf):
    rows = user_day_table(spark, sf)
    return encoding.align_columns(rows, {"pageviews", "sessions", "clv"}, ["date", "user_id"])


# ---- samples and splits ------------------------------------------------------------------------
_DRAW = f"md5(concat_ws(':', CAST(event_id AS VARCHAR), '{SEED}'))"


@query(
    "undersample_counts",
    f"""SELECT event_id, predicted_outcome FROM (
      SELECT event_id, predicted_outcome, row_number() OVER (PARTITION BY predicted_outcome ORDER BY {_DRAW}) AS r
      FROM fx_predictions)
    WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM fx_predictions GROUP BY predicted_outcome))""",
)
def undersample(spark, sf):
    rows = predictions(spark, sf).select("event_id", "predicted_outcome")
    return sampling.undersample(rows, "predicted_outcome", ["event_id"], SEED)


MIN_DATE = "2024-01-05"


def _split_sql(order: str) -> str:
    return f"""SELECT event_id, date, CASE WHEN date < DATE '{MIN_DATE}' THEN TRUE ELSE r <= cut END AS is_train
    FROM (SELECT event_id, date,
      row_number() OVER (PARTITION BY date < DATE '{MIN_DATE}' ORDER BY {order}) AS r,
      round_even(count(*) OVER (PARTITION BY date < DATE '{MIN_DATE}') * 0.7, 0) AS cut FROM fx_predictions)"""


@query("random_split", _split_sql(_DRAW))
def random_split(spark, sf):
    rows = predictions(spark, sf).select("event_id", "date")
    return sampling.random_split(rows, ["event_id"], 0.7, MIN_DATE, SEED, outcome_date="date")


@query("time_split", _split_sql(f"date, {_DRAW}"))
def time_split(spark, sf):
    rows = predictions(spark, sf).select("event_id", "date")
    return sampling.time_split(rows, ["event_id"], 0.7, MIN_DATE, outcome_date="date", seed=SEED)


@query(
    "class_metrics",
    """SELECT label, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0
      ELSE round(2 * precision * recall / (precision + recall), 6) END::DOUBLE AS f_score, support
    FROM (SELECT label, round(coalesce(hit / NULLIF(guessed, 0), 0.0), 6) AS precision,
        round(coalesce(hit / NULLIF(support, 0), 0.0), 6) AS recall, support
      FROM (SELECT l.label, count(*) FILTER (quality = l.k) AS support, count(*) FILTER (toxic = l.k) AS guessed,
          count(*) FILTER (quality = l.k AND toxic = l.k) AS hit
        FROM labels, (SELECT DISTINCT k, CAST(k AS VARCHAR) AS label FROM (
          SELECT quality AS k FROM labels UNION SELECT toxic FROM labels)) l GROUP BY 1))""",
)
def metrics(spark, sf):
    rows = spark.read.parquet(f"{sf}/labels.parquet")
    scores = rounded(class_metrics(rows, "quality", "toxic"))
    total = F.col("precision") + F.col("recall")
    f_score = F.when(total == 0, F.lit(0.0)).otherwise(
        F.round(2 * F.col("precision") * F.col("recall") / total, 6)
    )
    return scores.withColumn("f_score", f_score)


# ---- registry and job log ----------------------------------------------------------------------
@query(
    "latest_model",
    """SELECT * FROM fx_models WHERE max_date < DATE '2024-01-20' AND model_version = '1.0'
    AND train_date = (SELECT max(train_date) FROM fx_models
      WHERE max_date < DATE '2024-01-20' AND model_version = '1.0')""",
)
def latest_model(spark, sf):
    return training.latest_model(
        load(spark, sf, "fx_models"), "conversion", "1.0", 30, "2024-01-20", "2024-02-01 00:00:00"
    )


@query(
    "prediction_job_log",
    """SELECT date + 1 AS date, model_version, min(created_at) AS created_at, count(*) AS rows_predicted
    FROM fx_predictions GROUP BY date, model_version""",
)
def prediction_job_log(spark, sf):
    rows = predictions(spark, sf).withColumn("outcome_date", F.date_add("date", 1))
    return training.job_log(rows)


# ---- training ----------------------------------------------------------------------------------
_KEYS = ["browser_id", "date", "outcome"]


def model_rows(spark, sf):
    """Browser profiles with outcomes, payment history and publisher context, balanced and split.

    All rows are balanced first and then split by time.  Fitting reads its rows several times, so
    they come from a written table.
    """
    spec = SPECS["b"]
    pairs = daily.browser_users(pageviews(spark, sf))
    rows = packing.profile_first_user(browser_outcomes(spark, sf), pairs, FIRST_DAY, LAST_DAY)
    rows = context.with_payment_history(rows, history(spark, sf)).drop("user_ids")
    rows = context.with_context(rows, publisher_context(spark, sf))
    prepared = sinks.stored(training.prepare(rows, spec), scratch_dir(spark, "profiles"))
    balanced = sampling.undersample(prepared, "outcome", _KEYS, SEED)
    return sinks.stored(sampling.time_split(balanced, _KEYS, 0.7), scratch_dir(spark, "balanced")), spec


#: Folders of models that were fitted and stored, by application and input.
_MODELS: dict[tuple[str, str], tuple[str, str]] = {}


def stored_model(spark, sf):
    """The model as loaded from its stored form, and its rows; fitted on first use."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        rows, spec = model_rows(spark, sf)
        model = training.train(
            rows.where("is_train"), spec.numeric_features(context=True, payments=True),
            spec.categorical_features(), spec.bool_features(),
        )
        folder = scratch_dir(spark, "model")
        model.save(folder)
        _MODELS[key] = folder, rows.inputFiles()[0].rpartition("/")[0]
    folder, table = _MODELS[key]
    return training.OutcomeModel.load(spark, folder), spark.read.parquet(table)


def _balanced_sql(source: str, keys: list[str]) -> dict[str, str]:
    """Oracle tables: rows of every outcome down to the rarest one, then split by time at 70 %."""
    name = source[0]
    draw = f"md5(concat_ws(':', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}, '{SEED}'))"
    balanced = f"""
    SELECT * EXCLUDE (h, r, cut) FROM (
      SELECT *, max(CASE WHEN r = smallest THEN h END) OVER (PARTITION BY outcome) AS cut FROM (
        SELECT *, {draw} AS h, row_number() OVER (PARTITION BY outcome ORDER BY {draw}) AS r,
          (SELECT min(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY outcome)) AS smallest FROM {source}))
    WHERE h <= cut"""
    split = f"""
    SELECT * EXCLUDE (h, r, cut), h <= max(CASE WHEN r = cut THEN h END) OVER () AS is_train FROM (
      SELECT *, CAST(date AS VARCHAR) || ':' || {draw} AS h,
        row_number() OVER (ORDER BY CAST(date AS VARCHAR) || ':' || {draw}) AS r,
        round_even(count(*) OVER () * 0.7, 0) AS cut FROM {name}_balanced)"""
    return {f"{name}_balanced": balanced, f"{name}_split": split}


TABLES.update(_balanced_sql("b_outcome", _KEYS))


@query(
    "train_predict",
    """SELECT browser_id, date, outcome, is_train, 1.0::DOUBLE AS probability_sum, TRUE AS is_most_likely
    FROM b_split""",
)
def train_predict(spark, sf):
    """Predictions of the stored model; the forest itself is checked by its properties."""
    model, rows = stored_model(spark, sf)
    found = training.predict(model, rows, [*_KEYS, "is_train"])
    chances = [F.col(f"{label}_probability") for label in model.labels]
    own = F.coalesce(*[F.when(F.col("predicted_outcome") == label, c) for label, c in zip(model.labels, chances)])
    return found.select(
        *_KEYS, "is_train", F.round(sum(chances[1:], chances[0]), 6).alias("probability_sum"),
        (own >= F.array_max(F.array(*chances))).alias("is_most_likely"),
    )


_DENSE = sorted({
    *SPECS["b"].numeric_features(context=True, payments=True), *SPECS["b"].bool_features(),
})
_TEXTS = SPECS["b"].categorical_features()


@query(
    "feature_importances",
    "SELECT feature, TRUE AS is_share, TRUE AS adds_up FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in _DENSE)
    + "]) AS feature"
    + "".join(f" UNION SELECT '{c}_' || {c} FROM b_split WHERE is_train AND {c} IS NOT NULL" for c in _TEXTS)
    + ")",
)
def feature_importances(spark, sf):
    """Every input by name; shares are not negative and add up to one (to zero if no tree could split)."""
    model, _ = stored_model(spark, sf)
    found = model.importances()
    adds_up = round(sum(found.values()), 6) in (0.0, 1.0)
    return spark.createDataFrame([(c, v >= 0, adds_up) for c, v in found.items()], "feature string, is_share boolean, adds_up boolean")


@query("train_test_metrics", "SELECT part, outcome AS label, count(*) AS support, TRUE AS is_share FROM (SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, outcome FROM b_split) GROUP BY 1, 2")
def train_test_metrics(spark, sf):
    """Precision, recall and support of both parts; what no SQL knows is checked to be a share."""
    model, rows = stored_model(spark, sf)
    found = training.train_test_frames(model, rows)
    shares = [F.col(c).between(0, 1) for c in ("precision", "recall", "f_score")]
    return found.where("support > 0").select("part", "label", "support", (shares[0] & shares[1] & shares[2]).alias("is_share"))


@query("dry_run_metrics", "SELECT outcome AS label, count(*) AS support FROM b_split WHERE NOT is_train GROUP BY 1")
def dry_run_metrics(spark, sf):
    model, rows = stored_model(spark, sf)
    return training.outcome_frame(model, rows.where("not is_train")).where("support > 0").select("label", "support")


@query("model_registry", f"""SELECT 'conversion' AS model_type, 7::BIGINT AS window_days, CAST(max(outcome_date) + 1 AS VARCHAR) AS train_date,
    {len(SPECS["b"].numeric_columns())}::BIGINT AS n_numeric FROM b_split""")  # fmt: skip
def model_registry(spark, sf):
    """The registry row of the stored model, with the importances of one feature set counted."""
    model, rows = stored_model(spark, sf)
    day = str(training.model_date(rows).first()[0])
    row = training.registry_row(spark, model, SPECS["b"], {"model_type": "conversion", "window_days": BROWSER_WINDOW, "train_date": day})
    names = F.json_object_keys("importances__numeric_columns")
    return row.select("model_type", "window_days", "train_date", F.size(names).cast("long").alias("n_numeric"))


# ---- the user level: profiles come from the store ----------------------------------------------
_USER_KEYS = ["user_id", "date", "outcome_date", "outcome"]
#: The first day written by the newer pipeline version, and the period of outcomes to learn from.
NEWER, OUTCOMES = "2024-01-15", ("2024-01-20", "2024-02-20")
TABLES["u_retrieved"] = f"""
    SELECT user_id, date, outcome_date, outcome FROM u_full WHERE outcome_date <= DATE '{OUTCOMES[1]}'
    AND (outcome_date >= DATE '{OUTCOMES[0]}' OR outcome = 'churn') AND outcome IS NOT NULL"""
TABLES.update(_balanced_sql("u_retrieved", _USER_KEYS))


def user_model_rows(spark, sf):
    """Profiles of two pipeline versions, the older without device brands, read back for training.

    All churns of the past are kept next to the period, then outcomes are balanced and split by time.
    """
    newer = user_store(spark)
    older = replace(newer, version="1.00", spec=FeatureSpec("user"))
    rows = sinks.stored(user_rows(spark, sf, FIRST_DAY, LAST_DAY), scratch_dir(spark, "user_rows"))
    older.write(rows.where(F.col("date") < F.lit(NEWER).cast("date")), FIRST_DAY, "2024-01-14", stored=True)
    newer.write(rows.where(F.col("date") >= F.lit(NEWER).cast("date")), NEWER, LAST_DAY, stored=True)
    found = newer.profiles(*OUTCOMES, history_labels=labels_of(CHURN_LABELS, "negative"))
    found = context.with_context(found.where(F.col("outcome").isNotNull()), publisher_context(spark, sf))
    prepared = sinks.stored(training.prepare(found, newer.spec), scratch_dir(spark, "prepared"))
    balanced = sampling.undersample(prepared, "outcome", _USER_KEYS, SEED)
    return sinks.stored(sampling.time_split(balanced, _USER_KEYS, 0.7), scratch_dir(spark, "balanced")), newer.spec


@query(
    "churn_train_predict",
    """SELECT user_id, date, outcome_date, outcome, is_train, 1.0::DOUBLE AS probability_sum, TRUE AS is_most_likely,
    CASE WHEN count(*) FILTER (is_train) OVER () >= 20 THEN TRUE END AS beats_constant FROM u_split""",
)
def churn_train_predict(spark, sf):
    """The churn model from stored profiles: retrieved, unpacked, fitted, stored, loaded, applied.

    ``beats_constant`` tells whether the model is right on more of its training rows than any
    constant answer would be, by a fifth at least; null below 20 training rows, which tell nothing.
    """
    rows, spec = user_model_rows(spark, sf)
    fitted = training.train(
        rows.where("is_train"), spec.numeric_features(context=True), spec.categorical_features(), spec.bool_features()
    )
    folder = scratch_dir(spark, "churn_model")
    fitted.save(folder)
    model = training.OutcomeModel.load(spark, folder)
    found = sinks.stored(training.predict(model, rows, [*_USER_KEYS, "is_train"]), scratch_dir(spark, "churn_predictions"))
    right = F.avg((F.col("outcome") == F.col("predicted_outcome")).cast("double"))
    learned = found.where("is_train")
    share = learned.groupBy("outcome").count().agg((F.max("count") / F.sum("count")).alias("share"))
    n, hit = learned.agg(F.count("*"), right).first()
    beats = hit > 1.2 * share.first()[0] if n >= 20 else None
    chances = [F.col(f"{label}_probability") for label in model.labels]
    own = F.coalesce(*[F.when(F.col("predicted_outcome") == label, c) for label, c in zip(model.labels, chances)])
    return found.select(
        *_USER_KEYS, "is_train", F.round(sum(chances[1:], chances[0]), 6).alias("probability_sum"),
        (own >= F.array_max(F.array(*chances))).alias("is_most_likely"), F.lit(beats).cast("boolean").alias("beats_constant"),
    )
