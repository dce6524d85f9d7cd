"""Outcome models: preparation, training, prediction, registry."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model as MlModel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.flags import bool_to_int
from presslens.functions.numbers import row_shares
from presslens.functions.text import filled, name, scaled
from presslens.operators.encoding import fit_min_max
from presslens.operators.metrics import class_metrics
from presslens.session import scratch_dir
from presslens.sources.sinks import stored
from presslens.spec import FeatureSpec

Sampler = Callable[[DataFrame], DataFrame]


def prepare(df: DataFrame, spec: FeatureSpec, normalization: str = "ignore") -> DataFrame:
    """Unpacked profiles to model inputs: flags as 0/1, missing numbers as 0, optional row shares.

    Shares are taken within each feature group.  ``add`` keeps the counts next to the shares,
    ``replace`` drops them.
    """
    present = set(df.columns)
    flags = {c: bool_to_int(F.col(c)) for c in spec.bool_features() if c in present}
    df = df.withColumns(flags) if flags else df
    groups = [*spec.pivot_features().values(), *spec.time_features().values()]
    if normalization == "ignore":
        return df
    if normalization not in ("add", "replace"):
        raise ValueError(f"unknown normalization handling {normalization!r}")
    grouped = [c for g in groups for c in g]
    filled = df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) if c in present else F.lit(0.0) for c in grouped}
    )
    shares = [
        share.alias(f"{name}_normalized")
        for g in groups
        for name, share in zip(g, row_shares(g), strict=True)
    ]
    kept = [c for c in filled.columns if normalization == "add" or c not in set(grouped)]
    return filled.select(*kept, *shares)


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Add ``{column}_index``: position of the label in alphabetical order."""
    indexer = StringIndexer(inputCol=column, outputCol=f"{column}_index", stringOrderType="alphabetAsc")
    return indexer.fit(df).transform(df)


@dataclass
class OutcomeModel:
    """A fitted classifier with everything needed to encode new rows the same way."""

    classifier: MlModel
    labels: list[str]
    #: Numbers and flags, in the order of the vector; the categories follow them.
    dense: list[str]
    limits: dict[str, tuple[float, float]]
    categorical: list[str]
    encoder: PipelineModel | None = None

    def encode(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns plus the model inputs as one vector ``features``.

        Numbers are scaled by the fitted limits; columns the rows lack count as 0.  Texts become
        sparse indicators; null and values the model has not seen are all zero.
        """
        present = set(df.columns)
        dense = []
        for k, c in enumerate(self.dense):
            value = scaled(c, *self.limits[c], present=c in present) if c in self.limits else filled(c) if c in present else "0D"
            dense.append(f"{value} AS __dense_{k}")
        texts = [
            f"{f'CAST({name(c)} AS STRING)' if c in present else 'CAST(NULL AS STRING)'} AS __text_{k}"
            for k, c in enumerate(self.categorical)
        ]
        rows = df.selectExpr(*[name(c) for c in keep], *dense, *texts)
        if self.encoder is not None:
            rows = self.encoder.transform(rows)
        inputs = [f"__dense_{k}" for k in range(len(self.dense))] + [f"__hot_{k}" for k in range(len(self.categorical))]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(rows).select(*keep, "features")

    def _vector_names(self) -> list[str]:
        values = self.encoder.stages[0].labelsArray if self.encoder is not None else []
        return [*self.dense, *[f"{c}_{v}" for c, found in zip(self.categorical, values) for v in found]]

    @property
    def features(self) -> list[str]:
        """Names of all inputs in alphabetical order."""
        return sorted(self._vector_names())

    def importances(self) -> dict[str, float]:
        """Feature name -> importance, in alphabetical order."""
        values = self.classifier.featureImportances.toArray()
        return dict(sorted(zip(self._vector_names(), map(float, values), strict=True)))

    def save(self, path: str) -> None:
        """Classifier, encoder and encoding facts below one folder, written by Spark."""
        self.classifier.write().overwrite().save(f"{path}/classifier")
        if self.encoder is not None:
            self.encoder.write().overwrite().save(f"{path}/encoder")
        facts = {n: getattr(self, n) for n in ("labels", "dense", "limits", "categorical")}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/encoding")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OutcomeModel:
        facts = json.loads(spark.read.text(f"{path}/encoding").first()[0])
        facts["limits"] = {k: tuple(v) for k, v in facts["limits"].items()}
        encoder = PipelineModel.load(f"{path}/encoder") if facts["categorical"] else None
        return cls(RandomForestClassificationModel.load(f"{path}/classifier"), encoder=encoder, **facts)


def _category_encoder(rows: DataFrame, columns: Sequence[str]) -> PipelineModel | None:
    """Indexes of the values and sparse indicators, fitted on the rows; any number of values."""
    if not columns:
        return None
    every = range(len(columns))
    texts = rows.selectExpr(*[f"CAST({name(c)} AS STRING) AS __text_{k}" for k, c in enumerate(columns)])
    indexer = StringIndexer(
        inputCols=[f"__text_{k}" for k in every], outputCols=[f"__index_{k}" for k in every],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    # The bucket of unknown values is the last index, which gets no indicator.
    encoder = OneHotEncoder(
        inputCols=[f"__index_{k}" for k in every], outputCols=[f"__hot_{k}" for k in every], dropLast=True,
    )
    return Pipeline(stages=[indexer, encoder]).fit(texts)


def train(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    flags: Sequence[str] = (),
    label: str = "outcome",
    estimator=None,
    sampler: Sampler | None = None,
) -> OutcomeModel:
    """Fit a classifier on rows with a known outcome.

    ``df`` holds training rows only; encodings are learned from them.  ``sampler`` balances these
    rows; leave it out when the rows were balanced before they were split, as the catalogued model does.
    ``estimator`` is any Spark ML classifier (250-tree random forest by default).  Fitting reads
    the rows several times, so they should come from a stored table; a sampled set is stored here.
    """
    rows = df.where(F.col(label).isNotNull())
    if sampler is not None:
        rows = stored(sampler(rows), scratch_dir(df.sparkSession, "sampled"))
    present = set(rows.columns)
    numeric = sorted(set(numeric))
    known = [c for c in numeric if c in present]
    limits = {c: (0.0, 0.0) for c in numeric} | (fit_min_max(rows, known) if known else {})
    categorical = sorted(c for c in set(categorical) if c in present)
    dense = sorted({*numeric, *[c for c in flags if c in present]})
    model = OutcomeModel(None, [], dense, limits, categorical, _category_encoder(rows, categorical))
    encoded = model.encode(rows, [label])
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(encoded)
    estimator = estimator or RandomForestClassifier(numTrees=250, maxDepth=12, seed=42)
    estimator = estimator.copy({estimator.labelCol: "label", estimator.featuresCol: "features"})
    # The copy leaves the training summary behind, which would tie predictions to the session object.
    model.classifier = estimator.fit(indexer.transform(encoded)).copy()
    model.labels = list(indexer.labels)
    return model


def predict(model: OutcomeModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, ``{label}_probability`` per label and ``predicted_outcome``."""
    scored = model.classifier.transform(model.encode(df, keep))
    names = F.array(*[F.lit(name) for name in model.labels])
    probabilities = vector_to_array("probability")
    return scored.select(
        *keep,
        *[probabilities[i].alias(f"{name}_probability") for i, name in enumerate(model.labels)],
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_outcome"),
    )


def outcome_frame(model: OutcomeModel, df: DataFrame, label: str = "outcome") -> DataFrame:
    """Per-class metrics of a model on rows with a known outcome (also the dry-run check)."""
    known = df.where(F.col(label).isNotNull())
    return class_metrics(predict(model, known, [label]), label, "predicted_outcome")


def train_test_frames(model: OutcomeModel, df: DataFrame, label: str = "outcome") -> DataFrame:
    """``outcome_frame`` of the training and of the test rows, with a ``part`` column."""
    train_rows = outcome_frame(model, df.where("is_train"), label)
    test_rows = outcome_frame(model, df.where(~F.col("is_train")), label)
    return train_rows.select(F.lit("train").alias("part"), "*").unionByName(
        test_rows.select(F.lit("test").alias("part"), "*")
    )


def model_date(df: DataFrame) -> DataFrame:
    """One row with the day after the newest outcome, the date a model is named by."""
    return df.agg(F.date_add(F.max("outcome_date"), 1).alias("model_date"))


def registry_row(
    spark: SparkSession, model: OutcomeModel, spec: FeatureSpec, meta: Mapping[str, object]
) -> DataFrame:
    """One row for the ``models`` table: metadata and importances per feature set as JSON."""
    importances = model.importances()
    sets = {name: names for name, (_, names) in spec.feature_sets().items()}
    texts: dict[str, object] = dict(meta)
    for name, names in sets.items():
        if name.startswith("categorical"):
            wanted = [f for f in importances if any(f.startswith(f"{c}_") for c in names)]
        else:
            wanted = [c for c in names if c in importances]
        texts[f"importances__{name}"] = json.dumps({c: importances[c] for c in wanted})
    return spark.createDataFrame([texts])


def latest_model(
    registry: DataFrame,
    model_type: str,
    model_version: str,
    window_days: int,
    min_date: dt.date | str,
    now: dt.datetime | str,
) -> DataFrame:
    """Newest fitting registry rows whose training data end before ``min_date``.

    Newest means the fewest whole minutes before ``now``; ties are kept.
    """
    fitting = registry.where(
        (F.col("max_date") < F.lit(str(min_date)).cast("date"))
        & (F.col("model_type") == model_type)
        & (F.col("model_version") == model_version)
        & (F.col("window_days") == window_days)
    )
    reference = F.lit(str(now)).cast("timestamp_ntz")
    age = F.floor((F.unix_seconds(reference.cast("timestamp"))
                   - F.unix_seconds(F.col("train_date").cast("timestamp"))) / 60)
    aged = fitting.withColumn("__age", age)
    youngest = aged.agg(F.min("__age").alias("__age"))
    return aged.join(F.broadcast(youngest), "__age").drop("__age")


def job_log(predictions: DataFrame) -> DataFrame:
    """``prediction_job_log``: rows predicted per outcome day and model version."""
    return predictions.groupBy(F.col("outcome_date").alias("date"), "model_version").agg(
        F.min("created_at").alias("created_at"), F.count("*").alias("rows_predicted")
    )
