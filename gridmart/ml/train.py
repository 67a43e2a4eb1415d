"""The training job: feature table in, metrics and test predictions out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from gridmart.ml import spec
from gridmart.ml.metrics import evaluate, metrics_long
from gridmart.ml.preprocess import Preprocess, apply_preprocess, encoder, fit_preprocess
from gridmart.ml.split import chrono_split, model_input
from gridmart.operators import modes
from gridmart.session import stored
from gridmart.sinks.results import (
    METRICS_TABLE,
    PREDICTIONS_TABLE,
    AppendResult,
    append_result,
)
from gridmart.sources.staging import require_rows


@dataclass(frozen=True)
class Run:
    run_id: str
    metrics: DataFrame
    predictions: DataFrame


def dummy_prediction(train: DataFrame, target: str = spec.TARGET) -> float:
    """The most frequent class of the training rows, the smaller one on a tie."""
    return float(modes(train, [target]).first()["mode"])


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def fit_logistic(train: DataFrame, target: str = spec.TARGET):
    """Penalised logistic regression on ``features``.

    The penalty is ½‖w‖² against the summed loss, which in terms of Spark's mean loss is
    a weight of 1/n; columns are already standardised and the intercept is free.
    """
    rows = train.count()
    return LogisticRegression(
        featuresCol="features",
        labelCol=target,
        regParam=1.0 / (spec.INVERSE_PENALTY * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=spec.MAX_ITERATIONS,
        tol=1e-8,
    ).fit(train)


@dataclass(frozen=True)
class Fit:
    """What is learned from the training rows."""

    preprocess: Preprocess
    coder: PipelineModel
    model: LogisticRegressionModel

    def score(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(self.coder.transform(apply_preprocess(rows, self.preprocess)))

    def feature_names(self) -> list[str]:
        """Names in the order of the weights: numbers, then each category that has an indicator."""
        labels = zip(spec.CATEGORICAL, self.coder.stages[0].labelsArray, strict=True)
        return [*spec.NUMERIC, *[f"{c}={label}" for c, own in labels for label in own]]


def fit(train_rows: DataFrame) -> Fit:
    fitted = fit_preprocess(train_rows, spec.NUMERIC, spec.CATEGORICAL)
    ready = apply_preprocess(train_rows, fitted)
    coder = encoder(spec.NUMERIC, spec.CATEGORICAL).fit(ready)
    model = fit_logistic(coder.transform(ready).select("features", spec.TARGET))
    return Fit(fitted, coder, model)


def penalised_gradient(fitted: Fit, train_rows: DataFrame) -> DataFrame:
    """``(feature, gradient)`` of the mean penalised loss at the fitted weights, over all training rows.

    The loss is convex, so weights at which every entry is 0 are the fit.
    """
    names = [*fitted.feature_names(), "intercept"]
    weights = [*fitted.model.coefficients.toArray().tolist(), 0.0]
    penalty = fitted.model.getRegParam()
    scored = fitted.score(train_rows).select(
        vector_to_array("features").alias("x"),
        (positive_probability() - F.col(spec.TARGET)).alias("residual"),
    )
    x = [*[F.col("x")[i] for i in range(len(names) - 1)], F.lit(1.0)]
    means = scored.agg(*[F.avg(F.col("residual") * v).alias(f"g{i}") for i, v in enumerate(x)])
    entries = [
        F.struct(F.lit(n).alias("feature"), (F.col(f"g{i}") + penalty * w).alias("gradient"))
        for i, (n, w) in enumerate(zip(names, weights, strict=True))
    ]
    return means.select(F.inline(F.array(*entries)))


def train(features: DataFrame, run_id: str | None = None, copy: bool = True) -> Run:
    """Fit both models on the training seasons and score the later ones.

    The input is read many times (seasons, statistics, an iterating fit), so it is stored in
    the shared folder once, by season: each split then reads its own folders. A feature table that is
    already stored by season needs no ``copy``.
    """
    run_id = run_id or str(uuid.uuid4())
    data = model_input(features)
    if copy:
        data = stored(data, "features", "season")
    require_rows(data, "feature table")
    split = chrono_split(data)
    is_train = F.col("split") == "train"
    train_rows = split.filter(is_train)
    majority = dummy_prediction(train_rows)
    fitted = fit(train_rows)

    keep = [
        *spec.ID_COLUMNS,
        "season",
        F.col("split").alias("split_name"),
        F.col(spec.TARGET).alias("actual"),
    ]
    scored = fitted.score(split.filter(~is_train))
    logistic = stored(
        scored.select(
            *keep,
            F.lit(spec.LOGISTIC).alias("model_name"),
            F.col("prediction").alias("predicted"),
            positive_probability().alias("probability"),
        ),
        "scores",
    )
    dummy = split.filter(F.col("split") == "validation").select(
        *keep,
        F.lit(spec.DUMMY).alias("model_name"),
        F.lit(majority).alias("predicted"),
        F.lit(majority).alias("probability"),
    )
    wide = evaluate(dummy.unionByName(logistic))
    predictions = logistic.filter(F.col("split_name") == "test").select(
        F.lit(run_id).alias("run_id"),
        "model_name",
        "split_name",
        F.col("game_id").cast("string").alias("game_id"),
        F.col("play_id").cast("bigint").alias("play_id"),
        F.col("season").cast("bigint").alias("season"),
        F.col("actual").cast("bigint").alias("actual_is_successful_play"),
        F.col("predicted").cast("bigint").alias("predicted_is_successful_play"),
        F.col("probability").alias("predicted_success_probability"),
    )
    metrics = metrics_long(wide).select(F.lit(run_id).alias("run_id"), "*")
    return Run(run_id, metrics, predictions)


def train_job(
    features: DataFrame, database: str | None = None, copy: bool = True
) -> dict[str, AppendResult]:
    """Train and append metrics and predictions to the (existing) result tables."""
    run = train(features, copy=copy)
    prefix = f"{database}." if database else ""
    return {
        table: append_result(df, prefix + table, run.run_id)
        for table, df in ((METRICS_TABLE, run.metrics), (PREDICTIONS_TABLE, run.predictions))
    }
