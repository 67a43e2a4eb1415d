"""Metrics of binary predictions, per group of rows, without moving rows to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridmart.ml import spec
from gridmart.operators.quantiles import BUCKETS, add_buckets


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double, 0 where the divisor is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(
        F.try_divide(top.cast("double"), bottom.cast("double"))
    )


def binary_metrics(
    df: DataFrame, actual: str, predicted: str, by: list[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, and the confusion matrix as text.

    One aggregation counts the four cells for all groups; rows lacking
    either label are in none.
    """
    a, p = F.col(actual), F.col(predicted)
    cells = df.groupBy(*by).agg(
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.select(
        *by,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.format_string("[[%d, %d], [%d, %d]]", tn, fp, fn, tp).alias("confusion_matrix"),
    )


def roc_auc(
    df: DataFrame, actual: str, score: str, by: list[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Area under the ROC curve per group; NULL if only one class occurs.

    It is the share of (positive, negative) pairs in which the positive scores
    higher, ties counting half. Rows collapse to one per score first; running
    counts are then taken inside score buckets, and over bucket totals.
    """
    by = list(by)
    a = F.col(actual)
    scores = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(a == 1).alias("pos"), F.count_if(a == 0).alias("neg"))
    )
    placed = add_buckets(scores, by, "score", buckets)
    inside = (
        Window.partitionBy(*by, "bucket")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    pairs = F.col("pos").cast("double") * (below + F.col("neg") / 2)
    totals = (
        placed.withColumn("pairs", pairs)
        .groupBy(*by, "bucket")
        .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # At most ``buckets`` rows per group from here.
    running = (
        Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum("neg").over(running), F.lit(0))
    return (
        totals.withColumn("pairs", F.col("pairs") + F.col("pos").cast("double") * lower)
        .groupBy(*by)
        .agg(
            F.try_divide(
                F.sum("pairs"), F.sum("pos").cast("double") * F.sum("neg").cast("double")
            ).alias("roc_auc")
        )
    )


def metrics_long(wide: DataFrame, by: list[str] = ("model_name", "split_name")) -> DataFrame:
    """One row per metric; the confusion matrix is text without a value."""
    is_text = F.col("metric_name") == "confusion_matrix"
    raw = wide.select(*by, *[F.col(m).cast("string").alias(m) for m in spec.METRICS]).unpivot(
        list(by), spec.METRICS, "metric_name", "_raw"
    )
    return raw.select(
        *by,
        "metric_name",
        F.when(~is_text, F.col("_raw").cast("double")).alias("metric_value"),
        F.when(is_text, F.col("_raw")).alias("metric_text"),
    )


def evaluate(
    scored: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    score: str = "probability",
    by: list[str] = ("model_name", "split_name"),
    buckets: int = BUCKETS,
) -> DataFrame:
    """All metrics of every (model, split) in ``scored``, one row each.

    ``buckets`` is the number of ranges the scores of a group are ranked in; choose it so that a
    bucket of distinct scores fits a task.
    """
    by = list(by)
    return binary_metrics(scored, actual, predicted, by).join(
        roc_auc(scored, actual, score, by, buckets), by, "left"
    )
