"""Exact order statistics without putting a column into one task.

Fixed-size quantile sketches say roughly where a value lies; exact counting then only has to
look near it. Equal values are combined before every shuffle, and what is ranked globally
are the totals of a fixed number of buckets.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window, functions as F

from gridmart.operators.codes import small_side
from gridmart.session import stored

BUCKETS = 256


def value_counts(df: DataFrame, columns: list[str], data_type: str) -> DataFrame:
    """``(column, value, n)`` for the non-NULL values of ``columns``; the table is read once."""
    typed = df.select(*[F.col(c).cast(data_type).alias(c) for c in columns])
    return (
        typed.unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bucket_limits(df: DataFrame, value: str, buckets: int = BUCKETS) -> DataFrame:
    """One stored row with the limits of ``add_buckets``, for several frames that need the same ones.

    A sketch depends on the order it is merged in, so limits that are computed twice may differ.
    """
    steps = [i / buckets for i in range(1, buckets)]
    limits = F.percentile_approx(value, steps, 20 * buckets).alias("_limits")
    return stored(df.agg(limits), "limits")


def add_buckets(
    df: DataFrame, by: list[str], value: str, buckets: int = BUCKETS, known: DataFrame | None = None
) -> DataFrame:
    """Add ``bucket``: all values of a bucket lie below those of the next one.

    The limits come from a quantile sketch over the distinct values of ``df``, one row per group
    of ``by``; they are stored and, up to the bound of ``small_side``, broadcast, so that rows are not
    moved to their group. Without ``by``, limits may be ``known`` from ``bucket_limits``. A row compares itself with every k-th limit and then with the k limits in between.
    """
    steps = [i / buckets for i in range(1, buckets)]
    limits = F.percentile_approx(value, steps, 20 * buckets).alias("_limits")
    if known is not None:
        cut = df.withColumn("_limits", known.scalar())
    elif by:
        found = stored(df.groupBy(*by).agg(limits), "limits")
        cut = df.join(small_side(found), by)
    else:
        cut = df.withColumn("_limits", df.agg(limits).scalar())
    stride = isqrt(buckets)
    coarse = F.filter("_limits", lambda x, i: ((i + 1) % stride == 0) & (x < F.col(value)))
    first = F.size(coarse) * stride
    near = F.filter(F.slice("_limits", F.col("_first") + 1, stride), lambda x: x < F.col(value))
    return (
        cut.withColumn("_first", first)
        .withColumn("bucket", F.col("_first") + F.size(near))
        .drop("_limits", "_first")
    )


def _near_middle(df: DataFrame, columns: list[str], accuracy: int, margin: float) -> DataFrame:
    """``(column, side, value, n)`` of the values around each column's middle.

    Values further off than ``margin`` (a share of the rows) are counted under ``side`` -1 or 1
    without a value, so only about twice that share of the rows keep theirs.
    """
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ends = [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)]
    sketch = typed.agg(*[F.percentile_approx(c, ends, accuracy).alias(c) for c in columns])
    limits = sketch.unpivot([], columns, "column", "ends").select(
        "column", F.col("ends")[0].alias("lo"), F.col("ends")[1].alias("hi")
    )
    side = F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") > F.col("hi"), 1)
    return (
        typed.unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .join(F.broadcast(limits), "column")  # one row per column
        .select("column", F.coalesce(side, F.lit(0)).alias("side"), "value")
        .groupBy("column", "side", F.when(F.col("side") == 0, F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _missed(counts: DataFrame) -> list[str]:
    """Columns whose middle ranks are not among the values that were kept."""
    sides = counts.groupBy("column").agg(
        F.sum(F.when(F.col("side") < 0, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("side") > 0, F.col("n")).otherwise(0)).alias("above"),
        F.sum("n").alias("rows"),
    )
    outside = "(rows - 1) div 2 < below OR rows div 2 >= rows - above"
    return [r["column"] for r in sides.filter(outside).select("column").collect()]


def exact_medians(
    df: DataFrame,
    columns: list[str],
    buckets: int = BUCKETS,
    accuracy: int = 10000,
    margin: float | None = None,
) -> DataFrame:
    """``(column, median)``: the middle value, or the mean of the two middle ones.

    The counts around the middle are stored: they are small, and several steps need them. The sketch is
    off by ``1 / accuracy`` of the rows at most and the margin is four times that; should a
    middle rank lie outside all the same, the column is counted again with a margin eight times as wide.
    """
    margin = 4.0 / accuracy if margin is None else margin
    counts = stored(_near_middle(df, columns, accuracy, margin), "near-middle")
    while missed := _missed(counts):
        margin = min(max(8 * margin, 4.0 / accuracy), 1.0)
        again = stored(_near_middle(df, missed, accuracy, margin), "near-middle")
        counts = counts.filter(~F.col("column").isin(missed)).unionByName(again)
    middle = add_buckets(counts.filter("side = 0"), ["column"], "value", buckets)
    far = counts.filter("side <> 0").withColumn(
        "bucket", F.when(F.col("side") < 0, -1).otherwise(buckets)
    )
    counts = middle.unionByName(far)
    totals = counts.groupBy("column", "bucket").agg(F.sum("n").alias("size"))
    # At most ``buckets`` + 2 rows per column from here.
    by_column = Window.partitionBy("column")
    running = by_column.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        totals.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .withColumn("rows", F.sum("size").over(by_column))
        .withColumn("low", F.expr("(rows - 1) div 2"))
        .withColumn("high", F.expr("rows div 2"))
        .filter("high >= before AND low < before + size")
        .drop("size", "rows")
    )
    inside = Window.partitionBy("column", "bucket").orderBy("value")
    # Two rows per column at most.
    ranked = middle.join(F.broadcast(placed), ["column", "bucket"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(inside)
    )
    covers = {
        side: (F.col(side) < F.col("upto")) & (F.col(side) >= F.col("upto") - F.col("n"))
        for side in ("low", "high")
    }
    return ranked.groupBy("column").agg(
        (
            (
                F.max(F.when(covers["low"], F.col("value")))
                + F.max(F.when(covers["high"], F.col("value")))
            )
            / 2
        ).alias("median")
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, mode)``: the most frequent value, the smallest of equally frequent ones."""
    return (
        value_counts(df, columns, "string")
        .groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
