"""Data checks. Row checks are boolean columns, key checks are frames of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.operators import without_parent

RESULT = "check_name string, model string, violations bigint"


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def accepted_values(column: str, values: list) -> Column:
    """True for a value outside the set; NULL passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def rule(violation: Column) -> Column:
    """A violation condition; unknown (NULL) passes."""
    return F.coalesce(violation, F.lit(False))


def count_violations(df: DataFrame, model: str, row_checks: dict[str, Column]) -> DataFrame:
    """``(check_name, model, violations)`` for any number of row checks in one pass."""
    names = list(row_checks)
    counts = df.agg(*[F.count_if(row_checks[n]).alias(f"c{i}") for i, n in enumerate(names)])
    long = counts.unpivot([], [f"c{i}" for i in range(len(names))], "slot", "violations")
    label = reduce(
        lambda acc, i: acc.when(F.col("slot") == f"c{i}", F.lit(names[i])),
        range(1, len(names)),
        F.when(F.col("slot") == "c0", F.lit(names[0])),
    )
    return long.select(label.alias("check_name"), F.lit(model).alias("model"), "violations")


def duplicate_keys(df: DataFrame, keys: list[str], ignore_null: bool = False) -> DataFrame:
    """Keys that occur more than once, with their ``row_count``."""
    if ignore_null:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Child keys without a parent, with their ``row_count``; NULL keys pass.

    Child rows are counted per key before the join, so a hot key is one row in it.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return without_parent(counted, parent, keys)
