"""Aggregates that only look at the rows meeting a condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def conditional_rollup(
    df: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column | None, object]]
) -> DataFrame:
    """Group by ``keys`` with one column per measure ``(aggregate, condition, value)``.

    ``count`` counts rows meeting the condition. ``sum`` gives 0 to rows that do not
    meet it and skips NULL values of rows that do. ``avg`` and ``max`` see matching rows only.
    """
    return df.groupBy(*keys).agg(
        *[_measure(*spec).alias(name) for name, spec in measures.items()]
    )


def _measure(kind: str, condition: Column | None, value: object) -> Column:
    if kind == "count":
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    column = F.col(value) if isinstance(value, str) else value
    if condition is not None:
        column = F.when(condition, column)
        if kind == "sum":
            column = column.otherwise(F.lit(0))
    return {"sum": F.sum, "avg": F.avg, "max": F.max}[kind](column)
