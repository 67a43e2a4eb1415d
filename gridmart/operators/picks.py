"""One row per key: the latest, or the most frequent candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], order_desc: list[str], tiebreak: list[str] = ()
) -> DataFrame:
    """The row with the greatest ``order_desc`` per key; NULLs count as smallest.

    ``tiebreak`` columns (ascending, NULLs last) make the pick a total order. Spark
    turns rank-and-keep-first into a per-task limit ahead of the shuffle, so a
    hot key sends one row per task and not its whole group.
    """
    order = [F.desc_nulls_last(c) for c in order_desc] + [F.asc_nulls_last(c) for c in tiebreak]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _descending(df: DataFrame, name: str) -> Column:
    """A number that falls as the column rises."""
    kind = df.schema[name].dataType.typeName()
    column = F.col(name)
    if kind == "date":
        column = F.unix_date(column)
    elif kind == "timestamp":
        column = F.unix_micros(column)
    elif kind == "timestamp_ntz":
        column = F.unix_micros(F.to_utc_timestamp(column, "UTC"))
    elif kind == "boolean":
        column = column.cast("int")
    elif kind in ("string", "binary", "array", "map", "struct", "variant"):
        raise TypeError(f"{name} ({kind}) can't be ranked descending: a number or a time is needed")
    return -column


def pick_order(df: DataFrame, desc: list[str], asc: list[str]) -> Column:
    """Sort key for ``min_by``: numbers, dates or timestamps descending, then columns ascending,
    NULLs last in both."""
    parts = []
    for name in desc:
        parts += [F.col(name).isNull(), _descending(df, name)]
    for name in asc:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.struct(*[part.alias(f"o{i}") for i, part in enumerate(parts)])


def primary_by_count(
    df: DataFrame,
    keys: list[str],
    candidate: str,
    count: Column | None = None,
    then_desc: dict[str, Column] | None = None,
) -> DataFrame:
    """Per key, the ``candidate`` with the highest count; ties by ``then_desc`` aggregates
    descending, then by the smallest candidate. A NULL candidate takes part and can win.

    Two aggregations, each combined before its shuffle; no window over the rows.
    """
    then_desc = then_desc or {}
    counted = df.groupBy(*keys, candidate).agg(
        (F.count(F.lit(1)) if count is None else count).alias("candidate_count"),
        *[c.alias(name) for name, c in then_desc.items()],
    )
    order = pick_order(counted, ["candidate_count", *then_desc], [candidate])
    kept = ["candidate_count", *then_desc]
    best = F.min_by(F.struct(candidate, *kept), order)
    return counted.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, *[F.col(f"_best.{c}").alias(c) for c in [candidate, *kept]]
    )
