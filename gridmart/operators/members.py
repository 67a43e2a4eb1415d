"""Members that are referenced but not described."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def without_parent(
    child: DataFrame, parent: DataFrame, keys: dict[str, str] | list[str]
) -> DataFrame:
    """Child rows whose non-NULL key has no parent. ``keys`` maps child to parent columns.

    Parent keys are made distinct first: a key repeated millions of times
    enters the join once.
    """
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    known = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in pairs.items()]).distinct()
    on = [F.col(c) == F.col(f"_p_{c}") for c in pairs]
    for c in pairs:
        child = child.filter(F.col(c).isNotNull())
    return child.join(known, on, "left_anti")


def add_missing_members(dim: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``dim`` plus one row for each id it lacks, whose other columns are NULL.

    ``ids`` may repeat ids; they are made distinct before the join.
    """
    absent = without_parent(ids.select(key).distinct(), dim, [key])
    stubs = absent.select(
        *[
            F.col(key) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )
    return dim.unionByName(stubs)
