"""Rollups from states that can be combined: exact sums, distinct counts (HLL) and quantiles (KLL).

Rows are read once, at the finest grain; every coarser group is a combination of stored states. So a lattice of
grouping sets costs one pass over the rows, and states kept per season make the rollup of a new season cheap.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

#: 2^LOG_BUCKETS registers: a relative standard error of 1.04 / 2^(LOG_BUCKETS / 2), 1.6 %.
LOG_BUCKETS = 12
#: KLL accuracy: ranks are off by less than 1.4 % with 99 % confidence.
ACCURACY = 200


@dataclass(frozen=True)
class Measures:
    """What is kept per group: ``sums`` and ``distinct`` map new names to columns, ``quantiles`` to (column, rank)."""

    sums: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)
    quantiles: dict[str, tuple[str, float]] = field(default_factory=dict)
    count: str = "row_count"

    def sketched(self) -> list[str]:
        """Columns with a quantile state: one for all ranks of a column."""
        return list(dict.fromkeys(column for column, _ in self.quantiles.values()))


def states(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """One row per group with its states: counts and sums as they are, sketches as binary."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(measures.count),
        *[F.sum(c).alias(name) for name, c in measures.sums.items()],
        *[F.hll_sketch_agg(c, LOG_BUCKETS).alias(name) for name, c in measures.distinct.items()],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), ACCURACY).alias(f"_kll_{c}") for c in measures.sketched()],
    )


def combined(found: DataFrame, keys: list[str], measures: Measures, sets: list[list[str]] | None = None) -> DataFrame:
    """States of coarser groups: of ``keys``, or of each of the grouping ``sets`` (then with ``grouping_id``)."""
    aggregates = [
        *[F.sum(c).alias(c) for c in (measures.count, *measures.sums)],
        *[F.hll_union_agg(c).alias(c) for c in measures.distinct],
        *[F.kll_merge_agg_double(f"_kll_{c}").alias(f"_kll_{c}") for c in measures.sketched()],
    ]
    if sets is None:
        return found.groupBy(*keys).agg(*aggregates)
    columns = [[F.col(c) for c in one] for one in sets]
    level = F.grouping_id().cast("bigint").alias("grouping_id")
    return found.groupingSets(columns, *[F.col(c) for c in keys]).agg(level, *aggregates)


def estimates(found: DataFrame, measures: Measures) -> DataFrame:
    """States as numbers: distinct counts and quantiles are estimates, all else is exact."""
    fixed = [c for c in found.columns if c not in measures.distinct and not c.startswith("_kll_")]
    return found.select(
        *fixed,
        *[F.hll_sketch_estimate(c).alias(c) for c in measures.distinct],
        *[
            F.kll_sketch_get_quantile_double(f"_kll_{column}", F.lit(rank)).alias(name)
            for name, (column, rank) in measures.quantiles.items()
        ],
    )
