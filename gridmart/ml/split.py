"""Load and split the feature table by season."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.functions import lenient_double
from gridmart.ml import spec
from gridmart.sources.staging import require_columns


@dataclass(frozen=True)
class Seasons:
    """The last season is for testing, the one before for validation, all earlier ones train."""

    validation: float
    test: float

    def split(self, season: str = "season") -> Column:
        s = F.col(season)
        return (
            F.when(s == F.lit(self.test), "test")
            .when(s == F.lit(self.validation), "validation")
            .when(s < F.lit(self.validation), "train")
        )


def model_input(features: DataFrame) -> DataFrame:
    """The model's columns; numbers as doubles, with NULL for what is not a number."""
    wanted = spec.ID_COLUMNS + spec.NUMERIC + spec.CATEGORICAL + [spec.TARGET]
    require_columns(features, wanted, "feature table")
    numbers = set(spec.NUMERIC + [spec.TARGET])
    return features.select(
        *[lenient_double(c).alias(c) if c in numbers else F.col(c) for c in wanted]
    )


def select_seasons(df: DataFrame, season: str = "season") -> Seasons:
    """Only the three latest seasons reach the driver; fewer than three is an error."""
    latest = (
        df.select(season).dropna().distinct().orderBy(F.desc(season)).limit(3).collect()
    )
    if len(latest) < 3:
        raise ValueError("chronological splitting needs at least three seasons")
    return Seasons(validation=latest[1][0], test=latest[0][0])


def chrono_split(df: DataFrame, season: str = "season") -> DataFrame:
    """``df`` with a ``split`` column; rows without a season are in no split and dropped.

    The limits are literals in the plan, so on a table partitioned by season
    each split reads only its own folders. Seasons are taken from the rows
    themselves, hence no split is empty.
    """
    seasons = select_seasons(df, season)
    return df.withColumn("split", seasons.split(season)).filter(F.col("split").isNotNull())
