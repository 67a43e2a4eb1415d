"""Imputation, scaling and encoding, fitted on the training rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from gridmart.operators import exact_medians, modes


@dataclass(frozen=True)
class Preprocess:
    """One fitted number or word per column; nothing here grows with the data."""

    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    modes: dict[str, str]


def fit_preprocess(train: DataFrame, numeric: list[str], categorical: list[str]) -> Preprocess:
    """Median, then mean and population deviation of the filled column, and the
    most frequent category (the smallest of equally frequent ones)."""
    medians = {r["column"]: r["median"] for r in exact_medians(train, numeric).collect()}
    empty = [c for c in numeric if c not in medians]
    if empty:
        raise ValueError(f"no training value in: {', '.join(empty)}")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in numeric}
    stats = train.agg(
        *[F.avg(v).alias(f"mean_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"std_{c}") for c, v in filled.items()],
    ).first()
    frequent = {r["column"]: r["mode"] for r in modes(train, categorical).collect()}
    empty = [c for c in categorical if c not in frequent]
    if empty:
        raise ValueError(f"no training value in: {', '.join(empty)}")
    return Preprocess(
        medians=medians,
        means={c: stats[f"mean_{c}"] for c in numeric},
        # A constant column is only centred.
        scales={c: stats[f"std_{c}"] or 1.0 for c in numeric},
        modes=frequent,
    )


def impute(df: DataFrame, fitted: Preprocess) -> DataFrame:
    """Missing numbers and categories filled, under their own names."""
    fills = {**fitted.medians, **fitted.modes}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def apply_preprocess(df: DataFrame, fitted: Preprocess) -> DataFrame:
    """Add ``{c}_ready`` for every model column, filled and, for numbers, standardised."""
    ready = {
        c: (F.coalesce(F.col(c), F.lit(m)) - F.lit(fitted.means[c])) / F.lit(fitted.scales[c])
        for c, m in fitted.medians.items()
    }
    ready |= {c: F.coalesce(F.col(c), F.lit(m)) for c, m in fitted.modes.items()}
    return df.withColumns({f"{c}_ready": value for c, value in ready.items()})


def encoder(numeric: list[str], categorical: list[str], output: str = "features") -> Pipeline:
    """Indicators for the categories seen in training and one vector of all ready columns.

    The categories of a column travel through the driver: meant for codes, not for ids.

    Categories not seen in training get the extra index, which is the dropped
    last one: all their indicators are zero.
    """
    indexed = [f"{c}_index" for c in categorical]
    coded = [f"{c}_vector" for c in categorical]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=[f"{c}_ready" for c in categorical],
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True),
            VectorAssembler(inputCols=[*[f"{c}_ready" for c in numeric], *coded], outputCol=output),
        ]
    )
