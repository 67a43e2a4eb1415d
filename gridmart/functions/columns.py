"""Small column expressions shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def flag(name: str) -> Column:
    """0/1 flag whose missing values count as 0."""
    return F.coalesce(F.col(name), F.lit(0.0))


def is_no_play(name: str = "play_type") -> Column:
    """True / False / NULL: a missing play type is neither a no-play nor a real play."""
    return F.lower(F.col(name)) == "no_play"


def is_real_play(name: str = "play_type") -> Column:
    return F.lower(F.col(name)) != "no_play"


def lenient_double(name: str) -> Column:
    """Number, or NULL where the value is not one (a plain cast raises in ANSI mode)."""
    number = F.expr(f"try_cast(`{name}` AS DOUBLE)")
    return F.when(~F.isnan(number), number)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so MAX, AVG and SUM skip it."""

    def clean(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType):
            return f"nanvl({name}, CAST(NULL AS DOUBLE)) AS {name}"
        if isinstance(field.dataType, T.FloatType):
            return f"CASE WHEN NOT isnan({name}) THEN {name} END AS {name}"
        return name

    # SQL text: one parse is far quicker than hundreds of Column objects on wide tables.
    return df.selectExpr(*[clean(f) for f in df.schema.fields])
