"""Small hand-written sources. Column types come from the schema lists in FIXTURES.md."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmart.plans.columns import play_inputs

DOC = Path(__file__).resolve().parents[1] / "FIXTURES.md"
TYPES = {
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
}


@cache
def schema(source: str) -> T.StructType:
    block = DOC.read_text().split(f"### `{source}`", 1)[1].split("\n###", 1)[0].split("\n## ")[0]
    fields = []
    for kind, names in re.findall(r"- \*\*(\w+)\*\* \(\d+\): (.+)", block):
        fields += [T.StructField(n.strip(), TYPES[kind]) for n in names.split(",")]
    return T.StructType(fields)


def rows(spark: SparkSession, source: str, data: list[dict]) -> DataFrame:
    """A staged frame with the columns the models read; those not given are NULL."""
    fields = schema(source)
    if source == "stg_play_by_play":
        fields = T.StructType([f for f in fields if f.name in play_inputs()])
    known = set(fields.names)
    for row in data:
        assert set(row) <= known, set(row) - known
    double = {f.name for f in fields if isinstance(f.dataType, T.DoubleType)}
    return spark.createDataFrame(
        [
            tuple(
                float(r[n]) if n in double and r.get(n) is not None else r.get(n)
                for n in fields.names
            )
            for r in data
        ],
        fields,
    )


CODES = [("AA", "AA"), ("A1", "AA"), ("BB", "BB"), ("B1", "BB"), ("CC", "CC"), ("DD", "DD")]
FRANCHISES = [
    ("alphas", "Alpha Town", "AA", "X", "East"),
    ("bravos", "Bravo City", "BB", "X", "East"),
    ("charlies", "Charlie Bay", "CC", "Y", "West"),
    ("deltas", "Delta Port", "DD", "Y", "West"),
]


def seeds(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "map_team_code_seed": spark.createDataFrame(
            CODES, "source_team_code string, team_code string"
        ),
        "dim_franchise_seed": spark.createDataFrame(
            FRANCHISES,
            "franchise_id string, franchise_name string, team_code string, "
            "conference string, division string",
        ),
    }


def play(game_id: str, play_id: int, **values) -> dict:
    base = dict(
        game_id=game_id,
        play_id=play_id,
        season=2020,
        nfl_week=1,
        home_team="AA",
        away_team="BB",
        posteam="AA",
        defteam="BB",
        play_type="run",
        drive=1,
        down=1,
        ydstogo=10,
        yardline_100=50,
        yards_gained=5,
        epa=0.5,
        success=1,
    )
    return {**base, **values}


def game(game_id: str, **values) -> dict:
    return {
        **dict(game_id=game_id, season=2020, week=1, home_team="AA", away_team="BB"),
        **values,
    }


def roster(player: str | None, week: int | None, team: str, **values) -> dict:
    return {**dict(gsis_id=player, season=2020, week=week, team=team), **values}
