"""Feature table of the play-success model: only what is known before the snap, and the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.functions import flag, play_success, side_of_code
from gridmart.plans import columns as C
from gridmart.plans.plays import keyed

EXCLUDING_FLAGS = ["two_point_attempt", "qb_kneel", "qb_spike", "penalty", "aborted_play"]
REQUIRED = ["ydstogo", "yardline_100", "yards_gained", "drive"]


def is_eligible() -> Column:
    ok = F.col("down").between(1, 4) & F.lower("play_type").isin("pass", "run")
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    for name in EXCLUDING_FLAGS:
        ok = ok & (flag(name) == 0)
    return ok


def ml_play_success_features(base: DataFrame, games: DataFrame) -> DataFrame:
    """Eligible plays of known games. ``base`` is the play base; plays are filtered and
    narrowed before the join with the games."""
    conditions = ["roof", "surface", "temperature", "wind"]
    plays = (
        keyed(base)
        .filter(is_eligible())
        .withColumn("offense_home_away", side_of_code())
        .withColumn("is_successful_play", play_success())
        .select(*[c for c in C.FEATURES if c not in conditions])
    )
    return plays.join(games.select("game_id", *conditions), "game_id").select(*C.FEATURES)
