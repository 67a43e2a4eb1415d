"""Dimensions of the star schema. Frames in, frame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridmart.operators import (
    add_missing_members,
    latest_per_key,
    normalize_codes,
    unpivot_roles,
)
from gridmart.operators.picks import pick_order
from gridmart.plans import columns as C

# First and last day of the calendar.
FIRST_DAY = "1999-01-01"
LAST_DAY = "2035-12-31"

PLAYER_ROLES = {
    "passer": "passer_player_id",
    "rusher": "rusher_player_id",
    "receiver": "receiver_player_id",
}


def dim_franchise(franchise_seed: DataFrame) -> DataFrame:
    return franchise_seed.select(*C.DIM_FRANCHISE)


def dim_team_code(code_map: DataFrame, franchises: DataFrame) -> DataFrame:
    """Every code ever used, with its current code and franchise."""
    return code_map.join(franchises, "team_code").select(*C.DIM_TEAM_CODE)


def game_base(games: DataFrame, team_codes: DataFrame) -> DataFrame:
    """Games whose two sides are both known teams, with all schedule columns.

    ``dim_game`` and ``fct_game`` are projections of it; joining the one back
    to the schedule on ``game_id`` would add nothing while that key is unique.
    """
    keep = ("franchise_id", "team_code")
    homed = normalize_codes(games, team_codes, "home_team", "home", "inner", keep)
    return normalize_codes(homed, team_codes, "away_team", "away", "inner", keep)


def dim_game(base: DataFrame) -> DataFrame:
    return base.select(*C.DIM_GAME)


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between the ``first_day`` and ``last_day`` of the one-row ``bounds``.

    Weekdays count from 0 = Sunday, weeks are ISO weeks.
    """
    day = F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day")))
    d = F.col("date")
    return bounds.select(day.alias("date")).select(
        d,
        F.date_format(d, "yyyyMMdd").cast("bigint").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week_num"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.weekofyear(d).alias("week_of_year"),
    )


def calendar_bounds(spark, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )


def play_player_ids(plays: DataFrame) -> DataFrame:
    return unpivot_roles(plays, PLAYER_ROLES, []).select("player_id")


def dim_player(rosters: DataFrame, plays: DataFrame) -> DataFrame:
    """Each player's latest roster entry, plus a bare row for players only seen in plays.

    Several teams can list a player in the same week; team and then the
    remaining columns decide.
    """
    known = rosters.filter(F.col("gsis_id").isNotNull()).withColumnRenamed("gsis_id", "player_id")
    attributes = [c for c in C.DIM_PLAYER if c != "player_id"]
    latest = latest_per_key(
        known.select("player_id", "season", "week", "team", *attributes),
        ["player_id"],
        ["season", "week"],
        ["team", *attributes],
    )
    return add_missing_members(latest.select(*C.DIM_PLAYER), play_player_ids(plays), "player_id")


def dim_player_season(rosters: DataFrame, team_codes: DataFrame) -> DataFrame:
    """Per player and season: the franchise with most weeks, and the latest position data,
    which may stem from another franchise."""
    key = ["player_id", "season"]
    attributes = [c for c in C.DIM_PLAYER_SEASON if c not in (*key, "franchise_id")]
    mapped = normalize_codes(
        rosters.withColumnRenamed("gsis_id", "player_id").dropna(subset=key),
        team_codes,
        "team",
        "club",
        "inner",
    ).select(*key, "week", F.col("club_franchise_id").alias("franchise_id"), *attributes)
    # Three groupings, each combined before its shuffle: distinct weeks, franchises, players.
    best = {c: F.col(f"best.{c}").alias(c) for c in attributes}
    weeks = mapped.groupBy(*key, "franchise_id", "week").agg(
        F.min_by(F.struct(*attributes), pick_order(mapped, [], attributes)).alias("best")
    )
    weeks = weeks.select(*key, "franchise_id", "week", *best.values())
    clubs = weeks.groupBy(*key, "franchise_id").agg(
        F.count("week").alias("weeks"),
        F.max("week").alias("last_week"),
        F.min_by(F.struct(*attributes), pick_order(weeks, ["week"], attributes)).alias("best"),
    )
    clubs = clubs.select(*key, "franchise_id", "weeks", "last_week", *best.values())
    most = pick_order(clubs, ["weeks", "last_week"], ["franchise_id"])
    latest = pick_order(clubs, ["last_week"], ["franchise_id", *attributes])
    return (
        clubs.groupBy(*key)
        .agg(
            F.min_by("franchise_id", most).alias("franchise_id"),
            F.min_by(F.struct(*attributes), latest).alias("best"),
        )
        .select(*key, "franchise_id", *best.values())
        .select(*C.DIM_PLAYER_SEASON)
    )
