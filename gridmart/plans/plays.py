"""Play-level facts and the aggregates over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.functions import flag, is_no_play, is_real_play, opponent_of, side_of_franchise
from gridmart.operators import (
    conditional_rollup,
    normalize_codes,
    pick_order,
    running,
    unpivot_roles,
)
from gridmart.plans import columns as C
from gridmart.plans.dimensions import PLAYER_ROLES

KEY = ["game_id", "play_id"]


def play_base(pbp: DataFrame, team_codes: DataFrame, self_join: bool = False) -> DataFrame:
    """All staged play columns plus the franchises of both sides; every play is kept.

    The play facts are projections of this frame, so no play is ever
    shuffled to meet itself. That equals joining the fact back to the staged plays as
    long as (game_id, play_id) is unique, which the checks enforce. With
    ``self_join`` the join is carried out, and repeated keys multiply as they
    would there.
    """
    sides = pbp
    for code, prefix in (("posteam", "offense"), ("defteam", "defense")):
        sides = normalize_codes(sides, team_codes, code, prefix)
    if not self_join:
        return sides
    fact = sides.select(*C.FCT_PLAY)
    rest = [c for c in pbp.columns if c not in C.FCT_PLAY]
    return fact.join(pbp.select(*KEY, *rest), KEY)


def keyed(base: DataFrame) -> DataFrame:
    """Plays that can be found by their key; rows without one never join."""
    return base.dropna(subset=KEY)


def fct_play(base: DataFrame) -> DataFrame:
    return base.select(*C.FCT_PLAY)


def _any_flag(*names: str) -> Column:
    hit = F.lit(False)
    for name in names:
        hit = hit | (flag(name) == 1)
    return hit


def _no_flag(*names: str) -> Column:
    clear = F.lit(True)
    for name in names:
        clear = clear & (flag(name) == 0)
    return clear


def is_pass_play() -> Column:
    return (
        F.col("drive").isNotNull()
        & is_real_play()
        & _no_flag("two_point_attempt", "qb_spike", "qb_kneel")
        & _any_flag("pass_attempt", "sack", "qb_scramble")
    )


def is_rush_play() -> Column:
    return (
        F.col("drive").isNotNull()
        & is_real_play()
        & _no_flag("two_point_attempt", "qb_kneel", "sack")
        & _any_flag("rush_attempt", "qb_scramble")
    )


def is_kick_play() -> Column:
    return (
        F.col("drive").isNotNull()
        & is_real_play()
        & _no_flag("two_point_attempt")
        & _any_flag("punt_attempt", "kickoff_attempt", "field_goal_attempt", "extra_point_attempt")
    )


PENALTY_DETAILS = ["penalty_team", "penalty_player_id", "penalty_yards", "penalty_type"]


def is_penalty_play() -> Column:
    """No-plays count: most penalties before the snap are recorded as such."""
    marked = _any_flag("penalty")
    for name in PENALTY_DETAILS:
        marked = marked | F.col(name).isNotNull()
    return F.col("drive").isNotNull() & _no_flag("two_point_attempt") & marked


# The kinds overlap (a scramble is pass and rush, a penalty can be any), so each is a filter of
# its own and not a category of the play.
SUBFACTS = {
    "fct_play_pass": (is_pass_play, C.FCT_PLAY_PASS),
    "fct_play_rush": (is_rush_play, C.FCT_PLAY_RUSH),
    "fct_play_kick": (is_kick_play, C.FCT_PLAY_KICK),
    "fct_play_penalty": (is_penalty_play, C.FCT_PLAY_PENALTY),
}


def subfact(base: DataFrame, name: str) -> DataFrame:
    predicate, columns = SUBFACTS[name]
    return keyed(base).filter(predicate()).selectExpr(
        *[f"{c.removeprefix('stg_')} AS {c}" for c in columns]
    )


def fct_drive(base: DataFrame) -> DataFrame:
    """One row per drive. Only the exact spelling 'no_play' is left out here, and
    ``yards_gained_sum`` is the largest running net yardage of the drive."""
    plays = keyed(base).filter(F.col("drive").isNotNull() & (F.col("play_type") != "no_play"))
    return plays.groupBy("game_id", "drive").agg(
        F.max("offense_franchise_id").alias("offense_franchise_id"),
        F.max("drive_play_count").alias("drive_play_count"),
        F.max("ydsnet").alias("yards_gained_sum"),
        F.sum("epa").alias("epa_sum"),
        F.avg("success").alias("success_rate"),
        F.max("drive_inside20").alias("drive_inside20"),
        F.max("drive_ended_with_score").alias("drive_ended_with_score"),
    )


def game_measures(plays: DataFrame) -> DataFrame:
    """Counts and rates per game. A missing play type is neither real nor a no-play."""
    return conditional_rollup(
        plays,
        ["game_id"],
        {
            "play_count": ("count", None, None),
            "no_play_count": ("count", is_no_play(), None),
            "real_play_count": ("count", is_real_play(), None),
            "epa_sum": ("sum", is_real_play(), "epa"),
            "success_rate": ("avg", is_real_play(), "success"),
        },
    )


def fct_game(games: DataFrame, plays: DataFrame) -> DataFrame:
    """``games`` is the game base. Plays are aggregated before they meet the games."""
    return games.join(game_measures(plays), "game_id", "left").select(*C.FCT_GAME)


def player_states(plays: DataFrame, *more: str) -> DataFrame:
    """Role rows combined per game, player and franchise (and ``more`` columns): counts, sums and maxima, which
    can be combined again."""
    real = F.col("no_play") == 0
    roles = unpivot_roles(
        plays.withColumn("no_play", F.when(is_no_play(), 1).otherwise(0)),
        PLAYER_ROLES,
        ["game_id", "season", "nfl_week", "offense_franchise_id", "no_play", "epa", *more],
    ).withColumnRenamed("offense_franchise_id", "franchise_id")
    return roles.groupBy("game_id", "player_id", "franchise_id", *more).agg(
        F.max("season").alias("season"),
        F.max("nfl_week").alias("nfl_week"),
        F.count(F.lit(1)).alias("play_count"),
        F.sum("no_play").alias("no_play_count"),
        *[F.sum(f"is_{role}").alias(f"{role}_play_count") for role in PLAYER_ROLES],
        F.sum(F.when(real, F.coalesce("epa", F.lit(0.0))).otherwise(F.lit(0.0))).alias("epa_sum"),
    )


def player_games(per_franchise: DataFrame, games: DataFrame) -> DataFrame:
    """One row per player and game from the states per franchise."""
    counts = [f"{role}_play_count" for role in PLAYER_ROLES]
    per_player = per_franchise.groupBy("game_id", "player_id").agg(
        F.max("season").alias("season"),
        F.max("nfl_week").alias("nfl_week"),
        F.min_by(
            "franchise_id", pick_order(per_franchise, ["play_count"], ["franchise_id"])
        ).alias("franchise_id"),
        *[F.sum(c).alias(c) for c in ["play_count", "no_play_count", *counts, "epa_sum"]],
    )
    sides = games.select("game_id", "home_franchise_id", "away_franchise_id")
    return (
        per_player.join(sides, "game_id", "left")
        .withColumn("real_play_count", F.col("play_count") - F.col("no_play_count"))
        .withColumn("opponent_franchise_id", opponent_of())
        .withColumn("game_team_side", side_of_franchise())
        .select(*C.FCT_PLAYER_GAME)
    )


def fct_player_game(plays: DataFrame, games: DataFrame) -> DataFrame:
    """One row per player and game over all roles; a play counts once per role.

    Role rows are first combined per franchise. That partial result gives both the
    totals and the main franchise (most role rows, then the smallest id; no
    franchise is a candidate too), so nothing is joined back to the role rows.
    """
    return player_games(player_states(plays), games)


def running_state(base: DataFrame) -> DataFrame:
    """Each play with the state of its game up to it: plays so far, net yards, touchdowns, the highest drive and the
    last known down. A game of any number of plays is cut into slices of them (`running`)."""
    plays = keyed(base).select(*KEY, "drive", "down", "yards_gained", flag("touchdown").alias("touchdown"))
    return running(
        plays.withColumn("one", F.lit(1)),
        ["game_id"],
        ["play_id", "drive", "down", "yards_gained", "touchdown"],
        {
            "plays_so_far": ("count", "one"),
            "yards_so_far": ("sum", "yards_gained"),
            "touchdowns_so_far": ("sum", "touchdown"),
            "drive_so_far": ("max", "drive"),
            "last_down": ("last", "down"),
        },
    ).select(*KEY, "plays_so_far", "yards_so_far", "touchdowns_so_far", "drive_so_far", "last_down")
