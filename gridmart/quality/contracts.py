"""What must hold for every stored table."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, functions as F

from gridmart.functions import flag, is_no_play, is_real_play
from gridmart.plans.plays import PENALTY_DETAILS

FRANCHISE = ("dim_franchise", "franchise_id")
GAME = ("dim_game", "game_id")
PLAYER = ("dim_player", "player_id")


@dataclass(frozen=True)
class Contract:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    # (column, parent table, parent column)
    relationships: list[tuple[str, str, str]] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    grain: list[str] = field(default_factory=list)
    # Table that must hold every row's grain.
    parent: str | None = None
    rules: dict[str, Callable[[], Column]] = field(default_factory=dict)


def _play_rule(clear: list[str], some: list[str]) -> Callable[[], Column]:
    """Violated by rows outside drives, no-plays, a set ``clear`` flag, or no ``some`` flag."""

    def violation() -> Column:
        none_set = F.lit(True)
        for name in some:
            none_set = none_set & (flag(name) == 0)
        bad = F.col("drive").isNull() | F.coalesce(is_no_play(), F.lit(False)) | none_set
        for name in clear:
            bad = bad | (flag(name) != 0)
        return bad

    return violation


def _penalty_rule() -> Column:
    bare = flag("penalty") == 0
    for name in PENALTY_DETAILS:
        bare = bare & F.col(name).isNull()
    return F.col("drive").isNull() | (flag("two_point_attempt") != 0) | bare


def _sides_missing() -> Column:
    return is_real_play() & (
        F.col("offense_franchise_id").isNull() | F.col("defense_franchise_id").isNull()
    )


SIDES = [("offense_franchise_id", *FRANCHISE), ("defense_franchise_id", *FRANCHISE)]
PLAY_KEY = ["game_id", "play_id"]


def _subfact_contract(rule: Callable[[], Column]) -> Contract:
    return Contract(
        not_null=PLAY_KEY,
        relationships=SIDES,
        grain=PLAY_KEY,
        parent="fct_play",
        rules={"filter_rules": rule},
    )


CONTRACTS = {
    "dim_date": Contract(not_null=["date"], unique=["date"]),
    "dim_franchise": Contract(not_null=["franchise_id", "team_code"], unique=["franchise_id"]),
    "dim_game": Contract(
        not_null=[
            "game_id",
            "season",
            "game_type",
            "week",
            "gameday",
            "home_franchise_id",
            "away_franchise_id",
        ],
        unique=["game_id"],
        relationships=[("home_franchise_id", *FRANCHISE), ("away_franchise_id", *FRANCHISE)],
    ),
    "dim_player": Contract(not_null=["player_id"], unique=["player_id"]),
    "dim_player_season": Contract(
        not_null=["player_id", "season"],
        relationships=[("player_id", *PLAYER), ("franchise_id", *FRANCHISE)],
        grain=["player_id", "season"],
    ),
    "dim_team_code": Contract(
        not_null=["source_team_code", "team_code", "franchise_id"],
        unique=["source_team_code"],
        relationships=[
            ("team_code", "dim_franchise", "team_code"),
            ("franchise_id", *FRANCHISE),
        ],
    ),
    "fct_drive": Contract(
        not_null=["game_id", "drive", "offense_franchise_id"],
        relationships=[("game_id", *GAME), ("offense_franchise_id", *FRANCHISE)],
        grain=["game_id", "drive"],
    ),
    "fct_game": Contract(
        not_null=["game_id"], unique=["game_id"], relationships=[("game_id", *GAME)]
    ),
    "fct_play": Contract(
        not_null=PLAY_KEY,
        relationships=[("game_id", *GAME), *SIDES],
        grain=PLAY_KEY,
        rules={"real_plays_have_franchise_ids": _sides_missing},
    ),
    "fct_play_pass": _subfact_contract(
        _play_rule(
            ["two_point_attempt", "qb_spike", "qb_kneel"], ["pass_attempt", "sack", "qb_scramble"]
        )
    ),
    "fct_play_rush": _subfact_contract(
        _play_rule(["two_point_attempt", "qb_kneel", "sack"], ["rush_attempt", "qb_scramble"])
    ),
    "fct_play_kick": _subfact_contract(
        _play_rule(
            ["two_point_attempt"],
            ["punt_attempt", "kickoff_attempt", "field_goal_attempt", "extra_point_attempt"],
        )
    ),
    "fct_play_penalty": _subfact_contract(_penalty_rule),
    "fct_player_game": Contract(
        not_null=["game_id", "player_id"],
        relationships=[
            ("game_id", *GAME),
            ("player_id", *PLAYER),
            ("franchise_id", *FRANCHISE),
            ("opponent_franchise_id", *FRANCHISE),
        ],
        accepted={"game_team_side": ["home", "away", "unknown"]},
        grain=["game_id", "player_id"],
    ),
    "ml_play_success_features": Contract(
        not_null=[
            "game_id",
            "play_id",
            "season",
            "down",
            "ydstogo",
            "yardline_100",
            "drive",
            "offense_franchise_id",
            "defense_franchise_id",
            "offense_home_away",
            "is_successful_play",
        ],
        relationships=[("game_id", *GAME), *SIDES],
        accepted={
            "down": [1, 2, 3, 4],
            "offense_home_away": ["home", "away", "unknown"],
            "is_successful_play": [0, 1],
        },
        grain=PLAY_KEY,
    ),
}
