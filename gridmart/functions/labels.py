"""Derived labels: side of the ball, opponent, play success."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Share of the yards to go that makes a play a success, by down.
SUCCESS_SHARE = {1: 0.40, 2: 0.60, 3: 1.0, 4: 1.0}


def side_of_code(team: str = "posteam", home: str = "home_team", away: str = "away_team") -> Column:
    """Side by raw team code; a missing or foreign code is 'unknown'."""
    return (
        F.when(F.col(team) == F.col(home), "home")
        .when(F.col(team) == F.col(away), "away")
        .otherwise("unknown")
    )


def side_of_franchise(
    franchise: str = "franchise_id",
    home: str = "home_franchise_id",
    away: str = "away_franchise_id",
) -> Column:
    return side_of_code(franchise, home, away)


def opponent_of(
    franchise: str = "franchise_id",
    home: str = "home_franchise_id",
    away: str = "away_franchise_id",
) -> Column:
    return F.when(F.col(franchise) == F.col(home), F.col(away)).when(
        F.col(franchise) == F.col(away), F.col(home)
    )


def play_success(
    down: str = "down",
    to_go: str = "ydstogo",
    gained: str = "yards_gained",
    touchdown: str = "touchdown",
) -> Column:
    """1 for a touchdown or enough yards for the down, else 0."""
    enough = F.lit(False)
    for number, share in SUCCESS_SHARE.items():
        enough = enough | ((F.col(down) == number) & (F.col(gained) >= share * F.col(to_go)))
    return F.when((F.col(touchdown) == 1) | enough, 1).otherwise(0)
