"""The whole star schema over one set of sources."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from gridmart.operators import small_side
from gridmart.operators.codes import SMALL_ROWS
from gridmart.plans import dimensions, features, plays
from gridmart.sinks.marts import save_mart

TABLES = """
dim_franchise dim_team_code dim_game dim_date dim_player dim_player_season
fct_play fct_play_pass fct_play_rush fct_play_kick fct_play_penalty
fct_drive fct_game fct_player_game ml_play_success_features
""".split()


class Warehouse:
    """Lazy frames of all tables, each built once from the staged sources.

    ``sources`` holds the staged frames stg_play_by_play, stg_games,
    stg_roster_weekly, the two seeds, and optionally ``calendar_bounds``. With
    ``out`` every table is written there on first use and later tables read the
    stored copy. ``by_season`` says that the staged plays are read from folders by season: play tables, which only
    take broadcast columns on, are then written from where they are read.
    """

    def __init__(self, sources: dict[str, DataFrame], out: str | None = None, by_season: bool = False):
        self.sources = sources
        self.out = out
        self.by_season = by_season

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def build_all(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def _keep(self, name: str, df: DataFrame, in_place: bool = False) -> DataFrame:
        return save_mart(df, f"{self.out}/{name}", rebalance=not in_place) if self.out else df

    @cached_property
    def _in_place(self) -> bool:
        """Whether plays keep their place: not if the codes are too many to be broadcast."""
        return self.by_season and self.dim_team_code.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS

    @cached_property
    def dim_franchise(self) -> DataFrame:
        return self._keep(
            "dim_franchise", dimensions.dim_franchise(self.sources["dim_franchise_seed"])
        )

    @cached_property
    def dim_team_code(self) -> DataFrame:
        seed = self.sources["map_team_code_seed"]
        return self._keep("dim_team_code", dimensions.dim_team_code(seed, self.dim_franchise))

    @cached_property
    def team_codes(self) -> DataFrame:
        """The code dimension as a join side: broadcast, once its size is known to allow it."""
        return small_side(self.dim_team_code)

    @cached_property
    def game_base(self) -> DataFrame:
        return dimensions.game_base(self.sources["stg_games"], self.team_codes)

    @cached_property
    def play_base(self) -> DataFrame:
        return plays.play_base(self.sources["stg_play_by_play"], self.team_codes)

    @cached_property
    def dim_game(self) -> DataFrame:
        return self._keep("dim_game", dimensions.dim_game(self.game_base))

    @cached_property
    def dim_date(self) -> DataFrame:
        bounds = self.sources.get("calendar_bounds")
        if bounds is None:
            bounds = dimensions.calendar_bounds(self.sources["stg_games"].sparkSession)
        return self._keep("dim_date", dimensions.dim_date(bounds))

    @cached_property
    def dim_player(self) -> DataFrame:
        rosters = self.sources["stg_roster_weekly"]
        return self._keep("dim_player", dimensions.dim_player(rosters, self.fct_play))

    @cached_property
    def dim_player_season(self) -> DataFrame:
        rosters = self.sources["stg_roster_weekly"]
        return self._keep(
            "dim_player_season", dimensions.dim_player_season(rosters, self.team_codes)
        )

    @cached_property
    def fct_play(self) -> DataFrame:
        return self._keep("fct_play", plays.fct_play(self.play_base), self._in_place)

    @cached_property
    def fct_play_pass(self) -> DataFrame:
        return self._subfact("fct_play_pass")

    @cached_property
    def fct_play_rush(self) -> DataFrame:
        return self._subfact("fct_play_rush")

    @cached_property
    def fct_play_kick(self) -> DataFrame:
        return self._subfact("fct_play_kick")

    @cached_property
    def fct_play_penalty(self) -> DataFrame:
        return self._subfact("fct_play_penalty")

    def _subfact(self, name: str) -> DataFrame:
        return self._keep(name, plays.subfact(self.play_base, name), self._in_place)

    @cached_property
    def fct_drive(self) -> DataFrame:
        return self._keep("fct_drive", plays.fct_drive(self.play_base))

    @cached_property
    def fct_game(self) -> DataFrame:
        return self._keep("fct_game", plays.fct_game(self.game_base, self.fct_play))

    @cached_property
    def fct_player_game(self) -> DataFrame:
        return self._keep("fct_player_game", plays.fct_player_game(self.fct_play, self.dim_game))

    @cached_property
    def ml_play_success_features(self) -> DataFrame:
        return self._keep(
            "ml_play_success_features",
            features.ml_play_success_features(self.play_base, self.dim_game),
        )
