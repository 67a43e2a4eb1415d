"""Facts that follow their source files: only files that changed are read again.

Each play-level table, and each aggregated one as states that can be combined, is stored by source file (`versions`).
An update compares fingerprints with those of the last one, rebuilds what belongs to files that are new or changed, takes out
those that are gone, and writes down the fingerprints at the very end: an update that breaks off
is simply done again. Games, drives and player-games come from combining the states of all files, a small
fraction of the plays; a game whose plays stand in several files is right as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.functions import is_no_play, is_real_play
from gridmart.operators import conditional_rollup
from gridmart.plans import columns as C
from gridmart.plans import plays as P
from gridmart.session import discard, stored, without_shuffles, work_paths
from gridmart.sinks import versions
from gridmart.sinks.versions import KEY

PRINTS = "_files"


def game_states(plays: DataFrame) -> DataFrame:
    real = is_real_play()
    return conditional_rollup(
        plays,
        [KEY, "game_id"],
        {
            "play_count": ("count", None, None),
            "no_play_count": ("count", is_no_play(), None),
            "real_play_count": ("count", real, None),
            "epa_sum": ("sum", real, "epa"),
            "successes": ("sum", real & F.col("success").isNotNull(), "success"),
            "judged": ("count", real & F.col("success").isNotNull(), None),
        },
    )


def games_of(states: DataFrame, games: DataFrame) -> DataFrame:
    """``fct_game`` from the states of all files and the game base."""
    counts = ["play_count", "no_play_count", "real_play_count", "epa_sum", "successes", "judged"]
    whole = states.groupBy("game_id").agg(*[F.sum(c).alias(c) for c in counts])
    measures = whole.withColumn("success_rate", _rate("successes", "judged")).drop("successes", "judged")
    return games.join(measures, "game_id", "left").select(*C.FCT_GAME)


def _rate(total: str, number: str):
    return F.when(F.col(number) > 0, F.col(total) / F.col(number))


_DRIVE_MAX = ["offense_franchise_id", "drive_play_count", "yards_gained_sum", "drive_inside20", "drive_ended_with_score"]


def drive_states(base: DataFrame) -> DataFrame:
    plays = P.keyed(base).filter(F.col("drive").isNotNull() & (F.col("play_type") != "no_play"))
    highest = [F.max("ydsnet" if c == "yards_gained_sum" else c).alias(c) for c in _DRIVE_MAX]
    return plays.groupBy(KEY, "game_id", "drive").agg(
        *highest,
        F.sum("epa").alias("epa_sum"),
        F.sum("success").alias("successes"),
        F.count("success").alias("judged"),
    )


def drives_of(states: DataFrame) -> DataFrame:
    """``fct_drive`` from the states of all files."""
    whole = states.groupBy("game_id", "drive").agg(
        *[F.max(c).alias(c) for c in _DRIVE_MAX], *[F.sum(c).alias(c) for c in ("epa_sum", "successes", "judged")]
    )
    return whole.withColumn("success_rate", _rate("successes", "judged")).select(*C.FCT_DRIVE)


def player_games_of(states: DataFrame, games: DataFrame) -> DataFrame:
    """``fct_player_game`` from the states of all files."""
    summed = [c for c in states.columns if c.endswith("_count")] + ["epa_sum"]
    # Both aggregates find their rows together then: one shuffle of all states and not two.
    near = states.repartition("game_id", "player_id")
    whole = near.groupBy("game_id", "player_id", "franchise_id").agg(
        F.max("season").alias("season"), F.max("nfl_week").alias("nfl_week"), *[F.sum(c).alias(c) for c in summed]
    )
    return P.player_games(whole, games)


#: What is stored per source file, from the play base of its rows (which has the file's key).
PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fct_play": lambda base: base.select(*C.FCT_PLAY, KEY),
    **{
        name: lambda base, name=name: P.keyed(base).filter(P.SUBFACTS[name][0]()).selectExpr(
            *[f"{c.removeprefix('stg_')} AS {c}" for c in P.SUBFACTS[name][1]], KEY
        )
        for name in P.SUBFACTS
    },
    "game_states": game_states,
    "drive_states": drive_states,
    "player_states": lambda base: P.player_states(base, KEY),
}

#: Staged columns that the states are made of, with those of the team codes and of the play's key.
INPUTS = {
    name: ["game_id", "play_id", "season", "play_type", "epa", "posteam", "defteam", *more]
    for name, more in {
        "game_states": ["success"],
        "drive_states": ["drive", "success", *C.DRIVE_INPUTS],
        "player_states": ["nfl_week", *P.PLAYER_ROLES.values()],
    }.items()
}


@dataclass
class Changes:
    added: list[str]
    changed: list[str]
    removed: list[str]

    @property
    def read(self) -> list[str]:
        return sorted(self.added + self.changed)


class IncrementalFacts:
    """Facts of plays under ``folder``; ``parts`` names those that are wanted."""

    def __init__(self, spark: SparkSession, folder: str, parts: list[str] | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.parts = list(parts or PARTS)

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _prints(self) -> dict[str, str]:
        now = versions.current(self.spark, self._path(PRINTS))
        return {k: v["print"] for k, v in now.files.items()} if now else {}

    def changes(self, prints: dict[str, str]) -> Changes:
        before = self._prints()
        return Changes(
            sorted(prints.keys() - before.keys()),
            sorted(k for k in prints.keys() & before.keys() if prints[k] != before[k]),
            sorted(before.keys() - prints.keys()),
        )

    def update(
        self, prints: dict[str, str], load: Callable[[list[str]], DataFrame], team_codes: DataFrame
    ) -> Changes:
        """Bring all parts up to the files of ``prints`` (key to fingerprint).

        ``load`` gives the staged plays of some keys with their ``source_file``; it is called once, with the files that are new
        or changed. Another set of team codes changes every play, so it is part of each fingerprint.
        """
        codes = sorted(map(str, team_codes.collect()))  # a few dozen rows
        mark = hashlib.md5("\n".join(codes).encode()).hexdigest()
        prints = {k: f"{p} {mark}" for k, p in prints.items()}
        found = self.changes(prints)
        if found.read:
            base, own = P.play_base(load(found.read), team_codes), []
            # Plays are kept for several parts to read, or to lie together by file; the states of one part are aggregated on
            # the way, and all but their columns pruned.
            if len(self.parts) > 1 or self.parts[0] not in INPUTS:
                others = work_paths(self.spark)
                base = stored(base, "changed-plays", partition_by=KEY)
                own = [p for p in work_paths(self.spark) if p not in others]
            with without_shuffles(self.spark):
                for name in self.parts:
                    versions.replace(PARTS[name](base), self._path(name), found.read)
            discard(self.spark, own)
        if found.removed:
            for name in self.parts:
                versions.remove(self.spark, self._path(name), found.removed)
        if found.read or found.removed:
            known = {k: {"load": "", "print": p} for k, p in prints.items()}
            versions.commit(self.spark, self._path(PRINTS), lambda files: known)
        return found

    def part(self, name: str, keys: list[str] | None = None) -> DataFrame:
        """A stored part as it is now, with its source file."""
        return versions.read(self.spark, self._path(name), keys=keys)

    def fct_play(self) -> DataFrame:
        return self.part("fct_play").select(*C.FCT_PLAY)

    def subfact(self, name: str) -> DataFrame:
        return self.part(name).select(*P.SUBFACTS[name][1])

    def fct_game(self, game_base: DataFrame) -> DataFrame:
        return games_of(self.part("game_states"), game_base)

    def fct_drive(self) -> DataFrame:
        return drives_of(self.part("drive_states"))

    def fct_player_game(self, games: DataFrame) -> DataFrame:
        return player_games_of(self.part("player_states"), games)
