"""Staged sources derived from the TPC-H-like test tables.

The test data hold no football, so line items play the plays, orders the games, events the
weekly rosters and nations the teams. Every source is one projection over one whole table,
with keys, NULLs, spelling variants and unknown codes set by arithmetic on its columns. The
expressions are portable SQL text: Spark evaluates them with ``selectExpr`` and the SQL
oracles use the same text in common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.plans.columns import play_inputs
from gridmart.sources.staging import GAMES, PLAYER_STATS, ROSTERS, TEAM_WEEK, TEAMS, stage

# 25 nations are known codes; the 26th code (N25) is in no seed.
HOME = "CAST({key} % 26 AS INT)"
AWAY = "CAST(({key} % 26 + 1 + {key} % 25) % 26 AS INT)"

FRANCHISES = {
    "franchise_id": "concat('f', CAST(n_nationkey % 20 AS STRING))",
    "franchise_name": "min(n_name)",
    "team_code": "concat('T', CAST(n_nationkey % 20 AS STRING))",
    "conference": "CASE WHEN n_nationkey % 20 < 10 THEN 'A' ELSE 'B' END",
    "division": "concat('D', CAST(min(n_regionkey) AS STRING))",
}
FRANCHISE_GROUP = ["franchise_id", "team_code", "conference"]

TEAM_CODES = {
    "source_team_code": "concat('N', CAST(n_nationkey AS STRING))",
    "team_code": "concat('T', CAST(n_nationkey % 20 AS STRING))",
}

SEASON = "CAST(1999 + {key} % 8 AS INT)"
WEEK = "CAST(1 + {key} % 18 AS INT)"


def _code(number: str) -> str:
    return f"concat('N', CAST({number} AS STRING))"


def _filler(name: str, i: int, kind: str, a: str, b: str) -> str:
    """Cheap values for a column no rule below depends on: distinct by column, some NULL."""
    if kind == "string":
        return f"CASE ({a} + {i}) % 3 WHEN 0 THEN '{name}-a' WHEN 1 THEN '{name}-b' END"
    if kind == "int":
        return f"CASE WHEN ({a} + {i}) % 9 = 0 THEN NULL ELSE CAST({b} % 100 + {i} AS INT) END"
    return f"CASE WHEN ({a} + {i}) % 9 = 0 THEN NULL ELSE CAST({b} + {i} AS DOUBLE) END"


STRING_ENDINGS = (
    "_id",
    "_name",
    "_team",
    "_type",
    "_result",
    "_length",
    "_location",
    "_gap",
    "_half",
    "_desc",
    "_nfl",
)
STRING_NAMES = {
    "defteam", "posteam", "side_of_field", "yrdln", "passer", "rusher", "receiver", "weekday",
    "gametime", "gsis", "pfr", "pff", "espn", "ftn", "roof", "surface", "home_coach",
    "away_coach", "referee", "stadium", "college", "headshot_url", "ngs_position", "status",
    "depth_chart_position", "status_description_abbr", "draft_club", "esb_id",
}
INT_NAMES = {
    "overtime", "home_score", "away_score", "total", "game_result", "away_rest", "home_rest",
    "away_moneyline", "home_moneyline", "away_spread_odds", "home_spread_odds", "under_odds",
    "over_odds", "div_game", "weight", "years_exp", "entry_year", "rookie_year",
    "draft_number", "jersey_number",
}


def kind_of(name: str) -> str:
    if name in INT_NAMES:
        return "int"
    return "string" if name in STRING_NAMES or name.endswith(STRING_ENDINGS) else "double"


def _flag(condition: str) -> str:
    """1 where the condition holds, else 0 for half of the rows and NULL for the others."""
    return (
        f"CASE WHEN {condition} THEN CAST(1 AS DOUBLE) WHEN k < 50 THEN CAST(0 AS DOUBLE) END"
    )


# First step over lineitem: p is a play-type code 0..13, k a pseudo-random 0..99. The four key
# columns of a line are packed into one play number.
PLAY_CORE = {
    "game_id": "l_orderkey",
    "play_id": "l_partkey * 268435456 + (l_suppkey % 33554432) * 8 + l_linenumber",
    "season": SEASON.format(key="l_orderkey"),
    "nfl_week": WEEK.format(key="l_orderkey"),
    "home_team": _code(HOME.format(key="l_orderkey")),
    "away_team": _code(AWAY.format(key="l_orderkey")),
    "p": "l_partkey % 14",
    "k": "(l_orderkey + l_partkey * 3 + l_suppkey * 5 + l_linenumber) % 100",
}
PLAY_SOURCE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
    "l_tax", "l_linestatus", "l_shipdate",
]
PLAY_RULES = {
    "posteam": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_linestatus = 'O' THEN home_team ELSE away_team END",
    "defteam": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_linestatus = 'O' THEN away_team ELSE home_team END",
    "game_date": "CAST(l_shipdate AS DATE)",
    "down": "CAST(nullif(l_linenumber % 6, 0) AS DOUBLE)",
    "drive": "CAST(nullif(l_linenumber, 7) AS DOUBLE)",
    "ydstogo": "CASE WHEN k = 99 THEN NULL ELSE CAST(CAST(l_quantity AS INT) % 15 + 1 AS DOUBLE) END",
    "yardline_100": "CAST(CAST(l_quantity AS INT) * 2 - 1 AS DOUBLE)",
    "yards_gained": "CAST(CAST(l_quantity AS INT) % 20 - 3 AS DOUBLE)",
    "ydsnet": "CAST(CAST(l_quantity AS INT) % 40 AS DOUBLE)",
    "epa": "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_discount * 10 - 0.5 END",
    "success": "CASE WHEN l_tax >= 0.04 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "play_type": (
        "CASE WHEN p = 0 THEN NULL WHEN p = 1 THEN 'no_play' WHEN p = 2 THEN 'NO_PLAY' "
        "WHEN p <= 6 THEN 'pass' WHEN p <= 10 THEN 'run' WHEN p = 11 THEN 'punt' "
        "WHEN p = 12 THEN 'kickoff' ELSE 'field_goal' END"
    ),
    "passer_player_id": "CASE WHEN p BETWEEN 3 AND 6 THEN l_suppkey END",
    "rusher_player_id": "CASE WHEN p BETWEEN 7 AND 10 THEN l_suppkey END",
    "receiver_player_id": "CASE WHEN p BETWEEN 3 AND 5 THEN l_suppkey + k % 3 END",
    "two_point_attempt": _flag("k = 0"),
    "qb_spike": _flag("k = 1"),
    "qb_kneel": _flag("k = 2"),
    "aborted_play": _flag("k = 3"),
    "qb_scramble": _flag("p = 7 AND k % 5 = 0"),
    "sack": _flag("p = 6"),
    "pass_attempt": _flag("p BETWEEN 3 AND 5"),
    "rush_attempt": _flag("p BETWEEN 7 AND 10"),
    "punt_attempt": _flag("p = 11"),
    "kickoff_attempt": _flag("p = 12"),
    "field_goal_attempt": _flag("p = 13 AND k % 2 = 0"),
    "extra_point_attempt": _flag("p = 13 AND k % 2 = 1"),
    "penalty": _flag("(p IN (1, 2) AND k % 2 = 0) OR k BETWEEN 90 AND 94"),
    "penalty_team": "CASE WHEN p IN (1, 2) AND k % 3 = 0 THEN home_team END",
    "penalty_yards": "CASE WHEN k = 95 THEN CAST(5 AS DOUBLE) END",
    "penalty_player_id": "CASE WHEN k = 96 THEN l_suppkey END",
    "penalty_type": "CASE WHEN k = 97 THEN 'holding' END",
    "touchdown": "CASE WHEN k BETWEEN 10 AND 12 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
}


def play_expressions() -> dict[str, str]:
    done = {c: c for c in PLAY_CORE if c not in ("p", "k")}
    out = {}
    for i, name in enumerate(play_inputs()):
        out[name] = (
            done.get(name)
            or PLAY_RULES.get(name)
            or _filler(name, i, kind_of(name), "l_partkey", "l_suppkey")
        )
    return out


GAME_RULES = {
    "game_id": "o_orderkey",
    "season": SEASON.format(key="o_orderkey"),
    "week": WEEK.format(key="o_orderkey"),
    "gameday": "CAST(o_orderdate AS DATE)",
    "home_team": _code(HOME.format(key="o_orderkey")),
    "away_team": _code(AWAY.format(key="o_orderkey")),
    "roof": "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END",
    "surface": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END",
    "temperature": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 90 AS DOUBLE) END",
    "wind": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 30 AS DOUBLE) END",
}

ROSTER_RULES = {
    "season": "CAST(year(ts) - event_id % 3 AS INT)",
    "week": "CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(extract(day FROM ts) AS INT) END",
    "team": "concat('N', CAST(((user_id + event_id % 4) % 26) AS STRING))",
    "player_position": "event_type",
    "jersey_number": "CAST(event_id % 99 AS INT)",
    "gsis_id": "nullif(user_id, 0)",
    "birth_date": "CAST(ts AS DATE)",
    "full_name": "concat('player ', CAST(user_id AS STRING))",
}


def game_expressions() -> dict[str, str]:
    return {
        c: GAME_RULES.get(c) or _filler(c, i, kind_of(c), "o_orderkey", "o_custkey")
        for i, c in enumerate(GAMES)
    }


def roster_expressions() -> dict[str, str]:
    return {
        c: ROSTER_RULES.get(c) or _filler(c, i, kind_of(c), "event_id", "user_id")
        for i, c in enumerate(ROSTERS)
    }


# Staged tables no model reads: one row per team, line item and order.
PLAIN = {
    "stg_teams_colors_logos": ("nation", TEAMS, {"team_abbr": TEAM_CODES["source_team_code"]}),
    "stg_player_stats": (
        "lineitem",
        PLAYER_STATS,
        {"player_id": "l_suppkey", "season": SEASON.format(key="l_orderkey")},
    ),
    "stg_stats_team_week": (
        "orders",
        TEAM_WEEK,
        {"season": SEASON.format(key="o_orderkey"), "week": WEEK.format(key="o_orderkey")},
    ),
}
FILLER_KEYS = {
    "nation": ("n_nationkey", "n_regionkey"),
    "lineitem": ("l_partkey", "l_suppkey"),
    "orders": ("o_orderkey", "o_custkey"),
}


def plain_expressions(name: str) -> dict[str, str]:
    table, columns, rules = PLAIN[name]
    a, b = FILLER_KEYS[table]
    return {c: rules.get(c) or _filler(c, i, kind_of(c), a, b) for i, c in enumerate(columns)}


def _select(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in expressions.items()]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _franchises(nation: DataFrame) -> DataFrame:
    keys = [f"{FRANCHISES[c]} AS {c}" for c in FRANCHISE_GROUP]
    grouped = nation.selectExpr("n_name", "n_regionkey", *keys).groupBy(*FRANCHISE_GROUP)
    rest = [F.expr(sql).alias(c) for c, sql in FRANCHISES.items() if c not in FRANCHISE_GROUP]
    return grouped.agg(*rest).select(*FRANCHISES)


def _plays(lines: DataFrame, columns: list[str]) -> DataFrame:
    core = lines.selectExpr(*PLAY_SOURCE, *_select(PLAY_CORE))
    expressions = play_expressions()
    return core.selectExpr(*_select({c: expressions[c] for c in columns}))


class Sources(dict):
    """Staged frames by name, each built when first asked for.

    ``play_columns`` limits the plays to what a query reads. Unused columns cost nothing at
    run time, but analysing 170 expressions takes longer than many of the queries.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, play_columns: list[str] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.play_columns = play_columns

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]

    def _build(self, name: str) -> DataFrame:
        if name == "map_team_code_seed":
            return self._read("nation").selectExpr(*_select(TEAM_CODES))
        if name == "dim_franchise_seed":
            return _franchises(self._read("nation"))
        if name == "stg_play_by_play":
            raw = _plays(self._read("lineitem"), self.play_columns or play_inputs())
            return stage(raw, name, self.play_columns)
        elif name == "stg_games":
            raw = self._read("orders").selectExpr(*_select(game_expressions()))
        elif name == "stg_roster_weekly":
            raw = self._read("events").selectExpr(*_select(roster_expressions()))
        else:
            raw = self._read(PLAIN[name][0]).selectExpr(*_select(plain_expressions(name)))
        return stage(raw, name)

    def _read(self, table: str) -> DataFrame:
        return read(self.spark, self.sf_dir, table)


def sources(
    spark: SparkSession, sf_dir: str, play_columns: list[str] | None = None
) -> Sources:
    return Sources(spark, sf_dir, play_columns)


def source_ctes() -> dict[str, str]:
    """The same sources as SQL text, by name."""
    core = ", ".join([*PLAY_SOURCE, *_select(PLAY_CORE)])
    group = ", ".join(FRANCHISES[c] for c in FRANCHISE_GROUP)
    return {
        "map_team_code_seed": f"SELECT {', '.join(_select(TEAM_CODES))} FROM nation",
        "dim_franchise_seed": (
            f"SELECT {', '.join(_select(FRANCHISES))} FROM nation GROUP BY {group}"
        ),
        "stg_play_by_play": (
            f"SELECT {', '.join(_select(play_expressions()))} "
            f"FROM (SELECT {core} FROM lineitem) AS lines"
        ),
        "stg_games": f"SELECT {', '.join(_select(game_expressions()))} FROM orders",
        "stg_roster_weekly": f"SELECT {', '.join(_select(roster_expressions()))} FROM events",
        **{
            name: f"SELECT {', '.join(_select(plain_expressions(name)))} FROM {table}"
            for name, (table, _, _) in PLAIN.items()
        },
    }
