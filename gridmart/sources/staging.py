"""From raw records to staged tables: flatten, lower-case, rename, choose columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from gridmart.functions import nan_to_null
from gridmart.plans.columns import play_inputs
from gridmart.sources.landing import PROVENANCE

# Staged columns of the five narrower sources, in source order.
GAMES = """
game_id season game_type week gameday weekday gametime away_team away_score home_team
home_score game_location game_result total overtime old_game_id gsis nfl_detail_id pfr pff espn
ftn away_rest home_rest away_moneyline home_moneyline spread_line away_spread_odds
home_spread_odds total_line under_odds over_odds div_game roof surface temperature wind
away_qb_id home_qb_id away_qb_name home_qb_name away_coach home_coach referee stadium_id stadium
""".split()

TEAMS = """
team_abbr team_name team_id team_nick team_conf team_division team_color team_color2
team_color3 team_color4 team_logo_wikipedia team_logo_espn team_wordmark team_conference_logo
team_league_logo team_logo_squared
""".split()

ROSTERS = """
season team player_position depth_chart_position jersey_number status full_name first_name
last_name birth_date height weight college gsis_id espn_id sportradar_id yahoo_id rotowire_id
pff_id pfr_id fantasy_data_id sleeper_id years_exp headshot_url ngs_position week game_type
status_description_abbr football_name esb_id gsis_it_id smart_id entry_year rookie_year
draft_club draft_number
""".split()

PLAYER_STATS = """
player_id player_name player_display_name position position_group headshot_url season week
season_type team opponent_team completions attempts passing_yards passing_tds
passing_interceptions sacks_suffered sack_yards_lost sack_fumbles sack_fumbles_lost
passing_air_yards passing_yards_after_catch passing_first_downs passing_epa passing_cpoe
passing_2pt_conversions pacr carries rushing_yards rushing_tds rushing_fumbles
rushing_fumbles_lost rushing_first_downs rushing_epa rushing_2pt_conversions receptions targets
receiving_yards receiving_tds receiving_fumbles receiving_fumbles_lost receiving_air_yards
receiving_yards_after_catch receiving_first_downs receiving_epa receiving_2pt_conversions racr
target_share air_yards_share wopr special_teams_tds def_tackles_solo def_tackles_with_assist
def_tackle_assists def_tackles_for_loss def_tackles_for_loss_yards def_fumbles_forced def_sacks
def_sack_yards def_qb_hits def_interceptions def_interception_yards def_pass_defended def_tds
def_fumbles def_safeties misc_yards fumble_recovery_own fumble_recovery_yards_own
fumble_recovery_opp fumble_recovery_yards_opp fumble_recovery_tds penalties penalty_yards
punt_returns punt_return_yards kickoff_returns kickoff_return_yards fg_made fg_att fg_missed
fg_blocked fg_long fg_pct fg_made_0_19 fg_made_20_29 fg_made_30_39 fg_made_40_49 fg_made_50_59
fg_made_60_ fg_missed_0_19 fg_missed_20_29 fg_missed_30_39 fg_missed_40_49 fg_missed_50_59
fg_missed_60_ fg_made_list fg_missed_list fg_blocked_list fg_made_distance fg_missed_distance
fg_blocked_distance pat_made pat_att pat_missed pat_blocked pat_pct gwfg_made gwfg_att
gwfg_missed gwfg_blocked gwfg_distance fantasy_points fantasy_points_ppr
""".split()

# Columns of the team table, in source order.
TEAM_WEEK = """
season week team season_type opponent_team completions attempts passing_yards passing_tds
passing_interceptions sacks_suffered sack_yards_lost sack_fumbles sack_fumbles_lost
passing_air_yards passing_yards_after_catch passing_first_downs passing_epa passing_cpoe
passing_2pt_conversions carries rushing_yards rushing_tds rushing_fumbles rushing_fumbles_lost
rushing_first_downs rushing_epa rushing_2pt_conversions receptions targets receiving_yards
receiving_tds receiving_fumbles receiving_fumbles_lost receiving_air_yards
receiving_yards_after_catch receiving_first_downs receiving_epa receiving_2pt_conversions
special_teams_tds def_tackles_solo def_tackles_with_assist def_tackle_assists def_tackles_for_loss
def_tackles_for_loss_yards def_fumbles_forced def_sacks def_sack_yards def_qb_hits
def_interceptions def_interception_yards def_pass_defended def_tds def_fumbles def_safeties
misc_yards fumble_recovery_own fumble_recovery_yards_own fumble_recovery_opp
fumble_recovery_yards_opp fumble_recovery_tds penalties penalty_yards timeouts punt_returns
punt_return_yards kickoff_returns kickoff_return_yards fg_made fg_att fg_missed fg_blocked fg_long
fg_pct fg_made_0_19 fg_made_20_29 fg_made_30_39 fg_made_40_49 fg_made_50_59 fg_made_60_
fg_missed_0_19 fg_missed_20_29 fg_missed_30_39 fg_missed_40_49 fg_missed_50_59 fg_missed_60_
fg_made_list fg_missed_list fg_blocked_list fg_made_distance fg_missed_distance
fg_blocked_distance pat_made pat_att pat_missed pat_blocked pat_pct gwfg_made gwfg_att gwfg_missed
gwfg_blocked gwfg_distance
""".split()

# The play-by-play source is several hundred columns wide; its own schema decides
# which of them are staged, and only what the stored tables read is required.
COLUMNS = {
    "stg_play_by_play": None,
    "stg_games": GAMES,
    "stg_teams_colors_logos": TEAMS,
    "stg_player_stats": PLAYER_STATS,
    "stg_roster_weekly": ROSTERS,
    "stg_stats_team_week": TEAM_WEEK,
}
RENAMES = {"stg_play_by_play": {"safety": "safety_flag"}}


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = sorted({c.lower() for c in columns} - {c.lower() for c in df.columns})
    if missing:
        raise ValueError(f"{what} is missing expected columns: {', '.join(missing)}")


def stage(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """The staged view ``name`` of a flattened source: lower-case names, renames,
    the published columns only, provenance dropped, NaN as NULL."""
    renames = RENAMES.get(name, {})
    named = df.selectExpr(
        *[
            f"`{c}` AS `{renames.get(c.lower(), c.lower())}`"
            for c in df.columns
            if c.lower() not in PROVENANCE
        ]
    )
    columns = columns or COLUMNS[name]
    if columns is None:
        require_columns(named, play_inputs(), name)
        columns = named.columns
    else:
        require_columns(named, columns, name)
    return nan_to_null(named.select(*columns))


# A quoted name, or an object or unknown type where a type stands: first, after ": " or in an array.
_NAME_OR_TYPE = re.compile(r"`(?:[^`]|``)*`|(?:^|(?<=: )|(?<=ARRAY<))(?:OBJECT<|VOID\b)")
_TYPES = {"OBJECT<": "STRUCT<", "VOID": "STRING"}


def struct_of(variant_schema: str) -> T.StructType:
    """The struct type of a variant's schema text; fields without any value are strings."""
    if not variant_schema.startswith("OBJECT<"):
        raise ValueError(f"records are not objects: {variant_schema}")
    ddl = _NAME_OR_TYPE.sub(lambda m: _TYPES.get(m[0], m[0]), variant_schema)
    return T.DataType.fromDDL(ddl)


def record_schema(raw: DataFrame) -> T.StructType:
    """Field names and types of all records, merged over files whose types drift."""
    return struct_of(raw.agg(F.schema_of_variant_agg("record")).first()[0])


def flatten(
    raw: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None
) -> DataFrame:
    """Raw records as typed columns, provenance kept.

    ``schema`` names the fields as they are spelled in the records. A value
    that does not fit its type becomes NULL.
    """
    renames = {k.lower(): v for k, v in (renames or {}).items()}
    fields = [
        f"try_variant_get(record, '$[\"{f.name}\"]', '{f.dataType.simpleString()}') "
        f"AS `{renames.get(f.name.lower(), f.name.lower())}`"
        for f in schema.fields
    ]
    return raw.selectExpr(*fields, *[c for c in PROVENANCE if c in raw.columns])


def read_columns(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Chosen columns of a stored table under lower-case names."""
    df = spark.table(table)
    require_columns(df, columns, table)
    return df.select(*[F.col(c).alias(c.lower()) for c in columns])


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{what} returned zero rows")
