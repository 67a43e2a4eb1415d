"""The registered queries once more, as portable SQL for an independent engine.

Written against the specification in plain relational form (windows, one branch per role,
NOT EXISTS), not derived from the Spark plans it checks.
"""

from __future__ import annotations

import re

from gridmart.adapters.driver_tables import source_ctes
from gridmart.plans import columns as C
from gridmart.quality.contracts import CONTRACTS


def cols(names: list[str], alias: str = "") -> str:
    return ", ".join(f"{alias}.{n}" if alias else n for n in names)


REAL = "play_type IS NOT NULL AND lower(play_type) <> 'no_play'"


def _none(*flags: str) -> str:
    return " AND ".join(f"coalesce({f}, 0) = 0" for f in flags)


def _any(*flags: str) -> str:
    return "(" + " OR ".join(f"coalesce({f}, 0) = 1" for f in flags) + ")"


SUBFACT_WHERE = {
    "fct_play_pass": f"{REAL} AND {_none('two_point_attempt', 'qb_spike', 'qb_kneel')} AND "
    + _any("pass_attempt", "sack", "qb_scramble"),
    "fct_play_rush": f"{REAL} AND {_none('two_point_attempt', 'qb_kneel', 'sack')} AND "
    + _any("rush_attempt", "qb_scramble"),
    "fct_play_kick": f"{REAL} AND {_none('two_point_attempt')} AND "
    + _any("punt_attempt", "kickoff_attempt", "field_goal_attempt", "extra_point_attempt"),
    "fct_play_penalty": f"{_none('two_point_attempt')} AND (coalesce(penalty, 0) = 1 OR "
    "coalesce(penalty_team, CAST(penalty_player_id AS STRING), CAST(penalty_yards AS STRING), "
    "penalty_type) IS NOT NULL)",
}


def _subfact(name: str) -> str:
    columns = {
        "fct_play_pass": C.FCT_PLAY_PASS,
        "fct_play_rush": C.FCT_PLAY_RUSH,
        "fct_play_kick": C.FCT_PLAY_KICK,
        "fct_play_penalty": C.FCT_PLAY_PENALTY,
    }[name]
    picked = [f"{c[4:]} AS {c}" if c.startswith("stg_") else c for c in columns]
    return (
        f"SELECT {', '.join(picked)} FROM play_wide "
        f"WHERE drive IS NOT NULL AND {SUBFACT_WHERE[name]}"
    )


ROSTER_TEXT = [c for c in C.DIM_PLAYER if c != "player_id"]
SEASON_TEXT = ["player_position", "jersey_number", "years_exp", "weight"]


def _asc(names: list[str]) -> str:
    return ", ".join(f"{n} ASC NULLS LAST" for n in names)


MODELS = {
    "dim_franchise": f"SELECT {cols(C.DIM_FRANCHISE)} FROM dim_franchise_seed",
    "dim_team_code": """
        SELECT m.source_team_code, m.team_code, d.franchise_id
        FROM map_team_code_seed m, dim_franchise d WHERE d.team_code = m.team_code""",
    "dim_game": f"""
        SELECT {cols([c for c in C.DIM_GAME if c not in (
            'home_franchise_id', 'home_team_code', 'away_franchise_id', 'away_team_code')], 'g')},
          h.franchise_id AS home_franchise_id, h.team_code AS home_team_code,
          a.franchise_id AS away_franchise_id, a.team_code AS away_team_code
        FROM stg_games g
        JOIN dim_team_code h ON g.home_team = h.source_team_code
        JOIN dim_team_code a ON g.away_team = a.source_team_code""",
    "play_wide": """
        SELECT s.*, o.franchise_id AS offense_franchise_id, d.franchise_id AS defense_franchise_id
        FROM stg_play_by_play s
        LEFT JOIN dim_team_code o ON s.posteam = o.source_team_code
        LEFT JOIN dim_team_code d ON s.defteam = d.source_team_code""",
    "fct_play": f"SELECT {cols(C.FCT_PLAY)} FROM play_wide",
    **{name: _subfact(name) for name in SUBFACT_WHERE},
    "fct_drive": """
        SELECT game_id, drive, max(offense_franchise_id) AS offense_franchise_id,
          max(drive_play_count) AS drive_play_count, max(ydsnet) AS yards_gained_sum,
          sum(epa) AS epa_sum, avg(success) AS success_rate,
          max(drive_inside20) AS drive_inside20,
          max(drive_ended_with_score) AS drive_ended_with_score
        FROM play_wide WHERE drive IS NOT NULL AND play_type <> 'no_play'
        GROUP BY game_id, drive""",
    "play_totals": f"""
        SELECT game_id, count(*) AS play_count,
          count(*) FILTER (WHERE lower(play_type) = 'no_play') AS no_play_count,
          count(*) FILTER (WHERE {REAL}) AS real_play_count,
          CASE WHEN count(*) FILTER (WHERE NOT ({REAL})) > 0
            THEN coalesce(sum(epa) FILTER (WHERE {REAL}), 0)
            ELSE sum(epa) FILTER (WHERE {REAL}) END AS epa_sum,
          avg(success) FILTER (WHERE {REAL}) AS success_rate
        FROM fct_play GROUP BY game_id""",
    "fct_game": f"""
        SELECT g.game_id, g.home_franchise_id, g.away_franchise_id,
          {cols(C.SCHEDULE_MEASURES, 's')}, {cols(C.GAME_MEASURES, 't')}
        FROM dim_game g LEFT JOIN stg_games s ON s.game_id = g.game_id
        LEFT JOIN play_totals t ON t.game_id = g.game_id""",
    "role_rows": """
        SELECT game_id, season, nfl_week, offense_franchise_id AS franchise_id, epa,
          CASE WHEN lower(play_type) = 'no_play' THEN 1 ELSE 0 END AS no_play,
          r.role, CASE r.role WHEN 'passer' THEN passer_player_id
            WHEN 'rusher' THEN rusher_player_id ELSE receiver_player_id END AS player_id
        FROM fct_play CROSS JOIN (VALUES ('passer'), ('rusher'), ('receiver')) AS r(role)""",
    "main_team": """
        SELECT game_id, player_id, franchise_id FROM (
          SELECT game_id, player_id, franchise_id, row_number() OVER (
            PARTITION BY game_id, player_id ORDER BY n DESC, franchise_id ASC NULLS LAST) AS place
          FROM (SELECT game_id, player_id, franchise_id, count(*) AS n FROM role_rows
                WHERE player_id IS NOT NULL GROUP BY game_id, player_id, franchise_id) AS c) AS p
        WHERE place = 1""",
    "player_totals": """
        SELECT game_id, player_id, max(season) AS season, max(nfl_week) AS nfl_week,
          count(*) AS play_count, CAST(sum(no_play) AS BIGINT) AS no_play_count,
          count(*) FILTER (WHERE no_play = 0) AS real_play_count,
          count(*) FILTER (WHERE role = 'passer') AS passer_play_count,
          count(*) FILTER (WHERE role = 'rusher') AS rusher_play_count,
          count(*) FILTER (WHERE role = 'receiver') AS receiver_play_count,
          coalesce(sum(epa) FILTER (WHERE no_play = 0), 0) AS epa_sum
        FROM role_rows WHERE player_id IS NOT NULL GROUP BY game_id, player_id""",
    "fct_player_game": """
        SELECT p.game_id, p.player_id, p.season, p.nfl_week, t.franchise_id,
          CASE t.franchise_id WHEN g.home_franchise_id THEN g.away_franchise_id
            WHEN g.away_franchise_id THEN g.home_franchise_id END AS opponent_franchise_id,
          CASE t.franchise_id WHEN g.home_franchise_id THEN 'home'
            WHEN g.away_franchise_id THEN 'away' ELSE 'unknown' END AS game_team_side,
          p.play_count, p.no_play_count, p.real_play_count, p.passer_play_count,
          p.rusher_play_count, p.receiver_play_count, p.epa_sum
        FROM player_totals p JOIN main_team t USING (game_id, player_id)
        LEFT JOIN dim_game g ON g.game_id = p.game_id""",
    "roster_latest": f"""
        SELECT gsis_id AS player_id, {cols(ROSTER_TEXT)} FROM (
          SELECT *, row_number() OVER (PARTITION BY gsis_id
            ORDER BY season DESC NULLS LAST, week DESC NULLS LAST, {_asc(['team', *ROSTER_TEXT])}) AS place
          FROM stg_roster_weekly WHERE gsis_id IS NOT NULL) AS r WHERE place = 1""",
    "play_people": """
        SELECT passer_player_id AS player_id FROM fct_play
        UNION SELECT rusher_player_id FROM fct_play UNION SELECT receiver_player_id FROM fct_play""",
    "dim_player": f"""
        SELECT coalesce(r.player_id, p.player_id) AS player_id, {cols(ROSTER_TEXT, 'r')}
        FROM roster_latest r FULL JOIN (SELECT player_id FROM play_people WHERE player_id IS NOT NULL) p
          ON p.player_id = r.player_id""",
    "roster_mapped": f"""
        SELECT r.gsis_id AS player_id, r.season, r.week, c.franchise_id, {cols(SEASON_TEXT, 'r')}
        FROM stg_roster_weekly r JOIN dim_team_code c ON c.source_team_code = r.team
        WHERE r.gsis_id IS NOT NULL AND r.season IS NOT NULL""",
    "dim_player_season": f"""
        SELECT l.player_id, l.season, t.franchise_id, {cols(SEASON_TEXT, 'l')}
        FROM (SELECT *, row_number() OVER (PARTITION BY player_id, season
                ORDER BY week DESC NULLS LAST, {_asc(['franchise_id', *SEASON_TEXT])}) AS place
              FROM roster_mapped) l
        JOIN (SELECT player_id, season, franchise_id, row_number() OVER (
                PARTITION BY player_id, season ORDER BY count(DISTINCT week) DESC,
                max(week) DESC NULLS LAST, franchise_id ASC NULLS LAST) AS place
              FROM roster_mapped GROUP BY player_id, season, franchise_id) t
          ON t.player_id = l.player_id AND t.season = l.season
        WHERE l.place = 1 AND t.place = 1""",
    "ml_play_success_features": f"""
        SELECT {', '.join(
            'g.' + c if c in ('roof', 'surface', 'temperature', 'wind')
            else {
                'offense_home_away': "CASE p.posteam WHEN p.home_team THEN 'home' "
                "WHEN p.away_team THEN 'away' ELSE 'unknown' END AS offense_home_away",
                'is_successful_play': "CAST(coalesce(p.touchdown, 0) = 1 OR p.yards_gained >= "
                "p.ydstogo * CASE p.down WHEN 1 THEN 0.4 WHEN 2 THEN 0.6 ELSE 1 END AS INT) "
                "AS is_successful_play",
            }.get(c, 'p.' + c) for c in C.FEATURES)}
        FROM play_wide p JOIN dim_game g ON g.game_id = p.game_id
        WHERE p.down IN (1, 2, 3, 4) AND p.ydstogo + p.yardline_100 + p.yards_gained + p.drive IS NOT NULL
          AND lower(p.play_type) IN ('pass', 'run') AND {_none(
            'p.two_point_attempt', 'p.qb_kneel', 'p.qb_spike', 'p.penalty', 'p.aborted_play')}""",
}

ALL = {**source_ctes(), **MODELS}


def with_tables(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` preceded by the definitions it needs."""
    known = {**ALL, **(extra or {})}
    order: list[str] = []

    def need(sql: str, own: str = "") -> None:
        for name in dict.fromkeys(re.findall(r"\w+", sql)):
            if name in known and name != own and name not in order:
                need(known[name], name)
                order.append(name)

    need(select)
    if not order:
        return select
    return "WITH " + ", ".join(f"{n} AS ({known[n]})" for n in order) + " " + select


def model(name: str, columns: list[str], rounded: dict[str, int] | None = None) -> str:
    rounded = rounded or {}
    picked = [f"round({c}, {rounded[c]}) AS {c}" if c in rounded else c for c in columns]
    return with_tables(f"SELECT {', '.join(picked)} FROM {name}")


def _count(check: str, table: str, value: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS model, "
        f"CAST(coalesce({value}, 0) AS BIGINT) AS violations"
    )


RULES = {
    "real_plays_have_franchise_ids": f"{REAL} AND (offense_franchise_id IS NULL OR "
    "defense_franchise_id IS NULL)",
}


def contract(table: str) -> str:
    """Violation counts of every check of a table. Filter rules are the negated selection."""
    spec = CONTRACTS[table]
    parts = []
    for c in spec.not_null:
        parts.append(
            _count(f"not_null:{c}", table, "count(*)") + f" FROM {table} WHERE {c} IS NULL"
        )
    for c, values in spec.accepted.items():
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        parts.append(
            _count(f"accepted_values:{c}", table, "count(*)")
            + f" FROM {table} WHERE {c} NOT IN ({listed})"
        )
    for name in spec.rules:
        where = RULES.get(name) or f"drive IS NULL OR NOT ({SUBFACT_WHERE[table]})"
        parts.append(_count(f"rule:{name}", table, "count(*)") + f" FROM {table} WHERE {where}")
    for keys in [[c] for c in spec.unique] + ([spec.grain] if spec.grain else []):
        key = ", ".join(keys)
        found = " AND ".join(f"{c} IS NOT NULL" for c in keys) if len(keys) == 1 else "1 = 1"
        parts.append(
            _count("unique:" + "+".join(keys), table, "count(*)")
            + f" FROM (SELECT {key} FROM {table} WHERE {found} GROUP BY {key} HAVING count(*) > 1) AS d"
        )
    for c, parent, field in spec.relationships:
        parts.append(
            _count(f"relationships:{c}", table, "count(*)")
            + f" FROM {table} t WHERE t.{c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{field} = t.{c})"
        )
    if spec.parent:
        on = " AND ".join(f"p.{c} = t.{c}" for c in spec.grain)
        parts.append(
            _count(f"parent:{spec.parent}", table, "count(*)")
            + f" FROM {table} t WHERE NOT EXISTS (SELECT 1 FROM {spec.parent} p WHERE {on})"
        )
    return with_tables(" UNION ALL ".join(parts))
