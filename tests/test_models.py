"""Edge cases of the star schema with exact expected rows."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from gridmart.operators import primary_by_count
from gridmart.plans import columns as C
from gridmart.plans import plays as P
from gridmart.plans.warehouse import TABLES, Warehouse
from gridmart.sinks.marts import save_mart

PLAYS = [
    fx.play("g1", 1, play_type=None, passer_player_id="p1"),
    fx.play("g1", 2, play_type="no_play", penalty_team="AA", rusher_player_id="p2"),
    fx.play("g1", 3, play_type="NO_PLAY", rusher_player_id="p2", epa=9),
    fx.play("g1", 4, posteam="ZZ", rush_attempt=1, rusher_player_id="p3"),
    fx.play("g1", 5, posteam=None, rush_attempt=1, rusher_player_id="p3"),
    fx.play("g1", 6, posteam="B1", defteam="A1", rush_attempt=1, rusher_player_id="p3"),
    fx.play("g1", 7, qb_scramble=1, sack=0, rush_attempt=1, epa=None),
    fx.play("g1", 8, play_type="pass", sack=1),
    fx.play("g1", 9, play_type="pass", pass_attempt=1, two_point_attempt=1, penalty=1),
    fx.play("g1", 10, play_type="pass", pass_attempt=1, qb_spike=1),
    fx.play("g1", 11, rush_attempt=1, qb_kneel=1),
    fx.play("g1", 12, play_type="pass", pass_attempt=1, drive=None, penalty=1),
    fx.play("g1", 13, play_type="pass", pass_attempt=1, passer_player_id="p1", receiver_player_id="p1"),
    fx.play("g1", 14, play_type="punt", punt_attempt=1, ydsnet=40, drive=2),
    fx.play("g1", 15, play_type="kickoff", kickoff_attempt=1, ydsnet=5, drive=2, epa=None),
    fx.play("g1", 16, play_type="run", ydsnet=12, drive=2, epa=None),
    fx.play("g2", 1, home_team="ZZ", rush_attempt=1, rusher_player_id="p4"),
    fx.play("g3", 1, epa=None, rusher_player_id="p5", drive=7),
    fx.play("g3", 2, epa=None, rusher_player_id="p5", drive=7),
    fx.play("g4", 1, posteam="BB", rusher_player_id="p6"),
    fx.play("g4", 2, posteam="AA", rusher_player_id="p6"),
]
GAMES = [fx.game("g1"), fx.game("g2", home_team="ZZ"), fx.game("g3"), fx.game("g4"), fx.game("g5")]
ROSTERS = [
    fx.roster(None, 1, "AA"),
    fx.roster("p1", 1, "AA", player_position="QB", full_name="old"),
    fx.roster("p1", 2, "A1", player_position="QB"),
    fx.roster("p1", 3, "AA", player_position="QB"),
    fx.roster("p1", 4, "BB", player_position="WR"),
    fx.roster("p1", 5, "BB", player_position="TE", full_name="new"),
    fx.roster("p2", 3, "BB", jersey_number=7, full_name="bravo"),
    fx.roster("p2", 3, "AA", jersey_number=9, full_name="alpha"),
    fx.roster("p7", None, "CC", full_name="no week"),
    fx.roster("p7", 1, "CC", full_name="week one"),
    fx.roster("p8", 1, "ZZ"),
]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    frames = {
        **fx.seeds(spark),
        "stg_play_by_play": fx.rows(spark, "stg_play_by_play", PLAYS),
        "stg_games": fx.rows(spark, "stg_games", GAMES),
        "stg_roster_weekly": fx.rows(spark, "stg_roster_weekly", ROSTERS),
    }
    return {name: save_mart(df, f"{folder}/{name}", None) for name, df in frames.items()}


@pytest.fixture(scope="module")
def warehouse(sources, tmp_path_factory):
    """All tables, each stored on first use."""
    return Warehouse(sources, str(tmp_path_factory.mktemp("marts")))


def keys(df):
    return sorted((r["game_id"], r["play_id"]) for r in df.select("game_id", "play_id").collect())


def one(df, **where):
    for name, value in where.items():
        df = df.filter(F.col(name) == value)
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict()


def g1(*ids):
    return [("g1", i) for i in ids]


def test_every_table_has_its_columns(warehouse):
    expected = {
        "dim_game": C.DIM_GAME,
        "dim_player": C.DIM_PLAYER,
        "dim_player_season": C.DIM_PLAYER_SEASON,
        "fct_play": C.FCT_PLAY,
        "fct_play_pass": C.FCT_PLAY_PASS,
        "fct_play_rush": C.FCT_PLAY_RUSH,
        "fct_play_kick": C.FCT_PLAY_KICK,
        "fct_play_penalty": C.FCT_PLAY_PENALTY,
        "fct_drive": C.FCT_DRIVE,
        "fct_game": C.FCT_GAME,
        "fct_player_game": C.FCT_PLAYER_GAME,
        "dim_date": C.DIM_DATE,
        "ml_play_success_features": C.FEATURES,
    }
    for name, columns in expected.items():
        assert warehouse.table(name).columns == columns, name


def test_codes_join_franchises(warehouse):
    assert warehouse.dim_team_code.count() == 6
    assert one(warehouse.dim_team_code, source_team_code="B1")["franchise_id"] == "bravos"


def test_unknown_code_keeps_play_and_drops_game(warehouse):
    assert warehouse.fct_play.count() == len(PLAYS)
    for play_id in (4, 5):
        row = one(warehouse.fct_play, game_id="g1", play_id=play_id)
        assert row["offense_franchise_id"] is None and row["defense_franchise_id"] == "bravos"
    row = one(warehouse.fct_play, game_id="g1", play_id=6)
    assert (row["offense_franchise_id"], row["defense_franchise_id"]) == ("bravos", "alphas")
    assert sorted(r[0] for r in warehouse.dim_game.select("game_id").collect()) == [
        "g1",
        "g3",
        "g4",
        "g5",
    ]


def test_subfacts(warehouse):
    assert keys(warehouse.fct_play_pass) == g1(7, 8, 13)
    assert keys(warehouse.fct_play_rush) == g1(4, 5, 6, 7) + [("g2", 1)]
    assert keys(warehouse.fct_play_kick) == g1(14, 15)
    assert keys(warehouse.fct_play_penalty) == g1(2)


def test_drive(warehouse):
    row = one(warehouse.fct_drive, game_id="g1", drive=2)
    assert (row["yards_gained_sum"], row["epa_sum"]) == (40, 0.5)
    assert one(warehouse.fct_drive, game_id="g3", drive=7)["epa_sum"] is None
    first = one(warehouse.fct_drive, game_id="g1", drive=1)
    # Plays 3 to 11 and 13; the lower-case no-play and the play without a type are out.
    assert first["epa_sum"] == pytest.approx(9 + 0.5 * 8)
    assert first["offense_franchise_id"] == "bravos"


def test_game(warehouse):
    row = one(warehouse.fct_game, game_id="g1")
    assert (row["play_count"], row["no_play_count"], row["real_play_count"]) == (16, 2, 13)
    assert row["epa_sum"] == pytest.approx(0.5 * 10)
    assert one(warehouse.fct_game, game_id="g3")["epa_sum"] is None
    empty = one(warehouse.fct_game, game_id="g5")
    assert empty["play_count"] is None and empty["home_franchise_id"] == "alphas"
    assert warehouse.fct_game.filter("game_id = 'g2'").count() == 0


def test_player_game(warehouse):
    table = warehouse.fct_player_game
    p1 = one(table, game_id="g1", player_id="p1")
    # The play without a type counts as real; one play counts for both roles.
    assert (p1["play_count"], p1["real_play_count"], p1["no_play_count"]) == (3, 3, 0)
    assert (p1["passer_play_count"], p1["receiver_play_count"], p1["epa_sum"]) == (2, 1, 1.5)
    assert (p1["game_team_side"], p1["opponent_franchise_id"]) == ("home", "bravos")
    p2 = one(table, game_id="g1", player_id="p2")
    assert (p2["no_play_count"], p2["real_play_count"], p2["epa_sum"]) == (2, 0, 0)
    # Two role rows without a franchise outnumber the one with it.
    p3 = one(table, game_id="g1", player_id="p3")
    assert p3["franchise_id"] is None and p3["game_team_side"] == "unknown"
    p4 = one(table, game_id="g2", player_id="p4")
    assert (p4["franchise_id"], p4["game_team_side"]) == ("alphas", "unknown")
    assert p4["opponent_franchise_id"] is None
    assert one(table, game_id="g3", player_id="p5")["epa_sum"] == 0
    assert one(table, game_id="g4", player_id="p6")["franchise_id"] == "alphas"


def test_players(warehouse):
    table = warehouse.dim_player
    assert sorted(r[0] for r in table.select("player_id").collect()) == [
        f"p{i}" for i in range(1, 9)
    ]
    assert one(table, player_id="p1")["full_name"] == "new"
    assert one(table, player_id="p2")["full_name"] == "alpha"
    assert one(table, player_id="p7")["full_name"] == "week one"
    stub = one(table, player_id="p6")
    assert all(v is None for c, v in stub.items() if c != "player_id")


def test_player_season(warehouse):
    table = warehouse.dim_player_season
    p1 = one(table, player_id="p1")
    assert (p1["franchise_id"], p1["player_position"]) == ("alphas", "TE")
    p2 = one(table, player_id="p2")
    assert (p2["franchise_id"], p2["jersey_number"]) == ("alphas", 9)
    assert one(table, player_id="p7")["franchise_id"] == "charlies"
    assert table.count() == 3


def test_calendar(warehouse):
    days = warehouse.dim_date
    assert days.count() == 13514
    for date, quarter, weekday in [
        ("1999-01-01", 1, 5),
        ("2024-02-29", 1, 4),
        ("2024-12-31", 4, 2),
        ("2035-12-31", 4, 1),
    ]:
        row = one(days, date=dt.date.fromisoformat(date))
        assert (row["quarter"], row["day_of_week_num"]) == (quarter, weekday)
        assert row["date_key"] == int(date.replace("-", ""))
    leap = one(days, date=dt.date(2024, 2, 29))
    assert (leap["month_name"], leap["day_of_week_name"], leap["week_of_year"]) == (
        "February",
        "Thursday",
        9,
    )


SUCCESS = [
    (dict(down=1, yards_gained=4), 1),
    (dict(down=1, yards_gained=3), 0),
    (dict(down=2, yards_gained=6), 1),
    (dict(down=3, yards_gained=9), 0),
    (dict(down=4, yards_gained=10), 1),
    (dict(touchdown=1, yards_gained=0), 1),
    (dict(down=5), None),
    (dict(down=None), None),
    (dict(penalty=1), None),
    (dict(aborted_play=1), None),
    (dict(ydstogo=None), None),
    (dict(play_type="PASS", posteam="BB"), 1),
    (dict(play_type="punt"), None),
    (dict(qb_spike=1), None),
    (dict(posteam="ZZ"), 1),
]


def test_features(spark, warehouse):
    plays = [fx.play("g1", i, **values) for i, (values, _) in enumerate(SUCCESS)]
    plays.append(fx.play("g2", 99))
    table = Warehouse(
        {**warehouse.sources, "stg_play_by_play": fx.rows(spark, "stg_play_by_play", plays)}
    ).ml_play_success_features
    got = {r["play_id"]: r for r in table.collect()}
    wanted = {i: label for i, (_, label) in enumerate(SUCCESS) if label is not None}
    assert {i: r["is_successful_play"] for i, r in got.items()} == {
        i: (1 if i in (11, 14) else label) for i, label in wanted.items()
    }
    assert got[11]["offense_home_away"] == "away" and got[14]["offense_home_away"] == "unknown"
    leaks = {"play_type", "yards_gained", "touchdown", "success", "epa", "play_desc"}
    assert not leaks & set(table.columns)


def test_self_join_is_identity_on_unique_keys_only(spark, warehouse):
    pbp, codes = warehouse.sources["stg_play_by_play"], warehouse.dim_team_code
    for name in P.SUBFACTS:
        joined = P.subfact(P.play_base(pbp, codes, self_join=True), name)
        assert sorted(map(str, joined.collect())) == sorted(
            map(str, warehouse.table(name).collect())
        )
    twice = pbp.unionByName(pbp.filter("game_id = 'g1' AND play_id = 14"))
    assert P.subfact(P.play_base(twice, codes), "fct_play_kick").count() == 3
    assert P.subfact(P.play_base(twice, codes, self_join=True), "fct_play_kick").count() == 5


def test_stored_tables_equal_lazy_ones(warehouse):
    lazy = Warehouse(warehouse.sources)
    for name in TABLES:
        assert warehouse.table(name).columns == lazy.table(name).columns
    for name in ("fct_game", "fct_player_game", "ml_play_success_features"):
        assert sorted(map(str, warehouse.table(name).collect())) == sorted(
            map(str, lazy.table(name).collect())
        )
    assert any(Path(warehouse.out, "fct_play").glob("season=2020"))


def test_primary_ties_fall_to_later_dates(spark):
    rows = [
        ("k", "a", "2020-01-01"),
        ("k", "b", "2020-03-01"),
        ("k", "c", None),
        ("m", "y", "2020-01-02"),
        ("m", "x", "2020-01-02"),
    ]
    df = spark.createDataFrame(rows, "k string, c string, day string")
    for kind in ("date", "timestamp"):
        days = df.withColumn("day", F.col("day").cast(kind))
        got = primary_by_count(days, ["k"], "c", then_desc={"last": F.max("day")}).collect()
        assert {r["k"]: r["c"] for r in got} == {"k": "b", "m": "x"}
    with pytest.raises(TypeError, match="last"):
        primary_by_count(df, ["k"], "c", then_desc={"last": F.max("day")})
