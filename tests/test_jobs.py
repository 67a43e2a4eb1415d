"""From landed files to stored tables and checks."""

import json

import pytest

import fixtures as fx
from gridmart.jobs import build, ingest, main
from gridmart.plans.warehouse import TABLES
from gridmart.quality import failed, run_checks
from gridmart.sinks.marts import publish, save_mart
from gridmart.sources.staging import read_columns


def land(df, root, key, renames=None):
    named = df.selectExpr(*[f"`{c}` AS `{(renames or {}).get(c, c)}`" for c in df.columns])
    named.coalesce(1).write.parquet(f"{root}/{key}")


def test_landing_to_checks(spark, tmp_path):
    landing, raw, out = (str(tmp_path / d) for d in ("landing", "raw", "marts"))
    for season in (2020, 2021):
        plays = [
            fx.play(f"g{season}", i, season=season, rush_attempt=1, rusher_player_id="p1")
            for i in range(3)
        ]
        land(
            fx.rows(spark, "stg_play_by_play", plays),
            landing,
            f"pbp/play_by_play_{season}.parquet",
            {"safety_flag": "safety"},
        )
        rosters = [fx.roster("p1", 1, "A1", season=season, full_name=f"name {season}")]
        land(
            fx.rows(spark, "stg_roster_weekly", rosters),
            landing,
            f"weekly_rosters/roster_weekly_{season}.parquet",
        )
    games = [fx.game(f"g{s}", season=s, game_type="REG") for s in (2020, 2021)]
    land(fx.rows(spark, "stg_games", games), landing, "schedules/games.parquet")
    assert ingest(spark, landing, raw, "all", 2020, 2022) == {
        "RAW_PLAY_BY_PLAY": 2,
        "RAW_GAMES": 1,
        "RAW_ROSTER_WEEKLY": 2,
    }
    seeds = {}
    for name, df in fx.seeds(spark).items():
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / name))
        seeds[name] = str(tmp_path / name)
    schemas = {
        n: fx.schema(n) for n in ("stg_play_by_play", "stg_games", "stg_roster_weekly")
    }
    warehouse = build(spark, raw, out, schemas, seeds=seeds)
    assert all((tmp_path / "marts" / name).exists() for name in TABLES)
    assert warehouse.fct_play.count() == 6
    assert warehouse.fct_play_rush.count() == 6
    assert warehouse.dim_player.first()["full_name"] == "name 2021"
    assert warehouse.fct_game.first()["play_count"] == 3
    broken = {
        (r["model"], r["check_name"]) for r in failed(run_checks(warehouse.table)).collect()
    }
    assert broken == {("dim_game", "not_null:gameday")}


def test_command_line_on_files_with_other_names(spark, tmp_path, capsys):
    """Upstream names, renamed from a JSON file; a violated contract ends the job before training."""
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    other = {
        "stg_play_by_play": {"safety_flag": "safety", "play_desc": "desc", "nfl_week": "week"},
        "stg_games": {"game_result": "result"},
    }
    plays = [fx.play("g1", i, season=2021, rush_attempt=1, rusher_player_id="p1") for i in range(3)]
    land(
        fx.rows(spark, "stg_play_by_play", plays),
        landing,
        "pbp/play_by_play_2021.parquet",
        other["stg_play_by_play"],
    )
    games = fx.rows(spark, "stg_games", [fx.game("g1", season=2021, game_type="REG")])
    land(games, landing, "schedules/games.parquet", other["stg_games"])
    rosters = fx.rows(spark, "stg_roster_weekly", [fx.roster("p1", 1, "A1", season=2021)])
    land(rosters, landing, "weekly_rosters/roster_weekly_2021.parquet")
    seeds = {}
    for name, df in fx.seeds(spark).items():
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / name))
        seeds[name] = str(tmp_path / name)
    renames = {
        table: {there: here for here, there in names.items() if here != "safety_flag"}
        for table, names in other.items()
    }
    (tmp_path / "renames.json").write_text(json.dumps(renames))
    (tmp_path / "seeds.json").write_text(json.dumps(seeds))
    files = ["--renames", str(tmp_path / "renames.json"), "--seeds", str(tmp_path / "seeds.json")]
    years = ["--start-year", "2021", "--end-year", "2021"]
    with pytest.raises(SystemExit, match="1 checks failed"):
        main(["--landing", landing, "--out", out, *years, *files, "--build", "--train"], spark)
    said = capsys.readouterr().out
    assert "violated: dim_game not_null:gameday 1" in said and "written:" not in said
    assert spark.read.parquet(f"{out}/marts/fct_play").count() == 3
    assert spark.read.parquet(f"{out}/marts/stg_games").count() == 1


def test_listed_failures_stop_the_load(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark.range(1), landing, "schedules/games.parquet")
    (tmp_path / "failures.txt").write_text("schedules/games.parquet\n")
    with pytest.raises(RuntimeError, match="1 file"):
        main(
            ["--landing", landing, "--out", str(tmp_path / "out"), "--table", "schedules",
             "--failures", str(tmp_path / "failures.txt")],
            spark,
        )


def test_named_tables_show_the_last_complete_build(spark, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    rows = spark.range(6).selectExpr("id", "id % 2 AS season")
    save_mart(rows, f"{first}/fct")
    save_mart(rows.limit(1).select("id"), f"{first}/dim")
    publish(spark, first, ["fct", "dim"], "published")
    assert spark.table("published.fct").filter("season = 1").count() == 3
    assert read_columns(spark, "published.dim", ["ID"]).columns == ["id"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish(spark, second, ["fct", "dim"], "published")
    assert spark.table("published.fct").count() == 6
    save_mart(rows.filter("id > 3"), f"{second}/fct")
    publish(spark, second, ["fct"], "published")
    assert spark.table("published.fct").count() == 2 and spark.table("published.dim").count() == 1
    assert spark.read.parquet(f"{first}/fct").count() == 6
    spark.sql("DROP DATABASE published CASCADE")
