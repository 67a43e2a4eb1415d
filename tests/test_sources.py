"""Manifest, landing outcome, provenance, idempotent reload, staging."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fixtures as fx
from gridmart.sinks import load_landed
from gridmart.sinks.raw import merged_schema, read_raw, replace_by_source_file
from gridmart.sources import (
    build_manifest,
    flatten,
    landing_status,
    list_landed,
    read_columns,
    read_seed,
    record_schema,
    require_no_failures,
    scan_with_provenance,
    stage,
    year_range,
)
from gridmart.sources.staging import COLUMNS, struct_of


def manifest(spark, table, years):
    frame = spark.createDataFrame([(y,) for y in years], "year int")
    return build_manifest(frame, table).collect()


def test_all_datasets_over_two_years(spark):
    files = manifest(spark, "all", [2024, 2025])
    assert len(files) == 10
    assert len({f["dataset"] for f in files}) == 6


def test_prefix_can_differ_from_release(spark):
    (f,) = manifest(spark, "stats_team", [2024])
    assert f["source_key"] == "stats_teams/stats_team_week_2024.parquet"
    assert f["source_path"] == "stats_team/stats_team_week_2024.parquet"
    assert (f["release"], f["raw_table"]) == ("stats_team", "RAW_STATS_TEAM_WEEK")


def test_single_file_dataset_has_no_year(spark):
    (f,) = manifest(spark, "teams", [2024])
    assert f["year"] is None and f["source_key"] == "teams/teams_colors_logos.parquet"


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        manifest(spark, "nope", [2024])


def test_year_range(spark):
    assert [r["year"] for r in year_range(spark, 2022, 2024).collect()] == [2022, 2023, 2024]
    assert year_range(spark).agg(F.min("year")).first()[0] == 2000
    with pytest.raises(ValueError):
        year_range(spark, 2025, 2024)


def land(spark, root, key, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(f"{root}/{key}")


@pytest.fixture
def landed(spark, tmp_path):
    root = str(tmp_path / "landing")
    # The type of "wind" drifts between the years.
    land(spark, root, "pbp/play_by_play_2023.parquet", [(1, 3), (2, 4)], "PLAY_ID long, wind int")
    land(spark, root, "pbp/play_by_play_2024.parquet", [(3, 5.5)], "PLAY_ID long, wind double")
    land(spark, root, "teams/teams_colors_logos.parquet", [("AA",)], "team_abbr string")
    return root


def status_of(spark, root, failures=None):
    files = build_manifest(year_range(spark, 2023, 2025))
    wanted = files.filter(F.col("dataset").isin("pbp", "teams"))
    return landing_status(wanted, list_landed(spark, root), failures)


def test_landing_status(spark, landed):
    status = {r["source_key"]: r["status"] for r in status_of(spark, landed).collect()}
    assert status == {
        "pbp/play_by_play_2023.parquet": "uploaded",
        "pbp/play_by_play_2024.parquet": "uploaded",
        "pbp/play_by_play_2025.parquet": "missing",
        "teams/teams_colors_logos.parquet": "uploaded",
    }
    counts = require_no_failures(status_of(spark, landed))
    assert counts == {"uploaded": 3, "missing": 1, "failed": 0}


def test_a_failure_stops_the_load(spark, landed):
    bad = spark.createDataFrame([("pbp/play_by_play_2024.parquet",)], "source_key string")
    status = status_of(spark, landed, bad)
    assert {r["status"] for r in status.filter("year = 2024").collect()} == {"failed"}
    with pytest.raises(RuntimeError, match="1 file"):
        require_no_failures(status)


def raw_rows(spark, path):
    schema = spark.createDataFrame([], "PLAY_ID long, wind double").schema
    frame = flatten(read_raw(spark, path), schema)
    return sorted(
        (r["play_id"], r["wind"], r["source_file"], r["source_year"]) for r in frame.collect()
    )


def test_load_and_reload(spark, landed, tmp_path):
    out = str(tmp_path / "raw")
    assert load_landed(spark, status_of(spark, landed), landed, out) == {
        "RAW_PLAY_BY_PLAY": 2,
        "RAW_TEAMS_COLORS_LOGOS": 1,
    }
    path = f"{out}/RAW_PLAY_BY_PLAY"
    one, two = "pbp/play_by_play_2023.parquet", "pbp/play_by_play_2024.parquet"
    first = [(1, 3.0, one, 2023), (2, 4.0, one, 2023), (3, 5.5, two, 2024)]
    assert raw_rows(spark, path) == first
    load_landed(spark, status_of(spark, landed), landed, out)
    assert raw_rows(spark, path) == first

    def reload_2024():
        entries = status_of(spark, landed).filter("year = 2024").collect()
        replace_by_source_file(scan_with_provenance(spark, landed, entries), path, [two])

    land(spark, landed, two, [(8, 1.0), (9, None)], "PLAY_ID long, wind double")
    reload_2024()
    assert raw_rows(spark, path) == [*first[:2], (8, 1.0, two, 2024), (9, None, two, 2024)]
    land(spark, landed, two, [], "PLAY_ID long, wind double")
    reload_2024()
    assert raw_rows(spark, path) == first[:2]
    teams = read_raw(spark, f"{out}/RAW_TEAMS_COLORS_LOGOS").first()
    assert teams["source_year"] is None and teams["source_dataset"] == "teams"


def test_nothing_uploaded_loads_nothing(spark, tmp_path):
    empty = build_manifest(year_range(spark, 2023, 2023)).withColumn(
        "status", F.lit("missing")
    )
    assert load_landed(spark, empty, str(tmp_path), str(tmp_path / "raw")) == {}


def test_schema_of_drifting_records(spark, landed, tmp_path):
    entries = status_of(spark, landed).filter("dataset = 'pbp' AND status = 'uploaded'").collect()
    raw = scan_with_provenance(spark, landed, entries)
    types = {f.name: f.dataType.simpleString() for f in record_schema(raw)}
    assert types == {"PLAY_ID": "bigint", "wind": "double"}


@pytest.mark.parametrize(
    "source, width",
    [
        ("stg_play_by_play", 372),
        ("stg_games", 46),
        ("stg_teams_colors_logos", 16),
        ("stg_player_stats", 114),
        ("stg_roster_weekly", 36),
        ("stg_stats_team_week", 102),
    ],
)
def test_staged_columns(spark, source, width):
    names = fx.schema(source).names
    raw_names = ["SAFETY" if n == "safety_flag" else n.upper() for n in names]
    types = [f.dataType.simpleString() for f in fx.schema(source)]
    ddl = ", ".join(f"`{n}` {t}" for n, t in zip(raw_names, types))
    raw = spark.createDataFrame([], ddl + ", source_file string, loaded_at timestamp")
    staged = stage(raw, source)
    assert len(staged.columns) == width and set(staged.columns) == set(names)
    if COLUMNS[source]:
        assert staged.columns == COLUMNS[source]


def test_stage_reports_missing_columns_and_drops_nan(spark):
    with pytest.raises(ValueError, match="missing expected columns: conference, team_abbr"):
        from gridmart.sources.staging import require_columns

        require_columns(
            spark.createDataFrame([], "x int"), ["team_abbr", "conference"], "teams"
        )
    frame = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    from gridmart.functions import nan_to_null

    assert [r[0] for r in nan_to_null(frame).collect()] == [1.0, None, None]


def test_seeds(spark, tmp_path):
    codes = read_seed(spark, "map_team_code_seed")
    franchises = read_seed(spark, "dim_franchise_seed")
    assert (codes.count(), franchises.count()) == (43, 32)
    assert codes.join(franchises, "team_code").count() == 43
    assert codes.filter("team_code = 'LAR'").count() == 4
    franchises.coalesce(1).write.option("header", True).csv(str(tmp_path / "seed"))
    assert read_seed(spark, "dim_franchise_seed", str(tmp_path / "seed")).count() == 32


def test_read_columns(spark):
    spark.createDataFrame([(1, "a")], "Game_Id int, Other string").write.mode(
        "overwrite"
    ).saveAsTable("some_table")
    assert read_columns(spark, "some_table", ["GAME_ID"]).columns == ["game_id"]
    with pytest.raises(ValueError):
        read_columns(spark, "some_table", ["absent"])


@pytest.mark.parametrize("name", ["v1+2", "a(b", "x.y$z"])
def test_listing_takes_the_root_literally(spark, tmp_path, name):
    root = tmp_path / name
    spark.range(3).write.parquet(str(root / "schedules" / "games.parquet"))
    assert [r["source_key"] for r in list_landed(spark, str(root)).collect()] == ["schedules/games.parquet"]


def test_type_words_inside_field_names_stay(spark):
    text = "OBJECT<AVOIDED_TACKLES: BIGINT, VOID: VOID, `a: VOID`: ARRAY<VOID>, o: OBJECT<OBJECT: VOID>>"
    schema = struct_of(text)
    assert schema.names == ["AVOIDED_TACKLES", "VOID", "a: VOID", "o"]
    assert [f.dataType.simpleString() for f in schema] == [
        "bigint", "string", "array<string>", "struct<OBJECT:string>"
    ]
    raw = spark.sql("SELECT parse_json('{\"AVOIDED_TACKLES\": 3, \"x\": null}') AS record")
    row = flatten(raw, record_schema(raw)).first()
    assert (row["avoided_tackles"], row["x"]) == (3, None)


def test_schemas_of_loads_are_merged(spark):
    one = T.StructType.fromDDL("a int, b int, c string")
    two = T.StructType.fromDDL("a bigint, b double, c int, d date")
    assert merged_schema(one, two).simpleString() == "struct<a:bigint,b:double,c:string,d:date>"


def test_team_week_in_source_order():
    assert COLUMNS["stg_stats_team_week"][:5] == ["season", "week", "team", "season_type", "opponent_team"]
    assert len(COLUMNS["stg_stats_team_week"]) == 102
