"""Checks find what they should, and all contracts are declared."""

import fixtures as fx
from gridmart.plans.warehouse import Warehouse
from gridmart.quality import CONTRACTS, duplicate_keys, failed, orphans, run_checks


def test_number_of_contracts():
    def total(attribute):
        return sum(len(getattr(c, attribute)) for c in CONTRACTS.values())

    assert total("not_null") == 43
    assert total("unique") == 6
    assert total("relationships") == 27
    assert total("accepted") == 4
    assert sum(bool(c.grain) for c in CONTRACTS.values()) == 9
    assert sum(bool(c.parent) for c in CONTRACTS.values()) == 4
    assert total("rules") == 5


def test_unique_ignores_null_and_reports_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "k int")
    assert [tuple(r) for r in duplicate_keys(df, ["k"], ignore_null=True).collect()] == [(1, 3)]
    assert duplicate_keys(df, ["k"]).count() == 2


def test_orphans_pass_null_and_count_rows(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert [tuple(r) for r in orphans(child, parent, {"c": "p"}).collect()] == [(9, 2)]


def test_violations_of_a_small_warehouse(spark, tmp_path):
    plays = [
        fx.play("g1", 1, rush_attempt=1, rusher_player_id="p1"),
        fx.play("g1", 1, rush_attempt=1, posteam="ZZ"),
        fx.play("g9", 2, play_type="pass", pass_attempt=1),
    ]
    warehouse = Warehouse(
        {
            **fx.seeds(spark),
            "stg_play_by_play": fx.rows(spark, "stg_play_by_play", plays),
            "stg_games": fx.rows(spark, "stg_games", [fx.game("g1", game_type="REG")]),
            "stg_roster_weekly": fx.rows(spark, "stg_roster_weekly", [fx.roster("p1", 1, "AA")]),
        },
        str(tmp_path),
    )
    models = ["dim_game", "fct_play", "fct_play_rush", "fct_drive", "dim_player", "fct_player_game"]
    found = {
        (r["model"], r["check_name"]): r["violations"]
        for r in failed(run_checks(warehouse.table, models)).collect()
    }
    assert found == {
        ("dim_game", "not_null:gameday"): 1,
        ("fct_play", "rule:real_plays_have_franchise_ids"): 1,
        ("fct_play", "unique:game_id+play_id"): 1,
        ("fct_play", "relationships:game_id"): 1,
        ("fct_play_rush", "unique:game_id+play_id"): 1,
        ("fct_drive", "relationships:game_id"): 1,
    }


def test_incremental_contracts_equal_a_full_run(spark, tmp_path):
    """All 98 results, after parts were added, changed and removed; unchanged parts are not read."""
    from pyspark.sql import functions as F

    from gridmart.quality.incremental import IncrementalChecks

    def season(year, n, **more):
        return [
            fx.play(f"g{year}", i % (n - 1), season=year, rush_attempt=i % 2, pass_attempt=i % 3 == 0, penalty=i % 4 == 0,
                    rusher_player_id="p1" if i % 2 else "p9", posteam="ZZ" if i == 3 else "AA", **more)
            for i in range(n)
        ]

    states, read = IncrementalChecks(spark, str(tmp_path / "states")), []

    def compare(years, at, full=True):
        warehouse = Warehouse(
            {
                **fx.seeds(spark),
                "stg_play_by_play": fx.rows(spark, "stg_play_by_play", [p for rows in years.values() for p in rows]),
                "stg_games": fx.rows(spark, "stg_games", [fx.game(f"g{y}", season=y, game_type="REG") for y in (2020, 2022)]),
                "stg_roster_weekly": fx.rows(spark, "stg_roster_weekly", [fx.roster("p1", 1, "AA")]),
            },
            str(tmp_path / f"build-{at}"),
        )
        read.clear()
        for model in CONTRACTS:
            table = warehouse.table(model)
            by_season = "season" in table.columns and model != "dim_game"
            part = F.concat(F.lit("s"), F.coalesce("season", F.lit(0)).cast("string")) if by_season else F.lit("all")
            parted = table.withColumn("source_file", part)
            prints = {f"s{y}": str(rows) for y, rows in years.items()} if by_season else {"all": str(years)}

            def load(keys, parted=parted, model=model):
                read.append((model, *keys))
                return parted.filter(F.col("source_file").isin(keys))

            states.update(model, prints, load)
        if not full:
            return
        got = sorted(tuple(r) for r in states.all_results().collect())
        assert any(v for _, _, v in got) and got == sorted(tuple(r) for r in run_checks(warehouse.table).collect()) and len(got) == 98

    compare({2020: season(2020, 6), 2021: season(2021, 8)}, 1, full=False)
    years = {2020: season(2020, 6), 2021: season(2021, 5, drive=None), 2022: season(2022, 7)}
    compare(years, 2)
    assert ("fct_play", "s2021", "s2022") in read and not any("s2020" in r for r in read)
    del years[2021]
    compare(years, 3)
    assert not any(r[0] == "fct_play" for r in read)
