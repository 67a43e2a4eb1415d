"""Physical plans keep the shapes that make them scale."""

import re

import pytest

from checks.queries import QUERIES
from gridmart.adapters import driver_tables as adapter
from gridmart.ml.metrics import roc_auc
from gridmart.operators import latest_per_key, normalize_codes
from gridmart.operators.codes import small_side
from gridmart.plans.warehouse import Warehouse
from gridmart.session import tune

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(adapter.sources(tune(spark), SF))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["fct_play", "fct_play_pass", "fct_play_rush", "fct_play_kick", "fct_play_penalty"]
)
def test_play_facts_move_no_play(warehouse, name):
    text = plan(warehouse.table(name))
    assert text.count("lineitem.parquet") == 1
    assert "SortMergeJoin" not in text
    # The only exchange groups the franchise seed of the test adapter.
    moved = re.findall(r"(?<!Broadcast)Exchange (\w+\(?\w*)", text)
    assert all(m.startswith("hashpartitioning(franchise_id") for m in moved), moved


def test_no_query_deals_rows_round_robin(spark):
    for name in ("dim_player", "fct_player_game", "check_fct_play"):
        assert "RoundRobin" not in plan(QUERIES[name](spark, SF)), name


def test_codes_join_the_same_rows_beyond_the_broadcast_bound(warehouse):
    plays, codes = warehouse.sources["stg_play_by_play"], warehouse.dim_team_code
    columns = ["game_id", "play_id", "home_franchise_id"]

    def joined(max_rows):
        side = small_side(codes, max_rows)
        return normalize_codes(plays, side, "home_team", "home").select(*columns)

    small, large = joined(10_000), joined(0)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_scores_are_not_moved_to_their_group(spark):
    scored = spark.range(4000).selectExpr("id % 3 AS g", "rand(1) AS score", "id % 2 AS actual")
    text = plan(roc_auc(scored, "actual", "score", ["g"]))
    by_group = re.findall(r"hashpartitioning\((g#\d+L?), \d+\)", text)
    # Once, for at most one row per group and bucket.
    assert len(by_group) <= 1, text


def test_player_seasons_read_rosters_once(warehouse):
    assert plan(warehouse.dim_player_season).count("events.parquet") == 1


def test_roles_are_read_in_one_scan(warehouse):
    text = plan(warehouse.fct_player_game)
    assert text.count("lineitem.parquet") == 1 and "Expand" in text
    assert "Window" not in text


def test_latest_is_limited_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"]))
    assert text.count("WindowGroupLimit") == 2


def test_aggregates_combine_before_the_shuffle(warehouse):
    for name in ("fct_drive", "fct_game", "fct_player_game"):
        assert "partial_" in plan(warehouse.table(name)), name


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    stored = Warehouse(adapter.sources(tune(spark), SF), str(tmp_path))
    plays = stored.fct_play
    text = plan(plays.filter("season = 2003 AND down = 4").select("game_id"))
    assert re.search(r"PartitionFilters: \[.*season.*2003", text)
    assert "EqualTo(down,4.0)" in text and "ReadSchema: struct<game_id:bigint,down:double>" in text
