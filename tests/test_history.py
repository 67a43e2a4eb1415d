"""Type-2 history of rosters, and facts that follow their files."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from gridmart.plans import columns as C
from gridmart.plans import history, plays
from gridmart.plans.dimensions import dim_game, dim_team_code, dim_franchise, game_base
from gridmart.plans.incremental import INPUTS, IncrementalFacts
from gridmart.session import work_paths

ROSTER = "gsis_id string, season int, week int, team string, player_position string, jersey_number int"


def entries(rng, n):
    for _ in range(n):
        yield (
            rng.choice(["p1", "p1", "p2", "p3", None]), rng.choice([2020, 2021]), rng.choice([None, *range(1, 9)]),
            rng.choice(["A", "A", "B", None]), "QB", rng.choice([7, 7, 8]),
        )


def expected(rows):
    weeks = {}
    for p, season, week, *tracked in rows:
        if p is not None and week is not None:
            key = tuple((v is None, v) for v in tracked)
            at = season * 100 + week
            weeks.setdefault(p, {})
            weeks[p][at] = min(weeks[p].get(at, key), key, key=lambda k: [(n, v or 0) if n else (n, v) for n, v in k])
    out = []
    for p, seen in weeks.items():
        spells = [(k, [a for a, _ in g]) for k, g in itertools.groupby(sorted(seen.items()), key=lambda x: x[1])]
        starts = [s[0] for _, s in spells[1:]] + [None]
        for (key, at), end in zip(spells, starts, strict=True):
            out.append((p, at[0], end, end is None, *[v for _, v in key], at))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.drop("row_hash").collect()), key=str)


def test_history_in_one_go(spark):
    rows = list(entries(random.Random(1), 120))
    df = spark.createDataFrame(rows, ROSTER).repartition(3)
    assert told(history.spells(history.observations(df))) == expected(rows)
    assert history.spells(history.observations(df.limit(0))).count() == 0


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 1, 2, 0, 2)])
def test_replay_in_any_order_gives_the_same_history(spark, tmp_path, order):
    rows = list(entries(random.Random(2), 90))
    parts = [rows[i::3] for i in range(3)]
    path = str(tmp_path / "history")
    for k in order:
        history.update_history(spark, path, spark.createDataFrame(parts[k], ROSTER), buckets=5)
    assert told(history.read_history(spark, path)) == expected(rows)


def test_only_buckets_of_new_rows_are_touched(spark, tmp_path):
    path = str(tmp_path / "history")
    many = [(f"p{i}", 2020, 1, "A", "QB", 1) for i in range(50)]
    assert len(history.update_history(spark, path, spark.createDataFrame(many, ROSTER), buckets=20)) > 10
    touched = history.update_history(spark, path, spark.createDataFrame([("p3", 2020, 5, "B", "QB", 1)], ROSTER), buckets=20)
    assert len(touched) == 1
    assert history.update_history(spark, path, spark.createDataFrame([], ROSTER)) == []
    rows = [tuple(r) for r in history.read_history(spark, path).filter("player_id = 'p3'").select("valid_from", "valid_to", "team").collect()]
    assert sorted(rows) == [(202001, 202005, "A"), (202005, None, "B")]
    assert history.read_history(spark, path).count() == 51


def test_late_rows_split_and_join_spells(spark):
    def merged(*batches):
        found = history.spells(history.observations(spark.createDataFrame([], ROSTER)))
        for rows in batches:
            found = history.merge(found, history.observations(spark.createDataFrame(rows, ROSTER)))
        return told(found.select("valid_from", "valid_to", "team", "row_hash"))

    def row(week, team):
        return ("p", 2020, week, team, "QB", 1)

    assert merged([row(1, "A"), row(9, "A")], [row(5, "B")]) == [
        (202001, 202005, "A"), (202005, 202009, "B"), (202009, None, "A")
    ]
    # The least team of a week counts: a correction joins what was apart.
    assert merged([row(1, "A"), row(5, "B"), row(9, "A")], [row(5, "A")]) == [(202001, None, "A")]


def test_roster_at_play(spark):
    some = fx.rows(spark, "stg_play_by_play", [
        fx.play("g", 1, season=2020, nfl_week=3, rusher_player_id="p1"),
        fx.play("g", 2, season=2020, nfl_week=1, rusher_player_id="p1"),
        fx.play("g", 3, season=2021, nfl_week=1, passer_player_id="p1", rusher_player_id="p2"),
    ])
    rosters = spark.createDataFrame([("p1", 2020, 2, "A", "QB", 1), ("p1", 2020, 4, "B", "QB", 2)], ROSTER)
    got = history.roster_at_play(some, rosters).select("play_id", "player_id", "is_passer", "roster_at", "roster_team")
    assert sorted(map(tuple, got.collect())) == [
        (1, "p1", 0, 202002, "A"), (2, "p1", 0, None, None), (3, "p1", 1, 202004, "B"), (3, "p2", 0, None, None)
    ]


# --- facts by file --------------------------------------------------------------------------


def season_plays(season, n, start=0, game=None):
    for i in range(start, start + n):
        yield fx.play(
            game or f"g{season}{i % 3}", i, season=season, nfl_week=i % 4, drive=i % 2 or None, epa=i / 8,
            success=[1.0, 0.0, None][i % 3], play_type=["pass", "run", "no_play", None, "NO_PLAY"][i % 5],
            pass_attempt=i % 2, rush_attempt=(i + 1) % 2, passer_player_id=f"p{i % 4}", rusher_player_id=f"r{i % 3}",
            posteam="A1" if i % 2 else "B1", defteam="B1", ydsnet=i % 7, penalty=i % 6 == 0,
        )


class Files:
    """Landed plays by key, with a note of what is read."""

    def __init__(self, spark):
        self.spark, self.rows, self.read = spark, {}, []

    def put(self, key, rows):
        self.rows[key] = list(rows)

    def prints(self):
        return {k: str(hash(str(v))) for k, v in self.rows.items()}

    def load(self, keys):
        self.read += keys
        parts = [
            fx.rows(self.spark, "stg_play_by_play", self.rows[k]).withColumn("source_file", F.lit(k)) for k in keys
        ]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole

    def all(self):
        return self.load(list(self.rows)).drop("source_file")


def rounded(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_updates_equal_a_full_build(spark, tmp_path):
    seeds = fx.seeds(spark)
    franchises = dim_franchise(seeds["dim_franchise_seed"])
    codes = dim_team_code(seeds["map_team_code_seed"], franchises)
    names = [f"g{s}{k}" for s in (2020, 2021, 2022) for k in range(3)]
    games = game_base(fx.rows(spark, "stg_games", [fx.game(n, season=int(n[1:5])) for n in names]), codes)
    files, facts = Files(spark), IncrementalFacts(spark, str(tmp_path / "facts"))

    def check(read):
        files.read = []
        found = facts.update(files.prints(), files.load, codes)
        assert sorted(files.read) == read == found.read
        base = plays.play_base(files.all(), codes)
        full = plays.fct_play(base)
        assert rounded(facts.fct_play()) == rounded(full)
        for name in plays.SUBFACTS:
            assert rounded(facts.subfact(name)) == rounded(plays.subfact(base, name))
        assert rounded(facts.fct_drive()) == rounded(plays.fct_drive(base))
        assert rounded(facts.fct_game(games)) == rounded(plays.fct_game(games, full))
        assert facts.fct_game(games).columns == C.FCT_GAME
        by_player = facts.fct_player_game(dim_game(games))
        assert rounded(by_player) == rounded(plays.fct_player_game(full, dim_game(games)))
        return found

    files.put("pbp/2020", season_plays(2020, 12))
    files.put("pbp/2021", season_plays(2021, 9))
    check(["pbp/2020", "pbp/2021"])
    # One changes, one is new and has plays of another file's game, one stays.
    files.put("pbp/2021", season_plays(2021, 14))
    files.put("pbp/2022", [*season_plays(2022, 5), *season_plays(2022, 4, 50, "g20200")])
    found = check(["pbp/2021", "pbp/2022"])
    assert (found.added, found.changed, found.removed) == (["pbp/2022"], ["pbp/2021"], [])
    del files.rows["pbp/2021"]
    found = check([])
    assert found.removed == ["pbp/2021"]
    files.put("pbp/2022", [])
    check(["pbp/2022"])


def test_an_update_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    codes = dim_team_code(fx.seeds(spark)["map_team_code_seed"], dim_franchise(fx.seeds(spark)["dim_franchise_seed"]))
    files, facts = Files(spark), IncrementalFacts(spark, str(tmp_path / "facts"), ["fct_play", "drive_states"])
    files.put("pbp/2020", season_plays(2020, 6))
    from gridmart.plans import incremental

    real, calls = incremental.versions.replace, []

    def once(df, path, keys):
        if calls.append(1) or len(calls) == 2:
            raise RuntimeError("lost")
        return real(df, path, keys)

    monkeypatch.setattr(incremental.versions, "replace", once)
    with pytest.raises(RuntimeError, match="lost"):
        facts.update(files.prints(), files.load, codes)
    assert facts.update(files.prints(), files.load, codes).added == ["pbp/2020"]
    assert facts.fct_play().count() == 6 and facts.update(files.prints(), files.load, codes).read == []
    # Other team codes change all plays.
    assert facts.update(files.prints(), files.load, codes.limit(1)).changed == ["pbp/2020"]


@pytest.mark.parametrize("part", ["drive_states", "game_states", "player_states"])
def test_states_need_few_columns_and_keep_no_plays(spark, tmp_path, part):
    seeds = fx.seeds(spark)
    codes = dim_team_code(seeds["map_team_code_seed"], dim_franchise(seeds["dim_franchise_seed"]))
    games = game_base(fx.rows(spark, "stg_games", [fx.game(f"g2020{k}", season=2020) for k in range(3)]), codes)
    files, facts = Files(spark), IncrementalFacts(spark, str(tmp_path / "facts"), [part])
    files.put("pbp/2020", season_plays(2020, 12))
    files.put("pbp/2021", season_plays(2021, 9, game="g20200"))
    before = work_paths(spark)
    facts.update(files.prints(), lambda keys: files.load(keys).select(*INPUTS[part], "source_file"), codes)
    assert work_paths(spark) == before
    base = plays.play_base(files.all(), codes)
    got, full = {
        "drive_states": lambda: (facts.fct_drive(), plays.fct_drive(base)),
        "game_states": lambda: (facts.fct_game(games), plays.fct_game(games, plays.fct_play(base))),
        "player_states": lambda: (
            facts.fct_player_game(dim_game(games)), plays.fct_player_game(plays.fct_play(base), dim_game(games))
        ),
    }[part]()
    assert rounded(got) == rounded(full)


def test_plays_kept_for_several_parts_are_deleted(spark, tmp_path):
    seeds = fx.seeds(spark)
    codes = dim_team_code(seeds["map_team_code_seed"], dim_franchise(seeds["dim_franchise_seed"]))
    files, facts = Files(spark), IncrementalFacts(spark, str(tmp_path / "facts"), ["fct_play", "drive_states"])
    files.put("pbp/2020", season_plays(2020, 12))
    before = work_paths(spark)
    facts.update(files.prints(), files.load, codes)
    assert work_paths(spark) == before and facts.fct_play().count() == 12


def test_player_states_are_shuffled_once_to_be_combined(spark, tmp_path):
    seeds = fx.seeds(spark)
    codes = dim_team_code(seeds["map_team_code_seed"], dim_franchise(seeds["dim_franchise_seed"]))
    files, facts = Files(spark), IncrementalFacts(spark, str(tmp_path / "facts"), ["player_states"])
    files.put("pbp/2020", season_plays(2020, 12))
    facts.update(files.prints(), files.load, codes)
    games = dim_game(game_base(fx.rows(spark, "stg_games", [fx.game("g20200", season=2020)]), codes))
    plan = facts.fct_player_game(games)._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "player_id" in x.split("hashpartitioning")[1].split(")")[0]]) == 1
