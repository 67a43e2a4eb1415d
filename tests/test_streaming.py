"""Streams against the batch job over the same files, with restarts; sketches against exact values."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridmart.operators import sketches
from gridmart.sinks import versions
from gridmart.streaming import landing

SCHEMA = "who string, at timestamp, n int"
START = datetime(2024, 1, 1)


def events(rng, n, hours=48):
    for i in range(n):
        yield rng.choice(["a", "a", "b", None]), START + timedelta(minutes=rng.randrange(60 * hours)), i


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def by_hand(rows, gap):
    groups = defaultdict(list)
    for who, at, n in rows:
        if at is not None:
            groups[who].append((at, n))
    out = []
    for who, own in groups.items():
        own.sort()
        session = [own[0]]
        for e in [*own[1:], None]:
            if e is None or e[0] - session[-1][0] > gap:
                out.append((who, session[0][0], session[-1][0] + gap, len(session), sum(n for _, n in session)))
                session = []
            if e is not None:
                session.append(e)
    return sorted(out, key=str)


def measures():
    return [F.count(F.lit(1)).alias("events"), F.sum("n").alias("total")]


def found(df):
    return sorted((tuple(r) for r in df.select("who", "started", "closed", "events", "total").collect()), key=str)


def test_sessions_of_a_table(spark):
    rows = [*events(random.Random(1), 150), ("a", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(landing.sessions(df, ["who"], "at", "40 minutes", measures())) == by_hand(rows, timedelta(minutes=40))


def test_a_restarted_stream_gives_the_sessions_of_the_batch(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = sorted(events(random.Random(2), 200), key=lambda r: r[1])
    # Neighbours in time lie in different files, less than the delay apart.
    late = [rows[k] for k in range(len(rows)) if k % 7 == 3]
    files, waiting = [], []
    for k in range(0, len(rows), 40):
        part = [r for r in rows[k : k + 40] if r not in late]
        files.append(part + waiting)
        waiting = [r for r in rows[k : k + 40] if r in late]
    files.append(waiting)

    def go():
        stream = landing.files_of(spark, folder, spark.createDataFrame([], SCHEMA).schema, batch_files=1)
        own = landing.sessions(stream, ["who"], "at", "40 minutes", measures(), delay="2 days")
        landing.land_sessions(own, out, check).awaitTermination()

    for k, part in enumerate(files):
        put(spark, folder, part)
        if k in (1, 3):
            go()
    put(spark, folder, [("clock", START + timedelta(days=30), 0)])
    go()
    streamed = versions.read(spark, out).filter("who IS NULL OR who <> 'clock'")
    batch = landing.sessions(spark.createDataFrame(rows, SCHEMA), ["who"], "at", "40 minutes", measures())
    assert found(streamed) == found(batch) == by_hand(rows, timedelta(minutes=40))


def test_events_beyond_the_delay_are_dropped(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def go():
        stream = landing.files_of(spark, folder, spark.createDataFrame([], SCHEMA).schema, batch_files=1)
        own = landing.sessions(stream, ["who"], "at", "10 minutes", measures(), delay="1 hour")
        landing.land_sessions(own, out, check).awaitTermination()

    put(spark, folder, [("a", START, 1)])
    go()
    put(spark, folder, [("b", START + timedelta(hours=9), 2)])
    go()
    put(spark, folder, [("a", START + timedelta(minutes=1), 4)])  # far too late
    go()
    assert [(r.who, r.total) for r in versions.read(spark, out).collect()] == [("a", 1)]


def test_landed_files_are_loaded_once_and_repeats_change_nothing(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def go(checkpoint):
        landing.land(landing.files_of(spark, folder, schema, batch_files=1), out, checkpoint).awaitTermination()
        return sorted(r.n for r in versions.read(spark, out).collect())

    put(spark, folder, [("a", START, 1), ("a", None, 2)])
    put(spark, folder, [("b", START, 3)])
    assert go(check) == [1, 2, 3]
    first = versions.current(spark, out).number
    put(spark, folder, [("b", START, 4)])
    assert go(check) == [1, 2, 3, 4] and versions.current(spark, out).number == first + 1
    # A stream that has lost its checkpoint reads all files again.
    assert go(str(tmp_path / "other")) == [1, 2, 3, 4]


@pytest.fixture(scope="module")
def plays(spark):
    return spark.range(40_000).select(
        (F.col("id") % 3).alias("season"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("team"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("game"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int")).alias("yards"),
    ).cache()


MEASURED = sketches.Measures(
    sums={"total": "yards"}, distinct={"games": "game"}, quantiles={"low": ("yards", 0.1), "middle": ("yards", 0.5)}
)
SETS = [["season", "team"], ["season"], ["team"], []]


def test_states_combine_up_the_lattice(plays):
    per_group = sketches.states(plays, ["season", "team"], MEASURED)
    got = sketches.estimates(sketches.combined(per_group, ["season", "team"], MEASURED, SETS), MEASURED).collect()
    exact = plays.groupingSets([[F.col(c) for c in s] for s in SETS], F.col("season"), F.col("team")).agg(
        F.grouping_id().alias("g"), F.count(F.lit(1)), F.sum("yards"), F.count_distinct("game"),
        F.percentile("yards", F.lit(0.1)), F.percentile("yards", F.lit(0.5)),
    ).collect()
    truth = {(r[2], r[0], r[1]): r[3:] for r in exact}
    assert len(got) == len(truth) == 15 + 3 + 5 + 1
    for r in got:
        rows, total, games, low, middle = truth[r.grouping_id, r.season, r.team]
        assert (r.row_count, r.total) == (rows, total)
        assert abs(r.games - games) <= 0.06 * games
        assert abs(r.low - low) <= 30 and abs(r.middle - middle) <= 40


def test_states_of_seasons_are_merged_later(plays):
    def of(season):
        return sketches.states(plays.filter(F.col("season") == season), ["season", "team"], MEASURED)

    merged = sketches.combined(of(0).unionByName(of(1)).unionByName(of(2)), ["team"], MEASURED)
    whole = sketches.combined(sketches.states(plays, ["season", "team"], MEASURED), ["team"], MEASURED)
    a, b = (
        {r.team: (r.row_count, r.total, r.games) for r in sketches.estimates(x, MEASURED).collect()}
        for x in (merged, whole)
    )
    assert a == b and len(a) == 5


def test_no_rows_have_no_states(plays):
    assert sketches.states(plays.limit(0), ["team"], MEASURED).count() == 0


def test_exact_rollup_keeps_no_digest_per_game(spark):
    """Distinct games and digests in one aggregate keep a digest for every game of every group."""
    from checks import series

    keys = ["season", "play_type", "team"]
    rows = [(s, p, t, float((i * 7) % 41), f"g{i % 3}" if i % 5 else None) for i, (s, p, t) in enumerate(
        (s, p, t) for s in (1, 2, None) for p in ("run", None) for t in ("A", "B", None) for _ in range(9))]
    plays = spark.createDataFrame(rows, "season int, play_type string, team string, yards_gained double, game_id string")
    exact = series.exact_per_set(plays, keys)
    got = {(r.grouping_id, r.season, r.play_type, r.team): (r.exact_games, list(r.middle)) for r in exact.collect()}
    want = {}
    for kept in series._SETS:
        level = sum(1 << i for i, c in enumerate(reversed(keys)) if c not in kept)
        groups = {}
        for r in rows:
            groups.setdefault((level, *(r[i] if c in kept else None for i, c in enumerate(keys))), []).append(r)
        for k, own in groups.items():
            yards = sorted(r[3] for r in own)
            ranks = [yards[math.ceil(p * len(yards)) - 1] for p in (0.44, 0.56)]
            want[k] = (len({r[4] for r in own} - {None}), ranks)
    assert got == want
    plan = exact._jdf.queryExecution().optimizedPlan().toString()
    digests = [line for line in plan.splitlines() if "percentile_approx" in line]
    assert digests and not any("count(distinct" in line for line in digests)
    assert not any("game_id" in line for line in digests)
