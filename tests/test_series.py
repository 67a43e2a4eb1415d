"""Running values, as-of joins and overlap joins against plain Python."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridmart.operators import as_of_join, overlap_join, running
from gridmart.operators import intervals


def expected_running(rows, ops):
    groups = {}
    for r in rows:
        groups.setdefault(r["k"], []).append(r)
    out = []
    for group in groups.values():
        state = {}
        for r in sorted(group, key=lambda r: (r["t"] is not None, r["t"] or 0, r["i"])):
            found = dict(r)
            for name, (op, column) in ops.items():
                v, s = r[column], state.get(name)
                if op == "count":
                    s = (s or 0) + (v is not None)
                elif v is not None:
                    s = v if s is None or op == "last" else {"sum": s + v, "min": min(s, v), "max": max(s, v)}[op]
                state[name] = found[name] = s
            out.append(tuple(found.values()))
    return sorted(out, key=str)


OPS = {
    "total": ("sum", "v"),
    "seen": ("count", "v"),
    "low": ("min", "v"),
    "high": ("max", "v"),
    "now": ("last", "w"),
}


@pytest.mark.parametrize("rows, slices", [(1000, 8), (20, 8), (1, 3)])
def test_running_values(spark, rows, slices):
    rng = random.Random(rows)
    data = [
        dict(k=rng.choice(["a", "a", "a", "b", None]), t=rng.choice([None, *range(30)]), i=i,
             v=rng.choice([None, 1, 5, -7]), w=rng.choice([None, None, "x", "y"]))
        for i in range(200)
    ] + [dict(k="none", t=None, i=900 + i, v=i, w=None) for i in range(25)]
    df = spark.createDataFrame([tuple(r.values()) for r in data], "k string, t int, i int, v int, w string")
    got = running(df.repartition(3), ["k"], ["t", "i"], OPS, rows, slices)
    assert sorted(map(tuple, got.collect()), key=str) == expected_running(data, OPS)
    assert got.columns == ["k", "t", "i", "v", "w", *OPS]


def test_a_hot_group_is_spread_over_tasks(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"), F.lit(1).alias("`a.b`"),
    ).withColumnRenamed("`a.b`", "a.b")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = running(df, ["k"], ["t"], {"n": ("sum", "a.b")}, rows=500, slices=64)
        hot = got.filter("k = -1")
        assert hot.agg(F.max("n"), F.count_distinct("n")).first() == (10_000, 10_000)
        sizes = [r.s for r in got.groupBy(F.spark_partition_id()).agg(F.count("n").alias("s"), F.max("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = sorted(sizes)
    assert len(sizes) == 24 and sizes[-1] <= 2 * sizes[12]


def test_unknown_operations_and_orders(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    with pytest.raises(ValueError, match="median"):
        running(df, ["k"], ["t"], {"m": ("median", "t")})
    with pytest.raises(TypeError, match="no distances"):
        running(df, ["k"], ["k"], {"m": ("sum", "t")})


START = datetime(2024, 1, 1)


def as_of(left, right, strict=False, forward=False, max_gap=None):
    out = []
    for k, t, i in left:
        best = None
        for rk, rt, v in right:
            if None in (k, t, rk, rt) or k != rk:
                continue
            gap = (rt - t) if forward else (t - rt)
            if gap < timedelta(0) or strict and not gap or max_gap is not None and gap > timedelta(microseconds=max_gap):
                continue
            key = (-gap, v is not None, v or 0)
            best = max(best or (key, v), (key, v))
        out.append((k, t, i, best and best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [10_000, 15])
@pytest.mark.parametrize("options", [{}, {"strict": True}, {"forward": True}, {"forward": True, "strict": True}, {"max_gap": 3_600_000_000}])
def test_as_of_join(spark, rows, options):
    rng = random.Random(2)

    def moment():
        return rng.choice([None, *[START + timedelta(minutes=20 * rng.randrange(60)) for _ in range(20)]])

    left = [(rng.choice(["a", "a", "b", "c", None]), moment(), i) for i in range(150)]
    right = [(rng.choice(["a", "a", "a", "b", None]), moment(), rng.choice([None, *range(9)])) for _ in range(120)]
    a = spark.createDataFrame(left, "key string, t timestamp, _time int").repartition(3)
    b = spark.createDataFrame(right, "name string, t timestamp, `a.b` int")
    got = as_of_join(a, b, {"key": "name"}, "t", "t", {"v": "a.b"}, rows=rows, slices=5, **options)
    assert got.columns == ["key", "t", "_time", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == as_of(left, right, **options)


def test_as_of_ties_and_empty_sides(spark):
    a = spark.createDataFrame([("a", date(2024, 1, 5))], "k string, d date")
    b = spark.createDataFrame([("a", date(2024, 1, 5), 1, "x"), ("a", date(2024, 1, 5), 2, "w")], "k string, d date, n int, v string")
    def run(x, y, **more):
        return [tuple(r) for r in as_of_join(x, y, {"k": "k"}, "d", "d", {"v": "v"}, **more).collect()]

    assert run(a, b, tiebreak=["n"]) == [("a", date(2024, 1, 5), "w")] and run(a, b)[0][-1] == "x"
    assert run(a, b.limit(0)) == [("a", date(2024, 1, 5), None)] and run(a.limit(0), b) == []


def spans(rng, n, far):
    for i in range(n):
        s = rng.choice([None, *range(far)]) if rng.random() < 0.05 else rng.randrange(-far, far)
        length = rng.choice([0, 1, 1, 2, 3, 7, 8, 9, 64, far])
        yield rng.choice(["a", "b", None]), s, None if s is None else s + length - (rng.random() < 0.05), i


def overlaps(left, right, keyed=True):
    return sorted(
        (i, j, max(s, t), min(e, f))
        for k, s, e, i in left
        for m, t, f, j in right
        if None not in (s, e, t, f) and s < e and t < f and s < f and t < e and (not keyed or k is not None and k == m)
    )


@pytest.mark.parametrize("crowd, far, keyed", [(10_000, 40, True), (2, 40, True), (3, 500, False)])
def test_overlap_join(spark, monkeypatch, crowd, far, keyed):
    monkeypatch.setattr(intervals, "CROWD", crowd)
    rng = random.Random(far)
    left, right = list(spans(rng, 120, far)), list(spans(rng, 90, far))
    a = spark.createDataFrame(left, "k string, s int, e int, _bin int").repartition(3)
    b = spark.createDataFrame(right, "name string, s bigint, `a.b` bigint, j int")
    pairs = overlap_join(
        a, b, {"k": "name"} if keyed else {}, ("s", "e"), ("s", "a.b"),
        {"i": "left._bin", "j": "right.j", "from": "start", "to": "end"},
    )
    assert sorted(map(tuple, pairs.collect())) == overlaps(left, right, keyed)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_overlap_of_days_and_wrong_bounds(spark):
    a = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 3))], "i int, s date, e date")
    b = spark.createDataFrame([(2, date(2024, 1, 3), date(2024, 1, 4)), (3, date(2023, 1, 3), date(2025, 1, 4))], "j int, s date, e date")
    pairs = overlap_join(a, b, {}, ("s", "e"), ("s", "e"), {"i": "left.i", "j": "right.j"})
    assert [tuple(r) for r in pairs.collect()] == [(1, 3)]
    with pytest.raises(TypeError, match="whole numbers"):
        overlap_join(spark.createDataFrame([(1.5, 2.5)], "s double, e double"), b, {}, ("s", "e"), ("s", "e"), {})
    with pytest.raises(ValueError, match="no column"):
        overlap_join(a, b, {}, ("s", "x"), ("s", "e"), {})
    assert overlap_join(a.limit(0), b, {}, ("s", "e"), ("s", "e"), {"i": "left.i"}).collect() == []
