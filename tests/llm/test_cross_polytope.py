"""Nearest neighbours against brute force."""

import random

import numpy as np
import pytest

from gridmart.llm import cross_polytope as cp

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, shard string, `a.b` string"


def frame(spark, rows, kind="double"):
    schema = SCHEMA.replace("double", kind)
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], schema).repartition(3)


def run(df, every=5, count=6, tables=None):
    tables = tables or cp.fit(df, every, count)
    found = {}
    rows = cp.search(df, tables, every, count).collect()
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for own in found.values():
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
    assert len(rows) == len({(r.query_id, r.rank) for r in rows}) == sum(map(len, found.values()))
    return found


def brute(rows, every=5, count=6):
    dim = max((len(v) for _, v in rows if v), default=0)
    kept = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            kept.setdefault(i, set()).add(tuple(v) + (0.0,) * (dim - len(v)))
    found = {}
    for i, own in kept.items():
        if i % every:
            continue
        scores = {
            j: max(float((np.array(a) * np.array(b)).sum()) for a in own for b in other)
            for j, other in kept.items()
            if j != i
        }
        found[i] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:count]
    return {i: f for i, f in found.items() if f}


def recall(got, truth):
    shared = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in t}) for q, t in truth.items())
    return shared / max(1, sum(map(len, truth.values())))


def vectors(rng, n, dim=24):
    return [(i, rng.normal(size=dim).tolist()) for i in range(n)]


def test_transform_is_orthonormal():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(cp.hadamard(cp.hadamard(x)), x) and np.allclose(np.linalg.norm(cp.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_probes_begin_with_the_own_bucket_and_reach_all():
    tables = cp.Tables(8, 256 * 100)
    x = np.random.default_rng(2).normal(size=(20, 8))
    keys = tables.keys(x)
    for i in range(20):
        for t in range(tables.tables):
            order = tables.order(x[i], t, tables.buckets)
            assert order[0] == keys[t, i] and sorted(order) == list(range(tables.buckets))


@pytest.mark.parametrize("small", [False, True])
def test_recall_and_exact_scores(spark, monkeypatch, small):
    if small:  # many buckets of several functions, shards in blocks
        monkeypatch.setattr(cp, "PER_BUCKET", 4)
        monkeypatch.setattr(cp, "SHARD", 50)
        monkeypatch.setattr(cp, "STEP", 3)
    rows = vectors(np.random.default_rng(3), 900)
    truth = brute(rows)
    got = run(frame(spark, rows))
    assert got.keys() == truth.keys() and all(len(g) == 6 for g in got.values())
    assert recall(got, truth) >= 0.9
    score = {(q, i): s for q, t in brute(rows, count=1000).items() for i, s in t}
    assert all(score[q, i] == s for q, g in got.items() for i, s in g)


def test_lengths_that_differ(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (np.array(v) * rng.uniform(0.1, 9)).tolist()) for i, v in vectors(rng, 600)]
    df = frame(spark, rows)
    assert cp.fit(df, 5, 6).longest is not None
    assert recall(run(df), brute(rows)) >= 0.9


def test_many_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = vectors(rng, 200)
    near = rng.normal(size=24)
    rows += [(1000 + i, [1.0] * 24) for i in range(300)] + [(2000 + i, [1.0] * 24) for i in (0, 0, 1)]
    rows += [(3000 + i, (near + rng.normal(size=24) * 1e-3).tolist()) for i in range(200)]
    got, truth = run(frame(spark, rows)), brute(rows)
    assert got.keys() == truth.keys() and recall(got, truth) >= 0.9
    # Of copies the smallest ids come first, without the query itself.
    assert [i for i, _ in got[1000]] == list(range(1001, 1007)) and got[1005][0][0] == 1000


AWKWARD = [
    (0, [1.0, 2.0]),
    (1, None),
    (2, []),
    (3, [0.0, -0.0]),
    (4, [float("nan"), 1.0]),
    (5, [float("inf"), 1.0]),
    (6, [None, 1.0]),
    (None, [9.0, 9.0]),
    (7, [3.0, -0.0]),
    (8, [5.0]),
    (10, [-1.0, 0.0]),
    (10, [1.0, 0.5]),
    (-5, [0.5, 0.5]),
]


def test_rows_that_take_no_part(spark):
    assert run(frame(spark, AWKWARD)) == brute(AWKWARD)
    assert run(frame(spark, AWKWARD, "float")) == brute(AWKWARD)


def test_fewer_rows_than_asked_for(spark):
    assert run(frame(spark, [(5, [1.0])])) == {}
    assert run(frame(spark, [(5, [1.0]), (6, [2.0])])) == {5: [(6, 2.0)]}


def test_tables_without_queries(spark):
    assert run(frame(spark, [])) == {} and run(frame(spark, [(1, [1.0]), (2, [2.0])])) == {}


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(cp, "SAMPLE", 4)
    rows = vectors(np.random.default_rng(random.Random(6).randrange(99)), 300)
    tables = cp.fit(frame(spark, rows), 5, 6)
    assert 1 <= tables.probes <= tables.buckets
