"""Split, fitted preprocessing, metrics, the fit itself and the result tables."""

import math
import random
from collections import Counter
from statistics import median

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridmart.ml import spec
from gridmart.ml.metrics import binary_metrics, roc_auc
from gridmart.ml.preprocess import apply_preprocess, encoder, fit_preprocess, impute
from gridmart.ml.split import chrono_split, model_input, select_seasons
from gridmart.ml.train import dummy_prediction, fit, fit_logistic, train, train_job
from gridmart.operators import exact_medians, modes
from gridmart.operators.quantiles import add_buckets
from gridmart.sinks import append_result, create_result_tables
from gridmart.sinks.results import METRICS_TABLE, PREDICTIONS_TABLE


def test_split(spark):
    df = spark.createDataFrame([(2018,), (2020,), (2019,), (2017,), (None,)], "season int")
    assert {r["season"]: r["split"] for r in chrono_split(df).collect()} == {
        2017: "train",
        2018: "train",
        2019: "validation",
        2020: "test",
    }
    with pytest.raises(ValueError, match="three seasons"):
        select_seasons(df.filter("season > 2018"))


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_medians_match_brute_force(spark, buckets):
    rng = random.Random(buckets)
    # A third of all values are one hot value; one column has an even, one an odd count.
    rows = [
        (
            5.0 if rng.random() < 0.33 else rng.uniform(-10, 10),
            rng.randint(0, 3) if i % 5 else None,
            float(i),
        )
        for i in range(501)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    got = {r["column"]: r["median"] for r in exact_medians(df, ["a", "b", "c"], buckets).collect()}
    for i, name in enumerate("abc"):
        assert got[name] == median([r[i] for r in rows if r[i] is not None]), name


def test_a_bracket_beside_the_middle_is_widened(spark):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 5), rng.expovariate(1), 7.0) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_medians(df, ["a", "b", "c"], accuracy=2, margin=0.0).collect()
    expected = {c: median(r[i] for r in rows) for i, c in enumerate("abc")}
    assert {r["column"]: r["median"] for r in got} == expected


def test_modes_break_ties_downwards(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 2), ("a", None), (None, None)], "x string, y int")
    got = {r["column"]: r["mode"] for r in modes(df, ["x", "y"]).collect()}
    assert got == {"x": "a", "y": "2"}


def test_buckets_keep_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    limits = (
        add_buckets(df, [], "v", 16)
        .groupBy("bucket")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy("bucket")
        .collect()
    )
    assert 12 < len(limits) <= 16
    assert all(a["hi"] < b["lo"] for a, b in zip(limits, limits[1:]))


def brute_auc(pairs):
    pos = [s for a, s in pairs if a == 1]
    neg = [s for a, s in pairs if a == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [3, 256])
def test_auc_matches_all_pairs(spark, buckets):
    rng = random.Random(1)
    rows = [
        (g, rng.randint(0, 1) if g != "z" else 1, 0.5 if rng.random() < 0.3 else rng.random())
        for g in "xyz"
        for _ in range(150)
    ]
    df = spark.createDataFrame(rows, "g string, a int, s double")
    got = {r["g"]: r["roc_auc"] for r in roc_auc(df, "a", "s", ["g"], buckets).collect()}
    for g in "xyz":
        want = brute_auc([(a, s) for h, a, s in rows if h == g])
        assert got[g] == (want if want is None else pytest.approx(want))
    whole = roc_auc(df, "a", "s", buckets=buckets).first()[0]
    assert whole == pytest.approx(brute_auc([(a, s) for _, a, s in rows]))


def test_metrics(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] + [(0, 0)] * 4
    got = binary_metrics(spark.createDataFrame(rows, "a int, p int"), "a", "p").first()
    assert got["confusion_matrix"] == "[[4, 1], [2, 3]]"
    assert (got["accuracy"], got["precision"], got["recall"]) == (0.7, 0.75, 0.6)
    assert got["f1"] == pytest.approx(2 / 3)
    none = binary_metrics(spark.createDataFrame([(0, 0)], "a int, p int"), "a", "p").first()
    assert (none["precision"], none["recall"], none["f1"], none["accuracy"]) == (0, 0, 0, 1)


def test_preprocess(spark):
    train = spark.createDataFrame(
        [(1.0, "a", 3.0), (None, "b", 3.0), (4.0, None, 3.0), (10.0, "b", 3.0)],
        "x double, c string, k double",
    )
    fitted = fit_preprocess(train, ["x", "k"], ["c"])
    filled = [1.0, 4.0, 4.0, 10.0]
    assert fitted.medians == {"x": 4.0, "k": 3.0} and fitted.modes == {"c": "b"}
    assert fitted.means["x"] == pytest.approx(np.mean(filled))
    assert fitted.scales["x"] == pytest.approx(np.std(filled)) and fitted.scales["k"] == 1.0
    assert [r["c"] for r in impute(train, fitted).collect()] == ["a", "b", "b", "b"]
    coder = encoder(["x", "k"], ["c"]).fit(apply_preprocess(train, fitted))
    fresh = spark.createDataFrame([(4.0, "new", 3.0), (4.0, "a", 3.0)], train.schema)
    vectors = [
        r["features"].toArray().tolist()
        for r in coder.transform(apply_preprocess(fresh, fitted)).collect()
    ]
    assert vectors[0][1:] == [0.0, 0.0, 0.0] and vectors[1][1:] == [0.0, 1.0, 0.0]
    with pytest.raises(ValueError, match="no training value"):
        fit_preprocess(train.withColumn("e", F.lit(None).cast("double")), ["e"], ["c"])


def newton(x, y, steps=50):
    """Minimise the penalised logistic loss 0.5 |w|^2 + sum(loss), free intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_a_category_without_values_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "n double, c string")
    with pytest.raises(ValueError, match="no training value in: c"):
        fit_preprocess(df, ["n"], ["c"])


def test_logistic_fit_matches_newton(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = (x @ [1.0, -2.0, 0.0] + rng.normal(size=200) > 0.3).astype(float)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y)], ["features", spec.TARGET]
    )
    model = fit_logistic(df)
    want = newton(x, y)
    assert np.allclose([*model.coefficients, model.intercept], want, atol=1e-4)


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        row = {c: rng.choice([None, 1.0, 2.0, 3.0, 7.0]) for c in spec.NUMERIC}
        row |= {c: rng.choice([None, "a", "b"]) for c in spec.CATEGORICAL}
        row |= {"game_id": f"g{i}", "play_id": i, "season": 2015.0 + i % 5}
        row["down"] = float(rng.randint(1, 4))
        row[spec.TARGET] = int(rng.random() < 0.2 + 0.15 * row["down"])
        rows.append(row)
    ddl = ", ".join(
        ["game_id string", "play_id long"]
        + [f"{c} double" for c in spec.NUMERIC]
        + [f"{c} string" for c in spec.CATEGORICAL]
        + [f"{spec.TARGET} int"]
    )
    return spark.createDataFrame(rows, ddl)


def test_training_run(spark, features):
    create_result_tables(spark)
    create_result_tables(spark)
    out = train_job(features)
    assert out[METRICS_TABLE].rows == 18 and out[PREDICTIONS_TABLE].rows == 120
    metrics = spark.table(METRICS_TABLE).collect()
    assert len({r["run_id"] for r in metrics}) == 1
    assert len({r["created_at"] for r in metrics}) == 1
    by = {(r["model_name"], r["split_name"], r["metric_name"]): r for r in metrics}
    assert len(by) == 18
    assert by["dummy_classifier", "validation", "roc_auc"]["metric_value"] == 0.5
    matrix = by["logistic_regression", "test", "confusion_matrix"]
    assert matrix["metric_value"] is None and matrix["metric_text"].startswith("[[")
    predictions = spark.table(PREDICTIONS_TABLE).collect()
    assert {r["season"] for r in predictions} == {2019}
    assert all(
        (r["predicted_success_probability"] > 0.5) == (r["predicted_is_successful_play"] == 1)
        for r in predictions
    )
    pairs = [(r["actual_is_successful_play"], r["predicted_success_probability"]) for r in predictions]
    auc = by["logistic_regression", "test", "roc_auc"]["metric_value"]
    assert auc == pytest.approx(brute_auc(pairs))
    labels = Counter(r[spec.TARGET] for r in features.filter("season < 2018").collect())
    train_rows = chrono_split(features).filter("split = 'train'")
    assert dummy_prediction(train_rows) == labels.most_common(1)[0][0]
    empty = append_result(spark.table(METRICS_TABLE).limit(0), METRICS_TABLE, "none")
    assert (empty.success, empty.rows) == (True, 0)


def test_metrics_and_predictions_match_newton(features):
    """Everything that the trained model writes, from weights of another solver and metrics by hand."""
    split = chrono_split(model_input(features)).cache()
    fitted = fit(split.filter("split = 'train'"))
    coded = fitted.coder.transform(apply_preprocess(split, fitted.preprocess))
    rows = coded.select("game_id", "split", spec.TARGET, vector_to_array("features").alias("x")).collect()
    x, y = np.array([r.x for r in rows]), np.array([r[spec.TARGET] for r in rows], dtype=float)
    part = np.array([r.split for r in rows])
    w = newton(x[part == "train"], y[part == "train"])
    chance = 1 / (1 + np.exp(-np.hstack([x, np.ones((len(x), 1))]) @ w))
    run = train(features, "r")
    told = {r.game_id: r for r in run.predictions.collect()}
    assert len(told) == (part == "test").sum()
    for r, p in zip(rows, chance):
        if r.split == "test":
            own = told[r.game_id]
            assert abs(own.predicted_success_probability - p) < 1e-4
            assert own.predicted_is_successful_play == (p > 0.5) and own.actual_is_successful_play == r[spec.TARGET]
    metrics = {
        (r.split_name, r.metric_name): r.metric_value
        for r in run.metrics.filter(F.col("model_name") == spec.LOGISTIC).collect()
    }
    for name in ("validation", "test"):
        own, guess, p = y[part == name], chance[part == name] > 0.5, chance[part == name]
        hit = (guess & (own == 1)).sum()
        good, bad = p[own == 1], p[own == 0]
        area = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
        assert abs(metrics[name, "accuracy"] - np.mean(guess == own)) < 1e-9
        assert abs(metrics[name, "precision"] - hit / max(1, guess.sum())) < 1e-9
        assert abs(metrics[name, "recall"] - hit / (own == 1).sum()) < 1e-9
        assert abs(metrics[name, "roc_auc"] - area) < 1e-3


def test_model_input(spark, features):
    with pytest.raises(ValueError, match="missing expected columns: roof"):
        model_input(features.drop("roof"))
    with pytest.raises(ValueError, match="zero rows"):
        train_job(features.limit(0))
    odd = features.limit(1).withColumn("wind", F.lit("calm")).withColumn("qtr", F.lit(math.nan))
    row = model_input(odd).first()
    assert row["wind"] is None and row["qtr"] is None
