"""Quality classifier by positive-unlabelled learning.

Rows trusted as good are the positives, texts of the whole corpus the unlabelled ones. A logistic model on
text statistics minimises the non-negative unbiased risk

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

with the sigmoid loss. When the second part turns negative, the step goes up its gradient instead, so that the model can't
overfit the positives. The prior, the share of good texts, is estimated from positives and unlabelled texts alone, as no
trusted negatives are assumed: a model fitted to half of them ranks the other half, and above a threshold the
unlabelled ones are as many as the good ones among them at least, so the least ratio of both shares of rows above a threshold,
by its upper confidence bound, tells the prior (at most ``HIGHEST``, beyond which the risk has no bad texts left).

Fit: ``FIT_ROWS`` positives and as many unlabelled texts in the mean (documented bound), chosen by a hash of
the id; only their ``FEATURES`` numbers reach the driver; the prior comes from the same rows. Scores cover all rows. Scoring
shuffles nothing.

Edge cases: NULL and empty texts have all-zero statistics and get the model's score for these. Rows with a
NULL id are never learned from. A document labelled both 0 and 1 is not trusted. Without a trusted positive
every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from gridmart.llm.rows import map_texts
from gridmart.llm.tables import held_out

FIT_ROWS = 8000
STEPS = 400
RATE = 0.05
L2 = 1e-3
GOOD = 0.7
#: Confidence of the bound that picks the threshold for the prior, and the largest prior.
CONFIDENCE = 0.9
HIGHEST = 0.99

FEATURES = 11

_ASCII_LETTERS = np.r_[65:91, 97:123]


def features(text: bytes | None) -> list[float]:
    """Statistics of one whole text."""
    text = text or b""
    words, lines = text.split(), text.split(b"\n")
    n, size = len(words), max(len(text), 1)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters = int(counts[_ASCII_LETTERS].sum() + counts[128:].sum())
    return [
        np.log1p(n),
        min(n, 12) / 12,
        np.log1p(len(set(words))) - np.log1p(n),
        len(set(lines)) / len(lines),
        letters / size,
        counts[48:58].sum() / size,
        counts[65:91].sum() / max(letters, 1),
        np.log1p(len(text) / max(n, 1)),
        min(len(zlib.compress(text, 1)) / size, 2.0),
        counts[46] / max(n, 1),
        len(lines) / max(n, 1),
    ]


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.design(x) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Adam steps on the non-negative risk, over all fit rows at a time."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES + 1))
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    model = Model(centre, scale, np.zeros(2 * FEATURES + 1))
    p, u = model.design(positive), model.design(unlabelled)
    w = model.weights
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        # Gradients of the risks: of positives taken for bad, and of bad ones taken for good.
        slope = prior * (p.T @ (sp * (1 - sp))) / len(p)
        as_good = -slope
        bad_gradient = u.T @ (su * (1 - su)) / len(u) - slope
        bad = su.mean() - prior * sp.mean()
        gradient = as_good + bad_gradient if bad >= 0 else -bad_gradient
        gradient = gradient + L2 * np.r_[w[:-1], 0]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, w)


def risk(model: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the risk of ``model``: positives taken for bad, and bad ones taken for good (unclipped)."""
    sp, su = model.score(positive), model.score(unlabelled)
    return prior * float((1 - sp).mean()), float(su.mean()) - prior * float(sp.mean())


def least_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from scores of both that were not fitted to."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    limits = np.unique(positive)
    above_p = 1 - np.searchsorted(np.sort(positive), limits, "left") / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), limits, "left") / len(unlabelled)
    spread = np.log(4 / (1 - CONFIDENCE)) / 2
    slack = np.sqrt(spread / len(positive)) + np.sqrt(spread / len(unlabelled))
    best = np.argmin((above_u + slack) / above_p)
    return float(above_u[best] / above_p[best])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good texts among unlabelled ones: one half of the rows ranks the other."""

    def halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # In an order of their own, as rows come from Spark in any order.
        rows = rows[np.lexsort(rows.T)]
        return rows[::2], rows[1::2]

    (p, other_p), (u, other_u) = halves(positive), halves(unlabelled)
    found = [
        least_ratio(model.score(b_p), model.score(b_u))
        for model, b_p, b_u in (
            (minimise(p, u, 0.5), other_p, other_u),
            (minimise(other_p, other_u, 0.5), p, u),
        )
    ]
    return min(float(np.mean(found)), HIGHEST)


def _share(rows: int, of: int):
    """Condition that keeps about ``rows`` of ``of`` rows, by a hash of their id."""
    limit = (1 << 62) if rows >= of else int((1 << 62) * (rows / of))
    return F.expr("xxhash64(cast(doc_id AS string)) & 4611686018427387903") < F.lit(limit)


def _statistics(docs: DataFrame, text: str) -> np.ndarray:
    def make():
        return lambda texts: [[features(t) for t in texts]]

    rows = map_texts(docs, make, "x array<double>", text).select("out.x").collect()
    return np.array([r["x"] for r in rows], dtype=float).reshape(-1, FEATURES)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Learn from documents and labels that are not held out."""
    free = F.coalesce(~held_out(F.col("doc_id")), F.lit(False))
    ids = labels.filter(free & F.col("quality").isNotNull()).groupBy("doc_id")
    known = ids.agg(F.min("quality").alias("quality"))
    good = known.filter("quality = 1").count()
    if not good:
        return minimise(np.zeros((0, FEATURES)), np.zeros((0, FEATURES)), 0.5)
    texts = docs.select("doc_id", text).filter(free)
    trusted = known.filter((F.col("quality") == 1) & _share(FIT_ROWS, good)).select("doc_id")
    # FIT_ROWS ids at most in the mean: small enough to broadcast.
    positive = _statistics(texts.join(F.broadcast(trusted), "doc_id"), text)
    unlabelled = _statistics(texts.filter(_share(FIT_ROWS, texts.count())), text)
    return minimise(positive, unlabelled, estimate_prior(positive, unlabelled))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` and ``out`` (score) for every document."""

    def make():
        def function(texts):
            return [model.score(np.array([features(t) for t in texts], dtype=float))]

        return function

    return map_texts(docs, make, "score double", text)


def digest(scored: DataFrame) -> DataFrame:
    return scored.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "out.score",
        (F.col("out.score") >= GOOD).cast("int").alias("predicted"),
    )
