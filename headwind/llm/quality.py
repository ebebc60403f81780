"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are training rows labelled good; the unlabelled set is a sample of all training
texts, labelled or not, with any labels hidden. The class prior is estimated as the share of good
rows among the labelled training rows. A linear model on indicator features of text statistics
minimises  prior * E_P[l(g, +)] + max(0, E_U[l(g, -)] - prior * E_P[l(g, -)])  with logistic loss.

The model is fitted on about `rows` positives and `rows` unlabelled texts (the documented bound);
every document is scored. Only the text is an input of the score.

Defined cases: null text is the empty text, whose statistics are all 0. A null doc_id is a training
row without label. Without positives or without texts the score is the prior, or 0.5 if there are no
labels. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.sampling import hashed_sample
from headwind.llm.texts import SHAPE, arrow_pass, remainder, statistics
from headwind.session import materialize

#: fixed values: the fold that is held out, and the score from which a text is predicted good
FOLDS, HELD_OUT, GOOD_FROM = 4, 2, 0.7


def shapes(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the statistics of the text; one pass, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat = np.array([statistics(t or "")[1] for t in batch.column("text").to_pylist()], dtype=np.float64)
            ends = pa.array(np.arange(0, flat.size + 1, len(SHAPE), dtype=np.int32))
            shape = pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), shape], names=["doc_id", "held_out", "shape"]
            )

        return step

    held_out = remainder("doc_id", FOLDS) == HELD_OUT
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    return arrow_pass(narrow, "doc_id long, held_out boolean, shape array<double>", make)


@dataclass(frozen=True)
class Model:
    """Indicators x > cut for each statistic, a weight for each, and an intercept."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    intercept: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x[:, i, None] > c for i, c in enumerate(self.cuts)], axis=1).astype(float)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.inputs(x) @ self.weights + self.intercept)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(g / 2))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Quantiles of each statistic, denser towards its greatest values, where oddities lie."""
    at = np.concatenate([np.linspace(0, 1, bins, endpoint=False), 1 - np.geomspace(0.5 / bins, 0.002, bins // 2)])
    return [np.unique(np.quantile(c, at, method="lower")) for c in x.T]


def minimise(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, bins: int = 16, rounds: int = 600, rate: float = 0.1, ridge: float = 1e-4
) -> Model:
    """Full-batch gradient descent (Adam). Where the estimated risk of the negatives falls below 0,
    its gradient is followed upwards, as the non-negative estimator asks."""
    model = Model(_cuts(unlabelled, bins), np.zeros(0), 0.0)
    p, u = (np.c_[model.inputs(x), np.ones(len(x))] for x in (positive, unlabelled))
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    shrink = np.full(len(w), ridge)
    shrink[-1] = 0
    for i in range(1, rounds + 1):
        gp, gu = p @ w, u @ w
        minus = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        down = u.T @ _sigmoid(gu) / len(u) - prior * (p.T @ _sigmoid(gp)) / len(p)
        up = -prior * (p.T @ _sigmoid(-gp)) / len(p)
        grad = (up + down if minus >= 0 else -down) + shrink * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return Model(model.cuts, w[:-1], float(w[-1]))


def fit(seen: DataFrame, labels: DataFrame, rows: int = 20_000, seed: int = 5) -> Model:
    """Fits on training rows only. The driver sees at most about 2 * `rows` rows of statistics."""
    train = seen.filter("not held_out")
    known = labels.filter("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = materialize(train.join(known, "doc_id"), "quality")
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("quality"), F.lit(0))).first()
    prior = float(np.clip(good / n, 0.01, 0.99)) if n else 0.5
    p, u = (_rows(hashed_sample(d, "doc_id", rows, seed + i)) for i, d in enumerate((known.filter("quality = 1"), train)))
    if not len(p) or not len(u):
        return Model([np.zeros(0)] * len(SHAPE), np.zeros(0), float(np.log(prior / (1 - prior))))
    return minimise(p, u, prior)


def _rows(df: DataFrame) -> np.ndarray:
    columns = [F.col("shape")[i].alias(name) for i, name in enumerate(SHAPE)]
    found = df.select(*columns).toArrow()
    return np.column_stack([c.to_numpy() for c in found.columns]).astype(float)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    seen = materialize(shapes(docs), "quality")
    model = fit(seen, labels)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch.column("shape").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(SHAPE))
            score = model.score(x)
            predicted = pa.array((score >= GOOD_FROM).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), predicted],
                names=["doc_id", "held_out", "score", "predicted"],
            )

        return step

    return arrow_pass(seen, "doc_id long, held_out boolean, score double, predicted int", make)
