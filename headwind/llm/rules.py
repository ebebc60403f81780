"""Quality rules: base rules on text statistics, and an isolation forest on the same statistics.

The forest is fitted on about `trees * subsample` rows labelled good, chosen by the hash of their id (a
documented bound; a tree never sees more than `subsample` rows by definition of the method). It
splits on all 16 rates, in widths of the range where good rows lie, and on a document's three
greatest excesses over these ranges, so that one odd statistic is enough. The rejection threshold is
calibrated on all labelled rows. Everything else covers all documents.

Defined cases: null text is the empty text and fails the base rules. Without labels, or without a
row labelled good, nothing is an anomaly. Repeated rows are judged alike, each on its own. A null
doc_id never matches a label. Columns beyond doc_id and text are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.sampling import hashed_sample
from headwind.llm.texts import BASE, SHAPE, arrow_pass, statistics
from headwind.session import materialize

#: of the forest's features, how many are a document's greatest excesses over what good rows show
_EXCESSES = 3
#: share of good rows beyond either end of a statistic's usual range, and its least width
_BEYOND, _NARROWEST = 0.001, 0.05
_STATS = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, shape array<double>"
_GRID = 1000  # scores are counted in thousandths for the calibration


def _measured(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BASE, base_failed and SHAPE of each text."""
    both = [statistics(t or "") for t in texts.to_pylist()]
    base = np.array([b for b, _ in both], dtype=np.int64).reshape(-1, len(BASE))
    shape = np.array([s for _, s in both], dtype=np.float64).reshape(-1, len(SHAPE))
    n, repeats = base[:, 0], base[:, 4]
    return base, (n < 50) | (100 * repeats > 50 * n), shape


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed and the shape of the text; one pass, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            base, failed, shape = _measured(batch.column("text"))
            flat = pa.array(shape.ravel())
            ends = pa.array(np.arange(0, shape.size + 1, len(SHAPE), dtype=np.int32))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in base.T), pa.array(failed), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", *BASE, "base_failed", "shape"],
            )

        return step

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _STATS, make)


@dataclass(frozen=True)
class Scale:
    """Where good rows usually lie, for each statistic of SHAPE."""

    middle: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def features(self, shape: np.ndarray) -> np.ndarray:
        """Each statistic in widths of its usual range, and the greatest excesses beyond these ranges.

        Logarithms keep the far ends apart without letting them stretch the range that cuts fall in.
        """
        width = np.maximum(self.high - self.low, _NARROWEST)
        off = (shape - self.middle) / width
        beyond = np.maximum(np.maximum(shape - self.high, self.low - shape), 0) / width
        most = -np.sort(-beyond, axis=1)[:, :_EXCESSES]
        return np.concatenate([np.sign(off) * np.log1p(np.abs(off)), np.log1p(most)], axis=1)


def scale_of(shape: np.ndarray) -> Scale:
    if not len(shape):
        shape = np.zeros((1, len(SHAPE)))
    low, middle, high = np.quantile(shape, [_BEYOND, 0.5, 1 - _BEYOND], axis=0)
    return Scale(middle, low, high)


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: feature (-1: leaf), cut, first child, path length at a leaf."""

    scale: Scale

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    usual: float
    threshold: float = 2.0

    def score(self, shape: np.ndarray) -> np.ndarray:
        """2^(-mean path / usual path): near 1 for rows that few random splits isolate."""
        if not len(self.roots) or not len(shape):
            return np.zeros(len(shape))
        x = self.scale.features(shape)
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                here = at[inner]
                right = x[inner, self.feature[here]] >= self.cut[here]
                at[inner] = self.child[here] + right
            total += self.path[at]
        return np.exp2(-total / len(self.roots) / self.usual)


def _usual_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.maximum(0, n - 1))


def grow(shape: np.ndarray, trees: int, subsample: int, seed: int) -> Forest:
    """Isolation trees on the features of good rows: a random feature, cut at random in the range of the
    node's rows or as far again beyond it. A cut beyond leaves one side empty, a leaf that only rows
    unlike these reach, and by a short path."""
    rng = np.random.default_rng(seed)
    scale = scale_of(shape)
    rows = scale.features(shape) if len(shape) else np.zeros((0, len(SHAPE) + _EXCESSES))
    feature, cut, child, path, roots = [], [], [], [], []

    def new() -> int:
        for values, empty in ((feature, -1), (cut, 0.0), (child, 0), (path, 0.0)):
            values.append(empty)
        return len(feature) - 1

    # half of the splits look at the excesses, and half of these at the greatest
    chance = np.full(rows.shape[1], 0.5 / len(SHAPE))
    chance[len(SHAPE) :] = 0.25 / (_EXCESSES - 1)
    chance[len(SHAPE)] = 0.25
    size = min(subsample, len(rows))
    limit = int(np.ceil(np.log2(max(2, size))))
    for _ in range(trees if size > 1 else 0):
        roots.append(new())
        todo = [(roots[-1], rows[rng.choice(len(rows), size, replace=False)], 0)]
        while todo:
            node, part, depth = todo.pop()
            if depth >= limit or len(part) < 2:
                path[node] = depth + float(_usual_path(len(part)))
                continue
            f = int(rng.choice(rows.shape[1], p=chance))
            low, high = part[:, f].min(), part[:, f].max()
            reach = max(high - low, _NARROWEST)
            at = low - reach / 2 + rng.random() * (high - low + reach)
            right = part[:, f] >= at
            feature[node], cut[node], child[node] = f, at, new()
            new()
            todo += [(child[node], part[~right], depth + 1), (child[node] + 1, part[right], depth + 1)]
    return Forest(scale, *(np.array(v) for v in (feature, cut, child, path, roots)), float(_usual_path(max(2, size))))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """The statistics with `anomaly` and `kept`."""
    names = [*BASE, "base_failed"]
    schema = f"{_STATS.rsplit(',', 1)[0]}, anomaly double, kept boolean"

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch.column("shape").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(SHAPE))
            anomaly = forest.score(x)
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False)
            kept = ~failed & (anomaly <= forest.threshold)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in names), pa.array(anomaly), pa.array(kept)],
                names=["doc_id", *names, "anomaly", "kept"],
            )

        return step

    return arrow_pass(stats, schema, make)


def fit(
    stats: DataFrame,
    labels: DataFrame,
    trees: int = 100,
    subsample: int = 256,
    keep_good: float = 0.998,
    seed: int = 7,
) -> Forest:
    """Grows the forest on rows labelled good that pass the base rules and calibrates its threshold on
    all labelled rows that pass them.

    The threshold lies a quarter of the way from the least one that keeps `keep_good` of all such rows
    labelled good to the greatest one that lets no more bad rows pass than that. The driver sees about
    `trees * subsample` rows of features and one count per score step and label.
    """
    known = labels.filter("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    passed = stats.filter("not base_failed")
    seen = materialize(passed.join(known, "doc_id"), "rules")
    rows = hashed_sample(seen.filter("quality = 1"), "doc_id", trees * subsample, seed).select("shape").collect()
    forest = grow(np.array([r[0] for r in rows], dtype=float).reshape(-1, len(SHAPE)), trees, subsample, seed)
    counts = np.zeros((2, _GRID + 1))
    for good in (0, 1):
        part = scored(seen.filter(F.col("quality") == good).drop("quality"), forest)
        for r in part.groupBy(F.ceil(F.col("anomaly") * _GRID).cast("int").alias("step")).count().collect():
            counts[good, r["step"]] = r["count"]
    bad, good = counts.cumsum(1)
    if not good[-1] or not len(forest.roots):
        return forest
    low = int(np.argmax(good >= keep_good * good[-1]))
    high = int(np.flatnonzero(bad == bad[low])[-1])
    return replace(forest, threshold=(3 * low + high) / 4 / _GRID)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the statistics, base_failed, anomaly and kept."""
    stats = materialize(measure(docs), "rules")
    return scored(stats, fit(stats, labels))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns unchanged. A second pass, but no text is shuffled."""
    forest = fit(materialize(measure(docs), "rules"), labels)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            _, failed, shape = _measured(batch.column("text"))
            return batch.filter(pa.array(~failed & (forest.score(shape) <= forest.threshold)))

        return step

    return arrow_pass(docs, docs.schema, make)
