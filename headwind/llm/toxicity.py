"""Toxicity by maximum-scoring segments over token log-odds.

1. Tokens are words and their prefixes, lower-cased and without outer punctuation. Their log-odds
   between toxic and clean labelled texts are smoothed by a Dirichlet prior from all labelled texts,
   and only those with a clearly positive z-value score; every other token has one small negative
   score, the log-odds of not being such a token.
2. A linear scan finds all maximal segments of a text (no part of one scores more than the whole,
   and none can be extended at a gain).
3. Segment scores are calibrated by the extreme-value law: scale from the root of the score
   distribution of clean texts, location from the best segments of clean texts. A text's evidence
   is the sum over its segments, where those that chance gives once or more count next to nothing,
   turned into a probability by logistic calibration on training rows. Passages reported are the
   segments that chance would give less than once.

The lexicon and the calibration are fitted on about `rows` labelled training rows (the documented
bound, chosen by hash of doc_id). Every document is scored by its whole text.

Defined cases: null or empty text has no evidence. Without labelled rows of both classes the score
is 0. A null doc_id is a training row without label. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.sampling import hashed_sample
from headwind.llm.texts import arrow_pass, remainder
from headwind.session import materialize

#: fixed values: the fold that is held out, and the score from which a text is predicted toxic
FOLDS, HELD_OUT, TOXIC_FROM = 5, 0, 0.5
_PREFIX = (4, 5, 6, 7, 8)
_EDGE = ".,;:!?\"'()[]{}<>|#$%&*-_/\\~^`=+"
_REMEMBER = 300_000


def forms(word: str) -> list[str]:
    """The word without outer punctuation, and its proper prefixes, marked by a star."""
    bare = word.lower().strip(_EDGE)
    return [bare, *(bare[:k] + "*" for k in _PREFIX if len(bare) > k)] if bare else []


def segments(hits: Iterable[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score); tokens between hits score `drift`.

    Only hits score above 0, so a segment starts and ends at one. Each open segment keeps the total
    before it and at its end; a new one absorbs those it can only gain from.
    """
    open_: list[tuple[int, int, float, float]] = []  # first, end, total before, total at the end
    total, at = 0.0, 0
    for place, score in hits:
        total += drift * (place - at)
        first, before = place, total
        total += score
        at = place + 1
        while True:
            k = len(open_) - 1
            while k >= 0 and open_[k][2] >= before:
                k -= 1
            if k < 0 or open_[k][3] >= total:
                break
            first, before = open_[k][0], open_[k][2]
            del open_[k:]
        open_.append((first, at, before, total))
    return [(first, end, total - before) for first, end, before, total in open_]


@dataclass
class Scanner:
    """Scores of tokens, and the calibration. Remembers the scores of words that it has met."""

    lexicon: dict[str, float]
    drift: float
    scale: float = 1.0
    location: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0
    _met: dict[str, float] = field(default_factory=dict)

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        met = self._met
        if len(met) > _REMEMBER:
            met.clear()
        scores = list(map(met.get, words))
        if None in scores:
            for w in {w for w, s in zip(words, scores, strict=True) if s is None}:
                met[w] = max((self.lexicon[f] for f in forms(w) if f in self.lexicon), default=0.0)
            scores = map(met.__getitem__, words)
        return [(i, s) for i, s in enumerate(scores) if s]

    def calibrated(self, text: str) -> list[tuple[int, int, float]]:
        """(first word, end, log of 1 / expected number by chance) of all maximal segments."""
        words = text.split()
        level = self.location + math.log(max(1, len(words)))
        return [(a, b, self.scale * s - level) for a, b, s in segments(self.hits(words), self.drift)]

    @staticmethod
    def total(found: list[tuple[int, int, float]]) -> float:
        """Evidence of a text: about the calibrated score of each significant segment, near 0 of others."""
        return sum(x[2] if x[2] > 30 else math.log1p(math.exp(x[2])) for x in found)

    def evidence(self, text: str) -> float:
        return self.total(self.calibrated(text))

    def score(self, text: str) -> float:
        g = self.slope * self.evidence(text) + self.intercept
        return 0.5 * (1 + math.tanh(g / 2))


def _counts(sample: DataFrame) -> DataFrame:
    """In how many toxic and clean texts of the sample each form occurs."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({f for w in set((text or "").split()) for f in forms(w)})
            both = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(both, pa.string()), *(pa.array([c[f] for f in both], pa.int64()) for c in seen)]
            return pa.RecordBatch.from_arrays(columns, names=["form", "clean", "toxic"])

        return step

    part = arrow_pass(sample.select("text", "toxic"), "form string, clean long, toxic long", make)
    return part.groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def lexicon(sample: DataFrame, least_z: float = 5.0, weight: float = 50.0) -> dict[str, float]:
    """Log-odds of the forms whose z-value, under the Dirichlet prior, is at least `least_z`.

    `weight` is the prior's size in texts. The result is bounded by the sample, not by the corpus.
    """
    per_class = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(per_class) < 2:
        return {}
    n = float(sum(per_class.values()))
    prior = weight * (F.col("clean") + F.col("toxic")) / n
    # a form in every text leaves none without it; one text in a hundred more keeps the odds finite
    without = lambda c, k: F.lit(1.01 * per_class[k] + weight) - F.col(c) - prior
    odds = lambda c, k: (F.col(c) + prior) / without(c, k)
    z = F.col("log_odds") / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    rows = (
        _counts(sample)
        .filter("toxic >= 3")
        .withColumn("log_odds", F.log(odds("toxic", 1)) - F.log(odds("clean", 0)))
        .filter(z >= least_z)
        .select("form", "log_odds")
        .collect()
    )
    return {r["form"]: r["log_odds"] for r in rows}


def _extreme_scale(scores: dict[float, float], drift: float) -> float:
    """The positive root of E[exp(root * score)] = 1 for a clean text's token."""
    rest = 1 - sum(scores.values())
    value = lambda x: sum(p * math.exp(x * s) for s, p in scores.items()) + rest * math.exp(x * drift) - 1
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def fit(docs: DataFrame, labels: DataFrame, rows: int = 20_000, seed: int = 3) -> Scanner:
    """Fits lexicon, drift and calibration on labelled training rows."""
    fold = remainder("doc_id", FOLDS)
    known = labels.filter("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
    chosen = materialize(hashed_sample(known.filter(fold != HELD_OUT), "doc_id", rows, seed), "toxicity")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # about `rows` rows of two numbers, so the side is bounded
    sample = materialize(texts.join(F.broadcast(chosen), "doc_id"), "toxicity")
    words = lexicon(sample)
    if not words:
        return Scanner({}, -1.0, intercept=-np.inf)
    rates = _rates(sample, Scanner(words, 0.0))
    total = {k: max(1, rates[k].pop(0.0, 0)) for k in (0, 1)}
    share = {k: sum(rates[k].values()) / total[k] for k in (0, 1)}
    drift = min(-1e-3, math.log1p(-min(0.5, share[1])) - math.log1p(-min(0.5, share[0])))
    # the extreme-value law needs clean texts to lose on average
    gained = sum(score * n for score, n in rates[0].items()) / total[0]
    drift = min(drift, -2 * gained)
    scale = _extreme_scale({s: n / total[0] for s, n in rates[0].items()} or {1.0: 1e-6}, drift)
    scanner = Scanner(words, drift, scale)
    best = _evidence(sample, scanner, best_only=True)
    clean = [x for x, toxic in best if not toxic]
    # moment estimate of the Gumbel location; texts without a hit have no best segment
    scanner.location = float(np.mean(clean) - np.euler_gamma) if clean else 0.0
    scanner.slope, scanner.intercept = _logistic(_evidence(sample, scanner, best_only=False))
    return scanner


def _rates(sample: DataFrame, scanner: Scanner) -> dict[int, Counter]:
    """Number of tokens by score and class; all tokens under score 0."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or "").split()
                found[toxic, 0.0] += len(words)
                found.update((toxic, s) for _, s in scanner.hits(words))
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([s for _, s in keys], pa.float64()), pa.array([found[k] for k in keys], pa.int64())],
                names=["toxic", "score", "n"],
            )

        return step

    out: dict[int, Counter] = {0: Counter(), 1: Counter()}
    part = arrow_pass(sample.select("text", "toxic"), "toxic int, score double, n long", make)
    for r in part.groupBy("toxic", "score").agg(F.sum("n").alias("n")).collect():
        out[r["toxic"]][r["score"]] += r["n"]
    return out


def _evidence(sample: DataFrame, scanner: Scanner, best_only: bool) -> list[tuple[float, int]]:
    """Of each sampled text: its evidence, or scale * best segment - log(words) if it has a hit."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not best_only:
                    rows.append((scanner.evidence(text or ""), toxic))
                    continue
                words = (text or "").split()
                found = segments(scanner.hits(words), scanner.drift)
                if found:
                    rows.append((scanner.scale * max(s for *_, s in found) - math.log(len(words)), toxic))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, names=["x", "toxic"])

        return step

    return [tuple(r) for r in arrow_pass(sample.select("text", "toxic"), "x double, toxic int", make).collect()]


def _logistic(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a little ridge; the slope is not negative."""
    x = np.c_[[r[0] for r in rows], np.ones(len(rows))]
    y, w = np.array([r[1] for r in rows], dtype=float), np.zeros(2)
    for _ in range(50):
        p = 0.5 * (1 + np.tanh(x @ w / 2))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (y - p) - 1e-3 * w), -2, 2)
    return max(0.0, float(w[0])), float(w[1])


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_passages, passages (word spans)."""
    scanner = fit(docs, labels)
    schema = "doc_id long, held_out boolean, score double, predicted int, n_passages int, passages string"

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column("text").to_pylist():
                found = scanner.calibrated(text or "")
                g = scanner.slope * scanner.total(found) + scanner.intercept
                found = [x for x in found if x[2] > 0]
                score = 0.5 * (1 + math.tanh(g / 2))
                rows.append((score, int(score >= TOXIC_FROM), len(found), ",".join(f"{a}:{b}" for a, b, _ in found)))
            kinds = [pa.float64(), pa.int32(), pa.int32(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], names=["doc_id", "held_out", "score", "predicted", "n_passages", "passages"])

        return step

    held_out = remainder("doc_id", FOLDS) == HELD_OUT
    narrow = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"))
    return arrow_pass(narrow, schema, make)
