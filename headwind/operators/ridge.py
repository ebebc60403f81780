"""The linear model with a square penalty solved exactly, from sums of products.

All products of inputs and label are summed in one pass, by combination of categories. A category's
0/1 input times another input is that input on the rows of the category, so these sums hold all that
the normal equations need, for any penalty and any set of inputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwind.operators.models import CATEGORICAL, CHANGE, NUMERIC

ONE, UNKNOWN, INTERCEPT = "one", "__unknown", "intercept"


def moment_sums(
    df: DataFrame, inputs: Sequence[str] = NUMERIC, label: str = CHANGE, by: Sequence[str] = CATEGORICAL
) -> DataFrame:
    """Rows (*by, left, right, total): the sum of left * right, each pair once; `one` is always 1.

    Each task multiplies its rows batch by batch and hands on its sums for each combination of categories;
    these few rows are added up. Rows have to be complete (`models.scorable`); a missing category is one
    of its own.
    """
    names = (ONE, *inputs, label)
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    left, right = ([p[i] for p in pairs] for i in (0, 1))
    rows = df.select(*by, F.lit(1.0).alias(ONE), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values = np.column_stack([batch.column(c).to_numpy() for c in names])
            group = np.zeros(batch.num_rows, dtype=np.int64)
            for c in by:
                codes = batch.column(c).dictionary_encode("encode")
                group = group * len(codes.dictionary) + codes.indices.to_numpy()
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                key = tuple(batch.column(c)[int(at[0])].as_py() for c in by)
                # not a matrix product of numpy: its own threads would compete with the other tasks
                found[key] = found.get(key, 0.0) + np.einsum("ni,nj->ij", values[at], values[at])
        if not found:
            return
        columns = [pa.array([k[i] for k in found], batch.schema.field(c).type) for i, c in enumerate(by)]
        totals = pa.array([m[left, right].tolist() for m in found.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*columns, totals], names=[*by, "totals"])

    fields = [T.StructField(c, df.schema[c].dataType) for c in by]
    sums = rows.mapInArrow(run, T.StructType([*fields, T.StructField("totals", T.ArrayType(T.DoubleType()))]))
    named = F.array(*[F.struct(F.lit(names[a]).alias("left"), F.lit(names[b]).alias("right")) for a, b in pairs])
    pair = F.inline(F.arrays_zip(named.alias("named"), F.col("totals").alias("part")))
    return sums.select(*by, pair).select(*by, "named.*", "part").groupBy(*by, "left", "right").agg(F.sum("part").alias("total"))


def solve(
    moments: DataFrame,
    reg_param: float,
    inputs: Sequence[str] = NUMERIC,
    label: str = CHANGE,
    by: Sequence[str] = CATEGORICAL,
) -> dict[str, float]:
    """Coefficients by name (`input`, `category=name`, `intercept`) of the penalised least squares fit.

    Inputs and label are scaled by their standard deviations, as the iterative fit does; an input that
    never varies gets 0. The driver reads some hundred numbers for each combination of categories and
    solves one system with a row for each input and name: bounded by the names, whatever the rows.
    Without rows there is only an intercept of 0.
    """
    found: dict[tuple, dict[tuple, float]] = {}
    for *names, left, right, total in moments.select(*by, "left", "right", "total").collect():
        sums = found.setdefault(tuple(names), {})
        sums[left, right] = sums[right, left] = total
    labels = {f"{c}={UNKNOWN if g[i] is None else g[i]}" for g in found for i, c in enumerate(by)}
    names = [*inputs, *sorted(labels)]
    at = {name: i for i, name in enumerate(names)}
    columns = [*inputs, label]
    products, firsts, ys = np.zeros((len(names) + 1,) * 2), np.zeros(len(names) + 1), len(names)
    n = 0.0
    for group, sums in found.items():
        marks = [at[f"{c}={UNKNOWN if g is None else g}"] for c, g in zip(by, group, strict=True)]
        place = [*(at[c] for c in inputs), ys]
        once = np.array([sums[ONE, c] for c in columns])
        products[np.ix_(place, place)] += [[sums[a, b] for b in columns] for a in columns]
        firsts[place] += once
        size = sums[ONE, ONE]
        n += size
        for m in marks:
            firsts[m] += size
            products[m, place] += once
            products[place, m] += once
            products[m, marks] += size
    if not n:
        return {INTERCEPT: 0.0}
    mean = firsts / n
    spread = products / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    # of a constant input only rounding is left
    varies = scale > 1e-9 * np.maximum(1.0, np.abs(mean))
    out = np.zeros(len(names))
    if varies[ys]:
        use = np.flatnonzero(varies[:ys])
        a = spread[np.ix_(use, use)] / np.outer(scale[use], scale[use]) + reg_param / scale[ys] * np.eye(len(use))
        b = spread[use, ys] / (scale[use] * scale[ys])
        # least squares: without a penalty the inputs of a category add up to a constant
        out[use] = np.linalg.lstsq(a, b, rcond=None)[0] * scale[ys] / scale[use]
    return {**dict(zip(names, map(float, out), strict=True)), INTERCEPT: float(mean[ys] - out @ mean[:ys])}


def coefficients_of(model: PipelineModel) -> dict[str, float]:
    """The coefficients of a fitted linear pipeline, named as those of `solve`; zeros of unknown names left out."""
    index, *_, learner = model.stages
    names = list(NUMERIC)
    for c, known in zip(CATEGORICAL, index.labelsArray, strict=True):
        names += [f"{c}={k}" for k in (*known, UNKNOWN)]
    found = dict(zip(names, learner.coefficients.toArray().tolist(), strict=True))
    kept = {k: v for k, v in found.items() if v or not k.endswith(f"={UNKNOWN}")}
    return {**kept, INTERCEPT: learner.intercept}
