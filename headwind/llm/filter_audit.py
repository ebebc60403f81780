"""Interaction audit of document filters: a Gray-code walk over all subsets of five filters.

Every document fails some of the filters; that is a mask of five bits, so a part of the corpus is 32
cells of counts, however large it is. A walk in Gray-code order toggles one filter at a time. Each
cell has a counter of the active filters that it fails; when a counter leaves 0 the cell's documents
leave the running survivors, and when it comes back to 0 they return. The 32 states so found answer
every order of the filters: what a step removes is the difference of two states.

The texts are read once and never shuffled; for equal texts their digests of 128 bits are, which are
taken for the text itself. A digest that many documents share meets one row of the first ids, in a
join whose other side Spark may split.

Defined cases: null text is empty; a null part is the empty string. A document without doc_id equals
no smaller one and has no label, and makes no other document a copy. Rows that share doc_id and text
are counted each on its own and are not copies of each other. A document is good (toxic) if any of
its labels says so. Without documents there are no parts and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.texts import Batches, arrow_pass, slices

FILTERS = "ABCDE"
_MASKS = 1 << len(FILTERS)
#: fixed values: what filters C and D look for
_UPPER, _SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
_COUNTS = ("n", "good", "toxic")
_RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def failures(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    upper = len(data) - len(data.translate(None, _UPPER))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    failed = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text), symbols > 0)
    return sum(bit << i for i, bit in enumerate(failed))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, the mask of filters A to D, and the digest of the text; one pass, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            masks = pa.array(map(failures, texts), pa.int32())
            digests = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            columns = [batch.column("doc_id"), batch.column("part"), masks, pa.array(digests, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])

        return step

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    return arrow_pass(narrow, "doc_id long, part string, mask int, digest binary", make)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of all five filters that they fail."""
    rows = measured(docs)
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = first.filter("first < last").select("digest", "first")
    is_copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    known = (
        labels.filter("quality = 1 or toxic = 1")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*(F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    )
    # neither side has a bound on its size, so no join may broadcast one on a guess
    marked = rows.join(copied.hint("merge"), "digest", "left").withColumn(
        "mask", F.col("mask") + F.when(is_copy, 1 << FILTERS.index("E")).otherwise(0)
    )
    return (
        marked.select("doc_id", "part", "mask")
        .join(known.hint("merge"), "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS[1:]))
    )


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors for every subset of active filters, as (subset, part, count), from (part, mask, count)."""
    masks = np.arange(_MASKS)
    states = np.zeros((_MASKS, len(counts), counts.shape[2]), dtype=np.int64)
    active = np.zeros(_MASKS, dtype=np.int64)
    survivors = counts.sum(axis=1)
    states[0] = survivors
    subset = 0
    for i in range(1, _MASKS):
        code = i ^ (i >> 1)
        bit, subset = code ^ subset, code
        failing = (masks & bit) > 0
        if code & bit:
            survivors = survivors - counts[:, failing & (active == 0)].sum(axis=1)
            active += failing
        else:
            active -= failing
            survivors = survivors + counts[:, failing & (active == 0)].sum(axis=1)
        states[code] = survivors
    return states


def _orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders in words; for each order and step the filter, and the subset active before it."""
    orders = list(permutations(range(len(FILTERS))))
    chosen = np.array(orders)
    before = np.cumsum(1 << chosen, axis=1) - (1 << chosen)
    return ["".join(FILTERS[i] for i in o) for o in orders], chosen, before


def audited(parts: list[str], counts: np.ndarray) -> pa.RecordBatch:
    """All orders and steps of some parts, from their cells."""
    states = walk(counts)
    names, chosen, before = _orders()
    after = before | (1 << chosen)
    kept, lost = states[after], states[before] - states[after]  # order, step, part, count
    everything, size = _MASKS - 1, len(FILTERS)
    fails = np.array([states[0] - states[1 << i] for i in range(size)])[..., 0]
    unique = np.array([states[everything ^ (1 << i)] - states[everything] for i in range(size)])[..., 0]
    # each subset without filter i stands before it in as many orders as there are ways to place the rest
    shapley = np.zeros((size, len(parts)), dtype=np.int64)
    for i in range(size):
        for subset in (s for s in range(_MASKS) if not s >> i & 1):
            k = subset.bit_count()
            ways = factorial(k) * factorial(size - 1 - k)
            shapley[i] += ways * (states[subset] - states[subset | 1 << i])[:, 0]
    values = [kept[..., 0], lost[..., 0], fails[chosen] - lost[..., 0], unique[chosen], lost[..., 1], lost[..., 2], shapley[chosen]]
    n_orders, n = len(names), len(parts)
    columns = [
        pa.array(np.tile(np.array(parts, dtype=object), n_orders * size), pa.string()),
        pa.array(np.repeat(np.array(names, dtype=object), size * n), pa.string()),
        pa.array(np.tile(np.repeat(np.arange(1, size + 1, dtype=np.int32), n), n_orders)),
        *(pa.array(v.ravel()) for v in values),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters, and step."""
    # at most 32 cells for each part
    by_part = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", *_COUNTS)).alias("cells"))

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, 64):
            counts = np.zeros((batch.num_rows, _MASKS, len(_COUNTS)), dtype=np.int64)
            for i, found in enumerate(batch.column("cells").to_pylist()):
                for cell in found:
                    counts[i, cell["mask"]] = [cell[c] for c in _COUNTS]
            yield audited(batch.column("part").to_pylist(), counts)

    return by_part.mapInArrow(run, _RESULT)


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
failed AS (
  SELECT doc_id, part,
         [len(words) < 200,
          100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM words),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f)
  JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (
  SELECT part, filter_order, step, n, good, toxic, fails,
         fails[strpos('ABCDE', substr(filter_order, step, 1))] AS here,
         len(list_filter(range(1, step), lambda i: fails[strpos('ABCDE', substr(filter_order, i::INTEGER, 1))])) > 0 AS gone
  FROM cells, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
sums AS (
  SELECT part, filter_order, step,
         coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (here AND len(list_filter(fails, lambda x: x)) = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (here AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (here AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley
FROM sums
"""
