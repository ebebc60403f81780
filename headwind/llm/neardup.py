"""Near-duplicates by fast similarity sketching, banding, and exact verification.

A sketch has 128 coordinates. In round i every shingle is thrown into one bin with the value
(i, hash); a bin keeps its least value. From round 128 on, round 128 + b throws every shingle into
bin b, so each coordinate fills after 256 rounds at the latest, usually after two or three. Two
sketches agree in a coordinate with a chance near their Jaccard similarity, and the number of
agreements concentrates as with independent permutations. 32 bands of 4 coordinates miss a pair of
similarity 0.85 with a chance of 6e-11, one of 0.8 with 5e-8.

Links are found without pairing up whole groups, and lose no pair that shares a bucket:

1. Equal shingle sets form classes; only the least doc_id of a class goes on.
2. Every member of a bucket is compared with the bucket's least member on full shingle sets. That
   gives links and, for every member, its distance to that pivot.
3. Twice, members outside a bucket's largest component are compared with a member of it, drawn by
   hash. This only joins components early, so that little is left for the next step.
4. Members of a bucket that are not yet in one component are compared with each other in blocks of
   bounded size, but only where their distances to the pivot differ by no more than the greatest
   distance of a link: by the triangle inequality of the Jaccard distance no other pair can be
   linked. A pair that shares several buckets is looked at in the first of them. Pairs inside a
   component are never looked at, and only those that may be linked become rows.
   In steps 3 and 4 a pair goes on to its full sets only if its long sketches allow a link: one bit
   of each of 2048 coordinates, of which a linked pair differs in more than the limit with a chance
   of about 1e-9 (six standard deviations).
5. Components by alternating star contraction, each round written to the shared folder.

Shingles are 64-bit hashes of word sequences; sets are compared on these, whole.

Defined cases: null text, or one without words, has no shingles and is linked with nothing. Texts
shorter than a shingle are one shingle. Rows that share a doc_id are one document. A row without
doc_id gets the component of its class, if other rows have ids, and is never a representative.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.llm.texts import arrow_pass, lower_words, with_row_key
from headwind.session import materialize, settled

_BINS, _BANDS = 128, 32
_TURNS = 2
_LONG = 16  # sketches in a long sketch
#: members of a bucket that are compared together, how many of them with all others at once, and by how
#: many hash values small buckets are gathered
_BLOCK, _STRIP, _SHELVES = 1024, 128, 4096
_ROWS = _BINS // _BANDS
_FOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SEEDS = np.random.default_rng(20170401).integers(1, 1 << 63, 2 * _BINS, dtype=np.uint64)
_ROUND, _DROP, _HALF = np.uint64(56), np.uint64(8), np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def shingles(text: str, size: int) -> np.ndarray:
    """Distinct hashes of the runs of `size` lower-cased words."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    size = min(size, len(h))
    n = len(h) - size + 1
    total = h[:n]
    for i in range(1, size):
        total = _mixed(total) * _FOLD + h[i : i + n]
    return np.unique(_mixed(total))


def sketch(x: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes that is not empty."""
    empty = np.iinfo(np.uint64).max
    filled = np.full(_BINS, empty, dtype=np.uint64)
    # enough rounds at once that most sets need one step
    step = max(1, -(-5 * _BINS // len(x)))
    for first in range(0, 2 * _BINS, step):
        rounds = np.arange(first, min(first + step, 2 * _BINS), dtype=np.uint64)
        h = _mixed(x[None, :] ^ _SEEDS[rounds.astype(int), None])
        bins = np.where(rounds[:, None] < _BINS, h % np.uint64(_BINS), rounds[:, None] % np.uint64(_BINS)).ravel()
        value = ((rounds[:, None] << _ROUND) | (h >> _DROP)).ravel()
        order = np.argsort(value)[::-1]
        best = np.full(_BINS, empty, dtype=np.uint64)
        best[bins[order].astype(int)] = value[order]  # the last write, the least value, stays
        filled = np.minimum(filled, best)
        if filled.max() != empty:
            break
    return filled


def bands(x: np.ndarray) -> np.ndarray:
    parts = sketch(x).reshape(_BANDS, _ROWS)
    key = _SEEDS[:_BANDS].copy()
    for i in range(_ROWS):
        key = _mixed(key * _FOLD + parts[:, i])
    return key.view(np.int64)


def long_bits(x: np.ndarray) -> np.ndarray:
    """One bit of each coordinate of several sketches, 64 to a number."""
    # the lowest bit of a value has no part in the choice of bins or of least values
    low = [sketch(_mixed(x ^ seed)) & np.uint64(1) for seed in _SEEDS[-_LONG:]]
    return np.packbits(np.concatenate(low).astype(np.uint8)).view(np.int64)


def _most_bits(percent: int) -> int:
    """In how many bits the long sketches of two sets of that similarity differ at most."""
    n, p = _LONG * _BINS, (1 - percent / 100) / 2
    return int(np.ceil(n * p + 6 * np.sqrt(n * p * (1 - p))))


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether two long sketches allow a similarity of `percent`."""
    n, limit = _LONG * _BINS, _most_bits(percent)
    differ = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(n // 64)]
    return reduce(add, differ) <= limit


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _longs(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *arrays]) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, number of shingles, digest of the set (a, b), and its bands; one pass, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                x = shingles(text or "", size)
                counts.append(len(x))
                digests.append((_mixed(x).sum(dtype=np.uint64), _mixed(x ^ _FOLD).sum(dtype=np.uint64)))
                keys.append(bands(x) if len(x) else np.zeros(0, dtype=np.int64))
            a, b = np.array(digests, dtype=np.uint64).view(np.int64).T
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(a), pa.array(b), _longs(keys)],
                names=["doc_id", "n_shingles", "a", "b", "bands"],
            )

        return step

    return arrow_pass(_texts(docs), "doc_id long, n_shingles long, a long, b long, bands array<long>", make)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and the whole set of shingle hashes."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t or "", size).view(np.int64) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), _longs(sets)], names=["doc_id", "shingles"])

        return step

    return arrow_pass(docs, "doc_id long, shingles array<long>", make)


def long_sketches(sets: DataFrame) -> DataFrame:
    """id and long sketch of sets that are not empty."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = batch.column("shingles")
            flat, ends = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum([0, *map(len, sets)])
            found = [long_bits(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), _longs(found)], names=["id", "bits"])

        return step

    return arrow_pass(sets.filter(F.size("shingles") > 0), "id long, bits array<long>", make, rows=256)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) with the sizes of their sets' intersection and union."""
    left = sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("shingles").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    return (
        pairs.join(left, "x")
        .join(right, "y")
        .select("x", "y", both.alias("common"), (F.size("sx") + F.size("sy")).alias("sizes"))
        .withColumn("all", F.col("sizes") - F.col("common"))
        .select("x", "y", "common", "all")
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id but the roots: the least id that it reaches.

    Large-star and small-star steps in turn: neighbours are joined to the least neighbour. Sums and
    minima combine before the shuffle, and the joins' other side has one row per id.
    """
    edges = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct()
    edges = materialize(edges, "components")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(roots, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(moved.unionByName(roots.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _split(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with the bucket's major one."""
    rows = buckets.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows"))
    split = sizes.groupBy("key").agg(F.max(F.struct("rows", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
    return rows.join(split.filter("roots > 1").select("key", F.col("top.root").alias("major")), "key")


def _to_major(buckets: DataFrame, roots: DataFrame, bits: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each member outside its bucket's major component, with one member of that, drawn by hash.

    A member lies in many buckets, so it meets many members of a large component; at most 32 each.
    """
    rows = _split(buckets, roots)
    drawn = F.min(F.struct(F.xxhash64("key", "id", F.lit(turn)), "id")).getField("id")
    chosen = rows.filter("root = major").groupBy("key").agg(drawn.alias("x"))
    pairs = rows.filter("root <> major").join(chosen, "key").select("x", F.col("id").alias("y")).distinct()
    left, right = (bits.select(F.col("id").alias(c), F.col("bits").alias(f"bits_{c}")) for c in "xy")
    return pairs.join(left, "x").join(right, "y").filter(_alike("bits_x", "bits_y", percent)).select("x", "y")


def _pairs_in(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a meeting's rows that are in one bucket, in different components, and may be linked.

    A pair that shares several buckets comes out of the first of them only.
    """
    of = {c: rows.column(c).to_numpy() for c in ("id", "n", "root", "far", "key", "block", "first", "second")}
    bits, bands = (np.asarray(rows.column(c).combine_chunks().flatten()).reshape(rows.num_rows, -1) for c in ("bits", "bands"))
    width, limit = 1 - percent / 100 + 1e-9, _most_bits(percent)
    order = np.argsort(of["key"], kind="stable")
    borders = np.flatnonzero(np.diff(of["key"][order])) + 1
    found = [np.zeros((2, 0), dtype=np.int64)]
    for own in np.split(order, borders):
        upper, lower = own[of["block"][own] == of["first"][own]], own[of["block"][own] == of["second"][own]]
        for at in range(0, len(upper), _STRIP):
            x, y = np.meshgrid(upper[at : at + _STRIP], lower, indexing="ij")
            x, y = x.ravel(), y.ravel()
            within = of["first"][x] == of["second"][x]
            small, large = np.minimum(of["n"][x], of["n"][y]), np.maximum(of["n"][x], of["n"][y])
            open_ = (of["root"][x] != of["root"][y]) & (~within | (of["id"][x] < of["id"][y]))
            open_ &= (np.abs(of["far"][x] - of["far"][y]) <= width) & (100 * small >= percent * large)
            x, y = x[open_], y[open_]
            near = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64) <= limit
            x, y = x[near], y[near]
            shared = (bands[x] == bands[y]).argmax(1)
            found.append(np.array([x, y])[:, bands[x, shared] == of["key"][x]])
    x, y = np.concatenate(found, axis=1)
    return of["id"][x], of["id"][y]


def _left_over(buckets: DataFrame, roots: DataFrame, open_: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's members in different components that the pivot's distances and the long
    sketches leave open.

    The members of a large bucket are dealt to blocks, and every two blocks meet in a task of bounded
    size; small buckets share a meeting. Pairs that are ruled out never become rows.
    """
    to_pivot = seen.select(F.col("x").alias("pivot"), F.col("y").alias("id"), (1 - F.col("common") / F.col("all")).alias("far"))
    rows = _split(buckets, roots).join(to_pivot, ["pivot", "id"], "left")  # the pivot itself is not there: distance 0
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))
    block, blocks, other = F.col("block"), F.col("blocks"), F.col("other")
    dealt = (
        rows.join(sizes, "key")
        .join(open_, "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        # buckets of one block are gathered by hash, about _BLOCK rows together
        .withColumn("meeting", F.when(blocks == 1, F.pmod(F.xxhash64("key"), F.lit(_SHELVES))).otherwise(F.col("key")))
        .select(
            "id", "n", "root", F.coalesce("far", F.lit(0.0)).alias("far"), "bits", "bands", "key", "block",
            F.least(block, other).alias("first"), F.greatest(block, other).alias("second"), "meeting", (blocks == 1).alias("small"),
        )
    )

    def met(rows: pa.Table) -> pa.Table:
        x, y = _pairs_in(rows, percent)
        return pa.table([np.minimum(x, y), np.maximum(x, y)], names=["x", "y"])

    return dealt.groupBy("small", "meeting", "first", "second").applyInArrow(met, "x long, y long")


def group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (it is its component's least id).

    Links: 100 * intersection >= percent * union of the sets of `size`-word shingles.
    """
    return settled(docs.sparkSession, lambda: _grouped(docs, size, percent), "neardup")


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    marks = materialize(sketched(docs, size), "neardup")
    key = ["n_shingles", "a", "b"]
    classes = marks.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    members = materialize(marks.drop("bands").join(classes, key, "left").select("doc_id", "n_shingles", "rep"), "neardup")

    shown = marks.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *key])
    banded = shown.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    pivots = banded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    buckets = materialize(banded.join(pivots.drop("last"), "key"), "neardup")

    wanted = buckets.select(F.col("id").alias("doc_id")).distinct()
    sets = materialize(full_sets(_texts(docs).join(wanted, "doc_id", "left_semi"), size), "neardup")
    linked = F.expr(f"100L * common >= {percent}L * `all`")
    stars = buckets.filter("id <> pivot").select(F.col("pivot").alias("x"), F.col("id").alias("y")).distinct()
    seen = materialize(compared(stars, sets), "neardup")
    links = seen.filter(linked).select("x", "y")
    roots = components(links)
    # components only grow, so no other document can be in a divided bucket later on
    open_ = _split(buckets, roots).select(F.col("id").alias("doc_id")).distinct()
    bits = materialize(long_sketches(sets.join(open_, "doc_id", "left_semi")), "neardup")
    banded_bits = bits.join(shown.select(F.col("doc_id").alias("id"), "bands"), "id")
    for turn in range(_TURNS):
        tried = compared(_to_major(buckets, roots, bits, percent, turn), sets).filter(linked).select("x", "y")
        links = links.unionByName(materialize(tried, "neardup"))
        roots = components(links)
    left = materialize(_left_over(buckets, roots, banded_bits, seen, percent), "neardup")
    rest = compared(left, sets).filter(linked).select("x", "y")
    roots = components(links.unionByName(rest))

    found = members.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def keep(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each group left, all columns unchanged.

    Rows are grouped by their texts alone, whatever their doc_id; the least doc_id stays, one that is
    null only if there is no other. Rows without words stay, but of those equal in doc_id and text one.
    """
    rows = with_row_key(docs, "neardup")
    grouped = group(rows.select(F.col("__row").alias("doc_id"), "text"), size, percent)
    groups = grouped.select(F.col("doc_id").alias("__row"), "n_shingles", "component_id")
    blank = F.col("n_shingles") == 0
    named = groups.join(rows.select("__row", "doc_id", "text"), "__row").select(
        "__row",
        "doc_id",
        F.when(blank & F.col("doc_id").isNotNull(), F.lit(None)).otherwise(F.col("component_id")).alias("component"),
        F.when(blank, F.col("doc_id")).alias("id"),
        F.when(blank, F.col("text")).alias("words"),
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    left = named.groupBy("component", "id", "words").agg(least.getField("__row").alias("__row")).select("__row")
    return rows.join(left, "__row", "left_semi").select(*docs.columns)
