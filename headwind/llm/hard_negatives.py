"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings.

Index. A node has up to `fan` split points, and a row goes to the child of its nearest one, so siblings
are divided by hyperplanes. For each split point i and each child c the node stores the least and the
greatest distance from i to any row below c, and for each child the range of its rows' norms. The
split points are fitted on a bounded sample (`sample` rows, by hash); the ranges cover all rows, and
every row lies in one leaf.

Search. A window of inner products [low, high] is, with the norms of a subtree, an annulus of distances
around the anchor. By the triangle inequality each range puts the distance of every row below c
between bounds; where the bounds of all split points, intersected, miss the annuli of all of the
anchor's windows, c is eliminated. In the leaves that are left all rows are scored exactly, so the
result is exact, whatever the sample.

1. An anchor looks into its own leaf. The `positives`-th best score there bounds its window from below.
2. Positives: all leaves that this window leaves.
3. Negatives: all leaves that the windows [least * p, p] of its positives' scores p leave.

A leaf's rows are dealt to blocks and its askers to groups, of bounded sizes, and each block meets
each group in a task of its own; a block hands on the best few rows of each window only. So neither a
large leaf nor many copies of a vector come together in one task.

Components are taken as floor(scale * x); scores are their inner products, exact below 2^53. Shorter
vectors count as filled up with zeros. Rows with a null id, label or vector, or a null or non-finite
component, take no part. Rows that share an id are separate rows, but not each other's positives or
negatives. Without anchors, positives or fitting negatives there are no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwind.llm.sampling import hashed_sample
from headwind.llm.texts import arrow_pass
from headwind.session import materialize


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: a negative scores at least this share, in hundredths, of the positive, and at most as much
    least: int = 80
    fan: int = 8
    sample: int = 4096
    #: rows of the sample below which a node is not divided, and the greatest depth
    leaf_sample: int = 96
    depth: int = 4
    block: int = 4096
    group: int = 1024


@dataclass
class Node:
    points: np.ndarray  # split points, one a row
    children: list[Node | int]  # a node, or the number of a leaf
    id: int
    near: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [child, point]: least distance
    far: np.ndarray = field(default_factory=lambda: np.zeros(0))
    norms: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [child]: least and greatest norm


def _squares(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] + (points**2).sum(1) - 2 * x @ points.T


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_squares(x, points), 0))


def grow(sample: np.ndarray, settings: Settings) -> Node | int:
    """A tree without ranges. Split points are rows of the sample, each the farthest from those before."""
    numbers = {"leaf": 0, "node": 0}

    def number(kind: str) -> int:
        numbers[kind] += 1
        return numbers[kind] - 1

    def divide(rows: np.ndarray, depth: int) -> Node | int:
        if len(rows) <= settings.leaf_sample or depth == settings.depth:
            return number("leaf")
        chosen = [int(_squares(rows, rows.mean(0)[None])[:, 0].argmax())]
        gap = _squares(rows, rows[chosen])[:, 0]
        while len(chosen) < settings.fan and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _squares(rows, rows[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return number("leaf")
        points, id_ = rows[chosen], number("node")
        to = _squares(rows, points).argmin(1)
        return Node(points, [divide(rows[to == c], depth + 1) for c in range(len(chosen))], id_)

    return divide(sample, 0)


def _placed(tree: Node | int, x: np.ndarray, visit=None) -> np.ndarray:
    """The leaf of each row. `visit(node, child, distances, norms)` sees the rows of every child."""
    leaf = np.zeros(len(x), dtype=np.int64)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if not isinstance(node, Node):
            leaf[at] = node
            continue
        squares = _squares(x[at], node.points)
        to = squares.argmin(1)
        for c, child in enumerate(node.children):
            below = to == c
            if below.any():
                if visit:
                    visit(node, c, np.sqrt(np.maximum(squares[below], 0)), np.sqrt((x[at[below]] ** 2).sum(1)))
                todo.append((child, at[below]))
    return leaf


def _nodes(tree: Node | int) -> list[Node]:
    return [tree, *(n for c in tree.children for n in _nodes(c))] if isinstance(tree, Node) else []


def visited(tree: Node | int, asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(asker, leaf) of the leaves that ranges and norms do not rule out for any of an asker's windows.

    low and high: [asker, window]; a window without members has low above high.
    """
    askers, leaves = [], []
    todo = [(tree, np.arange(len(asked)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, Node):
            askers.append(at)
            leaves.append(np.full(len(at), node))
            continue
        to_point, own = _distances(asked[at], node.points), (asked[at] ** 2).sum(1)
        for c, child in enumerate(node.children):
            least, most = node.norms[c]
            if least > most:  # no rows
                continue
            # distances are rounded: a margin far above that, far below any difference between rows
            margin = 1e-6 * (1 + np.sqrt(own) + most)
            nearest = np.maximum(node.near[c] - to_point, to_point - node.far[c]).max(1) - margin
            farthest = (to_point + node.far[c]).min(1) + margin
            nearest = np.maximum(nearest, 0)
            top = (own + most**2 - nearest**2) / 2 + margin
            bottom = (own + least**2 - farthest**2) / 2 - margin
            meets = (low[at] <= high[at]) & (low[at] <= top[:, None]) & (high[at] >= bottom[:, None])
            todo.append((child, at[meets.any(1)]))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *askers]), np.concatenate([none, *leaves])


def _matrix(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of each component as a double, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(vectors), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def taking_part(embeddings: DataFrame) -> DataFrame:
    """deal (a key of the row's own), vec_id, label, vector of the rows that take part; written."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    rows = (
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
            F.col("embedding").alias("vector"),
        )
        .filter("vec_id is not null and label is not null and vector is not null")
        .filter(finite)
        .withColumn("deal", F.monotonically_increasing_id())
    )
    return materialize(rows, "negatives")


def _with_leaf(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("leaf", T.LongType())])


@dataclass(frozen=True)
class Index:
    tree: Node | int
    rows: DataFrame  # deal, vec_id, label, vector, leaf
    width: int


def index(embeddings: DataFrame, settings: Settings) -> Index:
    """Fits the tree on a sample, places all rows, and gives the tree the ranges of all rows."""
    rows = taking_part(embeddings)
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    # the sample is bounded, and so are the ranges: one row for each child and split point of the tree
    sample = hashed_sample(rows, "deal", settings.sample, 3).select("vector").toArrow().column(0).combine_chunks()
    tree = grow(_matrix(sample, settings.scale, width), settings)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            leaf = _placed(tree, _matrix(batch.column("vector"), settings.scale, width))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

        return step

    placed = materialize(arrow_pass(rows, _with_leaf(rows), make, settings.block), "negatives")

    def ranges():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []

            def visit(node: Node, child: int, distances: np.ndarray, norms: np.ndarray) -> None:
                for i in range(len(node.points)):
                    d = distances[:, i]
                    found.append((node.id, child, i, d.min(), d.max(), norms.min(), norms.max()))

            _placed(tree, _matrix(batch.column("vector"), settings.scale, width), visit)
            kinds = [pa.int32()] * 3 + [pa.float64()] * 4
            columns = zip(*found, strict=True) if found else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        return step

    names = ["node", "child", "point", "near", "far", "least", "most"]
    part = arrow_pass(placed.select("vector"), "node int, child int, point int, near double, far double, least double, most double", ranges, settings.block)
    own = part.groupBy("node", "child", "point").agg(F.min("near"), F.max("far"), F.min("least"), F.max("most")).collect()
    by_id = {n.id: n for n in _nodes(tree)}
    for node in by_id.values():
        size = len(node.points)
        node.near, node.far, node.norms = np.zeros((size, size)), np.zeros((size, size)), np.full((size, 2), (1.0, 0.0))
    for id_, child, point, near, far, least, most in own:
        node = by_id[id_]
        node.near[child, point], node.far[child, point], node.norms[child] = near, far, (least, most)
    return Index(tree, placed, width)


_FOUND = "ask long, key long, found long, found_id long, score long"


def _best(score: np.ndarray, fits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n best fitting scores of each row; of equal ones the first columns."""
    score = np.where(fits, score, -np.inf)
    if score.shape[1] > n:
        nth = np.partition(score, -n, axis=1)[:, -n]
        fits = fits & (score >= nth[:, None])
    row, column = np.nonzero(fits)
    order = np.lexsort((column, -score[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < n], column[rank < n]


def _met(index_: Index, visits: DataFrame, same_label: bool, n: int, settings: Settings) -> DataFrame:
    """(ask, key, found, found_id, score): the best n rows of every window in each block of the leaves.

    visits: the askers' columns with the leaf that each goes to.
    """
    spark = visits.sparkSession
    # one row for each leaf, of which the tree has a bounded number
    many = dict(index_.rows.groupBy("leaf").count().collect())
    asks = dict(visits.groupBy("leaf").count().collect())
    sizes = [(leaf, -(-many[leaf] // settings.block), -(-asks[leaf] // settings.group)) for leaf in asks if leaf in many]
    # one row a leaf: the tree bounds it, whatever the rows; without the hint Spark knows no size of it.
    # Two tables, as both sides of a co-group must not come from one
    plan = lambda: F.broadcast(spark.createDataFrame(sizes, "leaf long, blocks int, groups int"))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    meet = ["leaf", "block", "group"]
    here = index_.rows.join(plan(), "leaf").withColumn("block", dealt("deal", "blocks")).withColumn("group", every("groups"))
    there = visits.join(plan(), "leaf").withColumn("group", dealt("ask", "groups")).withColumn("block", every("blocks"))
    width, scale = index_.width, settings.scale

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], pa.int64())] * 5, names=["ask", "key", "found", "found_id", "score"])
        if not left.num_rows or not right.num_rows:
            return none
        right = right.sort_by([("vec_id", "ascending"), ("deal", "ascending")])
        a, x = (_matrix(t.column("vector").combine_chunks(), scale, width) for t in (left, right))
        of = lambda t, c: t.column(c).to_numpy()
        score = a @ x.T
        alike = of(left, "label")[:, None] == of(right, "label")
        open_ = (alike if same_label else ~alike) & (of(left, "vec_id")[:, None] != of(right, "vec_id"))
        keys, low, high = (left.column(c).to_pylist() for c in ("keys", "low", "high"))
        found = []
        for k in range(max(map(len, keys))):
            has = np.array([i for i, own in enumerate(keys) if len(own) > k], dtype=np.int64)
            own = lambda values, k=k, has=has: np.array([values[i][k] for i in has])[:, None]
            fits = open_[has] & (score[has] >= own(low)) & (score[has] <= own(high))
            row, column = _best(score[has], fits, n)
            found.append((has[row], own(keys)[:, 0][row], column))
        row, key, column = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table(
            [of(left, "ask")[row], key.astype(np.int64), of(right, "deal")[column], of(right, "vec_id")[column], score[row, column].astype(np.int64)],
            names=none.schema.names,
        )

    return there.groupBy(*meet).cogroup(here.groupBy(*meet)).applyInArrow(scored, _FOUND)


def _first(found: DataFrame, n: int) -> DataFrame:
    """The best n rows of each window of all blocks, with their rank; cut before the shuffle as well."""
    order = Window.partitionBy("ask", "key").orderBy(F.desc("score"), "found_id", "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _going(index_: Index, asks: DataFrame, settings: Settings) -> DataFrame:
    """The askers' rows, one for each leaf that their windows leave."""
    tree, width, scale = index_.tree, index_.width, settings.scale

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            windows = batch.column("keys").to_pylist()
            most = max(map(len, windows), default=0)
            filled = lambda c, none: np.array([[*v, *[none] * (most - len(v))] for v in batch.column(c).to_pylist()]).reshape(-1, most)
            row, leaf = visited(tree, _matrix(batch.column("vector"), scale, width), filled("low", np.inf), filled("high", -np.inf))
            out = batch.take(pa.array(row))
            return pa.RecordBatch.from_arrays([*out.columns, pa.array(leaf, pa.int64())], names=[*batch.schema.names, "leaf"])

        return step

    columns = ["ask", "vec_id", "label", "vector", "keys", "low", "high"]
    narrow = asks.select(*columns)
    return arrow_pass(narrow, _with_leaf(narrow), make, settings.group)


def mine(embeddings: DataFrame, settings: Settings | None = None, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by `every`.
    """
    settings = settings or Settings()
    index_ = index(embeddings, settings)
    anchors = materialize(index_.rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("deal", "ask"), "negatives")
    array = lambda value: F.array(F.lit(value).cast("double"))
    one = F.array(F.lit(0).cast("long")).alias("keys")
    own = anchors.select("*", one, array("-inf").alias("low"), array("inf").alias("high"))
    look = _first(_met(index_, own, True, settings.positives, settings), settings.positives)
    bound = look.filter(F.col("rank") == settings.positives).select("ask", F.array(F.col("score").cast("double")).alias("low"))
    # asks are read twice, to count and to deal the askers of a leaf
    asks = materialize(own.drop("low").join(bound, "ask", "left").withColumn("low", F.coalesce("low", array("-inf"))), "negatives")
    positives = materialize(
        _first(_met(index_, _going(index_, asks, settings), True, settings.positives, settings), settings.positives), "negatives"
    )
    windows = positives.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("rank", "found", "score"))).alias("own"))
    score = lambda p: p["score"].cast("double")
    asks = anchors.join(windows, "ask").select(
        "ask",
        "vec_id",
        "label",
        "vector",
        F.transform("own", lambda p: p["rank"].cast("long")).alias("keys"),
        F.transform("own", lambda p: F.ceil(p["score"] * settings.least / 100).cast("double")).alias("low"),
        F.transform("own", score).alias("high"),
    )
    asks = materialize(asks, "negatives")
    negatives = _first(_met(index_, _going(index_, asks, settings), False, settings.negatives, settings), settings.negatives)
    of = positives.select("ask", F.col("rank").cast("long").alias("key"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select("ask", F.col("vec_id").alias("anchor_id"))
    return (
        negatives.join(of, ["ask", "key"])
        .join(ids, "ask")
        .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM part a JOIN part b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
