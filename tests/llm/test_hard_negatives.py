"""Hard negatives against brute force, and what the tree eliminates."""

import math

import numpy as np
import pytest

from headwind.llm import hard_negatives
from headwind.llm.hard_negatives import Settings, grow, mine, visited

SCHEMA = "vec_id long, embedding array<float>, label int, leaf string, deal int"


def brute(rows, every=100):
    own = []
    for id_, vector, label, *_ in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((id_, (label + 1) % 10 if id_ % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in (r for r in own if r[0] % every == 0):
        others = sorted(((-score(a[2], b[2]), b[0], b[1]) for b in own if b[0] != a[0]))
        for p, pid, _ in [o for o in others if o[2] == a[1]][:5]:
            fits = [o for o in others if o[2] != a[1] and 80 * -p <= 100 * -o[0] <= 100 * -p][:5]
            out += [(a[0], pid, rank, nid, -p, -n) for rank, (n, nid, _) in enumerate(fits, 1)]
    return sorted(out)


def rows_of(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "k", 3) for i, v, y in rows], SCHEMA)
    return sorted(tuple(r) for r in mine(df, Settings(**kw)).collect()) if kw else sorted(tuple(r) for r in mine(df).collect())


def clustered(n, width=12, seed=1, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    return [(i, centres[i % 8] + spread * rng.normal(size=width), int(rng.integers(10))) for i in range(n)]


def test_equals_brute_force(spark):
    rows = clustered(1500)
    assert rows_of(spark, rows) == brute(rows)


def test_small_blocks_groups_and_leaves_change_nothing(spark):
    rows = clustered(700, width=5, seed=2)
    small = dict(block=40, group=2, leaf_sample=10, sample=200, fan=4, depth=3)
    assert rows_of(spark, rows, **small) == brute(rows)


def test_ties_many_copies_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4), i % 10) for i in range(300)]
    rows += [(i, np.ones(4), i % 3) for i in range(300, 650)]  # a third and more of one vector
    rows += [(None, np.ones(4), 1), (651, None, 1), (652, np.ones(4), None), (653, [1, None, 1, 1], 1)]
    rows += [(654, [np.nan, 1, 1, 1], 1), (655, [np.inf, 1, 1, 1], 1), (656, np.ones(2), 1), (700, [], 2), (-100, np.ones(4), 4)]
    assert rows_of(spark, rows, block=64, group=3, leaf_sample=20) == brute(rows)


def test_tables_without_anchors_or_rows(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(i, np.ones(3), 1) for i in range(1, 50)]) == []
    assert rows_of(spark, [(100, np.ones(3), 1)]) == []
    assert rows_of(spark, [(i, np.zeros(3), i % 2) for i in range(0, 40)]) == brute([(i, np.zeros(3), i % 2) for i in range(0, 40)])


def test_ranges_rule_out_leaves_but_no_row():
    settings = Settings(leaf_sample=20, fan=6)
    x = np.floor(256 * np.array([v for _, v, _ in clustered(3000, spread=0.05)]))
    tree = grow(x[:500], settings)
    nodes = {n.id: n for n in hard_negatives._nodes(tree)}
    for n in nodes.values():
        size = len(n.points)
        n.near, n.far, n.norms = np.full((size, size), np.inf), np.zeros((size, size)), np.tile([np.inf, 0.0], (size, 1))

    def visit(node, c, distances, norms):
        node.near[c], node.far[c] = np.minimum(node.near[c], distances.min(0)), np.maximum(node.far[c], distances.max(0))
        node.norms[c] = min(node.norms[c, 0], norms.min()), max(node.norms[c, 1], norms.max())

    leaf = hard_negatives._placed(tree, x, visit)
    score = x[:40] @ x.T
    high = np.sort(score, axis=1)[:, -3:]
    low = 0.9 * high
    row, at = visited(tree, x[:40], low, high)
    seen = set(zip(row.tolist(), at.tolist(), strict=True))
    for i in range(40):
        inside = ((score[i] >= low[i][:, None]) & (score[i] <= high[i][:, None])).any(0)
        assert {(i, int(n)) for n in leaf[inside]} <= seen
    assert len(seen) < 0.5 * 40 * len(set(leaf.tolist()))  # most leaves are eliminated on clustered rows


@pytest.mark.parametrize("n", [1, 3, 7])
def test_best_takes_the_first_of_equal_scores(n):
    rng = np.random.default_rng(n)
    score, fits = rng.integers(0, 4, (20, 30)).astype(float), rng.random((20, 30)) < 0.6
    row, column = hard_negatives._best(score, fits, n)
    for i in range(20):
        want = sorted(np.flatnonzero(fits[i]), key=lambda c: (-score[i, c], c))[:n]
        assert column[row == i].tolist() == want
