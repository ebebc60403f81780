"""The audit against filters that are really applied, one order after another."""

from itertools import permutations

import duckdb
import numpy as np
import pytest

from headwind.llm import filter_audit
from headwind.llm.filter_audit import audit

GOOD = " ".join(f"w{i}" for i in range(250))


def really_applied(docs, labels):
    """(part, order, step) -> counts, by running every order over the rows."""
    texts = [(i, p or "", t or "") for i, p, t in docs]
    least = {}
    for i, _, t in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def fails(i, t):
        words = t.encode().split()
        return {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > least[t],
        }

    rows = [(p, i, fails(i, t)) for i, p, t in texts]
    out, removed_in_all = {}, {}
    for part in {p for p, _, _ in rows}:
        own = [(i, f) for p, i, f in rows if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone, left = [x for x in left if x[1][name]], [x for x in left if not x[1][name]]
                failing = [x for x in own if x[1][name]]
                only = sum(sum(f.values()) == 1 for _, f in failing)
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), only,
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
                removed_in_all[part, name] = removed_in_all.get((part, name), 0) + len(gone)
    return {k: (*v, removed_in_all[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    texts = [GOOD, GOOD.upper(), "a " * 300, GOOD + " #", "short", "", None, " \n\t ", "SHOUT $ " * 250, GOOD + " é|"]
    docs = [(int(i) if i % 11 else None, [None, "", "a", "b"][int(rng.integers(4))], texts[int(rng.integers(len(texts)))]) for i in range(90)]
    docs += [docs[1], docs[1], (5, "b", GOOD)]
    labels = [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 90, 2)] + [(None, 1, 1), (4, None, None), (4, 1, None)]
    frames = (
        spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, source string, text string, part string, mask int"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    return docs, labels, *frames


def test_equals_orders_really_applied(tables):
    docs, labels, d, x = tables
    assert found(audit(d, x)) == really_applied(docs, labels)


def test_equals_sql(tables):
    _, _, d, x = tables
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("labels", x.toPandas().astype("Int64"))
    rows = con.execute(filter_audit.SQL).fetchall()
    assert {r[:3]: tuple(r[3:]) for r in rows} == found(audit(d, x))


def test_empty_tables(tables):
    docs, _, d, x = tables
    assert audit(d.limit(0), x).count() == 0
    assert found(audit(d, x.limit(0))) == really_applied(docs, [])


def test_walk_keeps_every_subset():
    counts = np.random.default_rng(1).integers(0, 50, (3, 32, 2))
    states = filter_audit.walk(counts)
    for subset in range(32):
        left = [mask for mask in range(32) if not mask & subset]
        assert np.array_equal(states[subset], counts[:, left].sum(axis=1))


def test_a_very_long_text_is_measured_whole():
    assert filter_audit.failures("w " * 10**6 + "#") == 0b1010
