"""Hot-key-safe ordered operators against brute force, with ties, nulls and slice borders."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from headwind.operators import sliced
from headwind.operators.latest import last_per_key
from headwind.operators.sliced import earlier_row, numbered, time_slice
from headwind.operators.timeline import asof_backward, inside_any_interval

T0 = datetime(2026, 10, 6, 16, 0)


def at(s: int) -> datetime:
    return T0 + timedelta(seconds=s)


def cases(seed: int, n: int, hot: bool):
    """Half of the rows on one key, many at one instant."""
    rng = random.Random(seed)
    keys = ["a", "a", "a", "b", "c", None] if hot else ["a", "b", "c", "d", "e", "f"]
    step = rng.choice([1, 60, 900])
    return [(i, rng.choice(keys), at(step * rng.randrange(40)), rng.choice([None, 1, 2, 3, 4])) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("null_keys_match", [True, False])
def test_asof_equals_brute_force(spark, seed, strict, null_keys_match):
    left, right = cases(seed, 120, True), cases(seed + 100, 150, True)
    schema = "id int, k string, t timestamp, v int"
    got = asof_backward(
        spark.createDataFrame(left, schema),
        spark.createDataFrame(right, schema).select("k", F.col("t").alias("rt"), "v"),
        [("k", "k")],
        "t",
        "rt",
        {"v": "found"},
        strict,
        age_out="age",
        slice_s=600,
        null_keys_match=null_keys_match,
    )
    expected = {}
    for i, k, t, _ in left:
        seen = [
            (rt, v)
            for _, rk, rt, v in right
            if v is not None
            and rk == k
            and (k is not None or null_keys_match)
            and (rt < t if strict else rt <= t)
        ]
        best = max(seen, default=None)
        expected[i] = (best[1], int((t - best[0]).total_seconds())) if best else (None, None)
    rows = got.collect()
    assert len(rows) == len(left)
    assert {r.id: (r.found, r.age) for r in rows} == expected


def test_asof_takes_all_values_from_one_row(spark):
    left = spark.createDataFrame([("a", at(100))], "k string, t timestamp")
    right = spark.createDataFrame(
        [("a", at(10), 1, "x"), ("a", at(20), None, "y"), ("a", at(100), 9, "z")],
        "k string, rt timestamp, v int, w string",
    )
    row = asof_backward(left, right, [("k", "k")], "t", "rt", {"v": "v", "w": "w"}, True, "age").first()
    assert (row.v, row.w, row.age) == (1, "x", 90)


@pytest.mark.parametrize("seed", range(3))
def test_interval_flag_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    points = cases(seed, 100, True)
    spans = [(rng.choice(["a", "b", None]), at(s), at(s + rng.randrange(500)))
             for s in (rng.randrange(2400) for _ in range(12))]
    got = inside_any_interval(
        spark.createDataFrame(points, "id int, k string, t timestamp, v int"),
        spark.createDataFrame(spans, "k string, s timestamp, e timestamp"),
        [("k", "k")],
        "t",
        "s",
        "e",
        "flag",
        slice_s=300,
    )
    expected = {i: int(any(k is not None and k == sk and s <= t <= e for sk, s, e in spans)) for i, k, t, _ in points}
    assert {r.id: r.flag for r in got.collect()} == expected


@pytest.mark.parametrize("n", [1, 3])
@pytest.mark.parametrize("width", [1, 600, 10_000_000])
def test_earlier_row_equals_lag(spark, n, width):
    rows = cases(7, 200, True)
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v int")
    order = [F.col("t"), F.col("id")]
    got = earlier_row(df, ["k"], order, time_slice(F.col("t"), width), F.col("v"), "before", n)
    expected, last = {}, {}
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        seen = last.setdefault(k, [])
        expected[i] = seen[-n] if len(seen) >= n else None
        seen.append(v)
    assert {r.id: r.before for r in got.collect()} == expected


@pytest.mark.parametrize("width", [1, 600, 10_000_000])
def test_numbered_equals_row_number(spark, width):
    rows = cases(11, 200, True)
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v int")
    got = numbered(df, ["k"], [F.col("t"), F.col("id")], time_slice(F.col("t"), width), "rn")
    expected, count = {}, {}
    for i, k, _, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        count[k] = expected[i] = count.get(k, 0) + 1
    assert {r.id: r.rn for r in got.collect()} == expected


def test_a_hot_key_never_sits_in_one_window_group(spark):
    """All facts on one key: the largest window group is one slice, and copies are combined."""
    facts = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") % 7200).alias("rt"), "id"
    )
    asks = spark.range(7200, 7210).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("t"))
    out = asof_backward(asks, facts, [("k", "k")], "t", "rt", {"id": "v"}, True, slice_s=600)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" in plan
    rows = out.collect()
    assert len(rows) == 10 and {r.v for r in rows} == {14399}


def test_last_per_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, o int, v string"
    )
    got = {r.k: r.v for r in last_per_key(df, ["k"], [F.col("o")], ["v"]).collect()}
    assert got == {"a": "z", "b": None}


def hot_rows(spark, n=6000):
    """Half of all rows in one hour of one key, most of them at one instant."""
    k = F.col("id")
    hot = k % 2 == 0
    at = F.when(hot & (k % 8 != 0), 7200).when(hot, 7200 + k % 3600).otherwise(k * 37 % 400_000)
    return spark.range(n).select(
        F.when(hot, "a").otherwise(F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), (k % 7).cast("string")))).alias("key"),
        F.timestamp_seconds(at).alias("ts"),
        k.alias("event"),
    )


def test_hot_slices_are_divided_and_give_the_same_rows(spark):
    df, order = hot_rows(spark), [F.col("ts"), F.col("event")]
    hour = sliced.time_slice(F.col("ts"), 3600)
    plain = Window.partitionBy("key").orderBy(*order)
    want = df.select("event", F.row_number().over(plain).alias("n"), F.lag("event", 2).over(plain).alias("before"))
    got = sliced.numbered(df, ["key"], order, hour, "n", rows=200)
    got = sliced.earlier_row(got, ["key"], order, hour, F.col("event"), "before", 2, rows=200).select("event", "n", "before")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pieces_of_a_hot_slice_are_even(spark):
    df, order = hot_rows(spark, 40_000), [F.col("ts"), F.col("event")]
    cut = sliced._cut(df, ["key"], sliced.time_slice(F.col("ts"), 3600), order, 1000, None)
    sizes = sorted(r["count"] for r in cut.where("key = 'a'").groupBy(sliced._SLICE).count().collect())
    assert sum(sizes) == 20_000 and len(sizes) >= 15
    assert sizes[-1] <= 1.75 * sizes[len(sizes) // 2]
    assert sliced._cut(df.limit(0), ["key"], sliced.time_slice(F.col("ts"), 3600), order, 1000, None).count() == 0


def test_a_row_meets_few_borders_however_many_pieces_there_are(spark):
    """800 pieces of one slice: each table of borders is short for any one piece, and no row is misplaced."""
    df = spark.range(40_000).select(F.lit("hot").alias("key"), (F.col("id") * 7919 % 40_000).alias("place"))
    met = []

    def stage(rows):
        if "__borders" in rows.columns:
            met.append(rows.agg(F.max(F.size("__borders"))).first()[0])
        return rows

    got = sliced.numbered(df, ["key"], [F.col("place")], F.lit(0), "n", rows=50, stage=stage)
    assert got.where("n <> place + 1").isEmpty() and got.count() == 40_000
    assert max(m or 0 for m in met) <= 3 * sliced._FANOUT


def test_facts_that_nobody_asks_for_are_dropped_before_they_are_ordered(spark):
    facts = spark.range(4000).select((F.col("id") % 1000).alias("k"), F.timestamp_seconds("id").alias("rt"), F.col("id").alias("v"))
    asks = spark.range(5).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(2500)).alias("t"))
    plain = asof_backward(asks, facts, [("k", "k")], "t", "rt", {"v": "v"}, False)
    out = asof_backward(asks, facts, [("k", "k")], "t", "rt", {"v": "v"}, False, sparse=True)
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(out.collect()) == sorted(plain.collect()) == [(k, datetime.fromtimestamp(2500), 2000 + k) for k in range(5)]
