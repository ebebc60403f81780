"""What was known at a moment: backward as-of joins and interval existence.

Both are one question: over the facts of a key that lie before a moment, what is the greatest
payload? With payload `(time, value)` the answer is the latest fact; with payload `end of
interval` it tells whether some interval that has begun is still open.

The greatest payload folds, so facts are pre-aggregated before the shuffle, down to one row per
key and instant, together with the instants that are asked for. Each key is cut into time slices
and a slice receives one folded value from the slices before it. No key, however large, is ever
sorted in one task, nothing is broadcast, and no pairs are produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwind.settings import DEFAULTS

_KEY, _AT, _SLICE = "__key", "__at", "__slice"


def greatest_before(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    payload: Column,
    out: str,
    strict: bool,
    slice_s: int = DEFAULTS.slice_s,
    null_keys_match: bool = False,
    asked: DataFrame | None = None,
    latest: bool = False,
    sparse: bool = False,
) -> DataFrame:
    """Add `out`: max payload over the right rows of the same key with time < (<=) `left_time`.

    With `latest` it is the payload `v` of the last such time, together with that time `at`, and
    the max only decides between rows of one instant. A number as payload keeps the first and
    largest aggregation a hash aggregation.

    `by` lists (left column, right column) pairs. Every left row is kept exactly once.

    `asked` may give the keys and times of `left` from a cheaper source, such as the table `left`
    was derived from. Without it `left` is computed twice, and a chain of calls doubles each time.

    `sparse`: many facts have keys that nobody asks for; they are dropped before anything is ordered.
    """
    left_key = F.struct(*[F.col(a).alias(f"k{i}") for i, (a, _) in enumerate(by)])
    right_key = F.struct(*[F.col(b).alias(f"k{i}") for i, (_, b) in enumerate(by)])

    facts = right.filter(F.col(right_time).isNotNull())
    if not null_keys_match:
        for _, b in by:
            facts = facts.filter(F.col(b).isNotNull())
    facts = facts.select(
        right_key.alias(_KEY),
        F.col(right_time).alias(_AT),
        payload.alias("__fact"),
        F.lit(False).alias("__asked"),
    )
    asked = left if asked is None else asked
    asks = asked.filter(F.col(left_time).isNotNull()).select(
        left_key.alias(_KEY),
        F.col(left_time).alias(_AT),
        F.lit(None).cast(facts.schema["__fact"].dataType).alias("__fact"),
        F.lit(True).alias("__asked"),
    )
    if sparse:
        facts = facts.join(asks.select(_KEY), _KEY, "left_semi").select(*facts.columns)
    instants = (
        facts.unionByName(asks)
        .withColumn(_SLICE, F.floor(F.unix_seconds(_AT) / slice_s))
        .groupBy(_KEY, _SLICE, _AT)
        .agg(F.max("__fact").alias("__fact"), F.bool_or("__asked").alias("__asked"))
    )
    if latest:
        dated = F.struct(F.col(_AT).alias("at"), F.col("__fact").alias("v"))
        instants = instants.withColumn("__fact", F.when(F.isnotnull("__fact"), dated))
    inside_slice = Window.partitionBy(_KEY, _SLICE)
    in_order = inside_slice.orderBy(_AT)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    inside = instants.withColumn("__inside", F.max("__fact").over(so_far))

    earlier = (
        Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    # a slice's last row stands for it; ordered by the same window, so that both readers of `instants`
    # share one shuffle
    handed = (
        instants.withColumn("__top", F.max("__fact").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("__next", F.lead(_AT).over(in_order))
        .withColumn("__any", F.bool_or("__asked").over(inside_slice))
        .filter(F.isnull("__next"))
        .withColumn("__handed", F.max("__top").over(earlier))
        .filter("__any")
        .select(_KEY, _SLICE, "__handed")
    )
    # each side has its match; an outer join only keeps Spark from adding a filter to one of two
    # readers of `instants`, so that both share one shuffle
    answers = (
        inside.filter("__asked")
        .join(handed, [_KEY, _SLICE], "left")
        .select(_KEY, _AT, F.greatest("__inside", "__handed").alias(out))
    )
    return (
        left.withColumn(_KEY, left_key)
        .withColumn(_AT, F.col(left_time))
        .join(answers, [_KEY, _AT], "left")
        .drop(_KEY, _AT)
    )


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    values: dict[str, str],
    strict: bool,
    age_out: str | None = None,
    slice_s: int = DEFAULTS.slice_s,
    null_keys_match: bool = False,
    asked: DataFrame | None = None,
    sparse: bool = False,
) -> DataFrame:
    """Attach the latest right row before (`strict`) or at-or-before `left_time`.

    `values` maps right columns to output names. Rows whose first value is null are skipped, all
    outputs come from one row, and rows at one instant are ordered by their values, so the result
    is deterministic. `age_out` adds whole seconds between the two times.
    """
    first = next(iter(values))
    columns = [F.col(c).alias(o) for c, o in values.items()]
    payload = columns[0] if len(columns) == 1 else F.struct(*columns)
    joined = greatest_before(
        left,
        right.filter(F.col(first).isNotNull()),
        by,
        left_time,
        right_time,
        payload,
        "__latest",
        strict,
        slice_s,
        null_keys_match,
        asked,
        latest=True,
        sparse=sparse,
    )
    found = F.col("__latest")["v"]
    if len(columns) == 1:
        added = [found.alias(values[first])]
    else:
        added = [found[o].alias(o) for o in values.values()]
    if age_out:
        age = F.unix_seconds(left_time) - F.unix_seconds(F.col("__latest")["at"])
        added.append(age.alias(age_out))
    return joined.select(*left.columns, *added)


def inside_any_interval(
    left: DataFrame,
    intervals: DataFrame,
    by: Sequence[tuple[str, str]],
    at: str,
    start: str,
    end: str,
    out: str,
    slice_s: int = DEFAULTS.slice_s,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Flag 1/0: does some closed interval `[start, end]` of the same key contain `at`?

    Among the intervals that have begun by `at`, one is live exactly if the greatest end is not
    before `at`. Hence one row in, one row out, whatever the number of overlapping intervals.
    """
    joined = greatest_before(
        left, intervals, by, at, start, F.col(end), "__open_until", False, slice_s, asked=asked
    )
    live = F.coalesce(F.col("__open_until") >= F.col(at), F.lit(False))
    return joined.withColumn(out, live.cast("int")).drop("__open_until")
