"""Ordered operations for keys that may hold a large part of all rows.

A plain window over a key sorts that whole key in one task. Here every key is cut into slices
along its order (an hour of time, a run of sequence numbers). Rows are sorted inside a slice
only; what earlier slices hand over is a few values per slice, computed from one small row per
(key, slice). The result equals the plain window exactly.

Where a slice may be hot itself (one hour of a feed with half of all rows, or very many rows of one
instant), `rows` divides it further, at borders in the whole order, time and tie-breakers. They are
drawn from a small hashed sample of the rows, so wherever they fall, only the sizes of the pieces
depend on it, never the result. Dividing goes in steps, coarse pieces first: a row meets some 64 borders
a step, however many pieces there are, and a sample gathered for one piece has some 2,000 rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwind.session import materialize

_KEY, _SLICE = "__key", "__slice"

Stage = Callable[[DataFrame], DataFrame]


def time_slice(ts: Column, width_s: int) -> Column:
    return F.floor(F.unix_seconds(ts) / width_s)


#: sampled rows between two borders
_BETWEEN = 32
#: pieces that a step makes of one; of the first step only, more where a slice has above 64^3 times `rows` rows
_FANOUT = 64


def borders(cut: DataFrame, order: Sequence[Column], rows: int) -> DataFrame:
    """(key, slice, borders, steps): for each slice of more than about `rows` rows, where to divide it.

    Rows enter the sample by the hash of their place in the order, one in `rows / 32`; a slice's share of
    it is gathered and every 32nd place is a border. Slices that are small have no row here.
    """
    place = F.struct(*order)
    share = F.pmod(F.xxhash64(place, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return (
        cut.where(share < _BETWEEN / rows)
        .groupBy(_KEY, _SLICE)
        .agg(F.sort_array(F.collect_list(place)).alias("__drawn"))
        .where(F.size("__drawn") > _BETWEEN)
        .select(
            _KEY,
            _SLICE,
            F.transform(
                F.sequence(F.lit(_BETWEEN), F.size("__drawn") - 1, F.lit(_BETWEEN)), lambda i: F.get("__drawn", i)
            ).alias("__borders"),
        )
        .withColumn(
            "__steps",
            F.transform(
                F.sequence(F.floor(F.log2(F.size("__borders"))), F.lit(0), F.lit(-1)), lambda i: F.pow(2, i).cast("int")
            ),
        )
    )


def _passed(place: Column) -> Column:
    """How many of the sorted `__borders` are not above `place`, by halving; 0 without borders."""

    def step(n: Column, more: Column) -> Column:
        # past the end there is no border, and nothing is added
        return F.when(F.get("__borders", n + more - 1) <= place, n + more).otherwise(n)

    return F.coalesce(F.aggregate("__steps", F.lit(0), step), F.lit(0))


def _cut(
    df: DataFrame, by: Sequence[str], slice_of: Column, order: Sequence[Column], rows: int | None, stage: Stage | None
) -> DataFrame:
    # a struct is never null itself, so null keys keep matching each other in the joins below
    cut = df.withColumn(_KEY, F.struct(*by)).withColumn(_SLICE, slice_of)
    if not rows:
        return cut
    stage = stage or materialize
    # read once for each step's sample, and at last
    cut = stage(cut)
    for size in (rows * _FANOUT**2, rows * _FANOUT, rows):
        # few rows; staged, Spark knows how few and moves no row of the large side for the join
        found = stage(borders(cut, order, size))
        cut = (
            cut.join(found, [_KEY, _SLICE], "left")
            .withColumn(_SLICE, F.struct(F.col(_SLICE).alias("slice"), _passed(F.struct(*order)).alias("piece")))
            .drop("__borders", "__steps")
        )
    # the operators read it twice
    return stage(cut)


def numbered(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    slice_of: Column,
    out: str,
    rows: int | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """`row_number()` over `by`, ordered by `order`. `slice_of` must never decrease in `order`.

    With `rows`, slices of more rows than that are divided; `order` is rising then. The rows and the borders
    are written by `stage`, else to the shared folder.
    """
    cut = _cut(df, by, slice_of, order, rows, stage)
    earlier = (
        Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(_KEY, _SLICE)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__skip", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n")
    )
    inside = F.row_number().over(Window.partitionBy(_KEY, _SLICE).orderBy(*order))
    return (
        cut.withColumn("__rank", inside)
        .join(offsets, [_KEY, _SLICE])
        .withColumn(out, (F.col("__rank") + F.col("__skip")).cast("int"))
        .drop(_KEY, _SLICE, "__rank", "__skip")
    )


def earlier_row(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    slice_of: Column,
    value: Column,
    out: str,
    n: int = 1,
    rows: int | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """`lag(value, n)` over `by`, ordered by `order`. `slice_of` must never decrease in `order`.

    With `rows`, as in `numbered`.
    A slice hands over its last `n` values, so a slice needs at most the tails of the `n` slices
    before it.
    """
    inside = Window.partitionBy(_KEY, _SLICE).orderBy(*order)
    whole = Window.partitionBy(_KEY, _SLICE)
    ranked = (
        _cut(df, by, slice_of, order, rows, stage)
        .withColumn("__value", F.struct(value.alias("v")))
        .withColumn("__rank", F.row_number().over(inside))
        .withColumn("__size", F.count(F.lit(1)).over(whole))
        .withColumn("__near", F.lag("__value", n).over(inside))
    )
    tail = F.sort_array(F.collect_list(F.struct("__rank", "__value")))  # at most n entries
    tails = (
        ranked.filter(F.col("__rank") > F.col("__size") - n)
        .groupBy(_KEY, _SLICE)
        .agg(F.transform(tail, lambda t: t["__value"]).alias("__tail"))
    )
    before = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(-n, -1)
    handed = tails.withColumn("__before", F.flatten(F.collect_list("__tail").over(before))).drop(
        "__tail"
    )
    # 1-based position of the wanted value in the handed-over list
    position = F.size("__before") - n + F.col("__rank")
    far = F.get("__before", position - 1)
    # every slice has its row; an outer join only keeps Spark from adding a filter to one of the
    # two readers of `ranked`, so that both share one shuffle
    return (
        ranked.join(handed, [_KEY, _SLICE], "left")
        .withColumn(out, F.when(F.col("__rank") > n, F.col("__near")).otherwise(far)["v"])
        .drop(_KEY, _SLICE, "__value", "__rank", "__size", "__near", "__before")
    )
