"""Small column expressions shared by several operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.functions.clock import DAY_S


def category_of(code: Column, listed: Iterable[int], inside: str, outside: str) -> Column:
    """`inside` for a listed code, `outside` for every other one, null included."""
    return F.when(code.isin(list(listed)), F.lit(inside)).otherwise(F.lit(outside))


def mode_of(route_type: Column, rail_types: Iterable[int]) -> Column:
    return category_of(route_type, rail_types, "rail", "bus")


def whole_day_shift(raw_delay_s: Column) -> Column:
    """Whole days (-1, 0, 1) a reported date is off by. A null or larger shift counts as 0."""
    days = F.round(raw_delay_s / DAY_S).cast("int")
    return F.coalesce(F.when(days.between(-1, 1), days), F.lit(0))


def array_field_min(items: Column, field: Callable[[Column], Column]) -> Column:
    """Least non-null field over an array of structs; null for an empty or null array."""
    return F.array_min(F.transform(items, field))


def share(condition: Column) -> Column:
    """Share of rows where the condition holds; null conditions are left out."""
    return F.avg(condition.cast("int"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def folder_name(text: Column) -> Column:
    """Everything but letters, digits, `-` and `_` becomes `_`. Letters may be of any script."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_")


def mean_abs(error: Column) -> Column:
    return F.avg(F.abs(error))


def root_mean_square(error: Column) -> Column:
    error = error.cast("double")
    return F.sqrt(F.avg(error * error))


def exact_percentile(df: DataFrame, column: str, q: float) -> Column:
    """The least value of `column` with at least the share `q` of the rows up to it, exact for any number of rows.

    Equal values are counted together before the shuffle, so a group holds its distinct values: for
    whole seconds of delay or lead, a bounded number.
    """
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})").cast(df.schema[column].dataType)
