"""Mean of a measure over the days before a day, for the same key, from sums by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_SUM, DAY_N = "day_sum", "day_n"


def daily_sums(facts: DataFrame, by: Sequence[str], day: str, value: str) -> DataFrame:
    """Sum of `value` and number of rows per key and day; combined before the shuffle.

    A day's rows depend on that day's facts only, so a table of them is kept up by replacing the days
    whose facts changed.
    """
    return facts.groupBy(*by, day).agg(F.sum(value).alias(DAY_SUM), F.count("*").alias(DAY_N))


def trailing_days(
    daily: DataFrame, by: Sequence[str], day: str, days: int, mean_out: str, n_out: str
) -> DataFrame:
    """Per key and day: mean and count over the `days` days before that day, from `daily_sums`.

    Each daily sum is counted towards the `days` days after it, so a range join over rows becomes a
    sum over the small daily table, and callers join on equality. A day's own rows never count for
    itself.
    """
    return (
        daily.withColumn("__ahead", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .withColumn(day, F.date_add(F.col(day), F.col("__ahead")))
        .groupBy(*by, day)
        .agg((F.sum(DAY_SUM) / F.sum(DAY_N)).alias(mean_out), F.sum(DAY_N).alias(n_out))
    )
