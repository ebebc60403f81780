"""One row per key, chosen by an order, as an aggregation.

`max(struct)` combines before the shuffle, so a hot key costs one row per task; a
`row_number() = 1` window would sort every row of the key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], keep: Sequence[str]
) -> DataFrame:
    """The row with the greatest `order` per key. `keep` breaks ties, so it is deterministic."""
    ranks = [o.alias(f"__o{i}") for i, o in enumerate(order)]
    return (
        df.groupBy(*by)
        .agg(F.max(F.struct(*ranks, *keep)).alias("__top"))
        .select(*by, *[F.col(f"__top.{c}").alias(c) for c in keep])
    )
