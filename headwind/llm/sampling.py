"""Bounded samples of rows for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """About `rows` rows, chosen by the hash of their key: the same ones whenever it runs.

    One count and no sort. The number of rows is binomial around `rows`, or all rows if there are
    no more; rows that share a key are taken or left together.
    """
    n = df.count()
    if n <= rows:
        return df
    share = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return df.filter(share < rows / n)
