"""Tables as parquet folders below one shared root, with append, overwrite and range replace."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headwind.functions.clock import utc_day, utc_hour_text


@dataclass(frozen=True)
class Lake:
    """Root folder and environment prefix, e.g. `Lake("/lake", "dev_")`."""

    root: str
    prefix: str = ""

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{layer}/{table}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}checkpoints/{job}"

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        fs, path = _fs(spark, self.path(layer, table))
        return fs.exists(path)

    def read(
        self, spark: SparkSession, layer: str, table: str, schema: StructType | None = None
    ) -> DataFrame:
        """With a declared schema, a table without files is an empty table."""
        if schema is None:
            return spark.read.parquet(self.path(layer, table))
        make_folder(spark, self.path(layer, table))
        return spark.read.schema(schema).parquet(self.path(layer, table))

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        df.write.mode("append").parquet(self.path(layer, table))

    def overwrite(self, df: DataFrame, layer: str, table: str, *partitions: str) -> None:
        """Replace the table, schema included."""
        df.write.mode("overwrite").partitionBy(*partitions).option(
            "partitionOverwriteMode", "static"
        ).parquet(self.path(layer, table))

    def replace_days(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        first: date,
        last: date,
        day: str = "service_date",
        days: Sequence[date] | None = None,
    ) -> None:
        replace_days(df, self.path(layer, table), first, last, day, days)

    def replace_parts(self, df: DataFrame, layer: str, table: str, column: str, values: Sequence) -> None:
        replace_parts(df, self.path(layer, table), column, values)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def drop_empty_folders(spark: SparkSession, folder: str) -> None:
    """Delete the empty folders below a folder, never one with a file in it, even if that came just now."""
    fs, top = _fs(spark, folder)

    def emptied(path) -> None:
        for child in fs.listStatus(path):
            if child.isDirectory():
                emptied(child.getPath())
                if not len(fs.listStatus(child.getPath())):
                    fs.delete(child.getPath(), False)

    if fs.exists(top):
        emptied(top)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there, so that what reads it finds it empty."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        fs.mkdirs(folder)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def replace_days(
    df: DataFrame,
    path: str,
    first: date,
    last: date,
    day: str = "service_date",
    days: Sequence[date] | None = None,
) -> None:
    """Replace the rows of `first`..`last`, or of exactly `days`; create the table if it is missing.

    As `replace_parts`, for one part a day.
    """
    if days is not None:
        replace_parts(df, path, day, list(days))
        return
    chosen = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    replace_parts(df.where(F.col(day).between(F.lit(first), F.lit(last))), path, day, chosen, inside=True)


def replace_parts(df: DataFrame, path: str, column: str, values: Sequence, inside: bool = False) -> None:
    """Replace the parts of a table that have these values of its partition column, and no others.

    The rows are computed once, into a staging folder of this run beside the table. A rebalance by
    part gives each part few files and splits one that is too large for one task. Then, part by part,
    the old folder is moved aside and the new one moved in; if that fails, the old one is moved back
    and the error raised. Old folders go only when all parts are in place, so after a crash they are
    still in the staging folder. Parts without new rows end up empty. One writer at a time. `inside`:
    the caller has left out all other values.
    """
    spark = df.sparkSession
    inside_rows = (df if inside else df.where(F.col(column).isin(list(values)))).hint("rebalance", F.col(column))
    fs, table = _fs(spark, path)
    if not fs.exists(table):
        inside_rows.write.partitionBy(column).parquet(path)
        return
    run = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    inside_rows.write.partitionBy(column).parquet(f"{run}/new")
    _, aside = _fs(spark, f"{run}/old")
    fs.mkdirs(aside)
    for value in values:
        part = f"{column}={value}"
        (_, here), (_, old), (_, new) = (_fs(spark, f"{root}/{part}") for root in (path, f"{run}/old", f"{run}/new"))
        had = fs.exists(here)
        if had:
            _move(fs, here, old)
        if fs.exists(new):
            try:
                _move(fs, new, here)
            except Exception:
                if had:
                    _move(fs, old, here)
                raise
    _, rest = _fs(spark, run)
    fs.delete(rest, True)
    spark.catalog.refreshByPath(path)


def day_bounds(df: DataFrame, first: str = "", last: str = "", day: str = "service_date") -> tuple[date, date]:
    """The given ISO dates, or the first and last day in the data where one is empty."""
    if first and last:
        return date.fromisoformat(first), date.fromisoformat(last)
    low, high = df.agg(F.min(day), F.max(day)).first()
    return (date.fromisoformat(first) if first else low, date.fromisoformat(last) if last else high)


def with_utc_partitions(df: DataFrame, seconds: str) -> DataFrame:
    """`date` and `hour` (UTC, text) of an epoch column, for `partitionBy("feed", "date", "hour")`."""
    return df.withColumns(
        {"date": utc_day(F.col(seconds)).cast("string"), "hour": utc_hour_text(F.col(seconds))}
    )
