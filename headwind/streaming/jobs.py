"""Bursts: each starts from its checkpoint, handles all files that are there, and stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from headwind.operators.clean import (
    POSITION_KEY,
    STOP_UPDATE_KEY,
    distinct_by,
    positions_of,
    stop_updates_of,
)
from headwind.operators.quality import keep_valid, observed_rates, position_rules, stop_update_rules
from headwind.operators.schedule import with_schedule_delay
from headwind.settings import DEFAULTS, Settings
from headwind.sources.sinks import drop_empty_folders, make_folder
from headwind.sources.snapshots import bronze_records, read_files, watched_folder


def burst(
    df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per checkpoint, and wait for the end."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand every micro-batch and its number to `write`, and wait for the end.

    A batch whose write failed comes again with the same rows and number, so `write` must give the
    same result when it is repeated.
    """
    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_feed(
    spark: SparkSession,
    raw_root: str,
    feed: str,
    path: str,
    checkpoint: str,
    day: str | None = None,
    settings: Settings = DEFAULTS,
    archive: str | None = None,
) -> StreamingQuery:
    """Decode the snapshot files of a feed that no earlier burst has seen.

    A feed without a folder yet is a feed without files. `files_per_batch` only paces a backlog: no
    state is kept here, so nothing can come too late.

    With an `archive` folder, files leave the watched folder when a later batch or burst starts, and
    folders that are left empty go, so a burst lists the dates that are still open, not the whole
    history. A file that comes late for an old date makes its folder anew and is read like any other.
    """
    folder = watched_folder(raw_root, feed, day)
    make_folder(spark, folder)
    files = read_files(spark, folder, True, settings.files_per_batch, archive)
    query = burst(bronze_records(files, feed), path, checkpoint)
    if archive:
        drop_empty_folders(spark, folder)
    return query


def silver_stop_updates(
    bronze: DataFrame, schedule: DataFrame, settings: Settings = DEFAULTS, observe: str | None = None
) -> DataFrame:
    """Trip updates, stream or batch, to deduplicated stop updates with delay.

    `observe` names the rule counts that the query reports, taken before rows are dropped.
    """
    updates = distinct_by(
        stop_updates_of(bronze), STOP_UPDATE_KEY, "feed_ts", settings.watermark
    )
    rows, rules = with_schedule_delay(updates, schedule, settings=settings), stop_update_rules(settings)
    return keep_valid(observed_rates(rows, rules, observe) if observe else rows, rules)


def silver_positions(
    bronze: DataFrame, settings: Settings = DEFAULTS, observe: str | None = None
) -> DataFrame:
    rows = distinct_by(positions_of(bronze), POSITION_KEY, "vehicle_ts", settings.watermark)
    rules = position_rules(settings)
    return keep_valid(observed_rates(rows, rules, observe) if observe else rows, rules)


def reported(query: StreamingQuery, name: str) -> list[dict[str, int]]:
    """The metrics of that name from each micro-batch of a burst.

    A burst over a table has one batch with rows, for all its new files; Spark keeps the progress of
    the last hundred.
    """
    return [p.observedMetrics[name].asDict() for p in query.recentProgress if name in p.observedMetrics]


def stream_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet folder written by an earlier job, as a stream of its files; it may be empty."""
    make_folder(spark, path)
    return spark.readStream.schema(schema).parquet(path)


def stream_through(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], folder: str
) -> DataFrame:
    """Run a batch's rows through a streaming transformation and return what comes out.

    The rows are written below `folder` first; a stream then reads them in one burst.
    """
    spark = source.sparkSession
    source.write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{folder}/in")
    burst(transform(stream), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out")
