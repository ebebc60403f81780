"""Bronze feed rows to silver rows: flatten, clean, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.functions.columns import array_field_min

STOP_UPDATE_KEY = ("trip_id", "stop_id", "feed_ts")
POSITION_KEY = ("vehicle_id", "vehicle_ts")


def stop_updates_of(trip_updates: DataFrame) -> DataFrame:
    """One row per trip, stop and snapshot. Trips without stops disappear."""
    carried = ["trip_id", "rt_route_id", "start_date", "vehicle_id", "feed_ts"]
    lineage = [c for c in ("ingest_ts",) if c in trip_updates.columns]
    return (
        trip_updates.withColumnRenamed("route_id", "rt_route_id")
        .withColumn("feed_ts", F.timestamp_seconds("feed_timestamp"))
        .select(*carried, *lineage, F.explode("stop_time_updates").alias("u"))
        .select(
            *carried,
            F.col("u.stop_sequence"),
            F.col("u.stop_id"),
            F.col("u.arrival_time").alias("predicted_arrival_epoch"),
            F.col("u.departure_time").alias("predicted_departure_epoch"),
            F.col("u.schedule_relationship").alias("stop_schedule_relationship"),
            *lineage,
        )
    )


def positions_of(vehicle_rows: DataFrame) -> DataFrame:
    """Vehicle reports with instants and whether the vehicle serves a trip."""
    plain = [
        "vehicle_id",
        "trip_id",
        "route_id",
        "latitude",
        "longitude",
        "bearing",
        "current_status",
        "stop_id",
        "occupancy_status",
    ]
    lineage = [c for c in ("ingest_ts",) if c in vehicle_rows.columns]
    return vehicle_rows.select(
        *plain,
        F.timestamp_seconds("vehicle_timestamp").alias("vehicle_ts"),
        F.timestamp_seconds("feed_timestamp").alias("feed_ts"),
        F.isnotnull("trip_id").alias("in_service"),
        *lineage,
    )


ALERT_KEY = ("entity_id", "route_id", "stop_id", "cause", "effect", "header_text")


def merged_alerts(histories: DataFrame, *also: str) -> DataFrame:
    """Histories of several times, one under the other, as one. Merging the same one twice changes nothing."""
    return histories.groupBy(*ALERT_KEY, *also).agg(
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
        F.min("active_start_ts").alias("active_start_ts"),
    )


def with_alert_bucket(history: DataFrame, buckets: int) -> DataFrame:
    """`bucket`: the same for all rows of a key, whenever they are made."""
    return history.withColumn("bucket", F.pmod(F.xxhash64(*ALERT_KEY), F.lit(buckets)).cast("int"))


def alert_history(alert_rows: DataFrame) -> DataFrame:
    """Per alert, affected route and stop and text: first seen, last seen, earliest active start.

    Alerts that name nobody stay, with null route and stop. Null keys form groups.
    """
    starts = array_field_min(F.col("active_periods"), lambda p: p["start"])
    text = ["entity_id", "cause", "effect", "header_text"]
    return (
        alert_rows.select(
            *text,
            "feed_timestamp",
            starts.alias("starts"),
            F.explode_outer("informed_entities").alias("who"),
        )
        .groupBy(
            "entity_id",
            F.col("who.route_id").alias("route_id"),
            F.col("who.stop_id").alias("stop_id"),
            *text[1:],
        )
        .agg(
            F.timestamp_seconds(F.min("feed_timestamp")).alias("first_seen_ts"),
            F.timestamp_seconds(F.max("feed_timestamp")).alias("last_seen_ts"),
            F.timestamp_seconds(F.min("starts")).alias("active_start_ts"),
        )
    )


def distinct_by(df: DataFrame, key: Sequence[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """One row per key. On a stream pass the event time (part of the key) and how late rows may be;
    the state of passed event times is then evicted. Which copy survives is not defined."""
    if event_time and delay:
        df = df.withWatermark(event_time, delay)
    return df.dropDuplicates(list(key))
