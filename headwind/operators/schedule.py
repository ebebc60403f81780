"""The versioned schedule: newest version, the three-way schedule join, delays against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.functions.clock import clock_to_seconds, service_day_start
from headwind.functions.columns import mode_of, whole_day_shift
from headwind.settings import DEFAULTS, Settings


def newest_version(
    versions: DataFrame, starts: str = "feed_start_date", version: str = "gtfs_version"
) -> DataFrame:
    """One row: the version that starts last, the greater name on equal starts."""
    return versions.orderBy(F.desc(starts), F.desc(version)).select(version).limit(1)


def of_version(df: DataFrame, version: DataFrame, column: str = "gtfs_version") -> DataFrame:
    """Rows of one version. That side is one row by construction, hence the broadcast."""
    return df.join(F.broadcast(version.select(column).limit(1)), column)


def schedule_of(
    stop_times: DataFrame, trips: DataFrame, routes: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Stops with their trip and route. Text columns become numbers; bad numbers become null."""
    route_type = F.col("route_type").try_cast("int")
    lines = routes.select(
        "route_id",
        "route_short_name",
        route_type.alias("route_type"),
        mode_of(route_type, settings.rail_route_types).alias("mode"),
    )
    journeys = trips.select(
        "trip_id", "route_id", "service_id", F.col("direction_id").try_cast("int").alias("direction_id")
    )
    calls = stop_times.select(
        "trip_id",
        F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        F.col("stop_id").alias("scheduled_stop_id"),
        clock_to_seconds("arrival_time").alias("scheduled_arrival_secs"),
        clock_to_seconds("departure_time").alias("scheduled_departure_secs"),
    )
    # routes before stops: the small join first, the long table is shuffled once
    return calls.join(journeys.join(lines, "route_id"), "trip_id")


def delay_columns(
    df: DataFrame,
    reported_day: Column,
    predicted_epoch: Column,
    scheduled_secs: Column,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Corrected service date, both instants and the delay in seconds."""
    zone = settings.local_zone
    reported_start = service_day_start(reported_day, zone)
    shift = whole_day_shift(predicted_epoch - (reported_start + scheduled_secs))
    day = F.date_add(reported_day, shift)
    scheduled = service_day_start(F.col("service_date"), zone) + scheduled_secs
    return (
        df.withColumns({"service_date_shift_days": shift, "service_date": day})
        .withColumn("__scheduled", scheduled)
        .withColumns(
            {
                "scheduled_arrival_ts": F.timestamp_seconds("__scheduled"),
                "predicted_arrival_ts": F.timestamp_seconds(predicted_epoch),
                "arrival_delay_s": predicted_epoch - F.col("__scheduled"),
            }
        )
        .drop("__scheduled")
    )


def with_schedule_delay(
    updates: DataFrame,
    schedule: DataFrame,
    keys: Sequence[str] = ("trip_id", "stop_sequence"),
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Left join to the schedule, batch or stream-static. Unmatched updates keep null fields."""
    return delay_columns(
        updates.join(schedule, list(keys), "left"),
        F.to_date(F.try_to_timestamp(F.col("start_date"), F.lit("yyyyMMdd"))),
        F.col("predicted_arrival_epoch"),
        F.col("scheduled_arrival_secs"),
        settings,
    ).drop("predicted_arrival_epoch", "scheduled_arrival_secs", "scheduled_departure_secs")
