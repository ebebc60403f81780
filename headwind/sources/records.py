"""Declared schemas of feed records and schedule files. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


# fixed values: column names and types of the bronze tables
RECORDS: dict[str, str] = {
    "trip_updates": """feed_timestamp long, entity_id string, trip_id string, route_id string,
        direction_id int, start_date string, start_time string, trip_schedule_relationship string,
        vehicle_id string, vehicle_label string, update_timestamp long, trip_delay int,
        stop_time_updates array<struct<stop_sequence: int, stop_id: string, arrival_time: bigint,
            arrival_delay: int, departure_time: bigint, departure_delay: int,
            schedule_relationship: string>>""",
    "vehicle_positions": """feed_timestamp long, entity_id string, vehicle_id string, vehicle_label string,
        trip_id string, route_id string, direction_id int, start_date string, latitude double,
        longitude double, bearing float, speed float, current_status string,
        current_stop_sequence int, stop_id string, vehicle_timestamp long,
        occupancy_status string, occupancy_percentage int""",
    "alerts": """feed_timestamp long, entity_id string, cause string, effect string,
        severity_level string, header_text string, description_text string,
        active_periods array<struct<start: bigint, end: bigint>>,
        informed_entities array<struct<agency_id: string, route_id: string, route_type: int,
            direction_id: int, stop_id: string, trip_id: string>>""",
}

# fixed values: columns taken from each schedule file
SCHEDULE_FILES: dict[str, tuple[str, ...]] = {
    "feed_info": ("feed_publisher_name", "feed_start_date", "feed_end_date", "feed_version"),
    "routes": ("route_id", "route_short_name", "route_long_name", "route_type"),
    "trips": ("route_id", "service_id", "trip_id", "trip_headsign", "direction_id", "block_id"),
    "stop_times": ("trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"),
    "stops": ("stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station"),
    "calendar": (
        "service_id",
        "monday",
        "tuesday",
        "wednesday",
        "thursday",
        "friday",
        "saturday",
        "sunday",
        "start_date",
        "end_date",
    ),
    "calendar_dates": ("service_id", "date", "exception_type"),
}


def record_schema(feed: str) -> T.StructType:
    return T.StructType.fromDDL(RECORDS[feed])
