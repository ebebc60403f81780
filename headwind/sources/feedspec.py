"""The public GTFS-Realtime message layout, as a protobuf descriptor built in code.

Only the fields the records need, plus the required ones. Field numbers and enum values are those
of the published specification.
"""

from __future__ import annotations

from functools import lru_cache

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

PACKAGE = "transit_realtime"
MESSAGE = f"{PACKAGE}.FeedMessage"

# fixed values: enum names and numbers of the specification
ENUMS = {
    "TripDescriptor.ScheduleRelationship": {
        "SCHEDULED": 0,
        "ADDED": 1,
        "UNSCHEDULED": 2,
        "CANCELED": 3,
        "REPLACEMENT": 5,
        "DUPLICATED": 6,
        "DELETED": 7,
    },
    "StopTimeUpdate.ScheduleRelationship": {
        "SCHEDULED": 0,
        "SKIPPED": 1,
        "NO_DATA": 2,
        "UNSCHEDULED": 3,
    },
    "VehiclePosition.VehicleStopStatus": {"INCOMING_AT": 0, "STOPPED_AT": 1, "IN_TRANSIT_TO": 2},
    "VehiclePosition.OccupancyStatus": {
        "EMPTY": 0,
        "MANY_SEATS_AVAILABLE": 1,
        "FEW_SEATS_AVAILABLE": 2,
        "STANDING_ROOM_ONLY": 3,
        "CRUSHED_STANDING_ROOM_ONLY": 4,
        "FULL": 5,
        "NOT_ACCEPTING_PASSENGERS": 6,
        "NO_DATA_AVAILABLE": 7,
        "NOT_BOARDABLE": 8,
    },
    "Alert.Cause": {
        "UNKNOWN_CAUSE": 1,
        "OTHER_CAUSE": 2,
        "TECHNICAL_PROBLEM": 3,
        "STRIKE": 4,
        "DEMONSTRATION": 5,
        "ACCIDENT": 6,
        "HOLIDAY": 7,
        "WEATHER": 8,
        "MAINTENANCE": 9,
        "CONSTRUCTION": 10,
        "POLICE_ACTIVITY": 11,
        "MEDICAL_EMERGENCY": 12,
    },
    "Alert.Effect": {
        "NO_SERVICE": 1,
        "REDUCED_SERVICE": 2,
        "SIGNIFICANT_DELAYS": 3,
        "DETOUR": 4,
        "ADDITIONAL_SERVICE": 5,
        "MODIFIED_SERVICE": 6,
        "OTHER_EFFECT": 7,
        "UNKNOWN_EFFECT": 8,
        "STOP_MOVED": 9,
        "NO_EFFECT": 10,
        "ACCESSIBILITY_ISSUE": 11,
    },
    "Alert.SeverityLevel": {"UNKNOWN_SEVERITY": 1, "INFO": 2, "WARNING": 3, "SEVERE": 4},
}

# fixed values: message -> "type name number" per field; `*` marks a repeated field
MESSAGES = {
    "FeedMessage": "FeedHeader header 1, *FeedEntity entity 2",
    "FeedHeader": "string gtfs_realtime_version 1, uint64 timestamp 3",
    "FeedEntity": "string id 1, TripUpdate trip_update 3, VehiclePosition vehicle 4, Alert alert 5",
    "TripUpdate": "TripDescriptor trip 1, *StopTimeUpdate stop_time_update 2, "
    "VehicleDescriptor vehicle 3, uint64 timestamp 4, int32 delay 5",
    "StopTimeUpdate": "uint32 stop_sequence 1, StopTimeEvent arrival 2, StopTimeEvent departure 3, "
    "string stop_id 4, StopTimeUpdate.ScheduleRelationship schedule_relationship 5",
    "StopTimeEvent": "int32 delay 1, int64 time 2",
    "VehiclePosition": "TripDescriptor trip 1, Position position 2, uint32 current_stop_sequence 3, "
    "VehiclePosition.VehicleStopStatus current_status 4, uint64 timestamp 5, string stop_id 7, "
    "VehicleDescriptor vehicle 8, VehiclePosition.OccupancyStatus occupancy_status 9, uint32 occupancy_percentage 10",
    "Position": "float latitude 1, float longitude 2, float bearing 3, float speed 5",
    "Alert": "*TimeRange active_period 1, *EntitySelector informed_entity 5, Alert.Cause cause 6, "
    "Alert.Effect effect 7, TranslatedString header_text 10, TranslatedString description_text 11, "
    "Alert.SeverityLevel severity_level 14",
    "TimeRange": "uint64 start 1, uint64 end 2",
    "EntitySelector": "string agency_id 1, string route_id 2, int32 route_type 3, "
    "TripDescriptor trip 4, string stop_id 5, uint32 direction_id 6",
    "TripDescriptor": "string trip_id 1, string start_time 2, string start_date 3, "
    "TripDescriptor.ScheduleRelationship schedule_relationship 4, string route_id 5, uint32 direction_id 6",
    "VehicleDescriptor": "string id 1, string label 2",
    "TranslatedString": "*Translation translation 1",
    "Translation": "string text 1, string language 2",
}


@lru_cache(maxsize=1)
def descriptor_set() -> bytes:
    """Serialized FileDescriptorSet, the form Spark's `from_protobuf` takes."""
    field = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="headwind_feed.proto", package=PACKAGE, syntax="proto2"
    )
    for message, fields in MESSAGES.items():
        m = file.message_type.add(name=message)
        for enum, values in ENUMS.items():
            owner, name = enum.split(".")
            if owner == message:
                e = m.enum_type.add(name=name)
                for value, number in values.items():
                    e.value.add(name=value, number=number)
        for spec in fields.split(", "):
            kind, name, number = spec.lstrip("*").split()
            f = m.field.add(name=name, number=int(number))
            f.label = field.LABEL_REPEATED if spec.startswith("*") else field.LABEL_OPTIONAL
            if kind in MESSAGES or kind in ENUMS:
                f.type = field.TYPE_ENUM if kind in ENUMS else field.TYPE_MESSAGE
                f.type_name = f".{PACKAGE}.{kind}"
            else:
                f.type = getattr(field, f"TYPE_{kind.upper()}")
    return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()


@lru_cache(maxsize=1)
def feed_message() -> type:
    """Message class for the Python fallback codec."""
    files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set()).file
    return message_factory.GetMessages(list(files), pool=descriptor_pool.DescriptorPool())[MESSAGE]
