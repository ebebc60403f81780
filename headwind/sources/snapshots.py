"""Raw snapshot files, one protobuf feed message each, to typed bronze rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwind.sources import feedspec
from headwind.sources.records import record_schema

FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"
ENTITIES_PER_BATCH = 2000

# fixed values: the entity field that carries each feed
ENTITY_FIELD = {"trip_updates": "trip_update", "vehicle_positions": "vehicle", "alerts": "alert"}

_TRIP = "struct<trip_id: string, start_time: string, start_date: string, schedule_relationship: string, route_id: string, direction_id: bigint>"
_EVENT = "struct<delay: int, time: bigint>"
_VEHICLE = "struct<id: string, label: string>"
_TEXT = "struct<translation: array<struct<text: string, language: string>>>"

# the decoded form of one entity, per feed, named as in the message
ENTITY = {
    "trip_updates": f"""struct<id: string, trip_update: struct<trip: {_TRIP},
        stop_time_update: array<struct<stop_sequence: bigint, arrival: {_EVENT}, departure: {_EVENT},
            stop_id: string, schedule_relationship: string>>,
        vehicle: {_VEHICLE}, timestamp: bigint, delay: int>>""",
    "vehicle_positions": f"""struct<id: string, vehicle: struct<trip: {_TRIP},
        position: struct<latitude: float, longitude: float, bearing: float, speed: float>,
        current_stop_sequence: bigint, current_status: string, timestamp: bigint, stop_id: string,
        vehicle: {_VEHICLE}, occupancy_status: string, occupancy_percentage: bigint>>""",
    "alerts": f"""struct<id: string, alert: struct<
        active_period: array<struct<start: bigint, end: bigint>>,
        informed_entity: array<struct<agency_id: string, route_id: string, route_type: int,
            trip: {_TRIP}, stop_id: string, direction_id: bigint>>,
        cause: string, effect: string, severity_level: string, header_text: {_TEXT},
        description_text: {_TEXT}>>""",
}


def _records_from(feed: str) -> dict[str, Column]:
    """Bronze columns as expressions over one entity `e`."""
    e = F.col("e")
    if feed == "trip_updates":
        u = e["trip_update"]
        trip = u["trip"]
        return {
            "entity_id": e["id"],
            "trip_id": trip["trip_id"],
            "route_id": trip["route_id"],
            "direction_id": trip["direction_id"],
            "start_date": trip["start_date"],
            "start_time": trip["start_time"],
            "trip_schedule_relationship": trip["schedule_relationship"],
            "vehicle_id": u["vehicle"]["id"],
            "vehicle_label": u["vehicle"]["label"],
            "update_timestamp": u["timestamp"],
            "trip_delay": u["delay"],
            "stop_time_updates": F.transform(
                u["stop_time_update"],
                lambda s: F.struct(
                    s["stop_sequence"],
                    s["stop_id"],
                    s["arrival"]["time"],
                    s["arrival"]["delay"],
                    s["departure"]["time"],
                    s["departure"]["delay"],
                    s["schedule_relationship"],
                ),
            ),
        }
    if feed == "vehicle_positions":
        v = e["vehicle"]
        place = v["position"]
        return {
            "entity_id": e["id"],
            "vehicle_id": v["vehicle"]["id"],
            "vehicle_label": v["vehicle"]["label"],
            "trip_id": v["trip"]["trip_id"],
            "route_id": v["trip"]["route_id"],
            "direction_id": v["trip"]["direction_id"],
            "start_date": v["trip"]["start_date"],
            **{c: place[c] for c in ("latitude", "longitude", "bearing", "speed")},
            "vehicle_timestamp": v["timestamp"],
            **{
                c: v[c]
                for c in (
                    "current_status",
                    "current_stop_sequence",
                    "stop_id",
                    "occupancy_status",
                    "occupancy_percentage",
                )
            },
        }
    a = e["alert"]
    return {
        "entity_id": e["id"],
        "cause": a["cause"],
        "effect": a["effect"],
        "severity_level": a["severity_level"],
        "header_text": F.get(a["header_text"]["translation"]["text"], F.lit(0)),
        "description_text": F.get(a["description_text"]["translation"]["text"], F.lit(0)),
        "active_periods": F.transform(a["active_period"], lambda p: F.struct(p["start"], p["end"])),
        "informed_entities": F.transform(
            a["informed_entity"],
            lambda i: F.struct(
                i["agency_id"],
                i["route_id"],
                i["route_type"],
                i["direction_id"],
                i["stop_id"],
                i["trip"]["trip_id"],
            ),
        ),
    }


def protobuf_loaded(spark: SparkSession) -> bool:
    """Is Spark's own protobuf reader on the class path?"""
    try:
        spark._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.protobuf.ProtobufDataToCatalyst",
            False,
            spark._jvm.java.lang.Thread.currentThread().getContextClassLoader(),
        )
        return True
    except Exception:
        return False


def decode_entities(files: DataFrame, feed: str) -> DataFrame:
    """`(path, content)` to one row per entity of this feed: source_file, header_s, e.

    With the spark-protobuf package the message is decoded inside the JVM. Without it, Arrow
    batches go through a small Python decoder that yields a bounded number of entities at a time.
    """
    part = ENTITY_FIELD[feed]
    if protobuf_loaded(files.sparkSession):
        from pyspark.sql.protobuf.functions import from_protobuf

        message = from_protobuf(
            "content", feedspec.MESSAGE, binaryDescriptorSet=feedspec.descriptor_set()
        )
        return (
            files.select(F.col("path").alias("source_file"), message.alias("m"))
            .select(
                "source_file", F.col("m.header.timestamp").alias("header_s"), F.explode("m.entity").alias("e")
            )
            .where(F.isnotnull(f"e.{part}"))
        )
    schema = T.StructType.fromDDL(f"source_file string, header_s bigint, e {ENTITY[feed]}")
    return files.select("path", "content").mapInArrow(_decoder(schema, part), schema)


def _decoder(schema: T.StructType, part: str):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    entity_type = schema["e"].dataType

    def reader(kind: T.StructType, descriptor):
        """A function from message to dict, with every type decision made beforehand."""
        plan = []
        for f in kind.fields:
            field = descriptor.fields_by_name[f.name]
            if isinstance(f.dataType, T.ArrayType):
                plan.append((f.name, "many", reader(f.dataType.elementType, field.message_type)))
            elif isinstance(f.dataType, T.StructType):
                plan.append((f.name, "one", reader(f.dataType, field.message_type)))
            elif field.enum_type is not None:
                names = {n: v.name for n, v in field.enum_type.values_by_number.items()}
                plan.append((f.name, "value", names.get))
            else:
                plan.append((f.name, "value", None))

        def read(message) -> dict:
            row = {}
            for name, form, convert in plan:
                if form == "many":
                    row[name] = [convert(item) for item in getattr(message, name)]
                elif message.HasField(name):
                    value = getattr(message, name)
                    row[name] = convert(value) if convert else value
            return row

        return read

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message_class = feedspec.feed_message()
        entity_fields = message_class.DESCRIPTOR.fields_by_name["entity"].message_type
        read = reader(entity_type, entity_fields)
        rows: list[dict] = []
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                feed = message_class.FromString(content.as_py())
                header_s = feed.header.timestamp if feed.header.HasField("timestamp") else None
                for entity in feed.entity:
                    if entity.HasField(part):
                        rows.append(
                            {
                                "source_file": path.as_py(),
                                "header_s": header_s,
                                "e": read(entity),
                            }
                        )
                    if len(rows) >= ENTITIES_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return decode


def typed_records(entities: DataFrame, feed: str, schema: T.StructType | None = None) -> DataFrame:
    """Project entities to the declared columns, each cast to its declared type."""
    expressions = {"feed_timestamp": F.col("header_s"), **_records_from(feed)}
    schema = schema or record_schema(feed)
    return entities.select(
        *[expressions[f.name].cast(f.dataType).alias(f.name) for f in schema.fields], "source_file"
    )


def bronze_records(files: DataFrame, feed: str) -> DataFrame:
    """Typed rows with where they came from and when they were read."""
    rows = typed_records(decode_entities(files, feed), feed)
    return rows.withColumn("ingest_ts", F.current_timestamp())


def watched_folder(root: str, feed: str, day: str | None = None) -> str:
    """Folder of a feed, or of one UTC date of it."""
    folder = f"{root.rstrip('/')}/feed={feed}"
    return f"{folder}/date={day}" if day else folder


def bronze_schema(feed: str) -> T.StructType:
    """Columns of `bronze_records`, for tables that have no files yet."""
    return T.StructType(
        [
            *record_schema(feed).fields,
            T.StructField("source_file", T.StringType()),
            T.StructField("ingest_ts", T.TimestampType()),
        ]
    )


def read_files(
    spark: SparkSession, folder: str, stream: bool, files_per_batch: int | None = None, archive: str | None = None
) -> DataFrame:
    """Snapshot files below a folder, as a batch or as a stream that sees each file once.

    `files_per_batch` bounds a micro-batch of the stream; all files are read in any case. With an
    `archive` folder the stream moves files there, under their whole paths, once their batch is done;
    what it lists then does not grow with the history of the feed.
    """
    reader = spark.readStream.schema(FILE_COLUMNS) if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if stream and archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (
        reader.format("binaryFile")
        .option("pathGlobFilter", "*.pb")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
