"""Sources, sinks and streams on real folders."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headwind.operators import clean, coverage
from headwind.sources import feedspec, snapshots
from headwind.sources.records import record_schema
from headwind.sources.sinks import Lake, day_bounds, replace_days, with_utc_partitions
from headwind.sources.versioned_csv import read_versioned
from headwind.streaming import jobs

D = date(2026, 10, 1)


def message(feed_s, *entities):
    m = feedspec.feed_message()()
    m.header.gtfs_realtime_version, m.header.timestamp = "2.0", feed_s
    for build in entities:
        build(m.entity.add())
    return m.SerializeToString()


def trip_entity(name, stops):
    def build(e):
        e.id = name
        e.trip_update.trip.trip_id = name
        e.trip_update.trip.start_date = "20261005"
        for seq, at in stops:
            u = e.trip_update.stop_time_update.add()
            u.stop_sequence, u.stop_id = seq, f"s{seq}"
            if at is not None:
                u.arrival.time = at
            u.schedule_relationship = 1
    return build


def vehicle_entity(name, at):
    def build(e):
        e.id = name
        e.vehicle.vehicle.id = name
        e.vehicle.timestamp = at
        e.vehicle.position.latitude, e.vehicle.position.longitude = 39.5, -105.0
        e.vehicle.current_status = 2
    return build


def alert_entity(name):
    def build(e):
        e.id = name
        e.alert.cause, e.alert.effect = 10, 4
        e.alert.header_text.translation.add(text="first", language="en")
        e.alert.header_text.translation.add(text="second")
        e.alert.active_period.add(end=5)
        e.alert.informed_entity.add(route_id="7", route_type=3).trip.trip_id = "x"
    return build


def put(root, feed, day, feed_s, *entities, name=None):
    folder = root / f"feed={feed}" / f"date={day}" / "hour=08"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / (name or f"{feed}_{feed_s}.pb")).write_bytes(message(feed_s, *entities))


def test_decode_keeps_own_kind_and_unset_fields_stay_null(spark, tmp_path):
    mixed = (trip_entity("t1", [(1, 100), (2, None)]), vehicle_entity("v1", 50), alert_entity("a1"))
    put(tmp_path, "trip_updates", "2026-10-06", 10, *mixed)
    files = snapshots.read_files(spark, str(tmp_path), stream=False)
    got = {f: snapshots.bronze_records(files, f).collect() for f in snapshots.ENTITY_FIELD}
    assert [len(r) for r in got.values()] == [1, 1, 1]
    trip = got["trip_updates"][0]
    assert (trip.feed_timestamp, trip.trip_id, trip.route_id, trip.trip_delay) == (10, "t1", None, None)
    assert trip.trip_schedule_relationship is None
    assert [(u.arrival_time, u.departure_time, u.schedule_relationship) for u in trip.stop_time_updates] == [
        (100, None, "SKIPPED"),
        (None, None, "SKIPPED"),
    ]
    vehicle = got["vehicle_positions"][0]
    assert (vehicle.latitude, vehicle.current_status, vehicle.trip_id) == (39.5, "IN_TRANSIT_TO", None)
    alert = got["alerts"][0]
    assert (alert.cause, alert.effect, alert.severity_level) == ("CONSTRUCTION", "DETOUR", None)
    assert (alert.header_text, alert.description_text) == ("first", None)
    assert [tuple(p) for p in alert.active_periods] == [(None, 5)]
    assert [(i.route_id, i.trip_id, i.stop_id) for i in alert.informed_entities] == [("7", "x", None)]
    assert trip.source_file.endswith("trip_updates_10.pb") and trip.ingest_ts is not None
    for feed, rows in got.items():
        names = [f.name for f in record_schema(feed).fields]
        assert rows[0].__fields__ == [*names, "source_file", "ingest_ts"]


def test_large_message_comes_out_whole(spark, tmp_path):
    many = [trip_entity(f"t{i}", [(1, i)]) for i in range(snapshots.ENTITIES_PER_BATCH * 2 + 7)]
    put(tmp_path, "trip_updates", "2026-10-06", 10, *many)
    files = snapshots.read_files(spark, str(tmp_path), stream=False)
    rows = snapshots.bronze_records(files, "trip_updates")
    assert rows.select("entity_id").distinct().count() == len(many)


def test_bursts_read_each_file_once_and_only_the_named_kind(spark, tmp_path):
    raw, out, ck = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ck")
    put(raw, "trip_updates", "2026-10-06", 10, trip_entity("t1", [(1, 1)]))
    put(raw, "trip_updates", "2026-10-06", 11, trip_entity("no", []), name="trip_updates_11.tmp")
    put(raw, "alerts", "2026-10-06", 10, alert_entity("a"))
    for _ in range(2):
        jobs.ingest_feed(spark, str(raw), "trip_updates", out, ck)
    assert [r.entity_id for r in spark.read.parquet(out).collect()] == ["t1"]
    put(raw, "trip_updates", "2026-10-07", 20, trip_entity("t2", []))
    jobs.ingest_feed(spark, str(raw), "trip_updates", out, ck)
    assert sorted(r.entity_id for r in spark.read.parquet(out).collect()) == ["t1", "t2"]
    one = str(tmp_path / "one")
    jobs.ingest_feed(spark, str(raw), "trip_updates", one, ck + "1", "2026-10-07")
    assert [r.entity_id for r in spark.read.parquet(one).collect()] == ["t2"]


def test_watermark_survives_between_bursts_and_drops_late_rows(spark, tmp_path):
    base = 1791280800

    def burst(*rows):
        df = spark.createDataFrame(
            [(0, v, v, None, None, None, None, None, 39.5, -105.0, None, None, None, None, None, at, None, None)
             for v, at in rows],
            record_schema("vehicle_positions"),
        )
        return jobs.stream_through(df, jobs.silver_positions, str(tmp_path))

    burst(("v1", base), ("v1", base), ("v2", base + 3 * 3600))
    burst(("v1", base), ("v3", base + 60), ("v4", base + 2 * 3600), ("v2", base + 3 * 3600))
    got = burst(("v5", base + 2 * 3600))
    assert sorted((r.vehicle_id, int(r.vehicle_ts.timestamp()) - base) for r in got.collect()) == [
        ("v1", 0),
        ("v2", 10800),  # the copy of the second burst is known
        ("v4", 7200),  # two hours behind the newest, still in time; v1 and v3 came too late
        ("v5", 7200),
    ]


def test_stream_joins_the_schedule_and_drops_bad_rows(spark, tmp_path):
    rows = [(1791201600, "e", t, "15", 0, "20261005", None, None, "v", None, None, None,
             [(1, "s1", 1791208890, None, None, None, None), (7, "s7", 1, None, None, None, None)])
            for t in ("t1", "t1", None)]
    schedule = spark.createDataFrame(
        [("t1", 1, "s1", 28800, 28800)],
        "trip_id string, stop_sequence int, scheduled_stop_id string, scheduled_arrival_secs int, scheduled_departure_secs int",
    )
    df = spark.createDataFrame(rows, record_schema("trip_updates")).withColumn("ingest_ts", F.current_timestamp())
    out = jobs.stream_through(df, lambda s: jobs.silver_stop_updates(s, schedule), str(tmp_path))
    assert sorted((r.stop_sequence, r.arrival_delay_s) for r in out.collect()) == [(1, 90), (7, None)]
    assert {r.trip_id for r in out.collect()} == {"t1"} and out.count() == 2


def test_range_replace_touches_only_its_days_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select("id", F.date_add(F.lit(D), (F.col("id") % 10).cast("int")).alias("service_date"))
    replace_days(rows, path, D, D + timedelta(days=9))
    new = spark.createDataFrame([(100, D + timedelta(days=3)), (200, D + timedelta(days=8))], "id long, service_date date")
    for _ in range(2):
        replace_days(new, path, D + timedelta(days=3), D + timedelta(days=4))
    got = spark.read.parquet(path)
    assert got.where(F.col("service_date") == D + timedelta(days=3)).select("id").collect()[0].id == 100
    assert got.where(F.col("service_date") == D + timedelta(days=4)).isEmpty()
    assert got.count() == 40 - 8 + 1
    assert day_bounds(got) == (D, D + timedelta(days=9))
    assert day_bounds(got, "2026-10-03", "2026-10-04") == (date(2026, 10, 3), date(2026, 10, 4))
    assert day_bounds(got, "", "2026-10-04") == (D, date(2026, 10, 4))
    assert not (tmp_path / "t.staging").exists()


def test_lake_paths_append_and_overwrite_with_a_new_schema(spark, tmp_path):
    lake = Lake(str(tmp_path), "dev_")
    assert lake.name("gold", "t") == "dev_gold.t"
    df = spark.range(3)
    lake.append(df, "gold", "t")
    lake.append(df, "gold", "t")
    assert lake.read(spark, "gold", "t").count() == 6
    lake.overwrite(df.withColumn("x", F.lit(1)), "gold", "t")
    assert lake.read(spark, "gold", "t").columns == ["id", "x"]
    assert not lake.exists(spark, "gold", "other")


def test_versioned_csv_selects_by_name(spark, tmp_path):
    for version, header, row in (("a", "trip_id,stop_id,stop_sequence,arrival_time,departure_time,extra", "t,s,1,08:00:00,,x"),
                                 ("b", "stop_sequence,trip_id,arrival_time,departure_time,stop_id", "2,t,25:00:00,25:00:30,s")):
        folder = tmp_path / f"version={version}"
        folder.mkdir()
        (folder / "stop_times.txt").write_text(f"{header}\n{row}\n")
    rows = {r.gtfs_version: r for r in read_versioned(spark, str(tmp_path), "stop_times").collect()}
    assert (rows["a"].stop_sequence, rows["a"].departure_time) == ("1", None)
    assert (rows["b"].stop_sequence, rows["b"].arrival_time) == ("2", "25:00:00")


def ts(*seconds):
    return [("f", datetime(1970, 1, 1) + timedelta(seconds=s)) for s in seconds]


def test_gaps_and_coverage(spark):
    df = spark.createDataFrame(ts(0, 60, 120, 600, 900, 900), "feed string, ts timestamp")
    gaps = coverage.gaps(df, "feed", "ts", 300, slice_s=100)
    got = gaps.select(F.unix_seconds("gap_start"), F.unix_seconds("gap_end"), "gap_s").collect()
    assert [tuple(r) for r in got] == [(120, 600, 480)]  # exactly 300 s is no gap
    row = coverage.coverage_summary(df, "feed", "ts").first()
    assert (row.snapshots, row.n_gaps, row.gap_longest_s) == (6, 1, 480)
    single = spark.createDataFrame(ts(5), "feed string, ts timestamp")
    assert coverage.coverage_summary(single, "feed", "ts").first().n_gaps == 0


def test_freshness(spark):
    feeds = spark.createDataFrame([("f",), ("none",)], "feed string")
    df = spark.createDataFrame(ts(1000), "feed string, ts timestamp")

    def fresh(now):
        clock = F.timestamp_seconds(F.lit(now))
        return {r.feed: r.is_fresh for r in coverage.freshness(feeds, df, "feed", "ts", clock).collect()}

    assert fresh(1060) == {"f": True, "none": False}
    assert fresh(1301) == {"f": False, "none": False}


def test_manifests(spark):
    names = ["trip_updates_5.pb", "trip_updates_5.tmp", "alerts_7.pb", "other_1.pb", "trip_updates_x.pb"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = coverage.parse_manifest(df, ["trip_updates", "alerts"]).collect()
    assert sorted((r.feed, r.header_s) for r in got) == [("alerts", 7), ("trip_updates", 5)]
    some = spark.createDataFrame([("alerts_7.pb",)], "name string")
    assert [r.name for r in coverage.missing_from(df, some).collect()] == sorted(set(names) - {"alerts_7.pb"})
    bounds = spark.createDataFrame([(D, D + timedelta(days=2))], "a date, b date")
    assert [r.day for r in coverage.date_spine(bounds, "a", "b").collect()] == [D + timedelta(days=i) for i in range(3)]


def test_snapshot_path_and_partitions(spark):
    df = spark.createDataFrame([("trip_updates", 1791276877)], "feed string, s long")
    row = with_utc_partitions(df, "s").withColumn("p", coverage.snapshot_path(F.col("feed"), F.col("s"))).first()
    assert row.p == "feed=trip_updates/date=2026-10-06/hour=08/trip_updates_1791276877.pb"
    assert (row.date, row.hour) == ("2026-10-06", "08")


def test_repeated_headers_are_skipped_in_arrival_order(spark):
    rows = [("f", 1, 10), ("f", 2, 10), ("f", 3, 20), ("f", 4, 10), ("g", 5, 10), ("f", 6, None), ("f", 7, None)]
    df = spark.createDataFrame(rows, "feed string, n int, header long")
    got = coverage.changed_only(df, "feed", [F.col("n")], F.floor(F.col("n") / 2), "header")
    assert sorted(r.n for r in got.collect()) == [1, 3, 4, 5, 6]


def test_explode_drops_trips_without_stops_and_outer_keeps_parents(spark, tmp_path):
    put(tmp_path, "trip_updates", "2026-10-06", 10, trip_entity("t1", []), trip_entity("t2", [(1, 1), (2, 2)]))
    files = snapshots.read_files(spark, str(tmp_path), stream=False)
    rows = snapshots.bronze_records(files, "trip_updates")
    assert [r.trip_id for r in clean.stop_updates_of(rows).collect()] == ["t2", "t2"]
    assert rows.select(F.explode_outer("stop_time_updates")).count() == 3


@pytest.mark.parametrize("feed", ["trip_updates", "vehicle_positions", "alerts"])
def test_messages_are_those_of_the_json_reader(spark, feed):
    """The encoder leaves Python's slow JSON reader out and still writes the same bytes."""
    import json

    from google.protobuf import json_format

    from headwind.plans.views import Views
    from headwind.sources import snapshot_writer

    assert not hasattr(snapshot_writer, "json_format")
    entities = Views(spark, "/root/testdata/sf0.001").entities(feed).withColumn("header_s", F.lit(17).cast("long")).coalesce(1)
    files = snapshot_writer.encode_snapshots(entities, feed).collect()
    texts = entities.orderBy("e.id").select(F.to_json("e").alias("t")).collect()
    message = feedspec.feed_message()
    header = {"gtfs_realtime_version": "2.0", "timestamp": 17}
    want = json_format.ParseDict({"header": header, "entity": [json.loads(r.t) for r in texts]}, message())
    got = sorted((e for f in files for e in message.FromString(f.content).entity), key=lambda e: e.id)
    assert got == sorted(want.entity, key=lambda e: e.id) and len(got) == len(texts) > 0
    assert {message.FromString(f.content).header.timestamp for f in files} == {17}
