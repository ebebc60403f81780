"""What a refresh does with a second and third burst: it counts, merges, lists and labels new data only."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headwind.operators.clean import alert_history
from headwind.operators.features import daily_delays
from headwind.operators.labels import known_outcomes
from headwind.plans import dataflow
from headwind.settings import DEFAULTS
from headwind.sources.sinks import Lake, drop_empty_folders
from headwind.sources.sinks import remove as sinks_remove
from headwind.sources.snapshots import bronze_schema
from headwind.streaming import jobs
from tests.test_dataflow import START, static_files
from tests.test_io import alert_entity, put, trip_entity, vehicle_entity

SETTINGS = replace(DEFAULTS, alert_buckets=8, days_per_pass=1)
DAY_S = 86_400


def far_vehicle(name, at):
    def build(e):
        vehicle_entity(name, at)(e)
        e.vehicle.position.latitude = 10.0
    return build


def trip_of(day, name, stops):
    def build(e):
        trip_entity(name, stops)(e)
        e.trip_update.trip.start_date = f"2026100{day}"
    return build


def arrival(day, trip, stop, delay=0):
    return START + (day - 5) * DAY_S + (8 + trip) * 3600 + 300 * stop + delay


def stop_snapshot(raw, day, trip, stop, delay=0):
    at = arrival(day, trip, stop, delay)
    put(raw, "trip_updates", f"2026-10-0{day}", at - 60, trip_of(day, f"t{trip}", [(stop, at)]))


@pytest.fixture
def place(spark, tmp_path):
    raw, static = tmp_path / "raw", tmp_path / "static"
    static_files(static)
    lake = Lake(str(tmp_path / "lake"))

    def refresh(**more):
        dataflow.refresh(spark, lake, str(raw), str(static), SETTINGS, **more)

    return raw, lake, refresh


def counts_of(spark, lake):
    """Per run, in order: (table, rule) -> (rows, passed, dropped)."""
    rows = lake.read(spark, "gold", "quality").orderBy("counted_at").collect()
    runs = list(dict.fromkeys(r.run_id for r in rows))
    assert len({(r.run_id, r["name"], r.rule) for r in rows}) == len(rows)
    return [{(r["name"], r.rule): (r.n_rows, r.n_passed, r.n_dropped) for r in rows if r.run_id == run} for run in runs]


def test_each_refresh_leaves_its_own_rule_counts(spark, place):
    raw, lake, refresh = place
    stop_snapshot(raw, 5, 0, 1)
    stop_snapshot(raw, 5, 0, 2, delay=9000)  # beyond the delays that are kept
    put(raw, "vehicle_positions", "2026-10-05", START, vehicle_entity("v1", START), far_vehicle("v2", START))
    refresh()
    stop_snapshot(raw, 5, 1, 1)
    put(raw, "vehicle_positions", "2026-10-05", START + 9, far_vehicle("v1", START + 9))
    refresh()
    refresh()
    first, second, third = counts_of(spark, lake)
    assert len(first) == 9 and first.keys() == second.keys() == third.keys()
    assert first["silver.stop_updates", "delay_in_bounds"] == (2, 1, 1)
    assert first["silver.stop_updates", "trip_id_present"] == (2, 2, 1)
    assert first["silver.stop_updates", "schedule_matched"] == (2, 2, 1)
    assert first["silver.positions", "position_in_area"] == (2, 1, 1)
    assert first["silver.stops", "stop_in_area"] == (8, 8, 0)
    assert first["gold.stop_arrivals", "label_is_observed"] == (1, 1, 0)
    assert second["silver.stop_updates", "delay_in_bounds"] == (1, 1, 0)
    assert second["silver.positions", "position_in_area"] == (1, 0, 1)
    # the day was labelled again, with the label of the first burst
    assert second["gold.stop_arrivals", "label_is_observed"] == (2, 2, 0)
    assert third["silver.stop_updates", "delay_in_bounds"] == (0, 0, 0)
    assert third["gold.stop_arrivals", "delay_in_bounds"] == (0, 0, 0)
    none = lake.read(spark, "gold", "quality").where("n_rows = 0")
    assert none.where("pass_rate is not null").isEmpty() and not none.isEmpty()


def alerts_now(spark, lake):
    return sorted(map(str, (tuple(r) for r in lake.read(spark, "silver", "alerts").drop("bucket").collect())))


def alerts_anew(spark, lake):
    bronze = lake.read(spark, "bronze", "alerts", bronze_schema("alerts"))
    order = lake.read(spark, "silver", "alerts").drop("bucket").columns
    return sorted(map(str, (tuple(r) for r in alert_history(bronze).select(*order).collect())))


def data_files(lake):
    return {str(p) for p in Path(lake.path("silver", "alerts")).rglob("*.parquet")}


def alerts_burst(spark, raw, lake, number, names):
    put(raw, "alerts", "2026-10-05", START + 60 * number, *map(alert_entity, names))
    jobs.ingest_feed(spark, str(raw), "alerts", lake.path("bronze", "alerts"), lake.checkpoint("bronze_alerts"))
    dataflow.extend_alerts(spark, lake, SETTINGS)


def test_alert_history_merges_bursts_in_their_buckets_only(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    dataflow.extend_alerts(spark, lake, SETTINGS)  # no alerts yet
    assert lake.read(spark, "silver", "alerts").count() == 0
    alerts_burst(spark, raw, lake, 5, [f"a{i}" for i in range(20)])
    before = data_files(lake)
    alerts_burst(spark, raw, lake, 9, ["a3", "new"])
    alerts_burst(spark, raw, lake, 2, ["a3"])  # an earlier snapshot that came late
    assert alerts_now(spark, lake) == alerts_anew(spark, lake) and len(alerts_now(spark, lake)) == 21
    kept = len(before & data_files(lake))
    assert kept >= len(before) - 2  # two keys lie in two buckets at most
    row = lake.read(spark, "silver", "alerts").where("entity_id = 'a3'").first()
    assert (row.last_seen_ts - row.first_seen_ts).total_seconds() == 7 * 60


def test_alert_history_is_built_anew_after_a_broken_replacement(spark, tmp_path, monkeypatch):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    alerts_burst(spark, raw, lake, 1, ["a", "b"])

    def broken(self, df, *rest):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(Lake, "replace_parts", broken)
        alerts_burst(spark, raw, lake, 2, ["a", "c"])
    # as if the old buckets had been moved away and the new ones not moved in
    lake.overwrite(lake.read(spark, "silver", "alerts").limit(0), "silver", "alerts", "bucket")
    dataflow.extend_alerts(spark, lake, SETTINGS)
    assert alerts_now(spark, lake) == alerts_anew(spark, lake) and len(alerts_now(spark, lake)) == 3
    assert not lake.exists(spark, "silver", "alerts_being_replaced")


def test_an_alert_table_without_buckets_is_taken_over(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    put(raw, "alerts", "2026-10-05", START, alert_entity("a"))
    jobs.ingest_feed(spark, str(raw), "alerts", lake.path("bronze", "alerts"), lake.checkpoint("bronze_alerts"))
    lake.overwrite(alert_history(lake.read(spark, "bronze", "alerts")), "silver", "alerts")
    dataflow.extend_alerts(spark, lake, SETTINGS)
    assert alerts_now(spark, lake) == alerts_anew(spark, lake)


def test_bursts_list_open_dates_only(spark, tmp_path):
    raw, old, lake = tmp_path / "raw", tmp_path / "archive", Lake(str(tmp_path / "lake"))

    def burst():
        target, checkpoint = lake.path("bronze", "trip_updates"), lake.checkpoint("bronze")
        jobs.ingest_feed(spark, str(raw), "trip_updates", target, checkpoint, archive=str(old))
        return sorted(r.entity_id for r in spark.read.parquet(target).collect())

    def watched():
        return sorted(p.name for p in (raw / "feed=trip_updates").glob("date=*"))

    for i in range(3):
        put(raw, "trip_updates", "2026-10-05", 10 + i, trip_entity(f"a{i}", [(1, 1)]))
    assert burst() == ["a0", "a1", "a2"]
    put(raw, "trip_updates", "2026-10-06", 20, trip_entity("b", [(1, 1)]))
    assert burst() == ["a0", "a1", "a2", "b"]
    put(raw, "trip_updates", "2026-10-07", 30, trip_entity("c", [(1, 1)]))
    put(raw, "trip_updates", "2026-10-05", 13, trip_entity("late", [(1, 1)]))
    assert burst() == ["a0", "a1", "a2", "b", "c", "late"]
    assert burst() == ["a0", "a1", "a2", "b", "c", "late"]
    put(raw, "trip_updates", "2026-10-08", 40, trip_entity("d", [(1, 1)]))
    assert burst() == ["a0", "a1", "a2", "b", "c", "d", "late"]
    assert "date=2026-10-06" not in watched() and "date=2026-10-08" in watched()
    archived = {p.name for p in old.rglob("*.pb")}
    left = {p.name for p in raw.rglob("*.pb")}
    assert {f"trip_updates_{t}.pb" for t in (10, 11, 12, 20)} <= archived
    assert len(archived | left) == 7 and not archived & left


def test_folders_with_files_are_never_dropped(spark, tmp_path):
    for name in ("a/b", "a/c", "d/e"):
        (tmp_path / "top" / name).mkdir(parents=True)
    (tmp_path / "top/a/b/file").write_text("x")
    drop_empty_folders(spark, str(tmp_path / "top"))
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_dir()) == ["top", "top/a", "top/a/b"]
    drop_empty_folders(spark, str(tmp_path / "none"))


def test_only_the_dates_of_new_updates_are_labelled_again(spark, place, monkeypatch):
    raw, lake, refresh = place
    for day in (5, 6):
        for stop in (1, 2):
            stop_snapshot(raw, day, 0, stop)
    refresh()
    made = {r.service_date.day: r.t for r in lake.read(spark, "gold", "stop_arrivals").groupBy("service_date").agg(F.max("processed_ts").alias("t")).collect()}
    assert sorted(made) == [5, 6]
    stop_snapshot(raw, 6, 0, 3, delay=30)

    def broken(self, df, *rest):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(Lake, "replace_parts", broken)
        refresh()
    dataflow.relabel(spark, lake, SETTINGS)  # the batch comes again
    labels = lake.read(spark, "gold", "stop_arrivals")
    again = {r.service_date.day: r.t for r in labels.groupBy("service_date").agg(F.max("processed_ts").alias("t")).collect()}
    assert again[5] == made[5] and again[6] > made[6] and labels.count() == 5
    noted = lake.read(spark, "gold", "label_batches").select("batch", F.dayofmonth("service_date").alias("d")).collect()
    assert sorted(map(tuple, noted)) == [(0, 5), (0, 6), (1, 6)]


def sums_now(spark, lake):
    found = lake.read(spark, "gold", dataflow.DAILY)
    return sorted(map(str, found.select(sorted(found.columns)).collect()))


def sums_anew(spark, lake):
    made = daily_delays(known_outcomes(lake.read(spark, "gold", "stop_arrivals")), SETTINGS)
    return sorted(map(str, made.select(sorted(made.columns)).collect()))


def means_of(spark, lake):
    columns = ("service_date", "trip_id", "anchor_stop_sequence", "horizon", "hist_avg_delay_s", "hist_n")
    return sorted(map(str, lake.read(spark, "gold", "training_set").select(*columns).collect()))


def test_trailing_means_come_from_daily_sums_that_follow_the_labels(spark, place):
    raw, lake, refresh = place
    for day in (5, 6, 7):
        for stop in range(1, 5):
            stop_snapshot(raw, day, 0, stop, delay=10 * day)
    refresh()
    assert sums_now(spark, lake) == sums_anew(spark, lake) != []
    kept = {str(p) for p in Path(lake.path("gold", dataflow.DAILY)).rglob("service_date=2026-10-05/*.parquet")}
    stop_snapshot(raw, 6, 0, 4, delay=100)  # news for one day
    stop_snapshot(raw, 8, 0, 1)
    refresh()
    assert sums_now(spark, lake) == sums_anew(spark, lake)
    assert kept == {str(p) for p in Path(lake.path("gold", dataflow.DAILY)).rglob("service_date=2026-10-05/*.parquet")}
    dataflow.build_training_set(spark, lake, "2026-10-07", settings=SETTINGS)
    stored = means_of(spark, lake)
    assert stored and all("2026, 10, 7" in row or "2026, 10, 8" in row for row in stored)
    assert not all("hist_n=0" in row for row in stored)
    # without the table, the same means come from the outcomes
    sinks_remove(spark, lake.path("gold", dataflow.DAILY))
    dataflow.build_training_set(spark, lake, "2026-10-07", settings=SETTINGS)
    assert means_of(spark, lake) == stored
    stop_snapshot(raw, 8, 0, 2)
    refresh()  # a lake without the table gets it for all days
    assert sums_now(spark, lake) == sums_anew(spark, lake)


def test_daily_sums_left_half_written_are_made_anew(spark, place):
    raw, lake, refresh = place
    for day in (5, 6):
        stop_snapshot(raw, day, 0, 1)
    refresh()
    sinks_remove(spark, lake.path("gold", f"{dataflow.DAILY}/_SUCCESS"))
    sinks_remove(spark, lake.path("gold", f"{dataflow.DAILY}/service_date=2026-10-05"))
    assert dataflow.stored_daily_delays(spark, lake) is None
    stop_snapshot(raw, 6, 0, 2)
    refresh()
    assert sums_now(spark, lake) == sums_anew(spark, lake)
