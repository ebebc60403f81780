"""The composed jobs on real files: two bursts, late news for one day, training, scoring."""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from headwind.operators import models
from headwind.plans import dataflow
from headwind.settings import DEFAULTS
from headwind.sources.sinks import Lake
from tests.test_io import alert_entity, put, trip_entity, vehicle_entity

START = 1791180000  # service day 2026-10-05 begins at 06:00 UTC
SETTINGS = replace(DEFAULTS, horizons=(1, 2))


def static_files(root):
    folder = root / "version=A"
    folder.mkdir(parents=True)
    trips = [f"t{i}" for i in range(6)]
    files = {
        "feed_info": ["feed_publisher_name,feed_start_date,feed_end_date,feed_version", "p,20261001,20261231,A"],
        "routes": ["route_id,route_short_name,route_long_name,route_type", "15,15,,3"],
        "trips": ["route_id,service_id,trip_id,trip_headsign,direction_id,block_id"]
        + [f"15,wk,{t},,0," for t in trips],
        "stop_times": ["trip_id,arrival_time,departure_time,stop_id,stop_sequence"]
        + [f"{t},{8 + i:02d}:{5 * s:02d}:00,,s{s},{s}" for i, t in enumerate(trips) for s in range(1, 9)],
        "stops": ["stop_id,stop_name,stop_lat,stop_lon,parent_station"] + [f"s{s},x,39.7,-105.0," for s in range(1, 9)],
    }
    for name, lines in files.items():
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")


def snapshots_of(raw, i, delay):
    """Trip i drops one stop per snapshot; the snapshot is taken a minute before the next arrival."""
    due = [START + (8 + i) * 3600 + 300 * s + delay for s in range(1, 9)]
    for first in range(8):
        feed_s = due[first] - 60
        entity = trip_entity(f"t{i}", [(s + 1, due[s]) for s in range(first, 8)])
        put(raw, "trip_updates", "2026-10-05", feed_s, entity)
        put(raw, "vehicle_positions", "2026-10-05", feed_s, vehicle_entity(f"v{i}", feed_s))
    put(raw, "alerts", "2026-10-05", due[0], alert_entity("a"))


def test_refresh_train_and_score(spark, tmp_path):
    raw, static = tmp_path / "raw", tmp_path / "static"
    lake = Lake(str(tmp_path / "lake"), "dev_")
    static_files(static)
    for i in range(4):
        snapshots_of(raw, i, 60 * i)
    dataflow.refresh(spark, lake, str(raw), str(static), SETTINGS)
    labels = lake.read(spark, "gold", "stop_arrivals")
    assert labels.count() == 32 and labels.where("is_observed AND label_lead_s = 60").count() == 32
    assert sorted({r.delay_s for r in labels.collect()}) == [0, 60, 120, 180]
    hourly = lake.read(spark, "gold", "route_delay_hourly")
    assert hourly.agg(F.sum("n_arrivals")).first()[0] == 32
    made = labels.agg(F.max("processed_ts")).first()[0]

    # nothing new: no date is due, labels stay as they were
    dataflow.relabel(spark, lake, SETTINGS)
    assert lake.read(spark, "gold", "stop_arrivals").agg(F.max("processed_ts")).first()[0] == made

    snapshots_of(raw, 4, 240)
    dataflow.refresh(spark, lake, str(raw), str(static), SETTINGS)
    labels = lake.read(spark, "gold", "stop_arrivals")
    assert labels.count() == 40 and labels.agg(F.min("processed_ts")).first()[0] > made
    assert lake.read(spark, "bronze", "trip_updates").count() == 40
    assert lake.read(spark, "silver", "positions").count() == 40
    assert lake.read(spark, "silver", "alerts").count() == 1

    first, last = dataflow.build_training_set(spark, lake, settings=SETTINGS)
    assert (first, last) == (date(2026, 10, 5), date(2026, 10, 5))
    examples = lake.read(spark, "gold", "training_set")
    # horizons 1 and 2 on eight stops of five trips; stop 8 is the last scheduled one
    assert examples.count() == 5 * (7 + 6)
    assert examples.where("current_delay_s <> target_delay_s").isEmpty()
    assert examples.where("provider_pred_s <> target_delay_s OR provider_pred_s IS NULL").isEmpty()
    ahead = examples.where("trip_id = 't4' AND anchor_stop_sequence = 1 AND horizon = 1").first()
    assert (ahead.ahead_delay_s, ahead.stops_remaining) == (180, 7)

    run = dataflow.train(spark, lake, settings=SETTINGS, pipelines={"linear": models.linear_pipeline()})
    assert run.best is None and run.split.preliminary  # one day leaves nothing to train on
    dataflow.score(spark, lake, SETTINGS)
    predictions = lake.read(spark, "gold", "delay_predictions")
    assert {r.predictor for r in predictions.select("predictor").distinct().collect()} <= {"persistence", "provider"}
    live = lake.read(spark, "gold", "live_vehicles")
    assert live.count() == 0  # these vehicles report no trip


def test_refresh_without_any_alert_or_position(spark, tmp_path):
    """Feeds that have no folder, or an empty one, give empty tables; a later file is picked up."""
    raw, static = tmp_path / "raw", tmp_path / "static"
    lake = Lake(str(tmp_path / "lake"), "dev_")
    static_files(static)
    put(raw, "trip_updates", "2026-10-05", START, trip_entity("t0", [(1, START + 8 * 3600)]))
    (raw / "feed=alerts").mkdir()
    dataflow.refresh(spark, lake, str(raw), str(static), SETTINGS)
    assert lake.read(spark, "silver", "stop_updates").count() == 1
    assert lake.read(spark, "silver", "alerts").count() == 0
    put(raw, "alerts", "2026-10-05", START, alert_entity("a"))
    dataflow.refresh(spark, lake, str(raw), str(static), SETTINGS)
    assert lake.read(spark, "silver", "alerts").count() == 1
