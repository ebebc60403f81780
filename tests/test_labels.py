from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from headwind.operators.clean import alert_history, distinct_by, positions_of, stop_updates_of
from headwind.operators.labels import hourly_delay, known_outcomes, last_prediction_label
from headwind.operators.quality import keep_valid, position_rules, rule_rates, stop_update_rules
from headwind.operators.schedule import (
    newest_version,
    of_version,
    schedule_of,
    with_schedule_delay,
)
from headwind.plans.reports import delay_distribution, label_quality
from headwind.sources.records import record_schema

DAY = date(2026, 10, 6)
ARRIVAL = datetime(2026, 10, 6, 23, 30)  # 17:30 in Denver, a Tuesday
LABEL = """service_date date, trip_id string, stop_sequence int, rt_route_id string, route_id string,
route_short_name string, route_type int, mode string, direction_id int, stop_id string,
scheduled_arrival_ts timestamp, feed_ts timestamp, predicted_arrival_ts timestamp"""


def update(seen_before_s, delay_s, trip="t1", predicted=True, scheduled=True):
    actual = ARRIVAL + timedelta(seconds=delay_s)
    return (
        DAY, trip, 3, "15", "15", "15", 3, "bus", 0, "s3", ARRIVAL if scheduled else None,
        actual - timedelta(seconds=seen_before_s), actual if predicted else None,
    )


def label(spark, *rows):
    return last_prediction_label(spark.createDataFrame(list(rows), LABEL))


def test_last_prediction_wins(spark):
    row = label(spark, update(900, 60), update(300, 120), update(90, 210)).first()
    assert (row.delay_s, row.label_lead_s, row.is_observed, row.n_snapshots) == (210, 90, True, 3)


def test_long_lead_is_not_observed_and_passed_prediction_is(spark):
    assert label(spark, update(600, 10)).first().is_observed is False
    row = label(spark, update(-30, 10)).first()
    assert (row.label_lead_s, row.is_observed) == (-30, True)
    assert known_outcomes(label(spark, update(-30, 10))).first().known_ts == row.last_seen_ts


def test_rows_without_prediction_are_ignored(spark):
    assert label(spark, update(60, 0, predicted=False)).count() == 0


def test_label_without_schedule_has_no_delay_but_counts(spark):
    rows = label(spark, update(60, 30, scheduled=False), update(60, 60, trip="t2"))
    assert rows.where("is_observed AND delay_s IS NULL").count() == 1
    hourly = hourly_delay(rows.withColumn("scheduled_arrival_ts", F.lit(ARRIVAL))).first()
    assert (hourly.n_arrivals, hourly.avg_delay_s) == (2, 60)


def test_hourly_report(spark):
    row = hourly_delay(label(spark, update(60, 60), update(60, 420, trip="t2"))).first()
    assert (row.hour_local, row.day_of_week, row.is_weekday) == (17, "Tue", True)
    assert (row.n_arrivals, row.avg_delay_s, row.share_late_5min) == (2, 240, 0.5)


def bronze_trip(spark, *rows):
    return spark.createDataFrame(list(rows), record_schema("trip_updates"))


def trip(stops, feed_s=1791276877, start="20261006", trip_id="t1"):
    updates = [(seq, stop, arrival, None, None, None, "SCHEDULED") for seq, stop, arrival in stops]
    return (feed_s, "e", trip_id, "15", 0, start, None, None, "v", None, None, None, updates)


def schedule(spark):
    files = (
        spark.createDataFrame([("t1", "08:00:00", "bad", "s1", "1"), ("t1", "25:00:00", "25:01:00", "s2", "2")],
                              "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence string"),
        spark.createDataFrame([("15", "wk", "t1", None, "0", None)],
                              "route_id string, service_id string, trip_id string, trip_headsign string, direction_id string, block_id string"),
        spark.createDataFrame([("15", "15", None, "3")],
                              "route_id string, route_short_name string, route_long_name string, route_type string"),
    )
    return schedule_of(*files)


def test_schedule_join_and_delay(spark):
    start = 1791266400  # 2026-10-06 06:00 UTC
    rows = bronze_trip(
        spark,
        trip([(1, "s1", start + 28800 + 90), (2, "s2", start + 90000 - 86400 + 30), (9, "s9", start)]),
        trip([(1, "s1", None)], feed_s=1791276900),
    )
    out = {(r.stop_sequence, r.predicted_arrival_ts is None): r
           for r in with_schedule_delay(stop_updates_of(rows), schedule(spark)).collect()}
    assert out[(1, False)].arrival_delay_s == 90 and out[(1, False)].service_date == DAY
    shifted = out[(2, False)]
    assert (shifted.service_date_shift_days, shifted.arrival_delay_s) == (-1, 30)
    assert out[(9, False)].scheduled_arrival_ts is None and out[(9, False)].arrival_delay_s is None
    assert out[(1, True)].service_date_shift_days == 0


def test_malformed_start_date_gives_null_not_an_error(spark):
    row = with_schedule_delay(
        stop_updates_of(bronze_trip(spark, trip([(1, "s1", 1)], start="tomorrow"))), schedule(spark)
    ).first()
    assert row.service_date is None


def test_version_choice(spark):
    v = spark.createDataFrame(
        [("20260101", "a"), ("20260601", "b"), ("20260601", "c")], "feed_start_date string, gtfs_version string"
    )
    assert newest_version(v).collect()[0][0] == "c"
    assert of_version(v, newest_version(v)).count() == 1


def test_dedupe_is_idempotent_and_the_key_is_a_parameter(spark):
    rows = stop_updates_of(bronze_trip(spark, trip([(1, "s1", 5), (2, "s2", 6), (3, "s1", 7)])))
    assert distinct_by(rows.unionByName(rows), ["trip_id", "stop_id", "feed_ts"]).count() == 2
    assert distinct_by(rows.unionByName(rows), ["trip_id", "stop_sequence", "feed_ts"]).count() == 3


def test_alert_history_keeps_alerts_without_entities_and_groups_nulls(spark):
    periods = [(100, 200), (None, 5), (50, None)]
    entity = (None, "7", None, None, None, None)
    rows = [
        (1000, "a", "CONSTRUCTION", "DETOUR", None, "x", None, periods, [entity]),
        (1060, "a", "CONSTRUCTION", "DETOUR", None, "x", None, [], [entity]),
        (1000, "b", None, None, None, None, None, None, []),
        (1060, "b", None, None, None, None, None, None, None),
    ]
    out = alert_history(spark.createDataFrame(rows, record_schema("alerts"))).select(
        "entity_id", "route_id", *[F.unix_seconds(c).alias(c) for c in ("first_seen_ts", "last_seen_ts", "active_start_ts")]
    )
    assert sorted(map(tuple, out.collect())) == [
        ("a", "7", 1000, 1060, 50),
        ("b", None, 1000, 1060, None),
    ]


def test_rules_drop_unknown_and_count_every_row(spark):
    rows = [
        (1, "e", "v1", None, "t", "15", 0, None, 39.7, -105.0, None, None, None, None, None, 5, None, None),
        (1, "e", None, None, None, None, 0, None, 39.7, -105.0, None, None, None, None, None, 5, None, None),
        (1, "e", "v3", None, None, None, 0, None, None, None, None, None, None, None, None, 5, None, None),
    ]
    df = positions_of(spark.createDataFrame(rows, record_schema("vehicle_positions")))
    assert [r.in_service for r in df.orderBy("vehicle_id").collect()] == [False, True, False]
    assert [r.vehicle_id for r in keep_valid(df, position_rules()).collect()] == ["v1"]
    rates = {r.rule: (r.n_rows, r.n_passed) for r in rule_rates(df, position_rules()).collect()}
    assert rates == {"vehicle_id_present": (3, 2), "position_in_area": (3, 2)}
    assert rule_rates(df.limit(0), position_rules()).first().pass_rate is None
    assert [r.drop for r in stop_update_rules()] == [True, True, False, False]


def test_rules_as_metrics_of_a_running_query(spark):
    from pyspark.sql import Observation

    from headwind.operators.quality import observed_rates, outcome_rules

    seen = Observation("rates")
    rows = label(spark, update(60, 30), update(600, 30, trip="t2"))
    assert observed_rates(rows, outcome_rules(), seen).count() == 2
    assert seen.get == {"n_rows": 2, "label_is_observed": 1, "delay_in_bounds": 2}


def test_sketches_merge_to_quantiles_of_any_level(spark):
    from headwind.operators.labels import delay_quantiles, hourly_delay

    outcomes = spark.range(20_000).selectExpr(
        "true AS is_observed", "date_add(DATE'2026-10-01', CAST(id % 10 AS INT)) AS service_date", "'r' || id % 3 AS route_id",
        "'x' AS route_short_name", "'bus' AS mode", "timestamp_seconds(1790000000 + id * 60) AS scheduled_arrival_ts", "id * 7919 % 20000 AS delay_s",
    )
    hourly = hourly_delay(outcomes, sketches=True)
    for by in (["route_id"], ["service_date", "mode"], []):
        for r in delay_quantiles(hourly, by, {"q1": 0.25, "q2": 0.5}).collect():
            assert abs(r.q1 - 5000) < 700 and abs(r.q2 - 10_000) < 700
    assert delay_quantiles(hourly.limit(0), ["route_id"], {"q": 0.5}).count() == 0


def test_percentiles_of_many_rows_are_exact(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.lit("bus").alias("mode"),
        (F.col("id") * 7919 % n).alias("delay_s"),
        (F.col("id") * 7919 % n).alias("label_lead_s"),
        F.lit(DAY).alias("service_date"),
        F.lit(True).alias("is_observed"),
    )
    row = delay_distribution(rows).first()
    assert [row[f"p{q}_s"] for q in ("05", "25", "50", "75", "95")] == [2_999, 14_999, 29_999, 44_999, 56_999]
    assert label_quality(rows).first().median_lead_s == 29_999
