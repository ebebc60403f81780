"""Registered queries: every operator over the whole given tables.

Results carry epoch seconds, dates, text and rounded doubles, so that they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwind.functions import clock, columns
from headwind.operators import (
    clean,
    coverage,
    evaluate,
    features,
    labels,
    models,
    quality,
    ridge,
    schedule,
    scoring,
    sliced,
)
from headwind.plans import dataflow, reports
from headwind.plans.views import ROUTES, SETTINGS, ZONE, Views, seconds
from headwind.session import materialize, new_folder
from headwind.sources import sinks, snapshots
from headwind.sources.records import SCHEDULE_FILES
from headwind.sources.snapshot_writer import encode_snapshots, write_snapshots
from headwind.sources.versioned_csv import read_versioned
from headwind.streaming import jobs

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}


# queries that read the derived outcomes or pairs more than twice
STAGED: set[str] = set()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def staged(f: Query) -> Query:
    STAGED.add(f.__name__)
    return query(f)


def r6(c: Column | str, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def bigint(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


# ---- projections and scalar functions ----


@query
def clock_to_seconds(v: Views) -> DataFrame:
    k, e = F.col("k"), F.col("e")
    parts = [(k % 30), (k * 7) % 60, e % 60]
    text = F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])
    hms = F.when(k % 17 == 0, "unknown").otherwise(text)
    return v.events.select("event_id", clock.clock_to_seconds(hms).cast("long").alias("secs"))


@query
def mode_case(v: Views) -> DataFrame:
    code = F.when(F.col("p_size") % 6 != 5, F.col("p_size") % 6)
    mode = columns.mode_of(code, SETTINGS.rail_route_types)
    return v.table("part").select("p_partkey", mode.alias("mode"))


@query
def service_day_start(v: Views) -> DataFrame:
    days = v.table("lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return days.select("day", clock.service_day_start("day", ZONE).alias("start_e"))


def _raw_delay() -> Column:
    k = F.col("k")
    off = F.col("delay_s") + clock.DAY_S * (k % 5 - 2)
    return F.when(k % 10 != 9, off)


@query
def day_shift(v: Views) -> DataFrame:
    return v.arr.select("event_id", columns.whole_day_shift(_raw_delay()).alias("shift_days"))


@query
def scheduled_delay(v: Views) -> DataFrame:
    """One report in twenty names the day before."""
    secs = 21600 + 300 * F.col("stop_sequence")
    wrong = F.when(F.col("k") % 20 == 0, 1).otherwise(0)
    start = clock.service_day_start("service_date", ZONE)
    rows = v.arr.select(
        "event_id",
        secs.alias("secs"),
        F.date_sub("service_date", wrong).alias("reported"),
        F.when(F.col("k") % 13 != 0, start + secs + F.col("delay_s")).alias("predicted"),
    )
    out = schedule.delay_columns(
        rows, F.col("reported"), F.col("predicted"), F.col("secs"), SETTINGS
    )
    return out.select(
        "event_id",
        bigint("service_date_shift_days"),
        "service_date",
        seconds("scheduled_arrival_ts"),
        seconds("predicted_arrival_ts"),
        "arrival_delay_s",
    )


@query
def clean_positions(v: Views) -> DataFrame:
    return clean.positions_of(v.bronze("vehicle_positions")).select(
        "vehicle_id", "trip_id", "route_id", "latitude", "current_status", "stop_id",
        seconds("vehicle_ts"), seconds("feed_ts"), "in_service",
    )


@query
def explode_updates(v: Views) -> DataFrame:
    return clean.stop_updates_of(v.bronze("trip_updates")).select(
        "trip_id", "rt_route_id", "start_date", "vehicle_id", seconds("feed_ts"),
        bigint("stop_sequence"), "stop_id", "predicted_arrival_epoch", "predicted_departure_epoch",
        "stop_schedule_relationship",
    )


@query
def explode_outer_children(v: Views) -> DataFrame:
    return v.bronze("alerts").select(
        "feed_timestamp", "entity_id", F.explode_outer("informed_entities").alias("who")
    ).select("feed_timestamp", "entity_id", "who.route_id", "who.stop_id")


@query
def array_fold_min(v: Views) -> DataFrame:
    least = columns.array_field_min(F.col("active_periods"), lambda p: p["start"])
    return v.bronze("alerts").select(
        "feed_timestamp", "entity_id", "cause", least.alias("active_start_e")
    )


@query
def observed_known_ts(v: Views) -> DataFrame:
    return labels.known_outcomes(v.arr).select("event_id", seconds("known_ts"))


@query
def anchors_by_horizon(v: Views) -> DataFrame:
    return features.anchors_of(v.trend, SETTINGS).select(
        "service_date", "trip_id", bigint("anchor_stop_sequence"), bigint("horizon"),
        bigint("target_stop_sequence"), "current_delay_s", seconds("prediction_ts"),
    )


def _example_key() -> list:
    return ["service_date", "trip_id", bigint("anchor_stop_sequence"), bigint("horizon")]


@query
def time_features(v: Views) -> DataFrame:
    names = ("hour_local", "day_of_week", "is_weekend", "is_holiday", "target_hour_local")
    return features.with_time(v.pairs, SETTINGS).select(*_example_key(), *[bigint(c) for c in names])


@query
def date_between(v: Views) -> DataFrame:
    first, last = sinks.day_bounds(v.arr)
    kept = scoring.between_days(v.arr, first + timedelta(days=5), last - timedelta(days=5))
    return kept.groupBy("service_date").agg(F.count("*").alias("n"))


@query
def recent_rows(v: Views) -> DataFrame:
    kept = scoring.since_days(v.arr, "service_date", clock.utc_day(F.unix_seconds(v.now)), 7)
    return kept.select("event_id", "service_date")


@staged
def fill_features(v: Views) -> DataFrame:
    filled = models.fill_features(v.examples, SETTINGS)
    whole = ("delay_trend_s", "stops_remaining", "hist_n", "has_hist", "ahead_delay_s",
             "ahead_age_s", "has_ahead", "alert_active", "residual_s")
    return filled.select(*_example_key(), r6("hist_avg_delay_s"), *[bigint(c) for c in whole])


def _predictions(v: Views) -> DataFrame:
    return scoring.predictions_long(v.forecast_pairs, v.now)


@staged
def predictions_long(v: Views) -> DataFrame:
    return _predictions(v).select(
        *_example_key(), "predictor", r6("predicted_delay_s"), seconds("predicted_arrival_ts"),
        seconds("scored_at_ts"),
    )


@query
def safe_name(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", columns.folder_name(F.col("url")).alias("name"))


@staged
def metrics_flat(v: Views) -> DataFrame:
    return evaluate.metric_keys(_metrics(v)).select("predictor", "key", r6("value"))


# ---- joins ----


@query
def schedule_join(v: Views) -> DataFrame:
    files = v.static_files
    plan = schedule.schedule_of(files["stop_times"], files["trips"], files["routes"], SETTINGS)
    return plan.select(
        "trip_id", bigint("stop_sequence"), "scheduled_stop_id", bigint("scheduled_arrival_secs"),
        bigint("scheduled_departure_secs"), "route_id", "service_id", bigint("direction_id"),
        "route_short_name", bigint("route_type"), "mode",
    )


def _versions(v: Views) -> DataFrame:
    return v.events.groupBy(F.col("event_type").alias("gtfs_version")).agg(
        F.date_format(F.max(clock.utc_day(F.col("e"))), "yyyyMMdd").alias("feed_start_date")
    )


@query
def latest_version(v: Views) -> DataFrame:
    return schedule.newest_version(_versions(v))


@query
def only_latest_version(v: Views) -> DataFrame:
    rows = v.events.select("event_id", F.col("event_type").alias("gtfs_version"))
    return schedule.of_version(rows, schedule.newest_version(_versions(v))).select(
        "event_id", "gtfs_version"
    )


def _with_delay(updates: DataFrame, v: Views) -> DataFrame:
    return schedule.with_schedule_delay(updates, v.sched, settings=SETTINGS)


def _delay_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "trip_id", bigint("stop_sequence"), "stop_id", seconds("feed_ts"), "scheduled_stop_id",
        "service_date", bigint("service_date_shift_days"), seconds("scheduled_arrival_ts"),
        seconds("predicted_arrival_ts"), "arrival_delay_s",
    )


@query
def schedule_left_join(v: Views) -> DataFrame:
    return _delay_rows(_with_delay(clean.stop_updates_of(v.bronze("trip_updates")), v))


@query
def anchor_target_pairs(v: Views) -> DataFrame:
    return v.pairs.select(
        *_example_key(), bigint("target_stop_sequence"), "target_stop_id", "current_delay_s",
        "target_delay_s", "scheduled_gap_s", seconds("prediction_ts"), seconds("target_actual_ts"),
    )


@query
def scheduled_targets(v: Views) -> DataFrame:
    anchors = features.anchors_of(v.trend, SETTINGS)
    return features.scheduled_targets(anchors, v.sched, SETTINGS).select(
        *_example_key(), "target_stop_id", seconds("target_scheduled_ts"), "scheduled_gap_s"
    )


@query
def stops_remaining(v: Views) -> DataFrame:
    return features.with_stops_remaining(v.pairs, v.sched).select(
        *_example_key(), bigint("stops_remaining")
    )


@staged
def history_range_join(v: Views) -> DataFrame:
    timed = features.with_time(v.pairs, SETTINGS)
    return features.with_history(timed, v.obs, SETTINGS).select(
        *_example_key(), r6("hist_avg_delay_s"), bigint("hist_n")
    )


@staged
def history_stored_sums(v: Views) -> DataFrame:
    """As history_range_join, from a stored table of daily sums of which the newest days were replaced."""
    path = new_folder(v.spark, "daily")
    first, last = sinks.day_bounds(v.obs)
    due = F.col("service_date") > F.lit(last - timedelta(days=3))
    early = v.obs.withColumn("delay_s", F.when(due, F.col("delay_s") + 60).otherwise(F.col("delay_s")))
    sinks.replace_days(features.daily_delays(early, SETTINGS), path, first, last)
    days = [last - timedelta(days=n) for n in range(3)]
    sinks.replace_parts(features.daily_delays(v.obs.where(due), SETTINGS), path, "service_date", days)
    timed = features.with_time(v.pairs, SETTINGS)
    return features.with_history(timed, v.obs, SETTINGS, v.spark.read.parquet(path)).select(
        *_example_key(), r6("hist_avg_delay_s"), bigint("hist_n")
    )


@staged
def asof_strict(v: Views) -> DataFrame:
    return features.with_vehicle_ahead(v.pairs, v.obs, SETTINGS).select(
        *_example_key(), "ahead_delay_s", "ahead_age_s"
    )


@staged
def asof_inclusive(v: Views) -> DataFrame:
    return features.with_provider_forecast(v.pairs, v.upd, SETTINGS).select(
        *_example_key(), "provider_pred_s"
    )


@staged
def interval_flag(v: Views) -> DataFrame:
    return features.with_alert_flag(v.pairs, v.alerts, SETTINGS).select(
        *_example_key(), bigint("alert_active")
    )


def _vehicles(v: Views) -> DataFrame:
    positions = clean.positions_of(v.bronze("vehicle_positions")).where("vehicle_id IS NOT NULL")
    routes = v.static_files["routes"]
    return scoring.live_vehicles(positions, v.upd, routes, v.now, SETTINGS)


@query
def live_vehicles(v: Views) -> DataFrame:
    return _vehicles(v).select(
        "vehicle_id", "trip_id", "route_id", "route_short_name", "mode", "latitude", "longitude",
        seconds("vehicle_ts"), "delay_s", r6("delay_min"),
    )


# ---- aggregations and windows ----


@query
def last_prediction_label(v: Views) -> DataFrame:
    return labels.last_prediction_label(v.upd, settings=SETTINGS).select(
        "service_date", "trip_id", bigint("stop_sequence"), "route_id", "mode", "stop_id",
        seconds("actual_arrival_ts"), seconds("last_seen_ts"), seconds("first_seen_ts"),
        "n_snapshots", "delay_s", "label_lead_s", "is_observed",
    )


def _hourly(v: Views) -> DataFrame:
    return labels.hourly_delay(v.arr, SETTINGS)


@query
def route_delay_hourly(v: Views) -> DataFrame:
    return _hourly(v).select(
        "service_date", "day_of_week", "is_weekday", bigint("hour_local"), "route_id",
        "route_short_name", "mode", "n_arrivals", r6("avg_delay_s"), "median_delay_s",
        r6("share_late_5min"),
    )


@query
def alert_history(v: Views) -> DataFrame:
    return clean.alert_history(v.bronze("alerts")).select(
        "entity_id", "route_id", "stop_id", "cause", "effect", "header_text",
        seconds("first_seen_ts"), seconds("last_seen_ts"), seconds("active_start_ts"),
    )


def _metrics(v: Views) -> DataFrame:
    return evaluate.error_metrics(v.forecast_pairs, models.BASELINES)


@staged
def error_metrics(v: Views) -> DataFrame:
    return _metrics(v).select(
        "predictor", "mode", bigint("horizon"), "n", r6("mae_s"), r6("rmse_s")
    )


def _monitored(v: Views) -> DataFrame:
    return scoring.monitoring(_predictions(v), v.arr)


@staged
def monitoring_daily(v: Views) -> DataFrame:
    return _monitored(v).select(
        "service_date", "predictor", "model_version", "mode", bigint("horizon"), "n",
        r6("mae_s"), r6("rmse_s"),
    )


@query
def coverage_summary(v: Views) -> DataFrame:
    return coverage.coverage_summary(v.events, "event_type", "ts", 7200).select(
        "event_type", "snapshots", seconds("first_ts"), seconds("last_ts"), "n_gaps",
        "gap_total_s", "gap_longest_s",
    )


@query
def freshness(v: Views) -> DataFrame:
    """Feeds as expected plus one that never reported."""
    feeds = v.events.select("event_type").distinct()
    never = feeds.agg(F.max("event_type")).select(F.lit("never").alias("event_type"))
    return coverage.freshness(
        feeds.unionByName(never), v.events, "event_type", "ts", v.now, 1800
    ).select("event_type", seconds("newest_ts"), "age_s", "is_fresh")


def _judged(v: Views) -> DataFrame:
    return _with_delay(clean.stop_updates_of(v.bronze("trip_updates")), v)


RULES = (
    quality.Rule("trip_id_present", "trip_id IS NOT NULL", drop=True),
    quality.Rule("delay_in_bounds", "arrival_delay_s IS NULL OR abs(arrival_delay_s) <= 36000", drop=True),
    quality.Rule("schedule_matched", "scheduled_arrival_ts IS NOT NULL"),
    quality.Rule("date_not_shifted", "coalesce(service_date_shift_days, 0) = 0"),
)


@query
def expectation_rates(v: Views) -> DataFrame:
    updates = quality.rule_rates(_judged(v), RULES)
    positions = quality.rule_rates(
        clean.positions_of(v.bronze("vehicle_positions")), quality.position_rules(SETTINGS)
    )
    outcomes = quality.rule_rates(v.arr, quality.outcome_rules(SETTINGS))
    tagged = [
        df.withColumn("source", F.lit(name))
        for name, df in (("updates", updates), ("positions", positions), ("outcomes", outcomes))
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).select(
        "source", "rule", "action", "n_rows", "n_passed", r6("pass_rate")
    )


@query
def expectation_drop(v: Views) -> DataFrame:
    kept = quality.keep_valid(
        clean.positions_of(v.bronze("vehicle_positions")), quality.position_rules(SETTINGS)
    )
    return kept.select("vehicle_id", "latitude", "longitude", seconds("vehicle_ts"))


@query
def delay_trend(v: Views) -> DataFrame:
    return v.trend.select("event_id", "delay_trend_s")


@query
def latest_anchor(v: Views) -> DataFrame:
    return features.latest_anchors(v.trend, v.now, SETTINGS.live_anchor_max_age_s).select(
        "service_date", "trip_id", bigint("stop_sequence"), "delay_s", seconds("known_ts")
    )


@query
def gap_detection(v: Views) -> DataFrame:
    return coverage.gaps(v.events, "event_type", "ts", 7200).select(
        "event_type", seconds("gap_start", "start_e"), seconds("gap_end", "end_e"), "gap_s"
    )


@query
def consecutive_dedupe(v: Views) -> DataFrame:
    """Headers are hours, so neighbours of one feed often repeat."""
    rows = v.events.select("event_id", "event_type", (F.col("e") - F.col("e") % 3600).alias("header_s"))
    arrival = F.col("event_id")
    return coverage.changed_only(
        rows, "event_type", [arrival], F.floor(arrival / 100_000), "header_s"
    ).select("event_id", "event_type", "header_s")


# ---- examples and models ----

WHOLE = ("current_delay_s", "delay_trend_s", "stops_remaining", "scheduled_gap_s", "hour_local",
         "day_of_week", "is_weekend", "is_holiday", "hist_n", "ahead_delay_s", "ahead_age_s",
         "alert_active", "provider_pred_s", "persistence_pred_s")


@staged
def training_set(v: Views) -> DataFrame:
    return v.examples.select(
        *_example_key(), "target_delay_s", r6("hist_avg_delay_s"), *[bigint(c) for c in WHOLE]
    )


@staged
def live_examples(v: Views) -> DataFrame:
    live = features.live_examples(
        v.arr, v.upd, v.sched, v.alerts, v.now, SETTINGS, stage=materialize
    )
    return live.select(*_example_key(), r6("hist_avg_delay_s"), *[bigint(c) for c in WHOLE])


# what fits, their measures and the keys of their rows need of an example
MODELLED = {
    *features.EXAMPLE_KEY, "target_delay_s", *models.NUMERIC, *models.CATEGORICAL, *models.BASELINES,
    *models.TEST_PREDICTION_COLUMNS,
}


def _split(v: Views):
    rows = v.examples.select(*[c for c in v.examples.columns if c in MODELLED])
    data = models.scorable(models.fill_features(materialize(rows, "examples"), SETTINGS))
    first, last = sinks.day_bounds(data)
    return evaluate.time_split(data, first, last, SETTINGS)


@staged
def time_split(v: Views) -> DataFrame:
    first, last = sinks.day_bounds(v.pairs)
    train, test, split = evaluate.time_split(v.pairs, first, last, SETTINGS)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )
    return sides.groupBy("side").agg(
        F.count("*").alias("n"), F.min("service_date").alias("first"), F.max("service_date").alias("last")
    ).withColumns({"reason": F.lit(split.reason), "preliminary": F.lit(split.preliminary)})


@staged
def feature_vector(v: Views) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train, test, _ = _split(v)
    model = Pipeline(stages=models.feature_stages(one_hot=True)).fit(train)
    return model.transform(test).select(*_example_key(), vector_to_array("features").alias("features"))


def _fitted(v: Views, pipeline) -> DataFrame:
    train, test, _ = _split(v)
    scored = models.predict_delay(models.fit(pipeline, train), test, "model_pred_s")
    return scored.select(*_example_key(), r6("model_pred_s"), "target_delay_s")


@staged
def train_linear(v: Views) -> DataFrame:
    return _fitted(v, models.linear_pipeline())


@staged
def ridge_moments(v: Views) -> DataFrame:
    """Sums of products of inputs and label of the training rows, by mode and route.

    Means go in as whole seconds, so that sums do not depend on the order of rows.
    """
    train, _, _ = _split(v)
    train = train.withColumn("hist_avg_delay_s", F.floor("hist_avg_delay_s"))
    return ridge.moment_sums(train).select("mode", "route_id", "left", "right", "total")


@staged
def ridge_exact(v: Views) -> DataFrame:
    """Each coefficient of the exact solution, and whether the registered linear fit has the same."""
    train, _, _ = _split(v)
    pipeline = models.linear_pipeline()
    fitted = ridge.coefficients_of(models.fit(pipeline, train))
    exact = ridge.solve(ridge.moment_sums(train), pipeline.getStages()[-1].getRegParam())
    rows = [(k, abs(exact[k] - fitted.get(k, float("nan"))) <= 1e-3 * max(1.0, abs(exact[k]))) for k in exact]
    return v.spark.createDataFrame(rows, "coefficient string, agrees boolean")


@staged
def selection_blocks(v: Views) -> DataFrame:
    """Errors of the baselines on each block of days that candidate models are compared on."""
    train, _, split = _split(v)
    blocks = [models.block_metrics(train, models.BASELINES, b) for b in evaluate.rolling_blocks(split, SETTINGS)]
    found = reduce(DataFrame.unionByName, blocks)
    return found.select("first", "last", "mode", bigint("horizon"), "n", r6("mae_s"), r6("rmse_s"), "predictor")


@staged
def train_gbt(v: Views) -> DataFrame:
    return _fitted(v, models.tree_pipeline())


@staged
def model_selection(v: Views) -> DataFrame:
    train, test, split = _split(v)
    chosen = models.select_model(train, test, models.candidates(), split=split, settings=SETTINGS)
    return evaluate.result_rows(chosen.metrics, chosen.name or "baselines", split).drop("processed_ts")


@staged
def test_predictions(v: Views) -> DataFrame:
    train, test, split = _split(v)
    chosen = models.select_model(train, test, models.candidates(), split=split, settings=SETTINGS)
    lake = sinks.Lake(new_folder(v.spark, "predictions"))
    lake.overwrite(models.test_prediction_rows(chosen.scored, "run"), "gold", "test_predictions")
    return lake.read(v.spark, "gold", "test_predictions")


@staged
def champion_gate(v: Views) -> DataFrame:
    """A run on few days must not become champion, a full one must."""
    lake = sinks.Lake(new_folder(v.spark, "champions"))
    lake.overwrite(v.examples, "gold", "training_set", "service_date")
    start, end = sinks.day_bounds(lake.read(v.spark, "gold", "training_set"))
    dataflow.train(v.spark, lake, str(start), str(start + timedelta(days=9)), SETTINGS)
    dataflow.train(v.spark, lake, str(start), str(end), SETTINGS)
    _, version = dataflow.load_champion(v.spark, lake)
    return lake.read(v.spark, "models", "registry").select(
        "model", "data_status", "is_champion", (F.col("run_id") == version).alias("is_loaded")
    )


# ---- reports ----


@query
def rpt_live(v: Views) -> DataFrame:
    return reports.live(_vehicles(v)).withColumn("delay_min", F.round("delay_min", 6))


@query
def rpt_summary(v: Views) -> DataFrame:
    return reports.summary(_vehicles(v), SETTINGS)


@query
def rpt_worst_now(v: Views) -> DataFrame:
    return reports.worst_now(_vehicles(v), at_least=2)


@staged
def rpt_pred_vs_actual(v: Views) -> DataFrame:
    return reports.prediction_vs_actual(_predictions(v), v.arr, clock.utc_day(F.unix_seconds(v.now)), days=2).withColumn(
        "horizon", F.col("horizon").cast("long")
    )


@staged
def rpt_error_daily(v: Views) -> DataFrame:
    return reports.error_daily(_monitored(v))


@staged
def rpt_error_horizon(v: Views) -> DataFrame:
    return reports.error_horizon(_monitored(v)).withColumn("horizon", F.col("horizon").cast("long"))


@query
def rpt_label_quality(v: Views) -> DataFrame:
    return reports.label_quality(v.arr)


@query
def rpt_delay_distribution(v: Views) -> DataFrame:
    return reports.delay_distribution(v.arr, SETTINGS)


@query
def rpt_delay_histogram(v: Views) -> DataFrame:
    return reports.delay_histogram(v.arr)


@query
def rpt_time_of_day(v: Views) -> DataFrame:
    return reports.time_of_day(_hourly(v)).withColumn("hour_local", F.col("hour_local").cast("long"))


@query
def rpt_worst_routes(v: Views) -> DataFrame:
    return reports.worst_routes(_hourly(v), at_least=20)


@query
def rpt_five_pm(v: Views) -> DataFrame:
    return reports.five_pm(_hourly(v), at_least=2)


@query
def rpt_delay_growth(v: Views) -> DataFrame:
    return reports.delay_growth(v.arr)


def _results(v: Views) -> DataFrame:
    """Two runs: on the first half of the days and on all of them."""
    first, last = sinks.day_bounds(v.pairs)
    forecasts = materialize(v.forecast_pairs, "forecasts")
    runs = []
    for end in (first + timedelta(days=(last - first).days // 2), last):
        split = evaluate.plan_split(first, end, SETTINGS)
        part = scoring.between_days(forecasts, split.test_start, end)
        rows = dataflow.baseline_results(part, str(end), split)
        runs.append(rows.withColumn("processed_ts", F.lit(str(end)).cast("date")))
    return runs[0].unionByName(runs[1])


@staged
def rpt_latest_results(v: Views) -> DataFrame:
    return reports.latest_results(_results(v)).withColumn("horizon", F.col("horizon").cast("long"))


@staged
def rpt_model_gain(v: Views) -> DataFrame:
    return reports.model_gain(v.tested).withColumn("horizon", F.col("horizon").cast("long"))


@staged
def rpt_losing_slices(v: Views) -> DataFrame:
    out = reports.losing_slices(v.tested, at_least=20)
    return out.withColumns(
        {
            "horizon": F.col("horizon").cast("long"),
            "persistence_mae": F.round("persistence_mae", 6),
            "model_mae": F.round("model_mae", 6),
        }
    )


@staged
def rpt_ahead_effect(v: Views) -> DataFrame:
    out = reports.ahead_effect(v.tested)
    return out.withColumns({c: F.col(c).cast("long") for c in ("horizon", "has_ahead")})


@staged
def rpt_error_by_hour(v: Views) -> DataFrame:
    return reports.error_by_hour(v.tested).withColumn("hour_local", F.col("hour_local").cast("long"))


# ---- sources, sinks, coverage of files ----


def _raw_files(v: Views, *feeds: str) -> str:
    """Snapshot files of the given feeds, written from the events table."""
    root = new_folder(v.spark, "raw")
    for feed in feeds:
        write_snapshots(materialize(encode_snapshots(v.entities(feed), feed), "encoded"), root)
    return root


def _trip_rows(bronze: DataFrame) -> DataFrame:
    due = F.aggregate(
        "stop_time_updates",
        F.lit(0).cast("long"),
        lambda total, s: total + F.coalesce(s["arrival_time"], F.lit(0)),
    )
    return bronze.select(
        "feed_timestamp", "entity_id", "trip_id", "route_id", bigint("direction_id"), "start_date",
        "trip_schedule_relationship", "vehicle_id", "update_timestamp", bigint("trip_delay"),
        F.size("stop_time_updates").cast("long").alias("n_updates"), due.alias("arrivals_sum"),
    )


@query
def typed_projection(v: Views) -> DataFrame:
    return _trip_rows(v.bronze("trip_updates"))


@query
def decode_feed(v: Views) -> DataFrame:
    files = encode_snapshots(v.entities("trip_updates"), "trip_updates")
    return _trip_rows(
        snapshots.typed_records(
            snapshots.decode_entities(files, "trip_updates"), "trip_updates"
        )
    )


def _ingested(v: Views, bursts: int, day: str | None = None) -> DataFrame:
    root, out = _raw_files(v, "vehicle_positions"), new_folder(v.spark, "bronze")
    for _ in range(bursts):
        jobs.ingest_feed(
            v.spark, root, "vehicle_positions", f"{out}/rows", f"{out}/checkpoint", day
        )
    return v.spark.read.parquet(f"{out}/rows").select(
        "feed_timestamp", "entity_id", "vehicle_id", "trip_id", "latitude", "longitude",
        "current_status", "vehicle_timestamp", "occupancy_status", bigint("occupancy_percentage"),
        F.isnotnull("source_file").alias("has_source"), F.isnotnull("ingest_ts").alias("has_time"),
    )


@query
def ingest_available_now(v: Views) -> DataFrame:
    """Two bursts on one checkpoint; the second finds nothing new."""
    return _ingested(v, bursts=2)


@query
def ingest_one_date(v: Views) -> DataFrame:
    first, _ = sinks.day_bounds(v.events.select(clock.utc_day(F.col("e")).alias("service_date")))
    return _ingested(v, 1, str(first + timedelta(days=1)))


@query
def versioned_csv_scan(v: Views) -> DataFrame:
    root = new_folder(v.spark, "static")
    for version in ("V1", "V2"):
        trips = v.static_files["trips"]
        trips.select("block_id", *[c for c in trips.columns if c != "block_id"]).write.option(
            "header", True
        ).csv(f"{root}/version={version}/trips.txt")
    return read_versioned(v.spark, root, "trips").select(*SCHEDULE_FILES["trips"], "gtfs_version")


@query
def range_replace(v: Views) -> DataFrame:
    """Middle days are replaced by their rail rows; one of them is left without rows."""
    path = new_folder(v.spark, "replaced")
    rows = v.arr.select("event_id", "mode", "service_date")
    first, last = sinks.day_bounds(rows)
    sinks.replace_days(rows, path, first, last)
    low, high = first + timedelta(days=10), first + timedelta(days=14)
    new = rows.where((F.col("mode") == "rail") & (F.col("service_date") != F.lit(high)))
    sinks.replace_days(new, path, low, high)
    return v.spark.read.parquet(path).select("event_id", "mode", "service_date")


@staged
def append_results(v: Views) -> DataFrame:
    lake = sinks.Lake(new_folder(v.spark, "results"), "dev_")
    first, last = sinks.day_bounds(v.pairs)
    split = evaluate.plan_split(first, last, SETTINGS)
    forecasts = materialize(v.forecast_pairs, "forecasts")
    for run in ("a", "b"):
        lake.append(dataflow.baseline_results(forecasts, run, split), "gold", "model_results")
    return lake.read(v.spark, "gold", "model_results").select(
        "run_id", "predictor", "mode", bigint("horizon"), "n", r6("mae_s"), r6("rmse_s"), "data_status"
    )


@query
def overwrite_table(v: Views) -> DataFrame:
    """The second write replaces rows and columns."""
    lake = sinks.Lake(new_folder(v.spark, "overwritten"))
    lake.overwrite(v.events.select("event_id", "value"), "gold", "t")
    lake.overwrite(v.events.select("event_id", "event_type"), "gold", "t")
    return lake.read(v.spark, "gold", "t")


@query
def date_bounds(v: Views) -> DataFrame:
    first, last = sinks.day_bounds(v.arr)
    return v.arr.where(F.col("service_date").isin(first, last)).groupBy("service_date").agg(
        F.count("*").alias("n")
    )


@query
def partition_layout(v: Views) -> DataFrame:
    path = new_folder(v.spark, "layout")
    rows = v.events.select("event_id", F.col("event_type").alias("feed"), "e")
    sinks.with_utc_partitions(rows, "e").hint("rebalance", F.col("feed"), F.col("date")).write.partitionBy(
        "feed", "date"
    ).parquet(path)
    name = coverage.snapshot_path(F.col("feed"), F.col("e"))
    return v.spark.read.parquet(path).select(
        "event_id", "feed", F.col("date").cast("string").alias("date"), "hour", name.alias("path")
    )


def _names(v: Views) -> DataFrame:
    """Names of well-formed and other files."""
    text = F.concat("event_type", F.lit("_"), F.col("e").cast("string"))
    name = F.when(F.col("k") % 9 == 0, F.concat(text, F.lit(".tmp"))).otherwise(
        F.concat(text, F.lit(".pb"))
    )
    return v.events.select(name.alias("name"), "k")


@query
def manifest_parse(v: Views) -> DataFrame:
    return coverage.parse_manifest(_names(v), ROUTES)


@query
def manifest_diff(v: Views) -> DataFrame:
    have = _names(v).select("name")
    return coverage.missing_from(have, _names(v).where("k % 2 = 0").select("name"))


@query
def date_spine(v: Views) -> DataFrame:
    bounds = v.arr.agg(F.min("service_date").alias("a"), F.max("service_date").alias("b"))
    return coverage.date_spine(bounds, "a", "b")


# ---- streaming ----


@query
def stream_dedupe(v: Views) -> DataFrame:
    """Every feed row arrives twice; keys come out once."""
    rows = v.bronze("trip_updates")
    twice = rows.unionByName(rows).withColumn("ingest_ts", F.current_timestamp())
    out = jobs.stream_through(
        twice,
        lambda s: clean.distinct_by(
            clean.stop_updates_of(s), clean.STOP_UPDATE_KEY, "feed_ts", SETTINGS.watermark
        ),
        new_folder(v.spark, "dedupe"),
    )
    return out.select("trip_id", "stop_id", seconds("feed_ts"))


@query
def stream_dedupe_positions(v: Views) -> DataFrame:
    rows = v.bronze("vehicle_positions").where("vehicle_id IS NOT NULL")
    out = jobs.stream_through(
        rows.unionByName(rows),
        lambda s: clean.distinct_by(clean.positions_of(s), clean.POSITION_KEY, "vehicle_ts", SETTINGS.watermark),
        new_folder(v.spark, "dedupe"),
    )
    return out.select("vehicle_id", seconds("vehicle_ts"))


@query
def stream_static_join(v: Views) -> DataFrame:
    """Stream of updates, deduplicated by keys that identify a row, against the schedule."""
    schedule_table = materialize(v.sched, "schedule")
    key = ("trip_id", "stop_sequence", "stop_id", "feed_ts", "predicted_arrival_epoch",
           "predicted_departure_epoch")
    out = jobs.stream_through(
        v.bronze("trip_updates"),
        lambda s: schedule.with_schedule_delay(
            clean.distinct_by(clean.stop_updates_of(s), key, "feed_ts", SETTINGS.watermark),
            schedule_table,
            settings=SETTINGS,
        ),
        new_folder(v.spark, "joined"),
    )
    return _delay_rows(out)


@query
def stream_late_data(v: Views) -> DataFrame:
    """The newest day first, then everything: the second burst is late, except that day's own rows."""
    folder = new_folder(v.spark, "late")
    rows = materialize(v.bronze("vehicle_positions").where("vehicle_id IS NOT NULL"), "late-in")
    newest = rows.agg(F.max("vehicle_timestamp")).scalar()

    def step(s: DataFrame) -> DataFrame:
        return clean.distinct_by(clean.positions_of(s), clean.POSITION_KEY, "vehicle_ts", "2 hours")

    jobs.stream_through(rows.where(F.col("vehicle_timestamp") >= newest - 86_400), step, folder)
    out = jobs.stream_through(rows, step, folder)
    return out.select("vehicle_id", seconds("vehicle_ts"))


@query
def hot_slice_order(v: Views) -> DataFrame:
    """Row numbers and earlier rows of keys whose slices are far too large to sort in one task."""
    order = [F.col("ts"), F.col("event_id")]
    whole = sliced.time_slice(F.col("ts"), 3650 * 86_400)  # one slice for each key
    rows = v.events.select("event_id", "event_type", "ts")
    rows = sliced.numbered(rows, ["event_type"], order, whole, "place", rows=500, stage=materialize)
    rows = sliced.earlier_row(rows, ["event_type"], order, whole, F.col("event_id"), "third_before", 3, 500, materialize)
    return rows.select("event_id", "event_type", bigint("place"), "third_before")


@staged
def sketch_quantiles(v: Views) -> DataFrame:
    """Quantiles by route from the hourly sketches, held against the ranks they really have."""
    hourly = materialize(labels.hourly_delay(v.arr, SETTINGS, sketches=True), "hourly")
    share = {"low": 0.1, "middle": 0.5, "high": 0.9}
    found = labels.delay_quantiles(hourly, ["route_id"], share)
    known = v.arr.where("is_observed").select("route_id", "delay_s")
    ranked = known.join(found, "route_id").groupBy("route_id", "n_arrivals").agg(
        *[F.count_if(F.col("delay_s") < F.col(c)).alias(f"{c}_under") for c in share],
        *[F.count_if(F.col("delay_s") <= F.col(c)).alias(f"{c}_upto") for c in share],
    )
    error = 0.025 * F.col("n_arrivals") + 1
    return ranked.select(
        "route_id",
        "n_arrivals",
        *[
            ((F.col(f"{c}_under") <= q * F.col("n_arrivals") + error) & (F.col(f"{c}_upto") >= q * F.col("n_arrivals") - error)).alias(c)
            for c, q in share.items()
        ],
    )


# ---- the whole dataflow ----


@staged
def dataflow_end_to_end(v: Views) -> DataFrame:
    """Files to labels, examples, models, scores and monitoring; the result is rows per table."""
    lake = sinks.Lake(new_folder(v.spark, "lake"), "dev_")
    raw, static = _raw_files(v, *dataflow.FEEDS), new_folder(v.spark, "static")
    for file, rows in v.static_files.items():
        rows.write.option("header", True).csv(f"{static}/version=V1/{file}.txt")
    hourly = replace(SETTINGS, label_max_lead_s=3600, max_abs_delay_s=86_400, live_anchor_max_age_s=86_400)
    dataflow.refresh(v.spark, lake, raw, static, hourly)
    dataflow.build_training_set(v.spark, lake, settings=hourly)
    dataflow.train(v.spark, lake, settings=hourly)
    dataflow.score(v.spark, lake, hourly)
    counts = [
        lake.read(v.spark, *name.split(".")).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


TABLES = (
    "bronze.trip_updates", "bronze.vehicle_positions", "bronze.alerts",
    "silver.routes", "silver.stops", "silver.scheduled_stops",
    "silver.stop_updates", "silver.positions", "silver.alerts",
    "gold.stop_arrivals", "gold.route_delay_hourly", "gold.training_set",
    "gold.model_results", "gold.test_predictions",
    "gold.delay_predictions", "gold.prediction_monitoring", "gold.live_vehicles",
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: f(Views(spark, sf_dir, f.__name__ in STAGED))

    return {name: bind(f) for name, f in QUERIES.items()}
