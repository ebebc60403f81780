"""The whole dataflow as plain jobs: `refresh` after new files, `build_training_set`, `train`."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headwind.functions.clock import epoch, utc_day
from headwind.functions.columns import mode_of
from headwind.operators.clean import alert_history, merged_alerts, with_alert_bucket
from headwind.operators.evaluate import Split, error_metrics, result_rows, time_split
from headwind.operators.features import daily_delays, live_examples, training_examples
from headwind.operators.labels import hourly_delay, known_outcomes, last_prediction_label
from headwind.operators.models import (
    BASELINES,
    fill_features,
    predict_complete,
    select_model,
    test_prediction_rows,
)
from headwind.operators.quality import (
    COUNTS,
    observed_rates,
    outcome_rules,
    position_rules,
    rule_counts,
    stop_rules,
    stop_update_rules,
)
from headwind.operators.schedule import newest_version, of_version, schedule_of
from headwind.operators.scoring import (
    between_days,
    live_vehicles,
    monitoring,
    predictions_long,
    since_days,
)
from headwind.session import scratch
from headwind.settings import DEFAULTS, Settings
from headwind.sources.sinks import Lake, day_bounds, make_folder, remove
from headwind.sources.snapshots import bronze_schema
from headwind.sources.versioned_csv import read_versioned
from headwind.streaming.jobs import (
    burst,
    each_batch,
    ingest_feed,
    reported,
    silver_positions,
    silver_stop_updates,
    stream_folder,
)

FEEDS = ("trip_updates", "vehicle_positions", "alerts")


def load_schedule(spark: SparkSession, lake: Lake, static_root: str, settings: Settings) -> list[tuple]:
    """Newest schedule version to the silver tables routes, stops and scheduled_stops.

    Returns the counts of the stops' rules.
    """
    version = newest_version(read_versioned(spark, static_root, "feed_info"))

    def newest(file: str) -> DataFrame:
        return of_version(read_versioned(spark, static_root, file), version)

    routes = newest("routes")
    rail = mode_of(F.col("route_type").try_cast("int"), settings.rail_route_types)
    lake.overwrite(routes.withColumn("mode", rail), "silver", "routes")
    stops = newest("stops").withColumns(
        {c: F.col(c).try_cast("double") for c in ("stop_lat", "stop_lon")}
    )
    rules, seen = stop_rules(settings), Observation()
    lake.overwrite(observed_rates(stops, rules, seen), "silver", "stops")
    plan = schedule_of(
        newest("stop_times").drop("gtfs_version"),
        newest("trips").drop("gtfs_version"),
        routes.drop("gtfs_version"),
        settings,
    )
    lake.overwrite(plan, "silver", "scheduled_stops")
    return rule_counts("silver.stops", rules, [seen.get])


def refresh(
    spark: SparkSession,
    lake: Lake,
    raw_root: str,
    static_root: str,
    settings: Settings = DEFAULTS,
    day: str | None = None,
    archive: str | None = None,
) -> None:
    """Ingest new snapshots, extend silver, relabel the service dates they touch, rebuild reports.

    A feed may have no files yet, or no folder; its tables are then empty. Every step reads what is
    new since the last refresh. `gold/quality` gains one row per table and rule: the rows that this
    refresh judged, those that passed, and those that were dropped. With an `archive` folder, read
    snapshots are moved there.
    """
    for feed in FEEDS:
        target, checkpoint = lake.path("bronze", feed), lake.checkpoint(f"bronze_{feed}")
        ingest_feed(spark, raw_root, feed, target, checkpoint, day, settings, archive)
    counts = load_schedule(spark, lake, static_root, settings)
    updates = silver_stop_updates(
        stream_folder(spark, lake.path("bronze", "trip_updates"), bronze_schema("trip_updates")),
        lake.read(spark, "silver", "scheduled_stops"),
        settings,
        observe="rules",
    )
    query = burst(
        updates,
        lake.path("silver", "stop_updates"),
        lake.checkpoint("silver_stop_updates"),
        ["service_date"],
    )
    counts += rule_counts("silver.stop_updates", stop_update_rules(settings), reported(query, "rules"))
    positions = stream_folder(spark, lake.path("bronze", "vehicle_positions"), bronze_schema("vehicle_positions"))
    query = burst(
        silver_positions(positions, settings, observe="rules"),
        lake.path("silver", "positions"),
        lake.checkpoint("silver_positions"),
    )
    counts += rule_counts("silver.positions", position_rules(settings), reported(query, "rules"))
    extend_alerts(spark, lake, settings)
    counts += relabel(spark, lake, settings)
    run = F.lit(uuid.uuid4().hex).alias("run_id")
    lake.append(
        spark.createDataFrame(counts, COUNTS).select(run, "*", F.current_timestamp().alias("counted_at")), "gold", "quality"
    )


def extend_alerts(spark: SparkSession, lake: Lake, settings: Settings = DEFAULTS) -> None:
    """Merge the alerts of new bronze files into the history; what is in the other buckets is not read.

    First and last sightings and least starts merge in any order and however often, so a batch that
    comes again after a failure changes nothing. A mark stands while buckets are being replaced; if a
    job died then, the next one builds the history anew from all of bronze.
    """
    bronze = lake.path("bronze", "alerts")
    mark = lake.path("silver", "alerts_being_replaced")

    def bucketed(rows: DataFrame) -> DataFrame:
        return with_alert_bucket(alert_history(rows), settings.alert_buckets)

    def rebuild() -> None:
        lake.overwrite(bucketed(lake.read(spark, "bronze", "alerts", bronze_schema("alerts"))), "silver", "alerts", "bucket")

    def merge(batch: DataFrame, _: int) -> None:
        with scratch(spark) as stage:
            fresh = stage(bucketed(batch))
            # at most `alert_buckets` values
            buckets = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
            if not buckets:
                return
            if lake.exists(spark, "silver", "alerts"):
                fresh = lake.read(spark, "silver", "alerts").where(F.col("bucket").isin(buckets)).unionByName(fresh)
            make_folder(spark, mark)
            lake.replace_parts(merged_alerts(fresh, "bucket"), "silver", "alerts", "bucket", buckets)
            remove(spark, mark)

    begun = lake.exists(spark, "silver", "alerts")
    if lake.exists(spark, "silver", "alerts_being_replaced") or (
        begun and "bucket" not in lake.read(spark, "silver", "alerts").columns
    ):
        make_folder(spark, mark)
        rebuild()
        remove(spark, mark)
    each_batch(stream_folder(spark, bronze, bronze_schema("alerts")), merge, lake.checkpoint("silver_alert_history"))
    if not lake.exists(spark, "silver", "alerts"):
        none = bucketed(spark.createDataFrame([], bronze_schema("alerts"))).drop("bucket")
        none.write.parquet(f"{lake.path('silver', 'alerts')}/bucket=0")


def relabel(spark: SparkSession, lake: Lake, settings: Settings = DEFAULTS) -> list[tuple]:
    """Recompute labels and the hourly report of exactly the service dates that gained updates.

    The new files of the stop updates name the dates that are due, and only these are read. They come
    as a numbered batch that counts as done when its labels are written; a job that failed half-way is
    made up for by the next one, which gets the same batch again. `gold/label_batches` keeps each
    batch's dates with the newest ingest time, also where no label came out. Updates without a service
    date cannot be placed and get no label. Returns the counts of the labels' rules.
    """
    bronze = lake.read(spark, "bronze", "trip_updates", bronze_schema("trip_updates"))
    schema = silver_stop_updates(bronze, lake.read(spark, "silver", "scheduled_stops"), settings).schema
    updates = lake.read(spark, "silver", "stop_updates", schema)
    rules, metrics = outcome_rules(settings), []

    def label(batch: DataFrame, number: int) -> None:
        with scratch(spark) as stage:
            due = stage(batch.groupBy("service_date").agg(F.max("ingest_ts").alias("newest")))
            # one value per date that is due
            every = sorted(r["service_date"] for r in due.select("service_date").collect())
            for first in range(0, len(every), settings.days_per_pass):
                days = every[first : first + settings.days_per_pass]
                outcomes = last_prediction_label(updates.where(F.col("service_date").isin(days)), settings=settings)
                seen = Observation()
                lake.replace_parts(observed_rates(outcomes, rules, seen), "gold", "stop_arrivals", "service_date", days)
                metrics.append(seen.get)
                fresh = lake.read(spark, "gold", "stop_arrivals").where(F.col("service_date").isin(days))
                lake.replace_parts(hourly_delay(fresh, settings, sketches=True), "gold", "route_delay_hourly", "service_date", days)
                add_daily_delays(spark, lake, days, settings)
            if every:
                due.write.mode("overwrite").parquet(f"{lake.path('gold', 'label_batches')}/batch={number}")

    touched = stream_folder(spark, lake.path("silver", "stop_updates"), schema).select("service_date", "ingest_ts")
    each_batch(touched.where("service_date is not null"), label, lake.checkpoint("gold_labels"))
    return rule_counts("gold.stop_arrivals", rules, metrics)


DAILY = "delay_daily_sums"


def add_daily_delays(spark: SparkSession, lake: Lake, days: list[date], settings: Settings = DEFAULTS) -> None:
    """Refresh the daily sums of delays of these service dates from their labels.

    A lake without a finished table of them gets the sums of all its labels.
    """
    labels = lake.read(spark, "gold", "stop_arrivals")
    if not lake.exists(spark, "gold", f"{DAILY}/_SUCCESS"):
        sums = daily_delays(known_outcomes(labels), settings)
        lake.overwrite(sums.hint("rebalance", F.col("service_date")), "gold", DAILY, "service_date")
        return
    due = labels.where(F.col("service_date").isin(days))
    lake.replace_parts(daily_delays(known_outcomes(due), settings), "gold", DAILY, "service_date", days)


def stored_daily_delays(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The daily sums of delays, or nothing where no refresh has finished them yet."""
    return lake.read(spark, "gold", DAILY) if lake.exists(spark, "gold", f"{DAILY}/_SUCCESS") else None


def build_training_set(
    spark: SparkSession, lake: Lake, first: str = "", last: str = "", settings: Settings = DEFAULTS
) -> tuple[date, date]:
    """Examples of a range of dates, replaced by date.

    The trailing means come from stored daily sums. Outcomes of the days before the range are read
    only to find the vehicle ahead.
    """
    outcomes = lake.read(spark, "gold", "stop_arrivals")
    start, end = day_bounds(outcomes, first, last)
    daily, oldest = stored_daily_delays(spark, lake), start - timedelta(days=settings.history_days)
    with scratch(spark) as stage:
        examples = training_examples(
            between_days(outcomes, oldest, end),
            between_days(lake.read(spark, "silver", "stop_updates"), start, end),
            lake.read(spark, "silver", "scheduled_stops"),
            lake.read(spark, "silver", "alerts"),
            settings,
            stage=stage,
            daily=None if daily is None else between_days(daily, oldest, end),
            first=start,
        )
        lake.replace_days(examples, "gold", "training_set", start, end)
    return start, end


@dataclass(frozen=True)
class TrainingRun:
    run_id: str
    split: Split
    best: str | None
    champion: bool


def train(
    spark: SparkSession,
    lake: Lake,
    first: str = "",
    last: str = "",
    settings: Settings = DEFAULTS,
    pipelines=None,
) -> TrainingRun:
    """Baselines and candidates on a time split; results appended, best test predictions kept.

    The model is chosen on blocks of days before the held-out window (`gold/model_blocks`). Only a run on full data makes its model the champion.
    """
    table = lake.read(spark, "gold", "training_set")
    start, end = day_bounds(table, first, last)
    data = fill_features(between_days(table, start, end), settings)
    fit_on, test, split = time_split(data, start, end, settings)
    run_id = uuid.uuid4().hex
    chosen = select_model(fit_on, test, pipelines, split=split, settings=settings)
    lake.append(result_rows(chosen.metrics, run_id, split), "gold", "model_results")
    if chosen.model is None:
        return TrainingRun(run_id, split, None, False)
    lake.append(chosen.blocks.select(F.lit(run_id).alias("run_id"), "*"), "gold", "model_blocks")
    lake.overwrite(test_prediction_rows(chosen.scored, run_id), "gold", "test_predictions")
    champion = register_model(spark, lake, chosen.model, chosen.name, run_id, split)
    return TrainingRun(run_id, split, chosen.name, champion)


def register_model(
    spark: SparkSession, lake: Lake, model: PipelineModel, name: str, run_id: str, split: Split
) -> bool:
    """Save the model under its run and note it in the registry table."""
    path = lake.path("models", run_id)
    model.write().overwrite().save(path)
    entry = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("model"),
        F.lit(path).alias("path"),
        F.lit(split.status).alias("data_status"),
        F.lit(not split.preliminary).alias("is_champion"),
        F.current_timestamp().alias("registered_at"),
    )
    lake.append(entry, "models", "registry")
    return not split.preliminary


def load_champion(spark: SparkSession, lake: Lake) -> tuple[PipelineModel | None, str | None]:
    """The newest champion and its run, or nothing if no full-data run has been registered."""
    if not lake.exists(spark, "models", "registry"):
        return None, None
    row = (
        lake.read(spark, "models", "registry")
        .where("is_champion")
        .orderBy(F.desc("registered_at"), F.desc("run_id"))
        .select("path", "run_id")
        .first()
    )
    return (PipelineModel.load(row["path"]), row["run_id"]) if row else (None, None)


def newest_snapshot(updates: DataFrame):
    """Time of the newest snapshot of the whole table; one column is read, and no service date is
    trusted, since a single wrong one would set the clock back."""
    return updates.agg(F.max("feed_ts").alias("t")).first()["t"]


def score(spark: SparkSession, lake: Lake, settings: Settings = DEFAULTS):
    """Score active trips as of the newest snapshot, monitor past predictions, refresh live table."""
    everything = lake.read(spark, "silver", "stop_updates")
    now = newest_snapshot(everything)
    if now is None:
        return None
    now_ts = F.lit(now)
    today = utc_day(epoch(now_ts))
    updates = since_days(everything, "service_date", today, 1)
    outcomes = lake.read(spark, "gold", "stop_arrivals")
    daily = stored_daily_delays(spark, lake)
    model, version = load_champion(spark, lake)
    with scratch(spark) as stage:
        examples = live_examples(
            since_days(outcomes, "service_date", today, settings.history_days + 1),
            updates,
            lake.read(spark, "silver", "scheduled_stops"),
            lake.read(spark, "silver", "alerts"),
            now_ts,
            settings,
            stage=stage,
            daily=None if daily is None else since_days(daily, "service_date", today, settings.history_days + 1),
        )
        if model is not None:
            # rows with incomplete inputs stay, for the baselines, without a model value
            examples = predict_complete(model, fill_features(examples, settings), "model_pred_s")
        lake.append(predictions_long(examples, now_ts, version), "gold", "delay_predictions")
    # outcomes of the whole monitoring range: with fewer, older days would vanish from the table
    days = settings.monitoring_days
    watched = monitoring(
        since_days(lake.read(spark, "gold", "delay_predictions"), "service_date", today, days),
        since_days(outcomes, "service_date", today, days),
    )
    lake.overwrite(watched, "gold", "prediction_monitoring")
    live = live_vehicles(
        since_days(lake.read(spark, "silver", "positions"), "vehicle_ts", today, 1),
        updates,
        lake.read(spark, "silver", "routes"),
        now_ts,
        settings,
    )
    lake.overwrite(live, "gold", "live_vehicles")
    return now


def baseline_results(test: DataFrame, run_id: str, split: Split) -> DataFrame:
    return result_rows(error_metrics(test, BASELINES), run_id, split)
