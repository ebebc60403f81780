"""Reporting queries over the gold tables. Thresholds are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.functions.clock import local_minute_text
from headwind.functions.columns import exact_percentile, share, weighted_mean
from headwind.settings import DEFAULTS, Settings

PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _mean_miss(prediction: str) -> Column:
    return F.avg(F.abs(F.col(prediction) - F.col("target_delay_s")))


def live(vehicles: DataFrame) -> DataFrame:
    return vehicles.where(F.isnotnull("delay_min")).select(
        "route_short_name", "mode", "latitude", "longitude", "delay_min"
    )


def summary(vehicles: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return vehicles.agg(
        F.max("vehicle_ts").alias("newest"),
        F.count("*").alias("vehicles"),
        F.round(F.avg("delay_min"), 1).alias("avg_delay_min"),
        F.round(100 * share(F.col("delay_min") > 5), 1).alias("pct_late_5min"),
    ).select(
        local_minute_text("newest", settings.local_zone).alias("data_as_of"),
        "vehicles",
        "avg_delay_min",
        "pct_late_5min",
    )


def worst_now(vehicles: DataFrame, at_least: int = 2, top: int = 15) -> DataFrame:
    return (
        vehicles.where(F.isnotnull("delay_min"))
        .groupBy(F.col("route_short_name").alias("route"), "mode")
        .agg(F.count("*").alias("vehicles"), F.round(F.avg("delay_min"), 1).alias("avg_delay_min"))
        .where(F.col("vehicles") >= at_least)
        .orderBy(F.desc("avg_delay_min"), "route", "mode")
        .limit(top)
    )


def prediction_vs_actual(
    predictions: DataFrame, outcomes: DataFrame, today: Column, days: int = 2, sample: int = 3000
) -> DataFrame:
    """A fixed number of (predicted, actual) points, drawn by a hash of their key: repeatable, and no
    trip or day comes first."""
    actual = outcomes.where(F.col("is_observed") & (F.abs("delay_s") < 3600)).select(
        "service_date", "trip_id", F.col("stop_sequence").alias("target_stop_sequence"), "delay_s"
    )
    key = ["service_date", "trip_id", "target_stop_sequence"]
    point = [*key[1:], "horizon", "predictor"]
    drawn = F.md5(F.concat_ws("|", F.col("service_date").cast("string"), *[F.col(c).cast("string") for c in point]))
    return (
        predictions.where(F.col("service_date") >= F.date_sub(today, days))
        .join(actual, key)
        .orderBy(drawn, *point)
        .limit(sample)
        .select(
            "predictor",
            "horizon",
            F.round(F.col("predicted_delay_s") / 60, 2).alias("predicted_min"),
            F.round(F.col("delay_s") / 60, 2).alias("actual_min"),
        )
    )


def error_daily(monitored: DataFrame) -> DataFrame:
    return (
        monitored.groupBy("service_date", "predictor")
        .agg(F.round(weighted_mean(F.col("mae_s"), F.col("n")), 1).alias("mae_s"))
        .orderBy("service_date", "predictor")
        .select(F.col("service_date").cast("string").alias("service_day"), "predictor", "mae_s")
    )


def error_horizon(monitored: DataFrame) -> DataFrame:
    stops = F.when(F.col("horizon") == 1, "1 stop").otherwise(
        F.concat(F.col("horizon").cast("string"), F.lit(" stops"))
    )
    return (
        monitored.groupBy("predictor", "horizon")
        .agg(F.round(weighted_mean(F.col("mae_s"), F.col("n")), 1).alias("mae_s"))
        .select("predictor", stops.alias("horizon_label"), "horizon", "mae_s")
        .orderBy("horizon", "predictor")
    )


def label_quality(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("mode").agg(
        F.count("*").alias("trip_stops"),
        F.round(share(F.col("is_observed")), 3).alias("share_observed"),
        exact_percentile(outcomes, "label_lead_s", 0.5).alias("median_lead_s"),
        F.min("service_date").alias("first_date"),
        F.max("service_date").alias("last_date"),
    )


def delay_distribution(outcomes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    spread = outcomes.where("is_observed").groupBy("mode").agg(
        F.count("*").alias("arrivals"),
        F.round(F.avg("delay_s")).alias("mean_s"),
        *[exact_percentile(outcomes, "delay_s", q).alias(f"p{round(100 * q):02d}_s") for q in PERCENTILES],
        F.round(share(F.col("delay_s") > settings.late_after_s), 3).alias("share_late_5min"),
        F.round(share(F.col("delay_s") < -60), 3).alias("share_early_1min"),
    )
    points = [f"p{round(100 * q):02d}_s" for q in PERCENTILES]
    return spread.select(
        "mode", "arrivals", "mean_s", *points, "share_late_5min", "share_early_1min"
    )


def delay_histogram(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.where(F.col("is_observed") & F.col("delay_s").between(-600, 1800))
        .groupBy("mode", F.floor(F.col("delay_s") / 60).alias("delay_min"))
        .agg(F.count("*").alias("arrivals"))
        .orderBy("mode", "delay_min")
    )


def _mean_delay() -> Column:
    return F.round(weighted_mean(F.col("avg_delay_s"), F.col("n_arrivals"))).alias("avg_delay_s")


def time_of_day(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("is_weekday", "hour_local", "mode")
        .agg(F.sum("n_arrivals").alias("arrivals"), _mean_delay())
        .orderBy("is_weekday", "mode", "hour_local")
    )


def worst_routes(hourly: DataFrame, at_least: int = 200, top: int = 20) -> DataFrame:
    late = weighted_mean(F.col("share_late_5min"), F.col("n_arrivals"))
    return (
        hourly.groupBy("route_short_name", "mode")
        .agg(
            F.sum("n_arrivals").alias("arrivals"),
            _mean_delay(),
            F.round(late, 3).alias("share_late_5min"),
        )
        .where(F.col("arrivals") >= at_least)
        .orderBy(F.desc("avg_delay_s"), "route_short_name", "mode")
        .limit(top)
    )


def five_pm(hourly: DataFrame, at_least: int = 50, top: int = 10, hour: int = 17) -> DataFrame:
    return (
        hourly.where(F.col("is_weekday") & (F.col("hour_local") == hour))
        .groupBy("route_short_name", "mode")
        .agg(F.sum("n_arrivals").alias("arrivals"), _mean_delay())
        .where(F.col("arrivals") >= at_least)
        .orderBy(F.desc("avg_delay_s"), "route_short_name", "mode")
        .limit(top)
    )


def delay_growth(outcomes: DataFrame) -> DataFrame:
    bucket = F.least(F.floor(F.col("stop_sequence") / 5) * 5, F.lit(60))
    return (
        outcomes.where("is_observed")
        .groupBy("mode", bucket.alias("stop_sequence_bucket"))
        .agg(F.count("*").alias("arrivals"), F.round(F.avg("delay_s")).alias("avg_delay_s"))
        .orderBy("mode", "stop_sequence_bucket")
    )


def latest_results(results: DataFrame) -> DataFrame:
    """Rows of the newest run: one run writes all its rows with one time."""
    newest = results.agg(F.max("processed_ts")).scalar()
    return (
        results.where(F.col("processed_ts") == newest)
        .select(
            "data_status",
            "data_start",
            "data_end",
            "predictor",
            "mode",
            "horizon",
            "n",
            F.round("mae_s", 1).alias("mae_s"),
            F.round("rmse_s", 1).alias("rmse_s"),
        )
        .orderBy("mode", "horizon", "mae_s", "predictor")
    )


def model_gain(test_predictions: DataFrame) -> DataFrame:
    """Model and baselines on the examples that the provider predicted too."""
    gain = 100 * (1 - F.col("m") / F.col("b"))
    return (
        test_predictions.where(F.isnotnull("provider_pred_s"))
        .groupBy("mode", "horizon")
        .agg(
            F.count("*").alias("n"),
            _mean_miss("persistence_pred_s").alias("b"),
            _mean_miss("provider_pred_s").alias("p"),
            _mean_miss("model_pred_s").alias("m"),
        )
        .select(
            "mode",
            "horizon",
            "n",
            F.round("b", 1).alias("persistence_mae"),
            F.round("p", 1).alias("provider_mae"),
            F.round("m", 1).alias("model_mae"),
            F.when(F.col("b") != 0, F.round(gain, 1)).alias("model_gain_pct"),
        )
        .orderBy("mode", "horizon")
    )


def losing_slices(test_predictions: DataFrame, at_least: int = 200, top: int = 25) -> DataFrame:
    now = F.col("current_delay_s")
    state = (
        F.when(now < 0, "early")
        .when(now < 120, "on time (0-2 min)")
        .when(now < 600, "late (2-10 min)")
        .otherwise("very late (10+ min)")
    )
    return (
        test_predictions.groupBy("route_short_name", "mode", "horizon", state.alias("current_state"))
        .agg(
            F.count("*").alias("n"),
            _mean_miss("persistence_pred_s").alias("persistence_mae"),
            _mean_miss("model_pred_s").alias("model_mae"),
        )
        .where((F.col("n") >= at_least) & (F.col("model_mae") > F.col("persistence_mae")))
        .withColumn(
            "model_minus_persistence", F.round(F.col("model_mae") - F.col("persistence_mae"), 1)
        )
        .orderBy(
            F.desc("model_minus_persistence"), "route_short_name", "mode", "horizon", "current_state"
        )
        .limit(top)
    )


def _two_errors(test_predictions: DataFrame, *by: str) -> DataFrame:
    return test_predictions.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.round(_mean_miss("persistence_pred_s"), 1).alias("persistence_mae"),
        F.round(_mean_miss("model_pred_s"), 1).alias("model_mae"),
    )


def ahead_effect(test_predictions: DataFrame) -> DataFrame:
    return _two_errors(test_predictions, "horizon", "has_ahead").orderBy("horizon", "has_ahead")


def error_by_hour(test_predictions: DataFrame) -> DataFrame:
    weekdays = test_predictions.where("is_weekend = 0")
    return _two_errors(weekdays, "hour_local", "mode").orderBy("mode", "hour_local")
