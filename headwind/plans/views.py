"""Event-shaped inputs of every operator, derived from the `events` table.

An event becomes one outcome of an item ("trip") of a user and day; forecasts, alerts, schedules
and raw feed entities are derived from it. All of it is lazy and row-wise, except for numbering
the events of a trip.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwind.functions.clock import utc_day
from headwind.functions.columns import mode_of
from headwind.operators import features
from headwind.operators.labels import known_outcomes
from headwind.operators.sliced import numbered
from headwind.session import materialize
from headwind.settings import DEFAULTS
from headwind.sources.snapshots import ENTITY, typed_records

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
# trips in the table have at most a dozen events, so horizons are short; live ages are long
SETTINGS = replace(
    DEFAULTS,
    horizons=(1, 2, 5),
    live_anchor_max_age_s=12 * 3600,
    live_vehicle_max_age_s=6 * 3600,
)
ROUTES = ("click", "view", "purchase", "signup", "error")
ZONE = SETTINGS.local_zone


def seconds(column: str, name: str | None = None) -> Column:
    """A timestamp column as epoch seconds, named `<stem>_e`."""
    return F.unix_seconds(column).alias(name or column.removesuffix("_ts") + "_e")


@dataclass
class Views:
    """`staged` writes outcomes and pairs to tables first: queries that read them several times
    then scan those tables instead of repeating the shuffles that lead to them."""

    spark: SparkSession
    folder: str
    staged: bool = False

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.staged else df

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Times are cut to the second. Declaring `ts` an instant reads the stored value as UTC."""
        raw = self.spark.read.schema(EVENTS).parquet(f"{self.folder}/events.parquet")
        return raw.select(
            "event_id",
            F.timestamp_seconds(F.unix_seconds("ts")).alias("ts"),
            F.unix_seconds("ts").alias("e"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        )

    @cached_property
    def now(self) -> Column:
        """The newest event as a scalar subquery."""
        return self.events.agg(F.max("ts")).scalar()

    @cached_property
    def arr(self) -> DataFrame:
        """Outcomes: one row per event. Only the numbered events are staged; the rest is derived from each."""
        e = F.col("e")
        numbered_events = numbered(
            self.events.select(
                "event_id", "user_id", "event_type", "value", "k", "e", utc_day(e).alias("service_date")
            ),
            ["service_date", "user_id"],
            [e, F.col("event_id")],
            F.floor(e / 3600),
            "stop_sequence",
        )
        k = F.col("k")
        delay = F.floor(F.col("value") * 6) - 120
        rail = F.col("event_type").isin("signup", "error")
        return self._stage(numbered_events, "arr").select(
            "event_id",
            "user_id",
            "k",
            "e",
            "service_date",
            F.concat(
                F.col("service_date").cast("string"), F.lit(":"), F.col("user_id").cast("string")
            ).alias("trip_id"),
            "stop_sequence",
            F.concat(F.lit("s"), (k % 5).cast("string")).alias("stop_id"),
            F.col("event_type").alias("route_id"),
            F.col("event_type").alias("rt_route_id"),
            F.upper("event_type").alias("route_short_name"),
            F.when(rail, 0).otherwise(3).alias("route_type"),
            F.when(rail, "rail").otherwise("bus").alias("mode"),
            (F.col("user_id") % 2).cast("int").alias("direction_id"),
            delay.alias("delay_s"),
            F.timestamp_seconds(e).alias("actual_arrival_ts"),
            k.cast("long").alias("label_lead_s"),
            F.timestamp_seconds(e - k).alias("last_seen_ts"),
            F.timestamp_seconds(e - delay).alias("scheduled_arrival_ts"),
            (k <= 60).alias("is_observed"),
        )

    @cached_property
    def upd(self) -> DataFrame:
        """Forecasts: four per outcome, two hours apart."""
        n, k, e = F.col("n"), F.col("k"), F.col("e")
        predicted = e + 15 * n * (k % 3)
        return (
            self.arr.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .withColumn("feed_ts", F.timestamp_seconds(e - (k + 7200 * n)))
            .withColumn("predicted_arrival_ts", F.timestamp_seconds(predicted))
            .withColumn("arrival_delay_s", predicted - F.unix_seconds("scheduled_arrival_ts"))
        )

    @cached_property
    def obs(self) -> DataFrame:
        return known_outcomes(self.arr)

    @cached_property
    def trend(self) -> DataFrame:
        return features.with_trend(self.obs, SETTINGS)

    @cached_property
    def pairs(self) -> DataFrame:
        return self._stage(features.pairs_of(self.obs, SETTINGS), "pairs")

    @cached_property
    def sched(self) -> DataFrame:
        """Schedule: every stop of a trip and two more."""
        stops = self.arr.select("trip_id", "stop_sequence")
        more = (
            stops.groupBy("trip_id")
            .agg(F.max("stop_sequence").alias("top"))
            .select("trip_id", F.explode(F.expr("array(top + 1, top + 2)")).alias("stop_sequence"))
        )
        seq = F.col("stop_sequence")
        return stops.unionByName(more).select(
            "trip_id",
            "stop_sequence",
            F.concat(F.lit("s"), (seq % 5).cast("string")).alias("scheduled_stop_id"),
            (21600 + 300 * seq).alias("scheduled_arrival_secs"),
        )

    @cached_property
    def alerts(self) -> DataFrame:
        route = F.get(F.array(*[F.lit(r) for r in ROUTES]), F.col("k") % 5)
        stop = F.concat(F.lit("s"), (F.col("k") % 5).cast("string"))
        # short enough that a moment may be free of them, though every event makes one
        return self.events.select(
            route.alias("route_id"),
            F.when(F.col("user_id") % 2 == 1, stop).alias("stop_id"),
            F.col("ts").alias("first_seen_ts"),
            F.timestamp_seconds(F.col("e") + 60 + 6 * F.col("k")).alias("last_seen_ts"),
        )

    @cached_property
    def examples(self) -> DataFrame:
        """Pairs with every feature."""
        return features.with_features(
            self.pairs, self.obs, self.upd, self.sched, self.alerts, SETTINGS
        )

    @cached_property
    def forecast_pairs(self) -> DataFrame:
        """Pairs with both baselines only."""
        return features.with_provider_forecast(self.pairs, self.upd, SETTINGS).withColumn(
            "persistence_pred_s", F.col("current_delay_s")
        )

    @cached_property
    def tested(self) -> DataFrame:
        """Held-out predictions of a fixed stand-in model, for the error reports."""
        rows = features.with_vehicle_ahead(
            features.with_time(self.forecast_pairs, SETTINGS), self.obs, SETTINGS, self.pairs
        )
        return rows.withColumns(
            {
                "has_ahead": F.isnotnull("ahead_delay_s").cast("int"),
                "model_pred_s": 0.75 * F.col("current_delay_s") + 300.0,
            }
        )

    @cached_property
    def static_files(self) -> dict[str, DataFrame]:
        """Schedule files as text columns, in two versions of which the later one is complete."""
        trips = self.arr.groupBy("trip_id").agg(
            F.max("route_id").alias("route_id"), F.max("direction_id").alias("direction_id")
        )
        secs = F.col("scheduled_arrival_secs")

        def clock(s: Column) -> Column:
            parts = [F.floor(s / 3600), F.floor(s / 60) % 60, s % 60]
            return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])

        routes = self.events.select(F.col("event_type").alias("route_id")).distinct()
        rail = F.col("route_id").isin("signup", "error")
        return {
            "feed_info": self.events.groupBy()
            .agg(F.min(utc_day(F.col("e"))).alias("a"), F.max(utc_day(F.col("e"))).alias("b"))
            .select(
                F.lit("headwind").alias("feed_publisher_name"),
                F.date_format("a", "yyyyMMdd").alias("feed_start_date"),
                F.date_format("b", "yyyyMMdd").alias("feed_end_date"),
                F.lit("x").alias("feed_version"),
            ),
            "routes": routes.select(
                "route_id",
                F.upper("route_id").alias("route_short_name"),
                F.lit(None).cast("string").alias("route_long_name"),
                F.when(rail, "0").otherwise("3").alias("route_type"),
            ),
            "trips": trips.select(
                "route_id",
                F.lit("daily").alias("service_id"),
                "trip_id",
                F.lit(None).cast("string").alias("trip_headsign"),
                F.col("direction_id").cast("string").alias("direction_id"),
                F.lit(None).cast("string").alias("block_id"),
            ),
            "stop_times": self.sched.select(
                "trip_id",
                clock(secs).alias("arrival_time"),
                clock(secs + 30).alias("departure_time"),
                F.col("scheduled_stop_id").alias("stop_id"),
                F.col("stop_sequence").cast("string").alias("stop_sequence"),
            ),
            "stops": self.events.select(
                F.concat(F.lit("s"), (F.col("k") % 5).cast("string")).alias("stop_id")
            )
            .distinct()
            .select(
                "stop_id",
                F.concat(F.lit("Stop "), "stop_id").alias("stop_name"),
                F.lit("39.7").alias("stop_lat"),
                F.lit("-105.0").alias("stop_lon"),
                F.lit(None).cast("string").alias("parent_station"),
            ),
        }

    def entities(self, feed: str) -> DataFrame:
        """Raw feed entities `e` with the header second of the hourly snapshot they belong to."""
        header = F.col("e") - F.col("e") % 3600
        build = {
            "trip_updates": _trip_update,
            "vehicle_positions": _vehicle,
            "alerts": _alert,
        }[feed]
        return self.arr.select(
            F.lit("memory").alias("source_file"),
            header.alias("header_s"),
            build().cast(ENTITY[feed]).alias("e"),
        )

    def bronze(self, feed: str) -> DataFrame:
        return typed_records(self.entities(feed), feed)


def _named(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _trip(relationship: Column) -> Column:
    return _named(
        trip_id=F.col("trip_id"),
        start_time=_null(),
        start_date=F.date_format("service_date", "yyyyMMdd"),
        schedule_relationship=relationship,
        route_id=F.col("route_id"),
        direction_id=F.col("direction_id"),
    )


def _items(count: Column, item) -> Column:
    """`count` structs `item(j)`, j from 0; an empty array for 0."""
    numbers = F.slice(F.sequence(F.lit(0), F.lit(2)), F.lit(1), count)
    return F.transform(numbers, item)


def _trip_update() -> Column:
    k, e, seq = F.col("k"), F.col("e"), F.col("stop_sequence")

    def stop(j: Column) -> Column:
        at = e + 60 * (j + 1)
        arrival = _named(delay=_null("int"), time=at)
        return _named(
            stop_sequence=seq + j,
            arrival=F.when((k + j) % 11 != 0, arrival),
            departure=_named(delay=_null("int"), time=at + 20),
            stop_id=F.concat(F.lit("s"), ((k + j) % 5).cast("string")),
            schedule_relationship=F.when((k + j) % 7 == 0, "SKIPPED").otherwise("SCHEDULED"),
        )

    return _named(
        id=F.concat(F.lit("e"), F.col("event_id").cast("string")),
        trip_update=_named(
            trip=_trip(F.when(k % 2 == 0, "SCHEDULED")),
            stop_time_update=_items(k % 4, stop),
            vehicle=_named(id=F.concat(F.lit("v"), F.col("user_id").cast("string")), label=_null()),
            timestamp=e,
            delay=F.when(k % 3 == 0, F.col("delay_s").cast("int")),
        ),
    )


def _vehicle() -> Column:
    k = F.col("k")
    status = F.array(*[F.lit(s) for s in ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")])
    vehicle = _named(id=F.concat(F.lit("v"), F.col("user_id").cast("string")), label=_null())
    return _named(
        id=F.concat(F.lit("e"), F.col("event_id").cast("string")),
        vehicle=_named(
            trip=F.when(k % 4 != 0, _trip(_null())),
            position=_named(
                latitude=39.0 + (k % 16) / 8.0,
                longitude=-105.75 + (k % 16) / 8.0,
                bearing=k.cast("float"),
                speed=_null("float"),
            ),
            current_stop_sequence=F.col("stop_sequence"),
            current_status=F.get(status, k % 3),
            timestamp=F.col("e"),
            stop_id=F.col("stop_id"),
            vehicle=F.when(k != 7, vehicle),
            occupancy_status=F.when(k % 2 == 0, "MANY_SEATS_AVAILABLE"),
            occupancy_percentage=k,
        ),
    )


def _alert() -> Column:
    k, e = F.col("k"), F.col("e")
    user = F.col("user_id").cast("string")
    route = F.get(F.array(*[F.lit(r) for r in ROUTES]), k % 5)

    def informed(j: Column) -> Column:
        return _named(
            agency_id=_null(),
            route_id=F.when(j == 0, route),
            route_type=_null("int"),
            trip=_null("struct<trip_id: string, start_time: string, start_date: string, schedule_relationship: string, route_id: string, direction_id: bigint>"),
            stop_id=F.when(j == 1, F.concat(F.lit("s"), (k % 5).cast("string"))),
            direction_id=_null("bigint"),
        )

    def period(j: Column) -> Column:
        return _named(start=F.when(j != 1, e - 600 * (j + 1)), end=e + 3600)

    text = _named(text=F.concat(F.lit("alert "), user), language=F.lit("en"))
    nothing = _null("struct<translation: array<struct<text: string, language: string>>>")
    return _named(
        id=F.concat(F.lit("a"), user),
        alert=_named(
            active_period=_items(k % 3, period),
            informed_entity=_items(F.when(k % 3 == 1, 0).otherwise(2), informed),
            cause=F.when(k % 2 == 0, "CONSTRUCTION").otherwise("WEATHER"),
            effect=F.lit("DETOUR"),
            severity_level=_null(),
            header_text=_named(translation=F.array(text)),
            description_text=nothing,
        ),
    )
