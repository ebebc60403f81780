"""Data-quality rules: SQL predicates that are only counted, or that also remove rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headwind.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    drop: bool = False


def stop_update_rules(settings: Settings = DEFAULTS) -> tuple[Rule, ...]:
    limit = settings.max_abs_delay_s
    return (
        Rule("trip_id_present", "trip_id IS NOT NULL", drop=True),
        Rule("delay_in_bounds", f"arrival_delay_s IS NULL OR abs(arrival_delay_s) <= {limit}", drop=True),
        Rule("schedule_matched", "scheduled_arrival_ts IS NOT NULL"),
        Rule("date_not_shifted", "coalesce(service_date_shift_days, 0) = 0"),
    )


def position_rules(settings: Settings = DEFAULTS) -> tuple[Rule, ...]:
    a = settings.area
    inside = (
        f"latitude BETWEEN {a.min_lat} AND {a.max_lat} "
        f"AND longitude BETWEEN {a.min_lon} AND {a.max_lon}"
    )
    return (
        Rule("vehicle_id_present", "vehicle_id IS NOT NULL", drop=True),
        Rule("position_in_area", inside, drop=True),
    )


def stop_rules(settings: Settings = DEFAULTS) -> tuple[Rule, ...]:
    a = settings.area
    return (Rule("stop_in_area", f"stop_lat BETWEEN {a.min_lat} AND {a.max_lat}"),)


def outcome_rules(settings: Settings = DEFAULTS) -> tuple[Rule, ...]:
    return (
        Rule("label_is_observed", "is_observed"),
        Rule("delay_in_bounds", f"abs(delay_s) <= {settings.max_abs_delay_s}"),
    )


def _holds(rule: Rule):
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Remove rows that break a dropping rule. An unknown (null) outcome breaks it. Streams too."""
    for rule in rules:
        if rule.drop:
            df = df.where(_holds(rule))
    return df


def rule_rates(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule, rows seen, rows passed and pass rate, in one pass over the data."""
    counts = df.agg(
        F.count("*").alias("n"), *[F.count_if(_holds(r)).alias(f"p{i}") for i, r in enumerate(rules)]
    )
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit("drop" if r.drop else "warn").alias("action"),
                F.col(f"p{i}").alias("n_passed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select("n", F.inline(per_rule)).select(
        "rule",
        "action",
        F.col("n").alias("n_rows"),
        "n_passed",
        F.try_divide("n_passed", "n").alias("pass_rate"),
    )


def observed_rates(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str
) -> DataFrame:
    """Attach the same counts as metrics of the running query.

    A batch takes an `Observation`, a stream the name its progress reports them under. Where rules
    drop rows, `n_dropped` counts the rows that break at least one of them.
    """
    dropping = [_holds(r) for r in rules if r.drop]
    dropped = [F.count_if(~reduce(and_, dropping)).alias("n_dropped")] if dropping else []
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_holds(r)).alias(r.name) for r in rules],
        *dropped,
    )


#: one row per run, table and rule; `n_dropped` is the table's, whichever rule a row broke
COUNTS = "name string, rule string, action string, n_rows long, n_passed long, n_dropped long, pass_rate double"


def rule_counts(name: str, rules: Sequence[Rule], metrics: Iterable[Mapping[str, int]]) -> list[tuple]:
    """Rows of COUNTS for one table: what `observed_rates` reported, summed over a run's batches.

    A run without batches has seen 0 rows and has no rates.
    """
    metrics = list(metrics)
    total = lambda key: sum(m[key] for m in metrics if key in m)
    n, dropped = total("n_rows"), total("n_dropped")
    return [
        (name, r.name, "drop" if r.drop else "warn", n, total(r.name), dropped, total(r.name) / n if n else None)
        for r in rules
    ]
