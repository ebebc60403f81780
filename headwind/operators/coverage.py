"""How complete the collected snapshots are: manifests, gaps, freshness, calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.functions.clock import epoch, utc_day, utc_hour_text
from headwind.operators.sliced import earlier_row, time_slice
from headwind.settings import DEFAULTS


def snapshot_path(feed: Column, header_s: Column) -> Column:
    """Relative path of a snapshot: `feed=/date=/hour=/<feed>_<epoch>.pb`, date and hour in UTC."""
    return F.concat(
        F.lit("feed="),
        feed,
        F.lit("/date="),
        utc_day(header_s).cast("string"),
        F.lit("/hour="),
        utc_hour_text(header_s),
        F.lit("/"),
        feed,
        F.lit("_"),
        header_s.cast("string"),
        F.lit(".pb"),
    )


def parse_manifest(names: DataFrame, feeds: Sequence[str], name: str = "name") -> DataFrame:
    """Feed and header second of names like `<feed>_<epoch>.pb`; other names are left out."""
    pattern = r"^(" + "|".join(feeds) + r")_([0-9]+)\.pb$"
    return names.where(F.col(name).rlike(pattern)).select(
        name,
        F.regexp_extract(name, pattern, 1).alias("feed"),
        F.regexp_extract(name, pattern, 2).try_cast("long").alias("header_s"),
    )


def missing_from(have: DataFrame, reached: DataFrame, key: str = "name") -> DataFrame:
    """Rows of `have` whose key is not in `reached`, in key order."""
    return have.join(reached.select(key), key, "left_anti").orderBy(key)


def date_spine(bounds: DataFrame, first: str, last: str, out: str = "day") -> DataFrame:
    """Every date from `first` to `last`, both included."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias(out))


def gaps(
    df: DataFrame, feed: str, ts: str, after_s: int = DEFAULTS.gap_after_s, slice_s: int = DEFAULTS.slice_s
) -> DataFrame:
    """Neighbouring snapshots of a feed more than `after_s` apart.

    Copies of an instant cannot open a gap, so they are combined before the shuffle.
    """
    instants = df.select(feed, ts).where(F.isnotnull(ts)).distinct()
    paired = earlier_row(
        instants, [feed], [F.col(ts)], time_slice(F.col(ts), slice_s), F.col(ts), "gap_start"
    )
    length = epoch(ts) - epoch("gap_start")
    return paired.select(
        feed, "gap_start", F.col(ts).alias("gap_end"), length.alias("gap_s")
    ).where(F.col("gap_s") > after_s)


def coverage_summary(
    df: DataFrame, feed: str, ts: str, after_s: int = DEFAULTS.gap_after_s, slice_s: int = DEFAULTS.slice_s
) -> DataFrame:
    """Snapshots, first, last and the gaps of each feed. The gap rows themselves: `gaps`."""
    seen = df.groupBy(feed).agg(
        F.count(ts).alias("snapshots"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    holes = (
        gaps(df, feed, ts, after_s, slice_s)
        .groupBy(feed)
        .agg(
            F.count("*").alias("n_gaps"),
            F.sum("gap_s").alias("gap_total_s"),
            F.max("gap_s").alias("gap_longest_s"),
        )
    )
    return seen.join(holes, feed, "left").na.fill(0, ["n_gaps", "gap_total_s", "gap_longest_s"])


def freshness(
    feeds: DataFrame, df: DataFrame, feed: str, ts: str, now: Column, max_age_s: int = DEFAULTS.gap_after_s
) -> DataFrame:
    """Every feed of the spine with its newest snapshot. A feed without one is stale."""
    newest = df.groupBy(feed).agg(F.max(ts).alias("newest_ts"))
    age = epoch(now) - epoch("newest_ts")
    return feeds.join(newest, feed, "left").select(
        feed,
        "newest_ts",
        age.alias("age_s"),
        F.coalesce(age <= max_age_s, F.lit(False)).alias("is_fresh"),
    )


def changed_only(
    df: DataFrame, feed: str, arrival: Sequence[Column], slice_of: Column, header: str
) -> DataFrame:
    """Drop a snapshot whose header equals that of the snapshot that arrived just before it."""
    paired = earlier_row(df, [feed], arrival, slice_of, F.struct(header), "__before")
    first = F.isnull("__before")
    return paired.where(first | ~F.col(header).eqNullSafe(F.col(f"__before.{header}"))).drop(
        "__before"
    )
