from datetime import date

import pytest
from pyspark.sql import functions as F

from headwind.functions import clock, columns

DENVER = "America/Denver"


@pytest.fixture(params=["UTC", "America/Denver", "Asia/Kolkata"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def one(spark, *exprs):
    return tuple(spark.range(1).select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first())


def test_clock_text_may_pass_midnight_and_may_be_bad(spark):
    texts = ["08:01:02", "25:30:00", "", "8:x:1", "07:10", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clock.clock_to_seconds("t")).collect()]
    assert got == [28862, 91800, None, None, None, None]


@pytest.mark.parametrize(
    ("day", "start"),
    [
        (date(2026, 10, 5), 1791180000),  # 06:00 UTC
        (date(2026, 11, 1), 1793516400),  # clocks go back: 07:00 UTC
        (date(2026, 3, 8), 1772949600),  # clocks go forward: 06:00 UTC
    ],
)
def test_service_day_starts_at_noon_minus_twelve_hours(spark, zone, day, start):
    assert one(spark, clock.service_day_start(F.lit(day), DENVER)) == (start,)


def test_local_time_does_not_depend_on_the_session_zone(spark, zone):
    ts = F.timestamp_seconds(F.lit(1791302700))  # 2026-10-06 16:05 UTC, 10:05 in Denver
    assert one(
        spark,
        clock.local_hour(ts, DENVER),
        clock.local_day(ts, DENVER),
        clock.weekday(clock.local_day(ts, DENVER)),
        clock.local_minute_text(ts, DENVER),
    ) == (10, date(2026, 10, 6), 3, "2026-10-06 10:05")


def test_utc_partitions(spark, zone):
    s = F.lit(1791276877)
    assert one(spark, clock.utc_day(s), clock.utc_hour_text(s)) == (date(2026, 10, 6), "08")


def test_day_shift_rounds_to_whole_days_and_ignores_larger_or_missing(spark):
    values = [0, 43199, 43200, -43200, 86400, -90000, 200000, None]
    df = spark.createDataFrame([(v,) for v in values], "d long")
    got = [r[0] for r in df.select(columns.whole_day_shift(F.col("d"))).collect()]
    assert got == [0, 0, 1, -1, 1, -1, 0, 0]


def test_mode_folder_name_and_array_minimum(spark):
    modes = [columns.mode_of(F.lit(c).cast("int"), (0, 1, 2)) for c in (0, 2, 3, None)]
    assert one(spark, *modes) == ("rail", "rail", "bus", "bus")
    assert one(spark, columns.folder_name(F.lit("Sep26-37209 10/11é"))) == ("Sep26-37209_10_11é",)
    df = spark.sql(
        """SELECT array(named_struct('s', 5L), named_struct('s', CAST(NULL AS LONG)), named_struct('s', 3L)) a
        UNION ALL SELECT array() UNION ALL SELECT NULL"""
    )
    got = [r[0] for r in df.select(columns.array_field_min(F.col("a"), lambda x: x["s"])).collect()]
    assert got == [3, None, None]


def test_settings_are_immutable():
    from headwind.settings import DEFAULTS

    with pytest.raises(AttributeError):
        DEFAULTS.horizons = (1,)
