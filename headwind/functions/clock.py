"""Time arithmetic on epoch seconds.

Nothing here parses or renders through the session time zone, so every result is the same
whatever `spark.sql.session.timeZone` is, and all of it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_DAY_S = 43_200
DAY_S = 86_400


def epoch(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts))


def clock_to_seconds(text: Column | str) -> Column:
    """`HH:MM:SS` as seconds. Hours may pass 24; malformed text gives null, not an error."""
    part = F.split(_col(text), ":")
    hours, minutes, seconds = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def service_day_start(day: Column | str, zone: str) -> Column:
    """Epoch second of local noon minus twelve hours, which is not midnight on clock-change days."""
    wall_noon = F.timestamp_seconds(F.unix_date(_col(day)) * DAY_S + HALF_DAY_S)
    return F.unix_seconds(F.to_utc_timestamp(wall_noon, zone)) - HALF_DAY_S


def local_seconds(ts: Column | str, zone: str) -> Column:
    """Seconds of the local wall clock since 1970-01-01 00:00 local."""
    return F.unix_seconds(F.from_utc_timestamp(_col(ts), zone))


def local_day(ts: Column | str, zone: str) -> Column:
    return F.date_from_unix_date(F.floor(local_seconds(ts, zone) / DAY_S).cast("int"))


def local_hour(ts: Column | str, zone: str) -> Column:
    return F.floor(F.pmod(local_seconds(ts, zone), F.lit(DAY_S)) / 3600).cast("int")


def local_minute_text(ts: Column | str, zone: str) -> Column:
    """Local `yyyy-MM-dd HH:mm`."""
    minute = F.floor(F.pmod(local_seconds(ts, zone), F.lit(3600)) / 60).cast("string")
    return F.concat(
        local_day(ts, zone).cast("string"),
        F.lit(" "),
        F.lpad(local_hour(ts, zone).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(minute, 2, "0"),
    )


def weekday(day: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(day)


def utc_day(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / DAY_S).cast("int"))


def utc_hour_text(seconds: Column) -> Column:
    hour = F.floor(F.pmod(seconds, F.lit(DAY_S)) / 3600).cast("string")
    return F.lpad(hour, 2, "0")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
