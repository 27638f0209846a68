"""Hours, service days and schedules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL = "America/New_York"
HOUR = 3600


def ceil_hour_s(ts: Column) -> Column:
    """Hour-ending stamp in epoch seconds: a full hour stays, anything else goes up to the next."""
    return (F.ceil(ts / HOUR) * HOUR).cast("long")


def ceil_hour(ts: Column) -> Column:
    """The same for timestamps, which count microseconds."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL 3599999999 MICROSECONDS"))


def sched_ts(start_date: Column, seconds: Column, zone: str = LOCAL) -> Column:
    """Absolute time of `seconds` on the service day yyyyMMdd.

    Seconds count from local noon less twelve hours, so that they may pass 24 hours and the
    two days a year with a clock change come out right.
    """
    noon = F.to_utc_timestamp(F.to_timestamp(F.concat(start_date, F.lit("12")), "yyyyMMddHH"), zone)
    return noon + F.make_dt_interval(F.lit(0), F.lit(-12), F.lit(0), seconds.cast("decimal(18,6)"))


def hour_of_week(ts: Column, zone: str = LOCAL) -> Column:
    """0 for Monday's first local hour to 167, of an hour-ENDING stamp's hour."""
    local = F.from_utc_timestamp(ts - F.expr("INTERVAL 1 HOUR"), zone)
    return ((F.dayofweek(local) + 5) % 7 * 24 + F.hour(local)).cast("int")


def hms_seconds(hms: Column) -> Column:
    """H:MM:SS, hours beyond 24 allowed, in seconds; null for any other text."""
    part = lambda i: F.regexp_extract(hms, r"^\s*(\d+):(\d\d):(\d\d)\s*$", i)
    return F.when(part(1) != "", part(1).cast("int") * 3600 + part(2).cast("int") * 60 + part(3).cast("int"))


def crosses_clock_change(ts: Column, zone: str = LOCAL) -> Column:
    """Whether the local offset differs at the two ends of an hour-ending stamp's hour."""
    offset = lambda t: F.unix_timestamp(F.from_utc_timestamp(t, zone)) - F.unix_timestamp(t)
    return offset(ts) != offset(ts - F.expr("INTERVAL 1 HOUR"))


def local_day(ts: Column, zone: str = LOCAL) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def from_local(text: Column, fmt: str, zone: str = LOCAL) -> Column:
    """A local stamp as UTC; null where the text has another form."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(fmt)), zone)
