"""Time arithmetic on TIMESTAMP_NTZ columns, in exact elapsed microseconds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def ntz(value: datetime) -> Column:
    """A literal without time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as a double."""
    return micros_between(start, end) / F.lit(float(HOUR_US))


def plus_hours(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def floor_hour(ts: Column) -> Column:
    """The start of the hour, without passing through a zoned type."""
    part = lambda f: f(ts)
    return F.make_timestamp_ntz(part(F.year), part(F.month), part(F.day), part(F.hour), F.lit(0), F.lit(0))


def on_cadence(ts: Column, cadence_hours: int) -> Column:
    """Whole hours whose count since the epoch divides by the cadence; parts of a second are ignored."""
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return (F.minute(ts) == 0) & (F.floor(F.second(ts)) == 0) & (hours % cadence_hours == 0)


def day_key(ts: Column) -> Column:
    """The partition key YYYY-MM-DD."""
    return F.date_format(ts, "yyyy-MM-dd")
