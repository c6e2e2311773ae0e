"""Event-time arithmetic on epoch numbers and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND_MS = 1_000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def bucket_floor(value: Column, size: int) -> Column:
    """Start of the fixed-size bucket holding ``value`` (a long in the same unit as ``size``)."""
    return bucket_number(value, size) * F.lit(size)


def bucket_number(value: Column, size: int) -> Column:
    return F.floor(value / F.lit(size)).cast("long") if size > 1 else value.cast("long")


def window_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling window ``[start, start + seconds)`` holding ``ts``."""
    return F.timestamp_seconds(bucket_floor(F.unix_seconds(ts), seconds))


def window_end(start: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.unix_seconds(start) + F.lit(seconds))


def zoneless(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and an explicit UTC offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def next_boundary(ts_ms: Column, every_ms: int) -> Column:
    """First multiple of ``every_ms`` strictly after ``ts_ms``."""
    return bucket_floor(ts_ms, every_ms) + F.lit(every_ms)
