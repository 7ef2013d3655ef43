"""Time columns. All instants are UTC; the session time zone is pinned to it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: datetime | str | Column) -> Column:
    """A point in time given by the caller, e.g. the ``as_of`` of a report."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def epoch_to_ts(epoch: Column) -> Column:
    """Epoch seconds to a timestamp. Zero is how the wire says "not given"."""
    return F.timestamp_seconds(F.nullif(epoch.cast("long"), F.lit(0).cast("long")))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end``."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with their fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def minutes(seconds: Column) -> Column:
    """Seconds as minutes to one decimal."""
    return F.round(seconds / F.lit(60.0).cast("double"), 1)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with an offset; the fraction is printed only when there is one."""
    fraction = F.when(
        F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")
    ).otherwise("")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def clock(ts: Column) -> Column:
    """Time of day, or ``none`` where there is no time."""
    return F.coalesce(F.date_format(ts, "HH:mm:ss"), F.lit("none"))


def humanize_seconds(seconds: Column) -> Column:
    """A short age: ``45s``, ``12m`` or ``2h 5m``; NULL reads ``unknown``."""
    whole = seconds.cast("long")
    whole_minutes = F.floor(whole / 60).cast("long")
    hours = F.floor(whole / 3600).cast("long")
    return (
        F.when(whole.isNull(), "unknown")
        .when(whole < 90, F.format_string("%ds", whole))
        .when(whole_minutes < 90, F.format_string("%dm", whole_minutes))
        .otherwise(F.format_string("%dh %dm", hours, whole_minutes - hours * 60))
    )
