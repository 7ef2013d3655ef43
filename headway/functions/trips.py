"""Keys of snapshots and trips, and what a trip id says about its trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.times import iso_utc

# The trip-id format. Six digits of scheduled departure in
# hundredths of a minute, the route, one or two dots, then the path, whose
# first letter is the direction unless it starts a word.
TRIP_ID = r"(?d)^(\d{6})_([^.]+)\.{1,2}(.*)$"
LEADING_DIRECTION = r"^([NS])(?!\p{L})"


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trip_origin_seconds(trip_id: Column) -> Column:
    """Scheduled departure from the first stop, in seconds after midnight."""
    digits = _blank_to_null(F.regexp_extract(trip_id, TRIP_ID, 1))
    return F.round(digits.cast("int") * 3 / 5).cast("int")


def trip_path(trip_id: Column) -> Column:
    return _blank_to_null(F.regexp_extract(trip_id, TRIP_ID, 3))


def trip_direction(trip_id: Column) -> Column:
    path = F.regexp_extract(trip_id, TRIP_ID, 3)
    return _blank_to_null(F.regexp_extract(path, LEADING_DIRECTION, 1))


def parse_trip_id(trip_id: Column) -> list[Column]:
    """The three columns a trip id carries; all NULL where it does not match."""
    return [
        trip_direction(trip_id).alias("direction"),
        trip_origin_seconds(trip_id).alias("origin_departure_seconds"),
        trip_path(trip_id).alias("trip_path"),
    ]


def snapshot_id(feed_key: Column, header_timestamp: Column, fetched_at: Column) -> Column:
    """The same id for every poll of one published snapshot.

    A snapshot without a header time takes its fetch time, so two of them
    never collapse into one id.
    """
    anchor = F.coalesce(
        iso_utc(header_timestamp), F.concat(F.lit("nohdr:"), iso_utc(fetched_at))
    )
    return F.substring(F.sha1(F.concat(feed_key, F.lit("|"), anchor)), 1, 16)


def joined_key(*parts: Column) -> Column:
    """Parts joined by a bar; NULL if any part is NULL."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("|"), part.cast("string")]
    return F.concat(*pieces)


def trip_key(trip_id: Column, start_date: Column) -> Column:
    """Follows one train across snapshots; never NULL."""
    unknown = F.lit("unknown")
    return joined_key(F.coalesce(trip_id, unknown), F.coalesce(start_date, unknown))
