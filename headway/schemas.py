"""Declared schemas: raw tables, decoded payloads and their column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType(
        [StructField(name, kind, "required" not in rest) for name, kind, *rest in fields]
    )


_S, _I, _L, _T = StringType(), IntegerType(), LongType(), TimestampType()

_SNAPSHOT = (
    ("fetch_id", _S, "required"),
    ("feed_key", _S, "required"),
    ("fetched_at", _T, "required"),
    ("header_timestamp", _T),
    ("entity_id", _S),
)
_TRIP = (("trip_id", _S), ("route_id", _S), ("start_date", _S))
_TRIP_EXTRAS = (("direction", _S), ("origin_departure_seconds", _I), ("trip_path", _S))

RAW_VEHICLE_POSITIONS = _struct(
    *_SNAPSHOT,
    *_TRIP,
    *_TRIP_EXTRAS,
    ("current_stop_sequence", _I),
    ("current_status", _S),
    ("stop_id", _S),
    ("vehicle_timestamp", _T),
)

RAW_TRIP_STOP_UPDATES = _struct(
    *_SNAPSHOT,
    *_TRIP,
    *_TRIP_EXTRAS,
    ("stop_index", _I),
    ("stop_id", _S),
    ("arrival_time", _T),
    ("departure_time", _T),
    ("schedule_relationship", _S),
)

RAW_ALERTS = _struct(*_SNAPSHOT, ("alert_header", _S), *_TRIP, *_TRIP_EXTRAS)

RAW_FEED_FETCHES = _struct(
    ("fetch_id", _S, "required"),
    ("feed_key", _S, "required"),
    ("feed_url", _S, "required"),
    ("fetched_at", _T, "required"),
    ("header_timestamp", _T),
    ("payload_bytes", _L),
    ("entity_count", _I),
    ("vehicle_rows", _I),
    ("trip_stop_rows", _I),
    ("alert_rows", _I),
    ("poll_count", _I, "required"),
    ("last_polled_at", _T, "required"),
)

INGEST_ERRORS = _struct(
    ("occurred_at", _T, "required"),
    ("feed_key", _S, "required"),
    ("feed_url", _S),
    ("error_type", _S, "required"),
    ("error_message", _S),
)

# One row per poll of a landed snapshot; poll counts are an aggregate of it.
POLL_LOG = _struct(
    ("fetch_id", _S, "required"),
    ("feed_key", _S, "required"),
    ("polled_at", _T, "required"),
    ("path", _S),
)

# What the streams write beside the raw tables.
FIRST_POLLS = _struct(
    ("fetch_id", _S),
    ("fetched_at", _T),
    ("path", _S),
    ("header_timestamp", _T),
    ("feed_key", _S),
)

POLL_COUNTS = _struct(("fetch_id", _S), ("poll_count", _L), ("last_polled_at", _T))

DRIFT_OBSERVATIONS = _struct(
    ("trip_key", _S),
    ("trip_id", _S),
    ("route_id", _S),
    ("direction", _S),
    ("stop_id", _S),
    ("observation_count", _L),
    ("first_observed_at", _T),
    ("last_observed_at", _T),
    ("first_predicted_arrival", _T),
    ("last_predicted_arrival", _T),
    ("first_seconds_to_arrival", _L),
)

SNAPSHOT_WAITS = _struct(
    ("feed_key", _S),
    ("fetch_id", _S),
    ("header_timestamp", _T),
    ("waited", _L),
    ("opens_day", BooleanType()),
    ("is_late", BooleanType()),
)

RAW_TABLES = {
    "raw_feed_fetches": RAW_FEED_FETCHES,
    "raw_vehicle_positions": RAW_VEHICLE_POSITIONS,
    "raw_trip_stop_updates": RAW_TRIP_STOP_UPDATES,
    "raw_alerts": RAW_ALERTS,
    "ingest_errors": INGEST_ERRORS,
}

# What landing adds to the audit: trip ids that a snapshot has more than once.
REUSED_IDS = "reused_trip_ids"
LANDED_FETCHES = StructType([*RAW_FEED_FETCHES.fields, StructField(REUSED_IDS, ArrayType(_S))])

PAYLOADS = _struct(
    ("path", _S),
    ("feed_key", _S),
    ("feed_url", _S),
    ("fetched_at", _T),
    ("payload", BinaryType()),
)

_TRIP_MESSAGE = _struct(*_TRIP)

FEED_HEADER = _struct(("version", _S), ("timestamp", _L))

FEED_ENTITY = _struct(
    ("id", _S),
    (
        "vehicle",
        _struct(
            ("trip", _TRIP_MESSAGE),
            ("current_stop_sequence", _L),
            ("current_status", _I),
            ("timestamp", _L),
            ("stop_id", _S),
        ),
    ),
    (
        "trip_update",
        _struct(
            ("trip", _TRIP_MESSAGE),
            (
                "stop_time_update",
                ArrayType(
                    _struct(
                        ("stop_id", _S),
                        ("arrival", _L),
                        ("departure", _L),
                        ("schedule_relationship", _I),
                    )
                ),
            ),
        ),
    ),
    (
        "alert",
        _struct(
            ("header_text", ArrayType(_S)),
            ("informed", ArrayType(_struct(("route_id", _S), ("trip", _TRIP_MESSAGE)))),
        ),
    ),
)

# What the decode job adds to a payload row, in place of its bytes.
DECODED_FIELDS = _struct(
    ("payload_bytes", _L),
    ("header", FEED_HEADER),
    ("entity", ArrayType(FEED_ENTITY)),
    ("error_type", _S),
    ("error_message", _S),
)


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; a column ``df`` lacks is NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema.fields
        ]
    )
