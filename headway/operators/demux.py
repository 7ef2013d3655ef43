"""From decoded messages to the rows of the raw tables. Narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions.labels import SCHEDULE_RELATIONSHIP, VEHICLE_STATUS, enum_label
from headway.functions.times import epoch_to_ts
from headway.functions.trips import parse_trip_id, snapshot_id
from headway.schemas import (
    RAW_ALERTS,
    RAW_FEED_FETCHES,
    RAW_TRIP_STOP_UPDATES,
    RAW_VEHICLE_POSITIONS,
    project,
)

SNAPSHOT = ("fetch_id", "feed_key", "fetched_at", "header_timestamp")
KINDS = {"vehicle": "vehicles", "trip_update": "trip_updates", "alert": "alerts"}


def split_entities(decoded: DataFrame) -> DataFrame:
    """Decoded messages with one array per kind of entity instead of a mixed one.

    Each kind is a column of its own, so a job that flattens one kind reads
    only that column of a stored message.
    """

    def only(kind: str) -> Column:
        present = F.filter("entity", lambda e: e[kind].isNotNull())
        return F.transform(present, lambda e: F.struct(e["id"].alias("id"), e[kind].alias(kind)))

    kept = [name for name in decoded.columns if name not in ("header", "entity")]
    return decoded.select(
        *kept,
        epoch_to_ts(F.col("header.timestamp")).alias("header_timestamp"),
        F.array_size("entity").alias("entity_count"),
        *[only(kind).alias(column) for kind, column in KINDS.items()],
    )


def good_payloads(split: DataFrame) -> DataFrame:
    """The snapshots: payloads that decoded, with the id their publish time gives them."""
    identity = snapshot_id(F.col("feed_key"), F.col("header_timestamp"), F.col("fetched_at"))
    return split.filter(F.col("error_type").isNull()).withColumn("fetch_id", identity)


def bad_payloads(decoded: DataFrame) -> DataFrame:
    """Rejected payloads as rows of the error table, message still whole."""
    return decoded.filter(F.col("error_type").isNotNull()).select(
        F.col("fetched_at").alias("occurred_at"),
        "feed_key",
        "feed_url",
        "error_type",
        "error_message",
    )


def _text(path: str) -> Column:
    """Wire strings have no NULL; an empty one means "not given"."""
    return F.nullif(F.col(path), F.lit(""))


def _number(path: str) -> Column:
    return F.nullif(F.col(path), F.lit(0).cast("long")).cast("int")


def _trip(path: str) -> list[Column]:
    return [
        _text(f"{path}.trip_id").alias("trip_id"),
        _text(f"{path}.route_id").alias("route_id"),
        _text(f"{path}.start_date").alias("start_date"),
    ]


def _entities(snapshots: DataFrame, kind: str) -> DataFrame:
    """One row per entity of a kind."""
    rows = snapshots.select(*SNAPSHOT, F.explode(KINDS[kind]).alias("e"))
    return rows.select(*SNAPSHOT, _text("e.id").alias("entity_id"), F.col(f"e.{kind}").alias(kind))


def vehicle_rows(snapshots: DataFrame) -> DataFrame:
    """Train positions, as ``raw_vehicle_positions``."""
    rows = _entities(snapshots, "vehicle").select(
        *SNAPSHOT,
        "entity_id",
        *_trip("vehicle.trip"),
        _number("vehicle.current_stop_sequence").alias("current_stop_sequence"),
        enum_label(F.col("vehicle.current_status"), VEHICLE_STATUS).alias("current_status"),
        _text("vehicle.stop_id").alias("stop_id"),
        epoch_to_ts(F.col("vehicle.timestamp")).alias("vehicle_timestamp"),
    )
    return project(rows.select("*", *parse_trip_id(F.col("trip_id"))), RAW_VEHICLE_POSITIONS)


def stop_rows(snapshots: DataFrame) -> DataFrame:
    """Stop updates, as ``raw_trip_stop_updates``; the list position is the order."""
    trips = _entities(snapshots, "trip_update").select(
        *SNAPSHOT,
        "entity_id",
        *_trip("trip_update.trip"),
        F.col("trip_update.stop_time_update").alias("stops"),
    )
    # The trip id is read once per trip, below the generator, not once per stop.
    parsed = trips.select("*", *parse_trip_id(F.col("trip_id")))
    rows = parsed.select("*", F.posexplode("stops").alias("stop_index", "stop")).select(
        *[name for name in RAW_TRIP_STOP_UPDATES.names[:11]],
        "stop_index",
        _text("stop.stop_id").alias("stop_id"),
        epoch_to_ts(F.col("stop.arrival")).alias("arrival_time"),
        epoch_to_ts(F.col("stop.departure")).alias("departure_time"),
        enum_label(F.col("stop.schedule_relationship"), SCHEDULE_RELATIONSHIP).alias(
            "schedule_relationship"
        ),
    )
    return project(rows, RAW_TRIP_STOP_UPDATES)


def alert_rows(snapshots: DataFrame) -> DataFrame:
    """Alerts, as ``raw_alerts``: a row per informed entity, one of NULLs if none.

    The first translation is the header. A route named beside the trip counts
    where the trip itself names none.
    """
    alerts = _entities(snapshots, "alert").select(
        *SNAPSHOT,
        "entity_id",
        F.nullif(F.try_element_at("alert.header_text", F.lit(1)), F.lit("")).alias("alert_header"),
        F.explode_outer("alert.informed").alias("informed"),
    )
    rows = alerts.select(
        *SNAPSHOT,
        "entity_id",
        "alert_header",
        _text("informed.trip.trip_id").alias("trip_id"),
        F.coalesce(_text("informed.trip.route_id"), _text("informed.route_id")).alias("route_id"),
        _text("informed.trip.start_date").alias("start_date"),
    )
    return project(rows.select("*", *parse_trip_id(F.col("trip_id"))), RAW_ALERTS)


def rows_by_entity(snapshots: DataFrame) -> DataFrame:
    """How many rows each entity gives: fetch_id, fetched_at, kind, entity_id, rows.

    All three kinds are taken from one pass over the snapshots.
    """

    def counted(kind: str, rows_of) -> Column:
        return F.transform(
            KINDS[kind],
            lambda e: F.struct(
                F.lit(kind).alias("kind"),
                F.nullif(e["id"], F.lit("")).alias("entity_id"),
                rows_of(e).cast("int").alias("rows"),
            ),
        )

    kinds = F.concat(
        counted("vehicle", lambda e: F.lit(1)),
        counted("trip_update", _stops_of),
        counted("alert", _named_by),
    )
    rows = snapshots.select("fetch_id", "fetched_at", F.inline(kinds))
    return rows.filter("rows > 0")


def _stops_of(update: Column) -> Column:
    return F.coalesce(F.array_size(update["trip_update"]["stop_time_update"]), F.lit(0))


def _named_by(alert: Column) -> Column:
    return F.greatest(F.array_size(alert["alert"]["informed"]), F.lit(1))


def detail_counts() -> list[Column]:
    """How many rows of each kind a snapshot holds, from its own arrays."""

    def total(column: str, rows_of) -> Column:
        return F.aggregate(column, F.lit(0), lambda so_far, e: so_far + rows_of(e))

    return [
        F.array_size("vehicles").alias("vehicle_rows"),
        total("trip_updates", _stops_of).alias("trip_stop_rows"),
        total("alerts", _named_by).alias("alert_rows"),
    ]


def reused_trip_ids() -> Column:
    """Trip ids that more than one train of a snapshot has, NULL among them."""
    ids = F.array_sort(F.transform("vehicles", lambda e: _trip_id(e["vehicle"]["trip"]["trip_id"])))
    again = F.transform(ids, lambda x, i: (i > 0) & x.eqNullSafe(F.get(ids, i - 1)))
    pairs = F.filter(F.arrays_zip(ids.alias("id"), again.alias("again")), lambda p: p["again"])
    return F.array_distinct(F.transform(pairs, lambda p: p["id"]))


def _trip_id(wire: Column) -> Column:
    return F.nullif(wire, F.lit(""))


def audit_rows(snapshots: DataFrame, *more: str) -> DataFrame:
    """One audit row per snapshot, as ``raw_feed_fetches``, with ``more`` columns of its own.

    A snapshot without entities has its row too, and nothing is shuffled.
    """
    rows = snapshots.select(
        "*",
        *detail_counts(),
        F.lit(1).alias("poll_count"),
        F.col("fetched_at").alias("last_polled_at"),
    )
    return project(rows, StructType([*RAW_FEED_FETCHES.fields, *[rows.schema[name] for name in more]]))
