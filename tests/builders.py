"""Literal rows for tests: give the columns that matter, the rest is NULL."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway import schemas
from headway.sources.gtfs_rt import encode_payload
from headway.sources.tables import RawTables

HEADER = 1_741_962_600  # 2025-03-14 14:30:00 UTC
FETCHED = datetime(2025, 3, 14, 14, 42, tzinfo=UTC)


def at(seconds: int) -> datetime:
    return datetime.fromtimestamp(HEADER + seconds, UTC)


def frame(spark: SparkSession, schema: StructType, rows: list[dict]) -> DataFrame:
    nullable = StructType([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], nullable)


def snapshot(fetch_id="f1", feed_key="A", published=0, **rest) -> dict:
    when = None if published is None else at(published)
    row = {"fetch_id": fetch_id, "feed_key": feed_key, "header_timestamp": when}
    return row | {"fetched_at": at((published or 0) + 5)} | rest


def train(entity_id, trip_id="041300_5..N07R", stop_id="101N", status="STOPPED_AT", **rest) -> dict:
    row = {"entity_id": entity_id, "trip_id": trip_id, "stop_id": stop_id, "route_id": "1"}
    return snapshot() | row | {"start_date": "20250314", "current_status": status} | rest


def stop(entity_id, index=0, stop_id="101N", arrival=120, trip_id="041300_5..N07R", **rest) -> dict:
    row = {"entity_id": entity_id, "stop_index": index, "stop_id": stop_id, "trip_id": trip_id}
    row |= {"route_id": "1", "start_date": "20250314", "schedule_relationship": "SCHEDULED"}
    return snapshot() | row | {"arrival_time": None if arrival is None else at(arrival)} | rest


def alert(entity_id, text="Train delayed", trip_id="041300_5..N07R", **rest) -> dict:
    row = {"entity_id": entity_id, "alert_header": text, "trip_id": trip_id}
    return snapshot() | row | {"start_date": "20250314", "route_id": "1"} | rest


def fetch(**rest) -> dict:
    row = {"feed_url": "u", "poll_count": 1, "payload_bytes": 10, "entity_count": 1}
    row = snapshot(**rest) | row | {k: v for k, v in rest.items() if k != "published"}
    return row | {"last_polled_at": row["fetched_at"]}


def raw(spark, trains=(), stops=(), alerts=(), fetches=(), errors=()) -> RawTables:
    return RawTables(
        fetches=frame(spark, schemas.RAW_FEED_FETCHES, list(fetches)),
        vehicles=frame(spark, schemas.RAW_VEHICLE_POSITIONS, list(trains)),
        stops=frame(spark, schemas.RAW_TRIP_STOP_UPDATES, list(stops)),
        alerts=frame(spark, schemas.RAW_ALERTS, list(alerts)),
        errors=frame(spark, schemas.INGEST_ERRORS, list(errors)),
    )


# Payloads


def vehicle_entity(entity_id, trip_id="041300_5..N07R", stop_id="101N", status=1, **rest) -> dict:
    trip = {"trip_id": trip_id, "route_id": "1", "start_date": "20250314"}
    vehicle = {"trip": trip, "stop_id": stop_id, "current_status": status}
    return {"id": entity_id, "vehicle": vehicle | rest}


def update_entity(entity_id, stops, trip_id="041300_5..N07R") -> dict:
    trip = {"trip_id": trip_id, "route_id": "1", "start_date": "20250314"}
    return {"id": entity_id, "trip_update": {"trip": trip, "stop_time_update": stops}}


def alert_entity(entity_id, texts, informed) -> dict:
    return {"id": entity_id, "alert": {"header_text": texts, "informed": informed}}


def default_entities() -> list[dict]:
    return [
        vehicle_entity("000001"),
        vehicle_entity("000002", "052210_5..S07R", "140S"),
        update_entity(
            "000003",
            [
                {"stop_id": "101N", "arrival": 1_741_962_690},
                {"stop_id": "103N", "arrival": 1_741_963_020},
            ],
        ),
        alert_entity("000004", ["Train delayed"], [{"trip": {"trip_id": "041300_5..N07R"}}]),
    ]


def default_payload(header=HEADER, entities=None, version="1.0") -> bytes:
    return encode_payload(version, header, default_entities() if entities is None else entities)


def payloads(spark, *polls) -> DataFrame:
    """Polls given as (payload, seconds after ``FETCHED``, feed key)."""
    rows = []
    for number, (payload, later, *feed) in enumerate(polls):
        fetched = FETCHED + timedelta(seconds=later)
        row = {"path": f"poll-{number}-{later}", "feed_key": feed[0] if feed else "1234567S"}
        rows.append(row | {"feed_url": "u", "fetched_at": fetched, "payload": payload})
    return frame(spark, schemas.PAYLOADS, rows)


