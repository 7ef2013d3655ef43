"""The generic ``events`` table read as a transit feed, for tests and benchmarks.

Two readings, both pure projections of whole tables: the five raw tables
directly (a feed and day is a snapshot), and raw payload bytes (a block of
consecutive events is a snapshot) to put through the decode and landing jobs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from headway.functions.trips import parse_trip_id
from headway.operators.landing import quarantine
from headway.schemas import (
    PAYLOADS,
    RAW_ALERTS,
    RAW_FEED_FETCHES,
    RAW_TRIP_STOP_UPDATES,
    RAW_VEHICLE_POSITIONS,
    project,
)
from headway.sources.gtfs_rt import encode_payload, parts_of
from headway.sources.tables import RawTables

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
FEED_URL = "events"
CATALOGUE = {"F0": FEED_URL, "F1": FEED_URL, "F2": FEED_URL}
# Snapshots are a day apart here, so only more than a day is a gap.
GAP_SECONDS = 86_400
# Blocks of a feed are 90 seconds apart, bad ones leave holes.
LANDED_GAP_SECONDS = 100
# More than most lines of this feed have.
MANY_TRAINS = 12
FIRST_EVENT = 1_704_067_200  # 2024-01-01 00:00:00 UTC
# A little after the last event.
AS_OF = "2024-01-31 00:00:00"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _trip_id() -> Column:
    user = F.col("user_id")
    dots = F.when(user % 13 == 0, ".").otherwise("..")
    path = F.when(user % 17 == 0, "MAIN ST34").when(user % 2 == 0, "N15R").otherwise("S15R")
    origin = F.lpad(((user * 150) % 144000).cast("string"), 6, "0")
    return F.concat(origin, F.lit("_"), (user % 7 + 1).cast("string"), dots, path)


def _route() -> Column:
    return (F.col("user_id") % 7 + 1).cast("string")


def _start_date() -> Column:
    return F.when(F.col("user_id") % 29 != 0, "202401")


def _stop(offset: Column) -> Column:
    return (F.col("user_id") % 20 + offset).cast("string")


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(ts) + seconds)


def observations(events: DataFrame) -> DataFrame:
    """Events with the snapshot they belong to and the trip they are about.

    Feed F1 publishes its first nine days a day early, which leaves a hole in
    it without leaving out any row.
    """
    ts = F.col("ts").cast("timestamp")
    feed = F.concat(F.lit("F"), (F.col("user_id") % 3).cast("string"))
    day = F.date_trunc("day", ts)
    early = (feed == "F1") & (day < F.lit("2024-01-10").cast("timestamp"))
    header = F.when(early, _later(day, F.lit(-86_400))).otherwise(day)
    return events.select(
        "*",
        feed.alias("feed_key"),
        header.alias("header_timestamp"),
        F.concat(feed, F.lit("|"), F.date_format(header, "yyyy-MM-dd")).alias("fetch_id"),
        ts.alias("fetched_at"),
        _trip_id().alias("trip_id"),
        _route().alias("route_id"),
        _start_date().alias("start_date"),
        F.floor("value").alias("whole"),
    )


def vehicles(events: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("event_type").isin("view", "signup"), "STOPPED_AT")
        .when(F.col("event_type") == "click", "IN_TRANSIT_TO")
        .when(F.col("event_type") == "purchase", "INCOMING_AT")
        .otherwise("7")
    )
    rows = observations(events).select(
        "*",
        *parse_trip_id(F.col("trip_id")),
        F.col("event_id").alias("entity_id"),
        F.nullif(F.col("event_id") % 40, F.lit(0).cast("long")).alias("current_stop_sequence"),
        status.alias("current_status"),
        _stop((F.col("event_id") % 10 == 9).cast("int")).alias("stop_id"),
        _later(F.col("header_timestamp"), -F.col("whole")).alias("vehicle_timestamp"),
    )
    return project(rows, RAW_VEHICLE_POSITIONS)


def stops(events: DataFrame) -> DataFrame:
    index = F.col("stop_index")
    base = F.unix_seconds(F.lit("2024-02-01").cast("timestamp"))
    ahead = base + F.floor(F.col("value") * 10) + (index + 1) * 120
    past = F.unix_seconds("header_timestamp") + F.col("whole") - 400
    arrival = F.when(
        (index != 3) | (F.col("event_id") % 11 != 0),
        F.timestamp_seconds(F.when(F.col("user_id") % 23 == 0, past).otherwise(ahead)),
    )
    relationship = F.when(F.col("event_id") % 50 == 0, "SKIPPED").otherwise("SCHEDULED")
    trips = observations(events).select(
        "*",
        *parse_trip_id(F.col("trip_id")),
        (F.col("event_id") + 1_000_000).alias("entity_id"),
        relationship.alias("schedule_relationship"),
    )
    rows = trips.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("stop_index"))
    rows = rows.withColumn("arrival_time", arrival).withColumns(
        {"stop_id": _stop(index), "departure_time": _later(F.col("arrival_time"), F.lit(30))}
    )
    return project(rows, RAW_TRIP_STOP_UPDATES)


def alerts(events: DataFrame) -> DataFrame:
    header = F.when(F.col("value") > 20, "Train delayed").otherwise("Service change")
    named = F.when(F.col("event_id") % 10 != 0, F.col("trip_id"))
    rows = observations(events.filter("event_type = 'error'")).withColumns(
        {
            "entity_id": F.concat(F.lit("A"), F.col("event_id").cast("string")),
            "alert_header": header,
            "trip_id": named,
        }
    )
    return project(rows.select("*", *parse_trip_id(F.col("trip_id"))), RAW_ALERTS)


def fetches(events: DataFrame) -> DataFrame:
    count = F.count(F.lit(1))
    alert_count = F.count_if(F.col("event_type") == "error")
    rows = (
        observations(events)
        .groupBy("fetch_id", "feed_key", "header_timestamp")
        .agg(
            F.min("fetched_at").alias("fetched_at"),
            F.sum(F.length("props")).alias("payload_bytes"),
            (count * 2 + alert_count).alias("entity_count"),
            count.alias("vehicle_rows"),
            (count * 4).alias("trip_stop_rows"),
            alert_count.alias("alert_rows"),
            (count % 4 + 1).alias("poll_count"),
            F.max("fetched_at").alias("last_polled_at"),
        )
        .withColumn("feed_url", F.lit(FEED_URL))
    )
    return project(rows, RAW_FEED_FETCHES)


def errors(events: DataFrame) -> DataFrame:
    """Failed polls with a long message, before it is cut."""
    return observations(events.filter("event_type = 'error'")).select(
        F.col("fetched_at").alias("occurred_at"),
        "feed_key",
        F.lit(FEED_URL).alias("feed_url"),
        F.lit("FeedFetchError").alias("error_type"),
        F.repeat("props", F.lit(150)).alias("error_message"),
    )


class EventTables:
    """The raw tables of the test feed, each planned when it is first asked for."""

    def __init__(self, events: DataFrame) -> None:
        self._events = events

    @property
    def audit(self) -> DataFrame:
        return self.fetches

    @cached_property
    def fetches(self) -> DataFrame:
        return fetches(self._events)

    @cached_property
    def vehicles(self) -> DataFrame:
        return vehicles(self._events)

    @cached_property
    def stops(self) -> DataFrame:
        return stops(self._events)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerts(self._events)

    @cached_property
    def errors(self) -> DataFrame:
        return quarantine(errors(self._events))


def raw_tables(events: DataFrame) -> RawTables:
    return EventTables(events)


def poll_log(events: DataFrame) -> DataFrame:
    """Every event as one poll of its snapshot."""
    return observations(events).select(
        "fetch_id",
        "feed_key",
        "header_timestamp",
        "fetched_at",
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("path"),
    )


# Payloads. A block of events is one snapshot, so a payload has a fixed size
# however many events there are.
EVENTS_PER_PAYLOAD = 40
# As many payloads, or events of them, a task has as Python objects at once.
_PAYLOADS_AT_ONCE = 64
_EVENTS_AT_ONCE = 4000
_FIRST_BLOCK = 1_704_067_200  # 2024-01-01 00:00:00 UTC
_SECONDS_PER_BLOCK = 30



def _event_entities(event: dict, header: int) -> list[dict]:
    """The entities of one event: a train, its predictions and perhaps an alert."""
    number, user, value = event["event_id"], event["user_id"], event["value"]
    trip = {
        "trip_id": event["trip_id"],
        "route_id": None if user % 19 == 0 else event["route_id"],
        "start_date": event["start_date"],
    }
    status = {"view": 1, "signup": 1, "click": None, "purchase": 0}.get(event["event_type"], 9)
    predictions = []
    for index in range(4):
        arrival = header + int(value * 10) + (index + 1) * 120
        if index == 3 and number % 11 == 0:
            arrival = None
        elif index == 2 and number % 13 == 0:
            arrival = 0
        predictions.append(
            {
                "stop_id": f"S{user % 20 + index}",
                "arrival": arrival,
                "departure": arrival + 30 if arrival else None,
                "schedule_relationship": {0: 1, 1: 7}.get(number % 50),
            }
        )
    entities = [
        {
            "id": f"V{number}",
            "vehicle": {
                "trip": trip,
                "stop_id": f"S{user % 20}",
                "current_status": status,
                "current_stop_sequence": number % 40,
                "timestamp": header - int(value),
            },
        },
        {"id": f"U{number}", "trip_update": {"trip": trip, "stop_time_update": predictions}},
    ]
    if event["event_type"] == "error":
        text = "Train delayed" if value > 20 else "Service change"
        by_route = {"route_id": event["route_id"]}
        unrouted = {"trip_id": trip["trip_id"], "start_date": trip["start_date"]}
        informed = {
            0: [],
            1: [{"trip": trip}],
            2: [by_route | {"trip": unrouted}, by_route],
            3: [by_route],
        }[number % 4]
        alert = {"header_text": [] if number % 7 == 0 else [text], "informed": informed}
        entities.append({"id": f"A{number}", "alert": alert})
    return entities


def _block_payload(block: int, events: list[dict]) -> bytes:
    kind = block % 23
    if kind == 5:
        return b""
    if kind == 11:
        return b"<!DOCTYPE html><html><body>Service unavailable</body></html>"
    header = _FIRST_BLOCK + block * _SECONDS_PER_BLOCK
    entities = [entity for event in events for entity in _event_entities(event, header)]
    return encode_payload(
        version="" if kind == 17 else "1.0",
        timestamp=0 if block % 29 == 4 else header,
        entities=entities,
    )


def payloads(events: DataFrame) -> DataFrame:
    """Payload rows: mostly good, some empty, broken or without version, some polled twice."""
    block = F.expr(f"event_id div {EVENTS_PER_PAYLOAD}")
    event = F.struct(
        *[F.col(name) for name in ("event_id", "event_type", "value", "user_id")],
        _trip_id().alias("trip_id"),
        _route().alias("route_id"),
        _start_date().alias("start_date"),
    )
    # Encoding is Python work on little data; a given number of partitions keeps
    # the adaptive planner from packing it all into one task.
    cores = events.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, events.rdd.getNumPartitions())
    blocks = (
        events.withColumn("block", block)
        .repartition(tasks, "block")
        .groupBy("block")
        .agg(F.collect_list(event).alias("events"))
        .withColumn("events", F.array_sort("events"))
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("events"))
            for part in parts_of(batch, sizes, _PAYLOADS_AT_ONCE, _EVENTS_AT_ONCE):
                rows = zip(part.column("block").to_pylist(), part.column("events").to_pylist())
                payloads = pa.array([_block_payload(*row) for row in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("block"), payloads], ["block", "payload"])

    header = F.lit(_FIRST_BLOCK) + F.col("block") * _SECONDS_PER_BLOCK
    polls = F.when(F.col("block") % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    rows = (
        blocks.mapInArrow(encode, "block long, payload binary")
        .select("*", F.explode(polls).alias("poll"))
        .select(
            F.format_string("block-%d-%d.pb", "block", "poll").alias("path"),
            F.concat(F.lit("F"), (F.col("block") % 3).cast("string")).alias("feed_key"),
            F.lit(FEED_URL).alias("feed_url"),
            F.timestamp_seconds(header + 5 + F.col("block") % 20 + F.col("poll") * 30).alias(
                "fetched_at"
            ),
            "payload",
        )
    )
    return project(rows, PAYLOADS)
