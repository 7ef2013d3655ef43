"""Decoding GTFS-Realtime payloads as a Spark job.

The only Python that runs per payload: bytes in, one nested row out, batch by
batch over Arrow. Flattening, labels and keys are column expressions over the
nested row (``headway.operators.demux``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from headway.schemas import DECODED_FIELDS, PAYLOADS

# Message fields of the public GTFS-Realtime specification that
# are read here, as name: (number, type). A star marks a repeated field. Enums
# are read as numbers so that one without a label is kept; the vehicle status
# that is not on the wire means 2, in transit.
MESSAGES = {
    "FeedMessage": {"header": (1, "FeedHeader"), "entity": (2, "FeedEntity*")},
    "FeedHeader": {"gtfs_realtime_version": (1, "string"), "timestamp": (3, "uint64")},
    "FeedEntity": {
        "id": (1, "string"),
        "trip_update": (3, "TripUpdate"),
        "vehicle": (4, "VehiclePosition"),
        "alert": (5, "Alert"),
    },
    "TripUpdate": {"trip": (1, "TripDescriptor"), "stop_time_update": (2, "StopTimeUpdate*")},
    "StopTimeUpdate": {
        "arrival": (2, "StopTimeEvent"),
        "departure": (3, "StopTimeEvent"),
        "stop_id": (4, "string"),
        "schedule_relationship": (5, "int32"),
    },
    "StopTimeEvent": {"time": (2, "int64")},
    "VehiclePosition": {
        "trip": (1, "TripDescriptor"),
        "current_stop_sequence": (3, "uint32"),
        "current_status": (4, "int32"),
        "timestamp": (5, "uint64"),
        "stop_id": (7, "string"),
    },
    "Alert": {"informed_entity": (5, "EntitySelector*"), "header_text": (10, "TranslatedString")},
    "EntitySelector": {"route_id": (2, "string"), "trip": (4, "TripDescriptor")},
    "TripDescriptor": {
        "trip_id": (1, "string"),
        "start_date": (3, "string"),
        "route_id": (5, "string"),
    },
    "TranslatedString": {"translation": (1, "Translation*")},
    "Translation": {"text": (1, "string"), "language": (2, "string")},
}
DEFAULTS = {("VehiclePosition", "current_status"): "2"}

PARSE_ERROR = "FeedParseError"
PAYLOAD_HASH = "payload_sha256"
_EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)  # years 1 to 9999
_INT_MAX = 2**31 - 1
_PAYLOADS_PER_BATCH = 64
# As Python objects a message takes some thirty times its bytes.
_BYTES_PER_BATCH = 1 << 20


class BadPayload(ValueError):
    """A payload that is not a usable feed message."""


@cache
def feed_message():
    """The FeedMessage class, built once per Python worker."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as missing:  # pragma: no cover
        raise RuntimeError("decoding payloads needs the protobuf package") from missing

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="headway/feed.proto", package="headway.feed", syntax="proto2"
    )
    for message_name, fields in MESSAGES.items():
        message = file.message_type.add(name=message_name)
        for field_name, (number, kind) in fields.items():
            element = kind.rstrip("*")
            field = message.field.add(
                name=field_name,
                number=number,
                label=kinds.LABEL_REPEATED if kind.endswith("*") else kinds.LABEL_OPTIONAL,
            )
            if element in MESSAGES:
                field.type = kinds.TYPE_MESSAGE
                field.type_name = f".headway.feed.{element}"
            else:
                field.type = getattr(kinds, f"TYPE_{element.upper()}")
            if (message_name, field_name) in DEFAULTS:
                field.default_value = DEFAULTS[message_name, field_name]
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(
        pool.FindMessageTypeByName("headway.feed.FeedMessage")
    )


def _epoch(value: int) -> int:
    if not _EPOCH_RANGE[0] <= value <= _EPOCH_RANGE[1]:
        raise BadPayload(f"time {value} is out of range")
    return value


def _trip(trip) -> dict:
    return {"trip_id": trip.trip_id, "route_id": trip.route_id, "start_date": trip.start_date}


def _vehicle(vehicle) -> dict:
    if vehicle.current_stop_sequence > _INT_MAX:
        raise BadPayload(f"stop sequence {vehicle.current_stop_sequence} is out of range")
    return {
        "trip": _trip(vehicle.trip),
        "current_stop_sequence": vehicle.current_stop_sequence,
        "current_status": vehicle.current_status,
        "timestamp": _epoch(vehicle.timestamp),
        "stop_id": vehicle.stop_id,
    }


def _stop(stop) -> dict:
    return {
        "stop_id": stop.stop_id,
        "arrival": _epoch(stop.arrival.time) if stop.HasField("arrival") else None,
        "departure": _epoch(stop.departure.time) if stop.HasField("departure") else None,
        "schedule_relationship": stop.schedule_relationship,
    }


def _entity(entity) -> dict:
    row = {"id": entity.id, "vehicle": None, "trip_update": None, "alert": None}
    if entity.HasField("vehicle"):
        row["vehicle"] = _vehicle(entity.vehicle)
    if entity.HasField("trip_update"):
        update = entity.trip_update
        row["trip_update"] = {
            "trip": _trip(update.trip),
            "stop_time_update": [_stop(stop) for stop in update.stop_time_update],
        }
    if entity.HasField("alert"):
        row["alert"] = {
            "header_text": [text.text for text in entity.alert.header_text.translation],
            "informed": [
                {"route_id": informed.route_id, "trip": _trip(informed.trip)}
                for informed in entity.alert.informed_entity
            ],
        }
    return row


def decode_payload(payload: bytes | None, feed_key: str) -> dict:
    """One payload as a ``DECODED_FIELDS`` row: content, or the reason there is none."""
    from google.protobuf.message import DecodeError

    row = dict.fromkeys(DECODED_FIELDS.names) | {"payload_bytes": len(payload or b"")}
    try:
        if not payload:
            raise BadPayload(f"empty payload from feed '{feed_key}'")
        message = feed_message()()
        try:
            message.ParseFromString(payload)
            version = message.header.gtfs_realtime_version
        except (DecodeError, UnicodeDecodeError) as error:
            raise BadPayload(
                f"payload from feed '{feed_key}' is not a feed message,"
                f" it starts {payload[:80]!r}"
            ) from error
        if not version:
            raise BadPayload(f"payload from feed '{feed_key}' has no version header")
        header = {"version": version, "timestamp": _epoch(message.header.timestamp)}
        entities = [_entity(entity) for entity in message.entity]
        return row | {"header": header, "entity": entities}
    except (BadPayload, UnicodeDecodeError) as error:
        return row | {"error_type": PARSE_ERROR, "error_message": str(error)}


def payload_hash() -> Column:
    """A hash of the bytes of a payload, by which a replay tells whether it has the same ones."""
    return F.sha2(F.coalesce("payload", F.lit(b"")), 256)


def parts_of(batch: pa.RecordBatch, sizes: pa.Array, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``rows`` rows that add up to ``size``; a larger row is one alone."""
    start = held = 0
    for at, one in enumerate(pc.fill_null(sizes, 0).to_pylist()):
        if at > start and (at - start == rows or held + one > size):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += one
    if start < batch.num_rows:
        yield batch.slice(start)


def decode_payloads(payloads: DataFrame) -> DataFrame:
    """Payload rows with their bytes replaced by the decoded message.

    No shuffle: each payload is decoded where it was read. Arrow hands over
    bounded batches and every few payloads are handed back at once, so a task
    never holds a whole partition of decoded messages, nor a whole batch of them.
    """
    carried = [name for name in PAYLOADS.names if name != "payload"] + [PAYLOAD_HASH]
    given = payloads.select(*PAYLOADS.names, payload_hash().alias(PAYLOAD_HASH))
    schema = StructType([given.schema[name] for name in carried] + DECODED_FIELDS.fields)
    arrow_schema = to_arrow_schema(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("payload"))
            for part in parts_of(batch, sizes, _PAYLOADS_PER_BATCH, _BYTES_PER_BATCH):
                rows = [
                    decode_payload(payload, feed_key)
                    for payload, feed_key in zip(
                        part.column("payload").to_pylist(), part.column("feed_key").to_pylist()
                    )
                ]
                columns = [part.column(name) for name in carried]
                columns += [
                    pa.array([row[name] for row in rows], arrow_schema.field(name).type)
                    for name in DECODED_FIELDS.names
                ]
                yield pa.RecordBatch.from_arrays(columns, names=arrow_schema.names)

    return given.mapInArrow(decode, schema)


def encode_payload(version: str, timestamp: int, entities: list[dict]) -> bytes:
    """Bytes of a feed message given as nested dicts, for tests and the test feed.

    ``entities`` are shaped like ``FEED_ENTITY``; what is None is left off the wire.
    """
    message = feed_message()()
    if version:
        message.header.gtfs_realtime_version = version
    if timestamp:
        message.header.timestamp = timestamp
    for spec in entities:
        entity = message.entity.add()
        _fill(entity, {"id": spec["id"]})
        if spec.get("vehicle"):
            entity.vehicle.SetInParent()
            _fill(entity.vehicle, spec["vehicle"])
        if spec.get("trip_update"):
            update = spec["trip_update"]
            entity.trip_update.SetInParent()
            _fill(entity.trip_update.trip, update.get("trip") or {})
            for stop in update.get("stop_time_update") or []:
                target = entity.trip_update.stop_time_update.add()
                for moment in ("arrival", "departure"):
                    if stop.get(moment) is not None:
                        getattr(target, moment).time = stop[moment]
                _fill(target, {k: v for k, v in stop.items() if k not in ("arrival", "departure")})
        if spec.get("alert"):
            alert = spec["alert"]
            entity.alert.SetInParent()
            for text in alert.get("header_text") or []:
                entity.alert.header_text.translation.add(text=text, language="en")
            for informed in alert.get("informed") or []:
                _fill(entity.alert.informed_entity.add(), informed)
    return message.SerializeToString()


def _fill(message, values: dict) -> None:
    for name, value in values.items():
        if isinstance(value, dict):
            _fill(getattr(message, name), value)
        elif value is not None:
            setattr(message, name, value)
