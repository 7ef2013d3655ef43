from __future__ import annotations

from datetime import datetime

import pyarrow as pa
import pytest

from headway.operators.demux import (
    alert_rows,
    audit_rows,
    bad_payloads,
    good_payloads,
    split_entities,
    stop_rows,
    vehicle_rows,
)
from headway.schemas import PAYLOADS
from headway.sources import testfeed
from headway.sources.gtfs_rt import PAYLOAD_HASH, decode_payload, decode_payloads, parts_of
from headway.sources.payloads import read_payloads
from tests.builders import (
    HEADER,
    alert_entity,
    default_payload,
    payloads,
    update_entity,
    vehicle_entity,
)


def split(spark, *polls):
    return split_entities(decode_payloads(payloads(spark, *polls)))


def snapshots(spark, entities, header=HEADER):
    return good_payloads(split(spark, (default_payload(header, entities), 0)))


def rows(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def test_round_trip(spark):
    entities = [
        vehicle_entity("v", current_stop_sequence=4, timestamp=HEADER - 9),
        update_entity("u", [{"stop_id": "A", "arrival": HEADER + 60, "departure": HEADER + 90,
                             "schedule_relationship": 1}]),
        alert_entity("a", ["one", "two"], [{"route_id": "7", "trip": {"trip_id": "t"}}]),
    ]
    decoded = decode_payload(default_payload(entities=entities), "k")
    vehicle, update, alert = decoded["entity"]
    assert decoded["header"] == {"version": "1.0", "timestamp": HEADER}
    assert vehicle["id"] == "v" and vehicle["trip_update"] is None and vehicle["alert"] is None
    assert vehicle["vehicle"] == {
        "trip": {"trip_id": "041300_5..N07R", "route_id": "1", "start_date": "20250314"},
        "current_stop_sequence": 4,
        "current_status": 1,
        "timestamp": HEADER - 9,
        "stop_id": "101N",
    }
    assert update["trip_update"]["stop_time_update"] == [
        {"stop_id": "A", "arrival": HEADER + 60, "departure": HEADER + 90,
         "schedule_relationship": 1}
    ]
    assert alert["alert"]["header_text"] == ["one", "two"]
    assert alert["alert"]["informed"][0]["route_id"] == "7"


BAD = {
    "empty": (b"", "empty payload"),
    "missing": (None, "empty payload"),
    "html": (b"<!DOCTYPE html><html></html>", "not a feed message"),
    "truncated": (default_payload()[:-3], "not a feed message"),
    "no version": (default_payload(version=""), "no version header"),
    "far time": (default_payload(header=2**62), "out of range"),
}


@pytest.mark.parametrize("case", BAD)
def test_bad_payload_is_a_row_not_a_failure(spark, case):
    payload, reason = BAD[case]
    both = split(spark, (payload, 0), (default_payload(), 1))
    (error,) = bad_payloads(both).collect()
    assert error.error_type == "FeedParseError" and reason in error.error_message
    assert good_payloads(both).count() == 1


def test_vehicles(spark):
    entities = [
        vehicle_entity("1", status=0),
        vehicle_entity("2", status=1),
        vehicle_entity("3", status=2),
        vehicle_entity("4", status=None),
        vehicle_entity("5", status=8, timestamp=HEADER),
        vehicle_entity("6", trip_id=None, stop_id=None, current_stop_sequence=0),
    ]
    got = vehicle_rows(snapshots(spark, entities))
    assert [r.current_status for r in got.collect()] == [
        "INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO", "IN_TRANSIT_TO", "8", "STOPPED_AT",
    ]
    last = got.collect()[-1]
    assert last.trip_id is None and last.stop_id is None and last.current_stop_sequence is None
    assert last.vehicle_timestamp is None and last.direction is None
    assert got.collect()[4].vehicle_timestamp == datetime(2025, 3, 14, 14, 30, 0)


def test_stops_keep_their_place_in_the_list(spark):
    stops = [{"stop_id": s, "arrival": HEADER + i} for i, s in enumerate("ABC")]
    got = stop_rows(snapshots(spark, [update_entity("u", stops)]))
    assert rows(got, "stop_index", "stop_id") == [(0, "A"), (1, "B"), (2, "C")]


def test_stop_without_times_is_kept(spark):
    stops = [{"stop_id": "A"}, {"stop_id": "B", "arrival": 0, "departure": HEADER}]
    got = stop_rows(snapshots(spark, [update_entity("u", stops)]))
    assert rows(got, "arrival_time", "departure_time", "schedule_relationship") == [
        (None, None, "SCHEDULED"),
        (None, datetime(2025, 3, 14, 14, 30, 0), "SCHEDULED"),
    ]


def test_update_without_stops_has_no_rows(spark):
    assert stop_rows(snapshots(spark, [update_entity("u", [])])).count() == 0


def test_alerts(spark):
    entities = [
        alert_entity("two", ["x"], [{"trip": {"trip_id": "t1"}}, {"trip": {"trip_id": "t2"}}]),
        alert_entity("none", ["y"], []),
        alert_entity("route", [], [{"route_id": "7"}]),
        alert_entity("both", ["z"], [{"route_id": "7", "trip": {"trip_id": "t", "route_id": "8"}}]),
    ]
    found = snapshots(spark, entities)
    assert rows(alert_rows(found), "entity_id", "alert_header", "trip_id", "route_id") == [
        ("two", "x", "t1", None),
        ("two", "x", "t2", None),
        ("none", "y", None, None),
        ("route", None, None, "7"),
        ("both", "z", "t", "8"),
    ]
    assert audit_rows(found).first().alert_rows == 5


def test_positions_and_predictions_never_share_an_entity(spark):
    found = good_payloads(split(spark, (default_payload(), 0)))
    joined = vehicle_rows(found).join(stop_rows(found), ["fetch_id", "entity_id"])
    assert joined.count() == 0


def test_payload_files(spark, tmp_path):
    folder = tmp_path / "feed_key=ACE"
    folder.mkdir()
    (folder / "1741962600123.pb").write_bytes(default_payload())
    (folder / "unnamed.pb").write_bytes(b"junk")
    (folder / "empty.pb").write_bytes(b"")
    (folder / "notes.txt").write_text("not a payload")
    named, unnamed = read_payloads(spark, str(tmp_path)).orderBy("path").collect()
    assert named.feed_key == "ACE" and named.feed_url.endswith("nyct%2Fgtfs-ace")
    assert named.fetched_at == datetime(2025, 3, 14, 14, 30, 0, 123000)
    assert unnamed.fetched_at is not None and unnamed.payload == b"junk"


def test_parts_go_by_rows_and_size():
    batch = pa.record_batch({"at": list(range(8))})
    sizes = pa.array([1, 1, None, 9, 1, 1, 1, 1])

    def parts(rows, size):
        return [part["at"].to_pylist() for part in parts_of(batch, sizes, rows, size)]

    assert parts(3, 4) == [[0, 1, 2], [3], [4, 5, 6], [7]]
    assert parts(8, 100) == [list(range(8))]
    assert [*parts_of(batch.slice(0, 0), sizes.slice(0, 0), 3, 4)] == []


def test_a_worker_holds_few_messages_at_once(spark, monkeypatch):
    """Python sees bounded batches of payloads, and turns a bounded part of one into messages."""
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
    held = []
    run = {}
    given = payloads(spark, *[(default_payload(), n) for n in range(3)])
    monkeypatch.setattr(type(given), "mapInArrow", lambda self, f, schema: run.update(f=f))
    decode_payloads(given)
    big = default_payload(entities=[vehicle_entity(f"v{n}") for n in range(6000)])
    names = [*[n for n in PAYLOADS.names if n != "payload"], PAYLOAD_HASH]
    columns = {n: pa.nulls(12, pa.string()) for n in names} | {"payload": pa.array([big] * 12)}
    columns["feed_key"] = pa.array(["k"] * 12)
    for part in run["f"](iter([pa.record_batch(columns)])):
        held.append((part.num_rows, len(part["entity"].flatten())))
    assert sum(n for n, _ in held) == 12 and len(held) >= 3
    assert max(entities for _, entities in held) < 12 * 6000 / 2


def test_test_feed_encodes_a_bounded_number_of_events_at_once(spark, monkeypatch):
    run = {}
    events = spark.createDataFrame([], testfeed.EVENTS)
    monkeypatch.setattr(type(events), "mapInArrow", lambda self, f, schema: run.update(f=f) or given)
    given = spark.createDataFrame([], "block long, payload binary")
    testfeed.payloads(events)
    event = {"event_id": 1, "event_type": "view", "value": 1.0, "user_id": 2,
             "trip_id": "t", "route_id": "1", "start_date": None}
    batch = pa.record_batch({"block": list(range(300)), "events": [[event] * 40] * 300})
    held = [part.num_rows for part in run["f"](iter([batch]))]
    assert sum(held) == 300 and max(held) <= 100
