from __future__ import annotations

import hashlib
import re
from datetime import UTC, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions.labels import (
    SCHEDULE_RELATIONSHIP,
    VEHICLE_STATUS,
    drift_label,
    enum_label,
    freshness_level,
    percent,
    status_label,
)
from headway.functions.times import clock, epoch_to_ts, humanize_seconds, iso_utc, seconds_between
from headway.functions.trips import joined_key, parse_trip_id, snapshot_id, trip_key


def column(spark, ddl, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [row.out for row in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_epoch(spark):
    values = column(spark, "long", [1_741_962_600, 0, None], epoch_to_ts)
    assert values == [datetime(2025, 3, 14, 14, 30, 0), None, None]


# Six digits, an underscore, a route, one or two dots, and a path that may begin with a direction.
TRIP_IDS = [
    ("041300_5..N07R", "N", 24780, "N07R"),
    ("052210_5..S07R", "S", 31326, "S07R"),
    ("000010_FS.S01", "S", 6, "S01"),
    ("143990_A..N", "N", 86394, "N"),
    ("070000_6X..N", "N", 42000, "N"),
    ("033350_2..EASTERN", None, 20010, "EASTERN"),
    ("033350_2.NORTH END", None, 20010, "NORTH END"),
    ("120000_C..", None, 72000, None),
    ("no trip", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
    ("4130_5..N", None, None, None),
    ("04130x_5..N", None, None, None),
]


def parsed(spark, ids):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ids)], "i int, trip_id string")
    rows = df.select("i", *parse_trip_id(F.col("trip_id"))).orderBy("i").collect()
    return [tuple(row[1:]) for row in rows]


def test_trip_ids(spark):
    assert parsed(spark, [case[0] for case in TRIP_IDS]) == [case[1:] for case in TRIP_IDS]


def by_hand(trip_id):
    """What a trip id says, worked out without a pattern over the whole of it."""
    head, underscore, rest = trip_id.partition("_")
    route, dot, path = rest.partition(".")
    digits = len(head) == 6 and all(c in "0123456789" for c in head)
    if not (digits and underscore and route and dot) or "\n" in path:
        return None, None, None
    path = path.removeprefix(".")
    direction = path[:1] if re.match(r"[NS]", path) and not path[1:2].isalpha() else None
    return direction, round(int(head) * 0.6), path or None


@settings(max_examples=15, deadline=None)
@given(
    ids=st.lists(
        st.one_of(
            st.from_regex(r"[0-9]{5,7}_[A-Z0-9]{0,2}\.{0,3}[NSM]{0,2}[0-9é ]{0,3}", fullmatch=True),
            st.text("0123456789_.NSé x", max_size=14),
        ),
        min_size=30,
        max_size=60,
    )
)
def test_any_trip_id(spark, ids):
    assert parsed(spark, ids) == [by_hand(t) for t in ids]


def test_enums(spark):
    assert column(spark, "int", [0, 1, 2, 9, None], lambda v: enum_label(v, VEHICLE_STATUS)) == [
        "INCOMING_AT",
        "STOPPED_AT",
        "IN_TRANSIT_TO",
        "9",
        None,
    ]
    assert column(spark, "int", [3, 7], lambda v: enum_label(v, SCHEDULE_RELATIONSHIP)) == [
        "UNSCHEDULED",
        "7",
    ]


@pytest.mark.parametrize("micros", [0, 5, 120_000])
def test_snapshot_id_is_the_digest_of_feed_and_time(spark, micros):
    when = datetime(2025, 3, 14, 14, 30, 0, micros, tzinfo=UTC)
    df = spark.createDataFrame([("ACE", when, None)], "k string, t timestamp, n timestamp")
    row = df.select(
        iso_utc(F.col("t")).alias("iso"),
        snapshot_id(F.col("k"), F.col("t"), F.col("t")).alias("dated"),
        snapshot_id(F.col("k"), F.col("n"), F.col("t")).alias("undated"),
    ).first()

    def digest(text):
        return hashlib.sha1(text.encode()).hexdigest()[:16]

    assert row.iso == when.isoformat()
    assert row.dated == digest(f"ACE|{when.isoformat()}")
    assert row.undated == digest(f"ACE|nohdr:{when.isoformat()}")


def test_seconds_between_counts_boundaries(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 00:00:02.1' b"
    )
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 2


def test_humanize(spark):
    seconds = [None, 0.0, 89.9, 90.0, 5399.0, 5400.0, 7325.0]
    assert column(spark, "double", seconds, humanize_seconds) == [
        "unknown",
        "0s",
        "89s",
        "1m",
        "89m",
        "1h 30m",
        "2h 2m",
    ]


def test_clock(spark):
    when = datetime(2024, 1, 1, 7, 5, 9, tzinfo=UTC)
    assert column(spark, "timestamp", [when, None], clock) == ["07:05:09", "none"]


def test_labels(spark):
    drift = column(spark, "long", [121, 120, -120, -121], drift_label)
    assert drift == ["Losing time", "On plan", "On plan", "Making up time"]
    ages = column(spark, "double", [None, 119.9, 120.0, 899.0, 900.0], freshness_level)
    assert ages == ["NO DATA", "OK", "WARN", "WARN", "STALE"]
    statuses = column(
        spark, "string", ["STOPPED_AT", "INCOMING_AT", "IN_TRANSIT_TO", "7"],
        lambda v: status_label(F.lit(False), v),
    )
    assert statuses == ["At station", "Arriving", "In transit", "Unknown"]
    alerted = column(spark, "string", ["STOPPED_AT"], lambda v: status_label(F.lit(True), v))
    assert alerted == ["Delayed (MTA alert)"]


def test_percent_of_nothing_is_null(spark):
    assert column(spark, "long", [0, 3], lambda v: percent(F.lit(1), v, 1)) == [None, 33.3]


def test_keys(spark):
    df = spark.sql("SELECT 'f' f, 'e' e, 3 i, CAST(NULL AS string) n")
    row = df.select(
        joined_key(F.col("f"), F.col("e"), F.col("i")),
        joined_key(F.col("f"), F.col("n")),
        trip_key(F.col("e"), F.col("n")),
        trip_key(F.col("n"), F.col("n")),
    ).first()
    assert tuple(row) == ("f|e|3", None, "e|unknown", "unknown|unknown")
