from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway.queries import QUERIES
from headway.sources import testfeed

# Queries that encode or decode payloads; the others that land share the steps of the last one.
THROUGH_PAYLOADS = [
    "snapshot_audit",
    "decode_feed",
    "preview_top_alerts",
    "preview_arrivals",
    "poll_audit",
    "demux_entities",
    "project_raw",
    "decode_rejects",
    "flatten_stops",
    "preview_first_vehicles",
    "preview_routes",
    "preview_status",
    "landed_audit",
]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Some 120 payloads a task."""
    folder = str(tmp_path_factory.mktemp("feed"))
    number = F.col("id")
    kind = F.when(number % 9 == 0, "error").when(number % 2 == 0, "view").otherwise("click")
    spark.range(960 * testfeed.EVENTS_PER_PAYLOAD).select(
        number.alias("event_id"),
        F.timestamp_seconds(1_704_067_200 + number).cast("timestamp_ntz").alias("ts"),
        (number % 500).alias("user_id"),
        kind.alias("event_type"),
        (number % 50).cast("double").alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", THROUGH_PAYLOADS)
def test_a_query_has_few_payloads_as_objects_at_once(spark, feed, tmp_path, monkeypatch, name):
    """Every Python step of the query hands back parts of at most 64 payloads, of all payloads together."""
    seen = str(tmp_path)
    plain = type(spark.range(1)).mapInArrow

    def watched(self, step, schema, *more):
        def run(batches):
            import uuid

            given, handed = [], []

            def counted():
                for one in batches:
                    given.append(one.num_rows)
                    yield one

            for part in step(counted()):
                handed.append(part.num_rows)
                yield part
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as file:
                json.dump([given, handed], file)

        return plain(self, run, schema, *more)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", watched)
    QUERIES[name](spark, feed).write.format("noop").mode("overwrite").save()
    tasks = [json.loads(path.read_text()) for path in Path(seen).iterdir()]
    assert sum(sum(given) for given, _ in tasks) >= 960
    assert all(sum(given) == sum(handed) for given, handed in tasks)
    assert max(sum(given) for given, _ in tasks) > 64
    assert max(rows for given, _ in tasks for rows in given) <= 1000
    assert max(rows for _, handed in tasks for rows in handed) <= 64
