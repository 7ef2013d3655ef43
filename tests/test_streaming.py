from __future__ import annotations

import random
import shutil
from pathlib import Path

import pytest

from headway.operators.landing import land_next
from headway.operators.snapshots import with_gaps
from headway.plans import marts
from headway.plans.staging import stg_trip_stop_updates
from headway.schemas import FIRST_POLLS, PAYLOADS, RAW_TRIP_STOP_UPDATES
from headway.sources.payloads import stream_payloads
from headway.sources.store import Files
from headway.sources.tables import read_raw
from headway.streaming import aggregates, gaps, land
from headway.streaming.sinks import UpdateLog
from tests.builders import (
    FETCHED, HEADER, default_payload, frame, payloads, raw, snapshot, stop,
)


def files(spark, folder, schema, *batches):
    """Each batch of rows as one file, in order, read back one file per trigger."""
    for rows in batches:
        df = rows if hasattr(rows, "schema") else frame(spark, schema, rows)
        df.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def poll(fetch_id, published, later=0, feed_key="A", path="p"):
    row = snapshot(fetch_id, feed_key, published)
    return row | {"path": path, "fetched_at": FETCHED.replace(second=later)}


def in_order(df, *without):
    """Rows as text, by the names of their columns and then sorted."""
    columns = sorted(set(df.columns) - set(without))
    return sorted(map(str, df.select(columns).collect()))


POLLS = [
    [poll("f1", 0, 1), poll("f1", 0, 2), poll("f2", 30, 3)],
    [poll("f1", 0, 4), poll("f4", 700, 5), poll("n1", None, 5)],
    # An old snapshot again, a late new one, one without publish time, another feed.
    [poll("f2", 30, 6), poll("f3", 60, 7), poll("n2", None, 8), poll("g1", 5, 9, "B")],
]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "out")


def test_dedupe_for_all_time(spark, tmp_path, root):
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, *POLLS)
    land.stream_dedupe(stream, root).awaitTermination()
    got = {row.fetch_id: row.fetched_at.second for row in land.read_snapshots(spark, root).collect()}
    assert got == {"f1": 1, "f2": 3, "f4": 5, "n1": 5, "f3": 7, "n2": 8, "g1": 9}
    # A new run over the same checkpoint has nothing to do.
    land.stream_dedupe(stream, root).awaitTermination()
    assert land.read_snapshots(spark, root).count() == 7


def test_poll_counts(spark, tmp_path, root):
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, *POLLS)
    aggregates.stream_poll_count(stream, root).awaitTermination()
    got = {
        row.fetch_id: (row.poll_count, row.last_polled_at.second)
        for row in aggregates.read_poll_counts(spark, root).collect()
    }
    assert got == {"f1": (3, 4), "f2": (2, 6), "f3": (1, 7), "f4": (1, 5), "n1": (1, 5),
                   "n2": (1, 8), "g1": (1, 9)}


def test_gaps_keep_their_place_between_batches(spark, tmp_path, root):
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, [poll("f2", 300), poll("f1", 0)],
                   [poll("f4", 902), poll("g1", 0, feed_key="B")],
                   [poll("f3", 601), poll("n", None), poll("g2", 400, feed_key="B")],
                   [poll("late morning", 11_000), poll("dawn", 10_000), poll("f5", 905)])
    gaps.stream_gaps(stream, root).awaitTermination()
    got = {
        row.fetch_id: (row.seconds_since_previous_snapshot, row.is_late, row.is_after_ingestion_gap)
        for row in gaps.read_gaps(spark, root).collect()
    }
    assert got == {
        "f1": (None, False, False), "f2": (300, False, False), "g1": (None, False, False),
        "g2": (400, False, True), "n": (None, False, False), "f5": (3, False, False),
        # It came late, and the one that had come after a gap came right after it.
        "f3": (301, True, True), "f4": (301, False, True),
        # The day changes; the wait began at the last snapshot of the day before.
        "dawn": (9095, False, True), "late morning": (1000, False, True),
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_gaps_equal_batch_in_any_order(spark, tmp_path, root, seed):
    chance = random.Random(seed)
    times = chance.sample(range(0, 200_000, 50), 60)
    polls = [poll(f"f{t}", t, feed_key=chance.choice("AB")) for t in times] + [poll("n", None)]
    fetches = frame(spark, FIRST_POLLS, polls)
    want = with_gaps(fetches).select("fetch_id", "seconds_since_previous_snapshot", "is_after_ingestion_gap")
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, *[polls[i::4] for i in range(4)])
    gaps.stream_gaps(stream, root).awaitTermination()
    got = gaps.read_gaps(spark, root)
    assert in_order(got.select(want.columns)) == in_order(want)
    assert got.filter("is_late").count() > 5


def test_an_update_log_costs_the_same_however_long_it_is(spark, tmp_path, monkeypatch):
    """Every batch has three new keys and one that all have; runs of 3 are merged."""
    rows, again = [], []
    write = UpdateLog._write

    def spy(self, df, run):
        write(self, df, run)
        if run[0] != run[1]:
            again.append((run[1], spark.read.parquet(self._path(run)).count()))

    monkeypatch.setattr(UpdateLog, "_write", spy)
    log = UpdateLog(spark, str(tmp_path / "log"), ["k"], 3)
    schema = "k string, v long"
    for number in range(54):
        batch = spark.createDataFrame([("all", number), *[(f"{number}-{i}", i) for i in range(3)]], schema)
        log.append(batch.coalesce(1), number)
        rows.append(len(log.runs()))
        if number == 30:
            log.append(batch, number)
    first, second = (sum(n for last, n in again if last // 27 == half) for half in (0, 1))
    assert first <= 27 * 4 * 3 and second == first
    assert max(rows) <= 2 * 4
    got = {r.k: (r.v, r.update_id) for r in log.read(batch.schema).collect() if r.k == "all" and r.update_id == 53}
    assert got == {"all": (53, 53)}
    assert log.read(batch.schema).select("k").distinct().count() == 54 * 3 + 1
    # Readers that began before a merge find their runs until the next batch.
    assert len(list((tmp_path / "log").glob("run=*"))) >= len(log.runs())


@pytest.mark.parametrize("seed", [1, 2])
def test_drift_equals_batch_in_any_file_order(spark, tmp_path, root, seed):
    chance = random.Random(seed)
    stops = [
        stop(f"u{i}", 0, f"s{i % 5}", chance.randrange(100, 900), f"t{i % 3}")
        | snapshot(f"f{i}", "A", 30 * (i // 4))
        for i in range(60)
    ]
    want = marts.drift_from_observations(
        marts.drift_observations(stg_trip_stop_updates(raw(spark, stops=stops).stops))
    )
    chance.shuffle(stops)
    parts = [stops[i::4] for i in range(4)]
    stream = files(spark, str(tmp_path / "in"), RAW_TRIP_STOP_UPDATES, *parts)
    aggregates.stream_drift(stream, root).awaitTermination()
    assert in_order(aggregates.read_drift(spark, root)) == in_order(want)


def test_landing_equals_batch(spark, tmp_path, root):
    polls = [
        (default_payload(), 0), (default_payload(HEADER + 30), 30), (b"junk", 40),
        (default_payload(), 60), (default_payload(HEADER + 10), 70), (default_payload(0), 80),
    ]
    whole = payloads(spark, *polls)
    parts = [payloads(spark, *polls[:2]), payloads(spark, *polls[2:4]), payloads(spark, *polls[4:])]
    stream = files(spark, str(tmp_path / "in"), PAYLOADS, *parts)
    land.stream_land(stream, root).awaitTermination()
    batch_root = str(tmp_path / "batch")
    land_next(whole, batch_root)
    streamed, landed = read_raw(spark, root), read_raw(spark, batch_root)
    for name in ("fetches", "vehicles", "stops", "alerts", "errors"):
        rows = [in_order(getattr(tables, name), "landing_batch_id") for tables in (streamed, landed)]
        assert rows[0] == rows[1]
    assert streamed.fetches.count() == 4 and streamed.errors.count() == 1


def test_landing_survives_a_crash_and_resumes(spark, tmp_path, root, monkeypatch):
    from headway.operators import landing

    stream = files(spark, str(tmp_path / "in"), PAYLOADS, payloads(spark, (default_payload(), 0)))
    write = landing.write_batch

    def crash(df, root, table, *rest):
        write(df, root, table, *rest)
        if table == "raw_feed_fetches":
            raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "write_batch", crash)
        with pytest.raises(Exception, match="lost"):
            land.stream_land(stream, root).awaitTermination()
    assert read_raw(spark, root).vehicles.count() == 0
    land.stream_land(stream, root).awaitTermination()
    tables = read_raw(spark, root)
    assert (tables.fetches.count(), tables.vehicles.count()) == (1, 2)
    assert tables.fetches.first().poll_count == 1


def test_a_batch_beside_a_stream_loses_nothing(spark, tmp_path, root):
    land_next(payloads(spark, (default_payload(), 0)), root)
    parts = [payloads(spark, (default_payload(HEADER + s), s)) for s in (30, 60, 0)]
    stream = files(spark, str(tmp_path / "in"), PAYLOADS, *parts)
    query = land.stream_land(stream, root)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 3
    assert read_raw(spark, root).fetches.count() == 3
    land_next(payloads(spark, (default_payload(HEADER + 90), 90)), root)
    assert read_raw(spark, root).fetches.count() == 4


def test_a_lost_checkpoint_loses_nothing(spark, tmp_path, root):
    first = [payloads(spark, (default_payload(HEADER + s), s)) for s in (0, 30)]
    files(spark, str(tmp_path / "a"), PAYLOADS, *first)
    stream = spark.readStream.schema(PAYLOADS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "a"))
    land.stream_land(stream, root).awaitTermination()
    shutil.rmtree(f"{root}/checkpoint")
    more = files(spark, str(tmp_path / "b"), PAYLOADS, *[payloads(spark, (default_payload(HEADER + s), s)) for s in (60, 90, 30)])
    land.stream_land(more, root).awaitTermination()
    tables = read_raw(spark, root)
    assert (tables.fetches.count(), tables.vehicles.count()) == (4, 8)


def test_update_logs_are_folded_and_follow_the_newest_checkpoint(spark, tmp_path, root, monkeypatch):
    from headway.streaming import sinks

    monkeypatch.setattr(sinks, "FAN", 3)
    batches = [[poll("f1", 0, i), poll(f"n{i}", i, i)] for i in range(10)]
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, *batches)
    aggregates.stream_poll_count(stream, root).awaitTermination()
    got = {r.fetch_id: r.poll_count for r in aggregates.read_poll_counts(spark, root).collect()}
    assert got == {"f1": 10} | {f"n{i}": 1 for i in range(10)}
    log = Path(root) / aggregates.POLL_COUNT_TABLE
    (source,) = [p for p in log.iterdir() if p.is_dir()]
    assert len([p for p in source.iterdir() if not p.name.startswith(".")]) <= 6
    shutil.rmtree(f"{root}/checkpoint")
    short = files(spark, str(tmp_path / "new"), FIRST_POLLS, [poll("f1", 0, 1)])
    aggregates.stream_poll_count(short, root).awaitTermination()
    got = {r.fetch_id: r.poll_count for r in aggregates.read_poll_counts(spark, root).collect()}
    assert got == {"f1": 1}


def test_the_snapshot_feed_has_committed_snapshots_once(spark, tmp_path, root, monkeypatch):
    stream = files(spark, str(tmp_path / "in"), FIRST_POLLS, *POLLS)
    move = Files.move

    def crash(self, source, target):
        if f"/{land.FEED}/" in target:
            raise OSError("lost")
        move(self, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(Files, "move", crash)
        with pytest.raises(Exception, match="lost"):
            land.stream_dedupe(stream, root).awaitTermination()
    land.stream_dedupe(stream, root).awaitTermination()
    fed = spark.read.schema(FIRST_POLLS).parquet(f"{root}/{land.FEED}/*")
    assert sorted(r.fetch_id for r in fed.collect()) == sorted(r.fetch_id for r in land.read_snapshots(spark, root).collect())
    gaps.stream_gaps(land.read_snapshot_stream(spark, root, 1), root).awaitTermination()
    assert gaps.read_gaps(spark, root).count() == 7


def test_payload_folder_as_a_stream(spark, tmp_path, root):
    folder = tmp_path / "drop" / "feed_key=ACE"
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"{1_741_962_600_000 + i}.pb").write_bytes(default_payload(HEADER + 30 * i))
    land.stream_land(stream_payloads(spark, str(tmp_path / "drop"), 2), root).awaitTermination()
    assert read_raw(spark, root).fetches.count() == 3
