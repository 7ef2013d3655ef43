from __future__ import annotations

import shutil
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway.operators import landing
from headway.operators.demux import good_payloads, split_entities
from headway.sources.gtfs_rt import decode_payloads
from headway.sources.seen import MERGE_AT, Seen
from headway.sources.store import Batch, BatchMismatch, Files, Log, committed, failed_attempts
from headway.sources.tables import BATCH, compact_day, compact_due, read_raw, remove_failed, tidy
from headway.schemas import RAW_FEED_FETCHES
from tests.builders import FETCHED, HEADER, default_payload, frame, payloads, raw


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def counts(spark, root):
    tables = read_raw(spark, root)
    return (
        tables.fetches.count(), tables.vehicles.count(), tables.stops.count(),
        tables.alerts.count(), tables.errors.count(),
    )


def test_empty_root_reads_as_empty_tables(spark, root):
    assert counts(spark, root) == (0, 0, 0, 0, 0)


def test_default_snapshot(spark, root):
    landing.land_next(payloads(spark, (default_payload(), 0)), root)
    assert counts(spark, root) == (1, 2, 2, 1, 0)
    (audit,) = read_raw(spark, root).fetches.collect()
    assert (audit.vehicle_rows, audit.trip_stop_rows, audit.alert_rows) == (2, 2, 1)
    assert audit.entity_count == 4 and audit.payload_bytes == len(default_payload())
    assert audit.poll_count == 1 and audit.last_polled_at == FETCHED.replace(tzinfo=None)


def test_three_polls_land_once(spark, root):
    for later in (0, 30, 60):
        landing.land_next(payloads(spark, (default_payload(), later)), root)
    assert counts(spark, root) == (1, 2, 2, 1, 0)
    (audit,) = read_raw(spark, root).fetches.collect()
    assert audit.poll_count == 3 and audit.fetched_at == FETCHED.replace(tzinfo=None)
    assert audit.last_polled_at > audit.fetched_at


def test_polls_in_one_batch_land_once(spark, root):
    again = [(default_payload(), later) for later in (30, 0, 0, 60)]
    landing.land_next(payloads(spark, *again), root)
    assert counts(spark, root) == (1, 2, 2, 1, 0)
    assert read_raw(spark, root).fetches.first().poll_count == 4


def test_two_feeds_and_new_snapshots_both_land(spark, root):
    polls = [
        (default_payload(), 0, "A"),
        (default_payload(), 0, "B"),
        (default_payload(HEADER + 30), 30, "A"),
    ]
    landing.land_next(payloads(spark, *polls), root)
    assert counts(spark, root)[0] == 3


def test_snapshots_without_header_time_never_collapse(spark, root):
    polls = [(default_payload(0), 0), (default_payload(0), 30)]
    landing.land_next(payloads(spark, *polls), root)
    assert counts(spark, root)[0] == 2


def test_feed_without_entities_has_an_audit_row(spark, root):
    landing.land_next(payloads(spark, (default_payload(entities=[]), 0)), root)
    assert counts(spark, root) == (1, 0, 0, 0, 0)
    audit = read_raw(spark, root).fetches.first()
    assert (audit.entity_count, audit.vehicle_rows, audit.alert_rows) == (0, 0, 0)


def test_bad_payloads_do_not_stop_the_others(spark, root):
    landing.land_next(payloads(spark, (b"", 0, "A"), (default_payload(), 0, "B")), root)
    assert counts(spark, root) == (1, 2, 2, 1, 1)


def test_batch_of_only_bad_payloads(spark, root):
    landing.land_next(payloads(spark, (b"", 0)), root)
    landing.land_next(payloads(spark, (default_payload(), 0)), root)
    assert counts(spark, root) == (1, 2, 2, 1, 1)


@pytest.mark.parametrize("failing", ["raw_vehicle_positions", "raw_alerts", "raw_feed_fetches"])
def test_crash_shows_nothing_and_retry_shows_all(spark, root, monkeypatch, failing):
    landing.land_next(payloads(spark, (default_payload(), 0)), root)
    second, name = payloads(spark, (default_payload(HEADER + 30), 30)), Batch("s", 1)
    write = landing.write_batch

    def crash(df, root, table, *rest):
        write(df, root, table, *rest)
        if table == failing:
            raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "write_batch", crash)
        with pytest.raises(OSError):
            landing.land_batch(second, root, name)
    assert committed(spark, root, name) is None and len(failed_attempts(spark, root)) == 1
    assert counts(spark, root) == (1, 2, 2, 1, 0)
    landing.land_batch(second, root, name)
    assert counts(spark, root) == (2, 4, 4, 2, 0)
    (failed,) = failed_attempts(spark, root)
    remove_failed(spark, root, failed)
    assert failed_attempts(spark, root) == [] and counts(spark, root) == (2, 4, 4, 2, 0)
    assert not list(Path(root).rglob(f"*{failed}*"))
    with pytest.raises(ValueError):
        remove_failed(spark, root, "none")


def test_replay_after_publishing_changes_nothing(spark, root):
    batch, name = payloads(spark, (default_payload(), 0), (b"", 5)), Batch("s", 0)
    landing.land_batch(batch, root, name)
    before = read_raw(spark, root).fetches.collect()
    landing.land_batch(batch, root, name)
    assert read_raw(spark, root).fetches.collect() == before
    assert counts(spark, root) == (1, 2, 2, 1, 1)


def test_a_name_stands_for_one_content(spark, root):
    landing.land_batch(payloads(spark, (default_payload(), 0)), root, Batch("s", 0))
    other = payloads(spark, (default_payload(HEADER + 30), 30))
    with pytest.raises(BatchMismatch):
        landing.land_batch(other, root, Batch("s", 0))
    # The same number of another source is another batch.
    landing.land_batch(other, root, Batch("t", 0))
    assert counts(spark, root) == (2, 4, 4, 2, 0)


def test_nothing_depends_on_success_files(spark, root):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for later in (0, 30):
            landing.land_next(payloads(spark, (default_payload(HEADER + later), later)), root)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert counts(spark, root) == (2, 4, 4, 2, 0)


def test_listings_do_not_grow_with_other_days(spark, root, monkeypatch):
    """500 batches of other days were landed; a batch lists what it would without them."""
    listed: list[str] = []
    names = Files.names

    def spy(self, folder):
        found = names(self, folder)
        listed.extend(found)
        return found

    monkeypatch.setattr(Files, "names", spy)
    landing.land_next(payloads(spark, (default_payload(), 0)), root)
    del listed[:]
    landing.land_next(payloads(spark, (default_payload(HEADER + 30), 30)), root)
    before = len(listed)
    lake = Path(root)
    day = next((lake / "raw_feed_fetches").iterdir())
    for number in range(500):
        shutil.copytree(day, lake / "raw_feed_fetches" / "snapshot_date=2020-01-01" / f"feed_key=x{number}", dirs_exist_ok=True)
        (lake / "commits" / "old").mkdir(exist_ok=True)
        (lake / "commits" / "old" / f"{number}.json").write_text("{}")
    del listed[:]
    landing.land_next(payloads(spark, (default_payload(HEADER + 60), 60)), root)
    assert len(listed) <= before + 1


def test_new_snapshots_read_nothing_that_is_landed(spark, root, monkeypatch):
    asked: list[list[str]] = []
    read = landing.read_batches

    def spy(spark, root, table, schema, folders, days):
        asked.append(days)
        return read(spark, root, table, schema, folders, days)

    monkeypatch.setattr(landing, "read_batches", spy)
    for later in (0, 60, 30, 86_400):
        landing.land_next(payloads(spark, (default_payload(HEADER + later), later), (default_payload(0), later)), root)
    assert asked == [[], [], [], []] and counts(spark, root)[0] == 8
    landing.land_next(payloads(spark, (default_payload(HEADER + 60), 90), (default_payload(HEADER + 90), 90)), root)
    assert asked[-1] == ["2025-03-14"] and counts(spark, root)[0] == 9
    # A day landed before places were kept is looked at.
    Files(spark, root).remove(f"{root}/seen")
    landing.land_next(payloads(spark, (default_payload(HEADER), 90)), root)
    assert asked[-1] == ["2025-03-14"] and counts(spark, root)[0] == 9


def test_places_of_a_day_stay_in_few_files(spark, root):
    seen = Seen(spark, root, "t")
    for n in range(3 * MERGE_AT):
        assert seen.claim({"2025-03-14": {"A|0|1": 1 << n}}) == []
    assert seen.claim({"2025-03-14": {"A|0|1": 6, "B|0|1": 6}, "2025-03-15": {"A|0|1": 6}}) == ["2025-03-14"]
    assert len(Files(spark, root).names(f"{root}/seen/t/2025-03-14")) <= MERGE_AT + 2


def test_compaction_keeps_the_rows(spark, root):
    for later in (0, 30, 60):
        landing.land_next(payloads(spark, (default_payload(HEADER + later), later)), root)
    before = counts(spark, root)
    day = str(read_raw(spark, root).vehicles.first().snapshot_date)
    for table in ("raw_vehicle_positions", "raw_feed_fetches"):
        assert compact_day(spark, root, table, day) == 3
    assert counts(spark, root) == before
    assert read_raw(spark, root).vehicles.select(BATCH).distinct().count() == 1
    assert compact_day(spark, root, "raw_vehicle_positions", day) == 1
    landing.land_next(payloads(spark, (default_payload(HEADER + 30), 90)), root)
    assert counts(spark, root) == before


def test_a_read_begun_before_a_compaction_ends_with_the_same_rows(spark, root):
    for later in (0, 30, 60):
        landing.land_next(payloads(spark, (default_payload(HEADER + later), later)), root)
    begun, want = read_raw(spark, root).vehicles, read_raw(spark, root).vehicles.count()
    day = str(begun.first().snapshot_date)
    assert compact_day(spark, root, "raw_vehicle_positions", day) == 3
    assert begun.count() == want == read_raw(spark, root).vehicles.count()
    assert tidy(spark, root) == 0
    # One that runs is left alone; one that died is taken over.
    files, lock = Files(spark, root), f"{root}/compacting/raw_alerts.{day}"
    files.write(lock, "{}")
    assert compact_day(spark, root, "raw_alerts", day) == 0
    assert tidy(spark, root, 0) == 1 and counts(spark, root)[1] == want
    assert not files.names(f"{root}/marks")


def test_days_are_compacted_by_size(spark, root):
    for later in range(5):
        landing.land_next(payloads(spark, (default_payload(HEADER + 30 * later), later)), root)
        compact_due(spark, root, ["2025-03-14"], 2)
    assert counts(spark, root) == (5, 10, 10, 5, 0)
    # One of four batches and one of one.
    assert read_raw(spark, root).stops.select(BATCH).distinct().count() == 2
    tidy(spark, root, 0)
    assert counts(spark, root) == (5, 10, 10, 5, 0)
    assert len(list((Path(root) / "raw_alerts" / "snapshot_date=2025-03-14").glob("*/*"))) == 2


def test_crash_during_compaction_shows_the_old_rows(spark, root, monkeypatch):
    from headway.sources import tables

    for later in (0, 30):
        landing.land_next(payloads(spark, (default_payload(HEADER + later), later)), root)
    before = counts(spark, root)
    day = str(read_raw(spark, root).vehicles.first().snapshot_date)
    write = tables.write_batch

    def crash(*args):
        write(*args)
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "write_batch", crash)
        with pytest.raises(OSError):
            compact_day(spark, root, "raw_vehicle_positions", day)
    assert counts(spark, root) == before


def test_cycle_counters(spark):
    polls = payloads(
        spark,
        (default_payload(), 0),
        (default_payload(), 30),
        (b"", 30),
        (default_payload(HEADER + 30), 60),
        (default_payload(HEADER + 60), 90),
    )
    split = split_entities(decode_payloads(polls))
    landed = good_payloads(split).filter(F.col("path") == "poll-4-90")
    totals = landing.cycle_counters(landing.classify_polls(split, landed)).first()
    assert totals.asDict() == {"inserted": 2, "duplicate": 2, "failed": 1, "rows": 10}


def test_long_error_is_cut(spark):
    errors = spark.createDataFrame([(FETCHED, "A", "x" * 5000)], "occurred_at timestamp, feed_key string, error_message string")
    assert len(landing.quarantine(errors).first().error_message) == 1000


def test_store_summary_of_nothing(spark):
    row = landing.store_summary(raw(spark)).first()
    assert row.raw_feed_fetches == 0 and row.distinct_feeds == 0 and row.first_fetch_at is None


def test_landed_columns_are_the_declared_ones(spark, root):
    landing.land_next(payloads(spark, (default_payload(), 0)), root)
    landed = read_raw(spark, root).fetches
    assert set(RAW_FEED_FETCHES.names) <= set(landed.columns)
    assert frame(spark, RAW_FEED_FETCHES, []).columns == RAW_FEED_FETCHES.names


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from headway import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.scratch_dir(Session(), "x")
    Context.getCheckpointDir = lambda self: "hdfs://host/shared"
    assert session.scratch_dir(Session(), "x").startswith("hdfs://host/shared/headway/x-")
    assert session.scratch_dir(spark, "x")


def _beside(spark, root, *polls):
    """Something to do while a batch is written and not committed."""
    return lambda: landing.land_next(payloads(spark, *polls), root)


def test_writers_that_overlap_store_a_snapshot_once(spark, root):
    polls = [(default_payload(HEADER + 30 * i), 30 * i) for i in range(4)]
    landing.land_batch(payloads(spark, *polls), root, Batch("s", 0), _beside(spark, root, *polls[:3]))
    assert counts(spark, root) == (4, 8, 8, 4, 0)
    rows = read_raw(spark, root)
    assert rows.fetches.select("fetch_id").distinct().count() == 4
    # Every poll counts, whoever stored its snapshot.
    assert sorted(r.poll_count for r in rows.fetches.collect()) == [1, 2, 2, 2]
    assert rows.fetches.select(BATCH).distinct().count() == 2
    # What is wholly landed already leaves no rows; other days are left alone.
    later = (default_payload(HEADER + 86_400), 86_400)
    landing.land_batch(payloads(spark, polls[0], later), root, Batch("s", 1), _beside(spark, root, polls[0], later))
    assert counts(spark, root) == (5, 10, 10, 5, 0)
    assert failed_attempts(spark, root) == []


def test_two_runs_of_one_batch(spark, root):
    batch, name = payloads(spark, (default_payload(), 0), (b"", 5)), Batch("s", 0)
    landing.land_batch(batch, root, name, lambda: landing.land_batch(batch, root, name))
    assert counts(spark, root) == (1, 2, 2, 1, 1)
    (late,) = failed_attempts(spark, root)
    remove_failed(spark, root, late)
    assert counts(spark, root) == (1, 2, 2, 1, 1)
    other = payloads(spark, (default_payload(HEADER + 30), 30))
    with pytest.raises(BatchMismatch):
        landing.land_batch(other, root, Batch("s", 1), lambda: landing.land_batch(batch, root, Batch("s", 1)))
    assert counts(spark, root)[0] == 1


def test_other_bytes_of_the_same_length_are_another_batch(spark, root):
    landing.land_batch(payloads(spark, (default_payload(HEADER), 0)), root, Batch("s", 0))
    changed = default_payload(HEADER + 1)
    assert len(changed) == len(default_payload(HEADER))
    with pytest.raises(BatchMismatch):
        landing.land_batch(payloads(spark, (changed, 0)), root, Batch("s", 0))


def test_a_writer_that_died_between_entry_and_record_is_finished(spark, root, monkeypatch):
    polls = [(default_payload(HEADER + 30 * i), 30 * i) for i in range(2)]

    def die(self, entry):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Log, "finish", die)
        with pytest.raises(OSError):
            landing.land_batch(payloads(spark, polls[0]), root, Batch("s", 0))
    assert counts(spark, root)[0] == 0
    # The next writer completes the commit, and so has only the other snapshot to land.
    landing.land_next(payloads(spark, *polls), root)
    assert counts(spark, root) == (2, 4, 4, 2, 0)
    landing.land_batch(payloads(spark, polls[0]), root, Batch("s", 0))
    assert counts(spark, root) == (2, 4, 4, 2, 0) and failed_attempts(spark, root) == []


def test_many_writers_at_once(spark, root):
    polls = [(default_payload(HEADER + 30 * i), 30 * i) for i in range(3)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: landing.land_next(payloads(spark, *polls[i % 2 :]), root), range(4)))
    assert counts(spark, root) == (3, 6, 6, 3, 0)


def test_files_are_created_once(spark, tmp_path):
    files, name = Files(spark, str(tmp_path)), f"{tmp_path}/a/b.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: files.create(name, str(i)), range(16)))
    assert made.count(True) == 1 and files.read(name) == str(made.index(True))
    assert files.names(f"{tmp_path}/a") == ["b.json"]
