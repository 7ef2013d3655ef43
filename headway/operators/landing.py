"""Landing payloads once: dedupe by snapshot, details first, audit last."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.operators.demux import (
    alert_rows,
    audit_rows,
    bad_payloads,
    detail_counts,
    good_payloads,
    reused_trip_ids,
    split_entities,
    stop_rows,
    vehicle_rows,
)
from headway.schemas import INGEST_ERRORS, LANDED_FETCHES, POLL_LOG, RAW_FEED_FETCHES, REUSED_IDS, project
from headway.session import scratch_dir
from headway.sources.gtfs_rt import PAYLOAD_HASH, decode_payloads, payload_hash
from headway.sources.seen import Seen, places
from headway.sources.store import Batch, Files, commit_once, new_source
from headway.sources.tables import (
    FOLDERS,
    LANDED,
    SNAPSHOT_FOLDERS,
    RawTables,
    give_up_landed,
    read_batches,
    remove_folder,
    with_snapshot_date,
    write_batch,
)

MESSAGE_LENGTH = 1000
POLL_ID = ("fetched_at", "path")
DETAILS = {
    "raw_vehicle_positions": vehicle_rows,
    "raw_trip_stop_updates": stop_rows,
    "raw_alerts": alert_rows,
}
# The tables filed by snapshot, the one first that has a row for each.
BY_SNAPSHOT = {name: LANDED[name] for name in ("raw_feed_fetches", *DETAILS)}


def quarantine(errors: DataFrame) -> DataFrame:
    """Failed polls as rows of ``ingest_errors``, long messages cut."""
    cut = errors.withColumn("error_message", F.substring("error_message", 1, MESSAGE_LENGTH))
    return project(cut, INGEST_ERRORS)


def poll_rows(snapshots: DataFrame) -> DataFrame:
    """One poll-log row per poll of a good snapshot."""
    return project(snapshots.withColumn("polled_at", F.col("fetched_at")), POLL_LOG)


def first_polls(polls: DataFrame, poll_id: tuple[str, ...] = POLL_ID) -> DataFrame:
    """The ``fetch_id`` and ``poll_id`` columns of each snapshot's first poll.

    A minimum, not a row number: a snapshot polled so often that its copies
    are most of the rows is reduced before the shuffle.
    """
    first = F.min(F.struct(*poll_id)).alias("first")
    return polls.groupBy("fetch_id").agg(first).select("fetch_id", "first.*")


def new_snapshots(
    polls: DataFrame, landed: DataFrame, poll_id: tuple[str, ...] = POLL_ID
) -> DataFrame:
    """Which polls to land: the first of every snapshot not landed before."""
    return first_polls(polls, poll_id).join(landed.select("fetch_id"), "fetch_id", "left_anti")


def classify_polls(split: DataFrame, landed: DataFrame) -> DataFrame:
    """Each poll as ``inserted``, ``duplicate`` or ``failed``, with the rows it lands.

    ``POLL_ID`` tells polls of one snapshot apart, so the join back to the
    polls is spread over it and a much-polled snapshot stays in many tasks.
    """
    polls = good_payloads(split).select("*", *detail_counts()).select(
        "feed_key",
        "fetch_id",
        *POLL_ID,
        (F.col("vehicle_rows") + F.col("trip_stop_rows") + F.col("alert_rows"))
        .cast("long")
        .alias("rows"),
    )
    new = new_snapshots(polls, landed).withColumn("_new", F.lit(True))
    landing = F.col("_new").isNotNull()
    good = polls.join(new, ["fetch_id", *POLL_ID], "left").select(
        "feed_key",
        *POLL_ID,
        F.when(landing, "inserted").otherwise("duplicate").alias("status"),
        F.when(landing, F.col("rows")).otherwise(0).alias("rows"),
    )
    failed = split.filter(F.col("error_type").isNotNull()).select(
        "feed_key", *POLL_ID, F.lit("failed").alias("status"), F.lit(0).cast("long").alias("rows")
    )
    return good.unionByName(failed)


def cycle_counters(polls: DataFrame) -> DataFrame:
    """Totals of a cycle from ``classify_polls``."""
    counts = [
        F.count_if(F.col("status") == status).alias(status)
        for status in ("inserted", "duplicate", "failed")
    ]
    return polls.agg(*counts, F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))


def poll_content(content: Column) -> Column:
    """Tells one poll from another, with the content it brought."""
    return F.xxhash64("path", "feed_key", "fetched_at", content)


def payload_fingerprint(polls: DataFrame, content: Column) -> str:
    """Tells one batch of payloads from another, whatever the order of its rows."""
    rows = polls.agg(F.count(F.lit(1)), F.sum(poll_content(content).cast("decimal(38,0)"))).first()
    return f"{rows[0]}:{rows[1]}"


def landed_audit_rows(snapshots: DataFrame) -> DataFrame:
    """Audit rows with what staging needs to know of a snapshot, told from its message alone."""
    return project(audit_rows(snapshots.withColumn(REUSED_IDS, reused_trip_ids()), REUSED_IDS), LANDED_FETCHES)


def land_batch(
    payloads: DataFrame, root: str, batch: Batch, before_commit: Callable[[], None] | None = None
) -> dict:
    """Land one batch of payloads under ``root``; returns its record. Landing it again changes nothing.

    A batch is its source's name and a number, so batches of different sources
    never stand in for each other; another batch of the same name is an error.
    Writers may overlap: before a batch is committed, the snapshots that others
    have landed since it looked are taken out of it again. ``before_commit`` is
    called when all is written and nothing committed, to hold a batch open in a drill.
    All tables show the batch at once when its record is written: a crash leaves
    rows that no reader sees.

    Messages are decoded once, into a staging table on shared storage, which
    the jobs below read column by column; a lost executor costs a re-read.
    """

    def write(attempt: str) -> tuple[str, list[str]]:
        written = _write_tables(payloads, root, attempt)
        if before_commit:
            before_commit()
        return written

    return commit_once(
        payloads.sparkSession,
        root,
        batch,
        lambda: payload_fingerprint(payloads, payload_hash()),
        write,
        lambda attempt, days: give_up_landed(payloads.sparkSession, root, attempt, days, BY_SNAPSHOT),
    )


def _write_tables(payloads: DataFrame, root: str, attempt: str) -> tuple[str, list[str]]:
    spark = payloads.sparkSession
    staging = scratch_dir(spark, "landing")
    decoded_path, accepted_path = f"{staging}/decoded", f"{staging}/accepted"

    # A number tells staged polls apart, so a million accepted ones still fit a
    # broadcast and the messages themselves are not shuffled to be picked out.
    split_entities(decode_payloads(payloads)).withColumn(
        "poll_id", F.monotonically_increasing_id()
    ).write.parquet(decoded_path)
    decoded = spark.read.parquet(decoded_path)
    snapshots = good_payloads(decoded)

    errors = quarantine(bad_payloads(decoded)).withColumn("error_date", F.to_date("occurred_at"))
    write_batch(errors, root, "ingest_errors", attempt, FOLDERS["ingest_errors"])
    log = poll_rows(snapshots).withColumn("poll_date", F.to_date("polled_at"))
    write_batch(log, root, "poll_log", attempt, FOLDERS["poll_log"])

    polls = with_snapshot_date(snapshots).select(
        "fetch_id", "fetched_at", "path", "poll_id", "snapshot_date"
    )
    _, days = places(with_snapshot_date(snapshots), F.lit(0))
    met = Seen(spark, root, "raw_feed_fetches").claim(days)
    landed = read_batches(spark, root, "raw_feed_fetches", RAW_FEED_FETCHES, SNAPSHOT_FOLDERS, met)
    new_snapshots(polls, landed, (*POLL_ID, "poll_id")).select("poll_id").write.parquet(accepted_path)
    accepted = snapshots.join(spark.read.parquet(accepted_path), "poll_id", "left_semi")

    for table, rows_of in (DETAILS | {"raw_feed_fetches": landed_audit_rows}).items():
        rows = with_snapshot_date(rows_of(accepted))
        write_batch(rows, root, table, attempt, SNAPSHOT_FOLDERS)
    content = payload_fingerprint(decoded, F.col(PAYLOAD_HASH))
    remove_folder(spark, staging)
    return content, sorted(days)


def write_hidden(payloads: DataFrame, root: str) -> str:
    """Write a batch and stop short of its record, as a crash would; for drills and tests."""
    attempt = f"{new_source('drill')}.0.0"
    Files(payloads.sparkSession, root).write(f"{root}/marks/{attempt}", json.dumps([attempt]))
    _write_tables(payloads, root, attempt)
    return attempt


def land_next(payloads: DataFrame, root: str) -> Batch:
    """Land payloads as a batch of a source of its own; returns its name."""
    batch = Batch(new_source("batch"), 0)
    land_batch(payloads, root, batch)
    return batch


def store_summary(raw: RawTables) -> DataFrame:
    """Rows in each raw table, first and last fetch and how many feeds."""
    tables = {
        "raw_feed_fetches": raw.fetches,
        "raw_vehicle_positions": raw.vehicles,
        "raw_trip_stop_updates": raw.stops,
        "raw_alerts": raw.alerts,
        "ingest_errors": raw.errors,
    }
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    window = raw.fetches.agg(
        F.min("fetched_at").alias("first_fetch_at"),
        F.max("fetched_at").alias("last_fetch_at"),
        F.count_distinct("feed_key").alias("distinct_feeds"),
    )
    rows = counts.unionByName(window, allowMissingColumns=True)
    return rows.agg(
        *[
            F.max(F.when(F.col("table") == name, F.col("rows"))).alias(name)
            for name in tables
        ],
        *[F.max(name).alias(name) for name in window.columns],
    )
