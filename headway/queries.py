"""Every operator, model and report as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from headway.functions.labels import SCHEDULE_RELATIONSHIP, VEHICLE_STATUS, enum_label
from headway.functions.times import (
    clock,
    elapsed_seconds,
    epoch_to_ts,
    humanize_seconds,
    iso_utc,
    seconds_between,
)
from headway.functions.trips import parse_trip_id, snapshot_id
from headway.operators import demux, landing, quality, snapshots
from headway.operators.filters import filter_trains
from headway.plans import check_store, drift_store, marts, preview, serving, staging
from headway.plans.build import check_models, rebuild
from headway.schemas import (
    INGEST_ERRORS,
    RAW_ALERTS,
    RAW_FEED_FETCHES,
    RAW_TRIP_STOP_UPDATES,
    RAW_VEHICLE_POSITIONS,
    project,
)
from headway.session import prepare, scratch_dir, stored
from headway.sources import testfeed
from headway.sources.feeds import select_feeds
from headway.sources.gtfs_rt import decode_payloads
from headway.sources.store import Batch, new_source
from headway.sources.tables import (
    RawTables,
    current_version,
    new_version,
    poll_audit,
    publish_version,
    read_models,
    read_raw,
)
from headway.streaming import aggregates, gaps, land

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone (they are UTC), as the test tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _register(name: str, make: Query) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(make(prepare(spark), sf_dir))

    QUERIES[name] = query


def over_events(name: str):
    """A query over the events themselves."""

    def register(make: Callable[[DataFrame], DataFrame]):
        _register(name, lambda spark, sf_dir: make(testfeed.read_events(spark, sf_dir)))
        return make

    return register


def over_raw(name: str):
    """A query over the raw tables."""

    def register(make: Callable[[RawTables], DataFrame]):
        over_events(name)(lambda events: make(testfeed.raw_tables(events)))
        return make

    return register


def over_decoded(name: str):
    """A query over decoded payloads."""

    def register(make: Callable[[DataFrame], DataFrame]):
        over_events(name)(lambda events: make(decode_payloads(testfeed.payloads(events))))
        return make

    return register


def over_snapshots(name: str):
    """A query over the payloads that decoded well."""

    def register(make: Callable[[DataFrame], DataFrame]):
        over_decoded(name)(lambda decoded: make(demux.good_payloads(demux.split_entities(decoded))))
        return make

    return register


def with_spark(name: str):
    """A query that writes tables or runs a stream on its way."""

    def register(make: Query):
        _register(name, make)
        return make

    return register


# Decoding and flattening


@over_decoded("decode_feed")
def _(decoded):
    return decoded.select(
        "path",
        "feed_key",
        "fetched_at",
        F.col("header.version").alias("version"),
        F.nullif("header.timestamp", F.lit(0).cast("long")).alias("header_epoch"),
        F.array_size("entity").alias("entities"),
        "error_type",
    )


over_decoded("decode_rejects")(demux.bad_payloads)


@over_snapshots("demux_entities")
def _(good):
    return (
        demux.rows_by_entity(good)
        .groupBy("fetch_id", "fetched_at", "kind")
        .agg(F.sum("rows").alias("rows"), F.count_distinct("entity_id").alias("entities"))
    )


over_snapshots("flatten_stops")(demux.stop_rows)
over_snapshots("flatten_alerts")(demux.alert_rows)
over_snapshots("project_raw")(demux.vehicle_rows)


@over_snapshots("snapshot_audit")
def _(good):
    return demux.audit_rows(good).drop("payload_bytes")


@over_snapshots("preview_arrivals")
def _(good):
    return demux.stop_rows(good).select(
        "fetch_id",
        "fetched_at",
        "entity_id",
        "stop_index",
        F.coalesce("stop_id", F.lit("?")).alias("stop_id"),
        clock(F.col("arrival_time")).alias("arrival"),
    )


over_snapshots("preview_first_arrivals")(lambda good: preview.first_arrivals(demux.stop_rows(good)))
over_snapshots("preview_first_vehicles")(
    lambda good: preview.first_vehicles(demux.vehicle_rows(good))
)
over_snapshots("preview_routes")(lambda good: preview.trains_per_route(demux.vehicle_rows(good)))
over_snapshots("preview_status")(lambda good: preview.status_mix(demux.vehicle_rows(good)))
over_snapshots("preview_top_alerts")(lambda good: preview.top_alerts(demux.alert_rows(good)))


# Landing


def _payload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test feed's payloads as a stored table, as a poller would leave them."""
    return stored(testfeed.payloads(testfeed.read_events(spark, sf_dir)), "payloads")


def _split_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded payloads, stored: what reads them several times decodes them once."""
    decoded = decode_payloads(testfeed.payloads(testfeed.read_events(spark, sf_dir)))
    return stored(demux.split_entities(decoded), "decoded")


def _in_files(df: DataFrame, part: Column, label: str, parts: int = 4) -> DataFrame:
    """The rows as a stream that takes one file, that is one value of ``part``, at a time."""
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession, label)
    marked = stored(df.withColumn("_part", part.cast("int")), f"{label}-parts")
    for number in range(parts):
        rows = marked.filter(F.col("_part") == number).drop("_part")
        rows.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(folder)


def _second_polls_last(payloads: DataFrame) -> DataFrame:
    """A stream of payloads whose repeated polls come in its last file."""
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")
    part = F.when(F.col("path").endswith("-1.pb"), 3).otherwise(block % 3)
    return _in_files(payloads, part, "arriving")


@with_spark("land_raw")
def _(spark, sf_dir):
    root = scratch_dir(spark, "land")
    landing.land_next(testfeed.payloads(testfeed.read_events(spark, sf_dir)), root)
    return project(read_raw(spark, root).vehicles, RAW_VEHICLE_POSITIONS)


_landed: dict[tuple[str, str], str] = {}


def _landed_root(spark: SparkSession, sf_dir: str) -> str:
    """A root into which the test feed was landed, once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        root = scratch_dir(spark, "landed")
        landing.land_next(_payload_table(spark, sf_dir), root)
        _landed[key] = root
    return _landed[key]


def over_landed(name: str):
    """A query over landed tables."""

    def register(make: Callable[[RawTables], DataFrame]):
        with_spark(name)(lambda spark, sf_dir: make(read_raw(spark, _landed_root(spark, sf_dir))))
        return make

    return register


over_landed("landed_stops")(lambda raw: project(raw.stops, RAW_TRIP_STOP_UPDATES))
over_landed("landed_alerts")(lambda raw: project(raw.alerts, RAW_ALERTS))
over_landed("landed_errors")(lambda raw: project(raw.errors, INGEST_ERRORS))
over_landed("landed_trains")(marts.fct_current_trains)
over_landed("landed_lines")(lambda raw: marts.fct_line_activity(marts.fct_current_trains(raw)))
over_landed("landed_positions")(
    lambda raw: staging.stg_vehicle_positions(raw.vehicles, raw.audit)
)
over_landed("landed_health")(
    lambda raw: marts.dq_ingestion_health(raw, testfeed.LANDED_GAP_SECONDS).drop("payload_bytes")
)


@with_spark("landed_audit")
def _(spark, sf_dir):
    """The audit of what was landed; each payload size next to that of the stored payload."""
    audit = project(read_raw(spark, _landed_root(spark, sf_dir)).fetches, RAW_FEED_FETCHES)
    payloads = _payload_table(spark, sf_dir).select(
        "feed_key", "fetched_at", F.octet_length("payload").alias("_stored")
    )
    sizes = audit.join(payloads, ["feed_key", "fetched_at"], "left")
    difference = (F.col("payload_bytes") - F.col("_stored")).cast("long")
    return sizes.select(*[n for n in audit.columns if n != "payload_bytes"], difference.alias("size_difference"))


def _audit_without_size(raw: RawTables) -> DataFrame:
    return project(raw.fetches, RAW_FEED_FETCHES).drop("payload_bytes")


@with_spark("idempotent_landing")
def _(spark, sf_dir):
    """Every other block is landed as a batch; then all of them arrive as a stream."""
    root = scratch_dir(spark, "land-twice")
    payloads = _payload_table(spark, sf_dir)
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")
    landing.land_next(payloads.filter(block % 2 == 0), root)
    land.stream_land(_second_polls_last(payloads), root).awaitTermination()
    return _audit_without_size(read_raw(spark, root))


@with_spark("concurrent_landing")
def _(spark, sf_dir):
    """A batch of all blocks is held open while every other block is landed and committed."""
    root = scratch_dir(spark, "land-beside")
    payloads = _payload_table(spark, sf_dir)
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")

    def meanwhile() -> None:
        landing.land_next(payloads.filter(block % 2 == 0), root)

    landing.land_batch(payloads, root, Batch(new_source("held"), 0), before_commit=meanwhile)
    return _audit_without_size(read_raw(spark, root))


@with_spark("landed_drift")
def _(spark, sf_dir):
    """Drift rebuilt after half of the blocks were landed, and brought up to date after the rest."""
    root, models = scratch_dir(spark, "land-drift"), scratch_dir(spark, "drift-models")
    payloads = _payload_table(spark, sf_dir)
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")
    for half in (0, 1):
        landing.land_next(payloads.filter(block % 2 == half), root)
        folder = new_version(models)
        drift_store.refresh(spark, root, models, current_version(spark, models), folder)
        publish_version(spark, models, folder)
    return read_models(spark, models, [drift_store.MODEL])[drift_store.MODEL]


@with_spark("poll_audit")
def _(spark, sf_dir):
    good = demux.good_payloads(_split_stored(spark, sf_dir))
    first = landing.first_polls(good)
    audit = demux.audit_rows(good.join(first, ["fetch_id", *landing.POLL_ID], "left_semi"))
    return poll_audit(audit, landing.poll_rows(good)).drop("payload_bytes")


@with_spark("published_only")
def _(spark, sf_dir):
    """Alerts of a root in which the batch with every other block never got its record."""
    root = scratch_dir(spark, "unpublished")
    payloads = _payload_table(spark, sf_dir)
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")
    landing.land_next(payloads.filter(block % 2 == 0), root)
    landing.write_hidden(payloads.filter(block % 2 == 1), root)
    return project(read_raw(spark, root).alerts, RAW_ALERTS)


@with_spark("cycle_counters")
def _(spark, sf_dir):
    split = _split_stored(spark, sf_dir)
    landed = demux.good_payloads(split).filter("feed_key = 'F0'")
    return landing.cycle_counters(landing.classify_polls(split, landed))


over_events("error_quarantine")(lambda events: landing.quarantine(testfeed.errors(events)))
over_raw("select_feeds")(
    lambda raw: select_feeds(raw.vehicles, " F0 , F2,", testfeed.CATALOGUE).select(
        "fetch_id", "feed_key", "entity_id"
    )
)
over_raw("store_summary")(landing.store_summary)
over_raw("store_status")(lambda raw: serving.store_status(raw, testfeed.AS_OF))


# Single functions, over columns of the events


def _epoch() -> Column:
    known = F.col("event_id") % 5
    return F.when(known != 0, F.col("event_id") + 1_704_067_200).when(F.col("event_id") % 2 == 0, 0)


@over_events("epoch_to_ts")
def _(events):
    return events.select("event_id", epoch_to_ts(_epoch()).alias("instant"))


@over_events("parse_trip_id")
def _(events):
    good = testfeed.observations(events)
    shape = F.col("event_id") % 8
    origin = F.substring("trip_id", 1, 6)
    trip = (
        F.when(shape == 0, F.concat(origin, F.lit("_FS.S11R")))
        .when(shape == 1, F.concat(origin, F.lit("_7..SOUTH FERRY")))
        .when(shape == 2, F.concat(origin, F.lit("_6X..N")))
        .when(shape == 3, F.concat(origin, F.lit("_1..")))
        .when(shape == 4, F.col("props"))
        .when(shape == 5, F.lit(None))
        .otherwise(F.col("trip_id"))
    )
    rows = good.select("event_id", trip.alias("trip_id"))
    return rows.select("*", *parse_trip_id(F.col("trip_id")))


@over_events("decode_enums")
def _(events):
    number = (F.col("event_id") % 6).cast("int")
    return events.select(
        "event_id",
        enum_label(number, VEHICLE_STATUS).alias("current_status"),
        enum_label(number, SCHEDULE_RELATIONSHIP).alias("schedule_relationship"),
    )


@over_events("snapshot_id")
def _(events):
    header = F.when(F.col("event_id") % 3 != 0, F.col("header_timestamp"))
    fetched = F.when(F.col("event_id") % 2 == 0, F.col("fetched_at")).otherwise(
        F.date_trunc("second", "fetched_at")
    )
    return testfeed.observations(events).select(
        "event_id",
        iso_utc(fetched).alias("fetched_iso"),
        snapshot_id(F.col("feed_key"), header, fetched).alias("fetch_id"),
    )


@over_events("seconds_between")
def _(events):
    rows = testfeed.observations(events)
    return rows.select(
        "event_id",
        seconds_between(F.col("header_timestamp"), F.col("fetched_at")).alias("whole_seconds"),
        elapsed_seconds(F.col("header_timestamp"), F.col("fetched_at")).alias("elapsed_seconds"),
    )


@over_events("humanize_seconds")
def _(events):
    seconds = F.when(F.col("event_id") % 9 != 0, F.col("value") * (F.col("event_id") % 50))
    return events.select("event_id", humanize_seconds(seconds).alias("age"))


# Models and the steps they are made of

over_raw("stg_vehicle_positions")(
    lambda raw: staging.stg_vehicle_positions(raw.vehicles, raw.fetches)
)
over_raw("stg_trip_stop_updates")(lambda raw: staging.stg_trip_stop_updates(raw.stops))
over_raw("stg_alerts")(lambda raw: staging.stg_alerts(raw.alerts))
over_raw("snapshot_recency")(lambda raw: snapshots.snapshot_recency(raw.fetches))


def _newest(raw: RawTables, rows: DataFrame) -> DataFrame:
    return snapshots.only_newest(rows, snapshots.newest_snapshots(raw.vehicles))


over_raw("latest_positions")(lambda raw: staging.positions(_newest(raw, raw.vehicles)))
over_raw("next_stop")(lambda raw: marts.next_stops(staging.stg_trip_stop_updates(raw.stops)))
over_raw("following_stop")(
    lambda raw: marts.following_stops(staging.stg_trip_stop_updates(raw.stops))
)
over_raw("trip_alerts")(lambda raw: marts.trip_alerts(staging.stg_alerts(raw.alerts)))
over_raw("current_trains")(marts.fct_current_trains)
over_raw("line_activity")(lambda raw: marts.fct_line_activity(marts.fct_current_trains(raw)))
over_raw("prediction_drift")(marts.fct_prediction_drift)


def _health(raw: RawTables) -> DataFrame:
    return marts.dq_ingestion_health(raw, testfeed.GAP_SECONDS)


over_raw("ingestion_health")(_health)


@over_raw("ingestion_gaps")
def _(raw):
    return snapshots.with_gaps(raw.fetches, testfeed.GAP_SECONDS).select(
        "fetch_id",
        "feed_key",
        "header_timestamp",
        "seconds_since_previous_snapshot",
        "is_after_ingestion_gap",
    )


# Reports


def _served(raw: RawTables) -> DataFrame:
    return serving.current_trains(marts.fct_current_trains(raw))


def _drift_lines(raw: RawTables) -> DataFrame:
    return serving.drift_by_line(marts.fct_prediction_drift(raw))


def _lines(raw: RawTables) -> DataFrame:
    return marts.fct_line_activity(marts.fct_current_trains(raw))


over_raw("line_activity_served")(lambda raw: serving.line_activity(_lines(raw)))
over_raw("current_trains_served")(_served)
over_raw("lines_available")(lambda raw: serving.lines_available(_served(raw)))
over_raw("filter_trains")(
    lambda raw: filter_trains(_served(raw), ["1", "2", "3", "5"], "Northbound", True)
)
over_raw("drift_by_line")(_drift_lines)
over_raw("drift_seconds_by_line")(
    lambda raw: serving.drift_seconds_by_line(marts.fct_prediction_drift(raw))
)
over_raw("drift_leaders")(lambda raw: serving.drift_leaders(marts.fct_prediction_drift(raw)))
over_raw("drift_sides")(lambda raw: serving.drift_sides(_drift_lines(raw)))
over_raw("drift_sides_labelled")(
    lambda raw: serving.drift_sides_labelled(serving.drift_sides(_drift_lines(raw)))
)
over_raw("pipeline_health")(lambda raw: serving.pipeline_health(_health(raw)))
over_raw("health_rollup")(
    lambda raw: serving.health_rollup(serving.pipeline_health(_health(raw)))
)
over_raw("freshness")(lambda raw: serving.freshness(raw, testfeed.AS_OF))
over_raw("recent_error_count")(lambda raw: serving.recent_error_count(raw.errors, testfeed.AS_OF))
over_raw("recent_errors")(lambda raw: serving.recent_errors(raw.errors))


def _stale(raw: RawTables) -> DataFrame:
    return serving.model_staleness(raw.fetches, marts.fct_current_trains(raw))


over_raw("model_staleness")(_stale)
over_raw("freshness_verdict")(
    lambda raw: serving.freshness_verdict(serving.freshness(raw, testfeed.AS_OF), _stale(raw))
)
over_raw("headline_numbers")(lambda raw: serving.headline_numbers(_lines(raw), _drift_lines(raw)))


# Data checks


def _positions(raw: RawTables) -> DataFrame:
    return staging.stg_vehicle_positions(raw.vehicles, raw.fetches)


over_raw("dq_unique")(
    lambda raw: quality.unique(_positions(raw), "trip_id", "snapshot_recency_rank = 1")
)
over_raw("dq_not_null")(
    lambda raw: quality.not_null(staging.stg_alerts(raw.alerts), "trip_id").select(
        "fetch_id", "entity_id"
    )
)
over_raw("dq_accepted_values")(
    lambda raw: quality.accepted_values(
        staging.positions(raw.vehicles), "current_status", list(VEHICLE_STATUS.values())
    ).select("snapshot_train_key", "current_status")
)
over_raw("dq_relationships")(
    lambda raw: quality.relationships(
        staging.positions(raw.vehicles),
        "fetch_id",
        raw.fetches.filter("poll_count > 1"),
        "fetch_id",
    ).select("snapshot_train_key", "fetch_id")
)
over_raw("dq_positive_value")(
    lambda raw: quality.positive_value(_lines(raw), "trains_delayed").select(
        "feed_key", "route_id", "trains_delayed"
    )
)
over_raw("dq_at_most")(
    lambda raw: quality.at_most(_lines(raw), "trains_running", 10).select(
        "feed_key", "route_id", "trains_running"
    )
)
over_raw("dq_freshness")(lambda raw: quality.source_freshness(raw, testfeed.AS_OF))
over_raw("dq_ingestion_gaps")(lambda raw: quality.ingestion_gaps(_health(raw)))


@over_raw("dq_plausible_counts")
def _(raw):
    """A lower bound than the declared one, as the test feed's lines are short."""
    return quality.plausible_train_counts(_lines(raw), testfeed.MANY_TRAINS)


@over_raw("dq_prediction_coverage")
def _(raw):
    """Predictions of trains at odd stops are blanked, so that the check has something to find."""
    trains = marts.fct_current_trains(raw)
    odd = F.col("current_stop_id").cast("int") % 2 == 1
    return quality.prediction_coverage(
        trains.withColumn("next_stop_id", F.when(~odd, F.col("next_stop_id")))
    )


@with_spark("dq_report")
def _(spark, sf_dir):
    raw = testfeed.raw_tables(testfeed.read_events(spark, sf_dir))
    models = rebuild(spark, raw, scratch_dir(spark, "models"), testfeed.GAP_SECONDS)
    return check_models(raw, models)


@with_spark("landed_report")
def _(spark, sf_dir):
    """The checks after half of the blocks were landed, and again after the rest."""
    root, folder = scratch_dir(spark, "land-checked"), scratch_dir(spark, "checked-models")
    payloads = _payload_table(spark, sf_dir)
    block = F.regexp_extract("path", r"^block-(\d+)-", 1).cast("long")
    for half in (0, 1):
        landing.land_next(payloads.filter(block % 2 == half), root)
        raw = read_raw(spark, root)
        models = rebuild(spark, raw, folder, testfeed.LANDED_GAP_SECONDS, root)
        report = check_store.check_landed(spark, root, folder, raw, models)
    return report


# Streams, each over several files taken one at a time


def _events_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of four files, a week and a half each, that end within days."""
    days = (F.unix_seconds(F.col("ts").cast("timestamp")) - F.lit(testfeed.FIRST_EVENT)) / 86_400
    part = F.greatest(F.lit(0), F.least(F.floor(days / 7.5), F.lit(3)))
    return _in_files(testfeed.read_events(spark, sf_dir), part, "events")


@with_spark("stream_land")
def _(spark, sf_dir):
    root = scratch_dir(spark, "stream-land")
    land.stream_land(_second_polls_last(_payload_table(spark, sf_dir)), root).awaitTermination()
    return _audit_without_size(read_raw(spark, root))


@with_spark("stream_dedupe")
def _(spark, sf_dir):
    root = scratch_dir(spark, "stream-dedupe")
    polls = testfeed.poll_log(_events_in_files(spark, sf_dir))
    land.stream_dedupe(polls, root).awaitTermination()
    return land.read_snapshots(spark, root)


@with_spark("stream_poll_count")
def _(spark, sf_dir):
    root = scratch_dir(spark, "stream-polls")
    polls = testfeed.poll_log(_events_in_files(spark, sf_dir))
    aggregates.stream_poll_count(polls, root).awaitTermination()
    return aggregates.read_poll_counts(spark, root)


@with_spark("stream_drift")
def _(spark, sf_dir):
    root = scratch_dir(spark, "stream-drift")
    stops = testfeed.stops(_events_in_files(spark, sf_dir))
    aggregates.stream_drift(stops, root).awaitTermination()
    return aggregates.read_drift(spark, root)


@with_spark("stream_gaps")
def _(spark, sf_dir):
    root = scratch_dir(spark, "stream-gaps")
    polls = testfeed.poll_log(_events_in_files(spark, sf_dir))
    land.stream_dedupe(polls, root).awaitTermination()
    gaps.stream_gaps(land.read_snapshot_stream(spark, root, 1), root).awaitTermination()
    return gaps.read_gaps(spark, root, testfeed.GAP_SECONDS)


@with_spark("stream_gaps_late")
def _(spark, sf_dir):
    """Days dealt to files in turn, so most snapshots come after a later one."""
    root = scratch_dir(spark, "stream-late")
    days = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - F.lit(testfeed.FIRST_EVENT)) / 86_400)
    events = _in_files(testfeed.read_events(spark, sf_dir), F.pmod(-days, F.lit(4)), "late-events")
    land.stream_dedupe(testfeed.poll_log(events), root).awaitTermination()
    gaps.stream_gaps(land.read_snapshot_stream(spark, root, 1), root).awaitTermination()
    return gaps.read_gaps(spark, root, testfeed.GAP_SECONDS).drop("is_late")
