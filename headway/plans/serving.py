"""Reports over the marts and the raw audit tables.

Each returns a DataFrame. Reports that ask "how old" take ``as_of``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import LOSING_TIME, MAKING_UP_TIME, freshness_level
from headway.functions.times import elapsed_seconds, humanize_seconds, instant, seconds_between
from headway.operators.filters import ordered, since, top
from headway.operators.medians import middle_values
from headway.sources.tables import RawTables

Moment = datetime | str | Column

# Thresholds of the reports.
RECENT_MINUTES = 15
MODEL_LAG_SECONDS = 120
LOST_MINUTES = 2
LABELLED_TRIPS = 3


def line_activity(lines: DataFrame) -> DataFrame:
    return ordered(lines, "route_id", "feed_key").select(
        "route_id",
        "trains_running",
        "trains_northbound",
        "trains_southbound",
        "trains_at_station",
        "trains_in_transit",
        "trains_arriving",
        "trains_delayed",
        "pct_delayed",
        "median_minutes_to_next_stop",
        "max_minutes_to_next_stop",
        "trains_missing_prediction",
        "trains_with_reused_trip_id",
        "snapshot_at",
    )


def current_trains(trains: DataFrame) -> DataFrame:
    """The train table. ``next_stop`` is the one after the stop a train is at."""
    rows = trains.select(
        F.col("route_id").alias("line"),
        "direction",
        F.col("status_label").alias("status"),
        F.col("current_stop_id").alias("at_stop"),
        F.col("following_stop_id").alias("next_stop"),
        "minutes_to_next_stop",
        "trip_id",
        "has_reused_trip_id",
        "alert_text",
        "snapshot_at",
    )
    return ordered(rows, "line", "direction", "minutes_to_next_stop")


def lines_available(trains: DataFrame) -> DataFrame:
    """Lines a reader can pick, from the served train table."""
    return ordered(trains.select("line").filter(F.col("line").isNotNull()).distinct(), "line")


def drift_by_line(drift: DataFrame) -> DataFrame:
    """Drift per line over its trips, each trip counting once however many stops it has.

    A line's trips are those of all time, so their median is selected by counts.
    Minutes of trips are rounded to tenths, which are whole numbers.
    """
    trips = (
        drift.filter(F.col("route_id").isNotNull())
        .groupBy("route_id", "trip_key")
        .agg(F.min("trip_median_drift_minutes").alias("trip_drift"))
    )
    trip_drift = F.col("trip_drift")
    lines = trips.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("trips_observed"),
        F.count_if(trip_drift > LOST_MINUTES).alias("trips_losing_time"),
        F.count_if(trip_drift < -LOST_MINUTES).alias("trips_making_up_time"),
    )
    middle = middle_values(trips, ["route_id"], F.round(trip_drift * 10))
    middle = middle.withColumn("median_drift_minutes", F.round(F.expr("0.5D * (lower / 10D) + 0.5D * (upper / 10D)"), 2))
    lines = lines.join(middle, "route_id", "left").select(
        "route_id", "trips_observed", "median_drift_minutes", "trips_losing_time", "trips_making_up_time"
    )
    return ordered(lines, "route_id")


def drift_seconds_by_line(drift: DataFrame) -> DataFrame:
    """The median drift of a line's stops, in seconds; stops without a line are one group."""
    middle = middle_values(drift, ["route_id"], F.col("drift_seconds"))
    return middle.select("route_id", F.expr("0.5D * lower + 0.5D * upper").alias("median_drift_seconds"))


def drift_leaders(drift: DataFrame, limit: int = 10) -> DataFrame:
    """The trips whose predictions slipped most."""
    trips = drift.select(
        "trip_id",
        F.col("route_id").alias("line"),
        "direction",
        F.col("trip_stops_observed").alias("stops_observed"),
        F.col("trip_median_drift_minutes").alias("drift_minutes"),
    ).distinct()
    return top(trips, "drift_minutes", limit, "trip_id", "line", "direction", "stops_observed")


def drift_sides(lines: DataFrame) -> DataFrame:
    """Trips losing and making up time as two signed rows per line, for a diverging chart.

    ``axis_limit`` is the symmetric reach of the axis, the same on every row.
    """
    sides = lines.select(
        "route_id",
        "trips_observed",
        "median_drift_minutes",
        F.explode(
            F.array(
                F.struct(
                    F.lit(LOSING_TIME).alias("side"), F.col("trips_losing_time").alias("trips")
                ),
                F.struct(
                    F.lit(MAKING_UP_TIME).alias("side"),
                    (-F.col("trips_making_up_time")).alias("trips"),
                ),
            )
        ).alias("arm"),
    ).select("route_id", "arm.side", "arm.trips", "trips_observed", "median_drift_minutes")
    reach = lines.agg(
        F.greatest(
            F.lit(2.0).cast("double"),
            F.max(F.greatest("trips_losing_time", "trips_making_up_time")) * F.lit(1.25).cast("double"),
        )
    )
    return sides.select(
        "*", F.abs("trips").alias("trips_abs"), reach.scalar().alias("axis_limit")
    )


def drift_sides_labelled(sides: DataFrame) -> DataFrame:
    """The bars long enough to carry a number."""
    return sides.filter(F.abs("trips") >= LABELLED_TRIPS)


def pipeline_health(health: DataFrame, limit: int = 60) -> DataFrame:
    """The newest snapshots and how they were ingested."""
    return top(health, "snapshot_at", limit, "feed_key", "fetch_id").select(
        "snapshot_at",
        "feed_key",
        "vehicle_rows",
        "trip_stop_rows",
        "delay_alert_rows",
        "poll_count",
        "seconds_since_previous_snapshot",
        "pct_rows_with_reused_trip_id",
        "pct_rows_with_unparsed_trip_id",
        "avg_ingest_lag_seconds",
        "avg_position_age_seconds",
        "payload_bytes",
        "is_after_ingestion_gap",
    )


def health_rollup(newest: DataFrame) -> DataFrame:
    """Vital signs over the snapshots of ``pipeline_health``."""
    return newest.agg(
        F.median("seconds_since_previous_snapshot").alias("median_gap_seconds"),
        F.round(F.avg("avg_ingest_lag_seconds"), 1).alias("avg_ingest_lag_seconds"),
        F.round(F.avg("pct_rows_with_reused_trip_id"), 2).alias("avg_pct_reused_trip_id"),
        F.count_if("is_after_ingestion_gap").alias("ingestion_gaps"),
    )


def recent_error_count(errors: DataFrame, as_of: Moment) -> DataFrame:
    recent = errors.filter(since("occurred_at", instant(as_of), RECENT_MINUTES))
    return recent.agg(F.count(F.lit(1)).alias("recent_errors"))


def freshness(raw: RawTables, as_of: Moment) -> DataFrame:
    """How current the data is: one row."""
    return raw.fetches.agg(
        F.max("header_timestamp").alias("latest_snapshot_at"),
        F.max("last_polled_at").alias("last_poll_at"),
        F.count(F.lit(1)).alias("total_snapshots"),
        F.count_distinct("feed_key").alias("feeds"),
    ).select(
        "*",
        elapsed_seconds(F.col("latest_snapshot_at"), instant(as_of)).alias("age_seconds"),
        recent_error_count(raw.errors, as_of).scalar().alias("recent_errors"),
    )


def model_staleness(fetches: DataFrame, current_trains: DataFrame) -> DataFrame:
    """How far the models are behind the raw tables: one row."""
    newest_model = current_trains.agg(F.max("snapshot_at"))
    return fetches.agg(F.max("header_timestamp").alias("raw_latest_at")).select(
        "raw_latest_at", newest_model.scalar().alias("model_latest_at")
    ).select(
        "*",
        elapsed_seconds(F.col("model_latest_at"), F.col("raw_latest_at")).alias("lag_seconds"),
    )


def freshness_verdict(fresh: DataFrame, stale: DataFrame) -> DataFrame:
    """The banner: how alive ingestion looks, and whether the models lag behind it."""
    lag = stale.select("lag_seconds").scalar()
    rows = fresh.select("*", lag.alias("model_lag_seconds"))
    lagging = F.col("model_lag_seconds") > MODEL_LAG_SECONDS
    return rows.select(
        freshness_level(F.col("age_seconds")).alias("verdict"),
        humanize_seconds(F.col("age_seconds")).alias("age"),
        "total_snapshots",
        "recent_errors",
        F.when(lagging, humanize_seconds(F.col("model_lag_seconds"))).alias("models_behind"),
    )


def recent_errors(errors: DataFrame, limit: int = 20) -> DataFrame:
    ties = ("feed_key", "error_type", "error_message")
    return top(errors, "occurred_at", limit, *ties).select("occurred_at", *ties)


def headline_numbers(lines: DataFrame, drift_lines: DataFrame) -> DataFrame:
    """Totals for the head of the page: one row, zeros where there is nothing."""

    def total(df: DataFrame, column: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long"))

    return lines.agg(
        F.coalesce(F.sum("trains_running"), F.lit(0)).cast("long").alias("trains_running"),
        F.count(F.lit(1)).alias("lines_reporting"),
        F.coalesce(F.sum("trains_delayed"), F.lit(0)).cast("long").alias("trains_delayed"),
    ).select(
        "*",
        total(drift_lines, "trips_losing_time").scalar().alias("trips_losing_time"),
        total(drift_lines, "trips_making_up_time").scalar().alias("trips_making_up_time"),
    )


def store_status(raw: RawTables, as_of: Moment) -> DataFrame:
    """What a status command prints: one row."""
    return raw.fetches.agg(
        F.count(F.lit(1)).alias("snapshots"), F.max("header_timestamp").alias("newest")
    ).select(
        "*",
        seconds_between(F.col("newest"), instant(as_of)).alias("age_seconds"),
        raw.errors.agg(F.count(F.lit(1))).scalar().alias("ingest_errors"),
    )
