"""Staging: raw rows with keys, flags and derived times. Lazy, never stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.times import seconds_between
from headway.functions.trips import joined_key, trip_key
from headway.operators.skew import attach_group_stats
from headway.operators.snapshots import landed_recency, snapshot_recency, with_recency
from headway.schemas import REUSED_IDS


def keyed_positions(vehicles: DataFrame, *more: Column) -> DataFrame:
    """Train positions with what can be told from one row: keys, ages and a flag."""
    return vehicles.select(
        joined_key(F.col("fetch_id"), F.col("entity_id")).alias("snapshot_train_key"),
        trip_key(F.col("trip_id"), F.col("start_date")).alias("trip_key"),
        "fetch_id",
        "feed_key",
        "entity_id",
        "trip_id",
        "start_date",
        "route_id",
        "direction",
        "trip_path",
        "stop_id",
        "current_status",
        "current_stop_sequence",
        "header_timestamp",
        "fetched_at",
        "vehicle_timestamp",
        seconds_between(F.col("header_timestamp"), F.col("fetched_at")).alias(
            "ingest_lag_seconds"
        ),
        seconds_between(F.col("vehicle_timestamp"), F.col("header_timestamp")).alias(
            "position_age_seconds"
        ),
        "origin_departure_seconds",
        *more,
        F.col("direction").isNull().alias("is_unparsed_trip_id"),
    )


def positions(vehicles: DataFrame) -> DataFrame:
    """Train positions, flagged where their snapshot has the trip id more than once.

    Only the few reused (snapshot, trip id) pairs are joined back; every other
    row is false.
    """
    reused = attach_group_stats(
        vehicles,
        ["fetch_id", "trip_id"],
        [F.count(F.lit(1)).alias("_sharing")],
        spread_by=["entity_id", "stop_id"],
        having=F.col("_sharing") > 1,
    )
    flag = F.col("_sharing").isNotNull().alias("has_reused_trip_id")
    return keyed_positions(reused, flag)


def stg_vehicle_positions(vehicles: DataFrame, audit: DataFrame) -> DataFrame:
    """One row per train and snapshot, over all history.

    The audit tells which snapshots have trains, so the recency rank needs no
    pass over the positions. That of a landing root also tells which trip ids a
    snapshot has more than once: then positions are read once, and all that is
    joined to them is a row per snapshot.
    """
    if REUSED_IDS in audit.columns:
        known = landed_recency(audit).withColumnRenamed("fetch_id", "_of")
        rows = vehicles.join(known, vehicles["fetch_id"] == known["_of"], "left")
        reused = F.exists(REUSED_IDS, lambda x: x.eqNullSafe(F.col("trip_id")))
        flag = F.coalesce(reused, F.lit(False)).alias("has_reused_trip_id")
        rank = "snapshot_recency_rank"
        keyed = keyed_positions(rows, flag, F.col(rank))
        return keyed.select(*[name for name in keyed.columns if name != rank], rank)
    recency = snapshot_recency(audit.filter(F.col("vehicle_rows") > 0))
    return with_recency(positions(vehicles), recency, spread_by=["snapshot_train_key"])


def stg_trip_stop_updates(stops: DataFrame) -> DataFrame:
    """One row per upcoming stop, trip and snapshot that has a predicted arrival."""
    return stops.filter(F.col("arrival_time").isNotNull()).select(
        joined_key(F.col("fetch_id"), F.col("entity_id"), F.col("stop_index")).alias(
            "snapshot_stop_key"
        ),
        trip_key(F.col("trip_id"), F.col("start_date")).alias("trip_key"),
        "fetch_id",
        "feed_key",
        "entity_id",
        "trip_id",
        "start_date",
        "route_id",
        "direction",
        "stop_index",
        "stop_id",
        "schedule_relationship",
        "header_timestamp",
        "fetched_at",
        "arrival_time",
        "departure_time",
        (F.col("stop_index") == 0).alias("is_next_stop"),
        seconds_between(F.col("header_timestamp"), F.col("arrival_time")).alias(
            "seconds_to_arrival"
        ),
    )


def stg_alerts(alerts: DataFrame) -> DataFrame:
    """One row per affected trip, alert and snapshot."""
    return alerts.select(
        "fetch_id",
        "feed_key",
        "entity_id",
        "alert_header",
        "trip_id",
        "start_date",
        "route_id",
        "direction",
        trip_key(F.col("trip_id"), F.col("start_date")).alias("trip_key"),
        "header_timestamp",
        "fetched_at",
        F.lower(F.coalesce("alert_header", F.lit(""))).contains("delay").alias("is_delay_alert"),
        F.col("trip_id").isNotNull().alias("is_trip_level"),
    )
