"""Marts: current trains, line activity, prediction drift, ingestion health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import drift_label, percent, status_label
from headway.functions.times import minutes, seconds_between
from headway.operators.skew import attach_group_stats, salted_left_join
from headway.operators.snapshots import (
    GAP_SECONDS,
    newest_landed,
    newest_snapshots,
    only_newest,
    with_gaps,
)
from headway.plans.staging import positions, stg_alerts, stg_trip_stop_updates
from headway.sources.tables import RawTables

# A prediction counts as ahead of the train when first seen this far before.
AHEAD_SECONDS = 60
OBSERVED_NAMES = ("trip_id", "route_id", "direction")


def next_stops(stops: DataFrame) -> DataFrame:
    """The next predicted stop of a train, one row per snapshot, trip, date and stop.

    Two updates that agree on all four would double a train in the join below;
    the smallest entity id stays.
    """
    keys = ["fetch_id", "trip_id", "start_date", "stop_id"]
    kept = F.min(
        F.struct(
            F.col("entity_id").isNull().alias("unnamed"),
            F.col("entity_id").alias("trip_update_entity_id"),
            F.col("arrival_time").alias("next_stop_arrival_time"),
            F.col("seconds_to_arrival").alias("seconds_to_next_stop"),
        )
    )
    rows = stops.filter("is_next_stop").groupBy(*keys).agg(kept.alias("kept"))
    return rows.select(*keys, "kept.*").drop("unnamed")


def following_stops(stops: DataFrame) -> DataFrame:
    """The stop after the next one, by the entity that predicts it."""
    return stops.filter(F.col("stop_index") == 1).select(
        "fetch_id",
        F.col("entity_id").alias("trip_update_entity_id"),
        F.col("stop_id").alias("following_stop_id"),
        F.col("arrival_time").alias("following_stop_arrival_time"),
    )


def trip_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts naming a trip, one row per snapshot and trip."""
    texts = F.collect_set("alert_header")
    return (
        alerts.filter("is_trip_level")
        .groupBy("fetch_id", "trip_key")
        .agg(
            F.bool_or("is_delay_alert").alias("has_delay_alert"),
            F.count(F.lit(1)).alias("alert_count"),
            F.when(F.size(texts) > 0, F.array_join(F.array_sort(texts), "; ")).alias("alert_text"),
        )
    )


def fct_current_trains(raw: RawTables) -> DataFrame:
    """Every train in its feed's newest snapshot, with its prediction and alerts.

    All three inputs are cut down to the newest snapshots before anything is
    grouped or joined. A position and a prediction are different entities, so
    they meet on snapshot, trip, start date and stop. The sides joined on have
    one row per key, which keeps one row per train.
    """
    landed = "snapshot_date" in raw.fetches.columns
    newest = newest_landed(raw.fetches) if landed else newest_snapshots(raw.vehicles)
    trains = positions(only_newest(raw.vehicles, newest))
    stops = stg_trip_stop_updates(only_newest(raw.stops, newest))
    alerts = stg_alerts(only_newest(raw.alerts, newest))

    predicted = (
        next_stops(stops)
        .join(following_stops(stops), ["fetch_id", "trip_update_entity_id"], "left")
        .select(
            F.col("fetch_id").alias("on_fetch"),
            F.col("trip_id").alias("on_trip"),
            F.coalesce("start_date", F.lit("")).alias("on_date"),
            F.col("stop_id").alias("on_stop"),
            F.col("stop_id").alias("next_stop_id"),
            "next_stop_arrival_time",
            "seconds_to_next_stop",
            "following_stop_id",
            "following_stop_arrival_time",
        )
    )
    with_prediction = salted_left_join(
        trains.withColumn("_date", F.coalesce("start_date", F.lit(""))),
        predicted,
        [("fetch_id", "on_fetch"), ("trip_id", "on_trip"), ("_date", "on_date"), ("stop_id", "on_stop")],
        spread_by=["entity_id"],
    )
    rows = salted_left_join(
        with_prediction,
        trip_alerts(alerts),
        [("fetch_id", "fetch_id"), ("trip_key", "trip_key")],
        spread_by=["entity_id"],
    )
    delayed = F.coalesce("has_delay_alert", F.lit(False))
    return rows.select(
        "snapshot_train_key",
        "trip_key",
        "feed_key",
        "fetch_id",
        "entity_id",
        "trip_id",
        "route_id",
        "direction",
        "start_date",
        "current_status",
        F.col("stop_id").alias("current_stop_id"),
        "current_stop_sequence",
        "next_stop_id",
        "next_stop_arrival_time",
        "seconds_to_next_stop",
        minutes(F.col("seconds_to_next_stop")).alias("minutes_to_next_stop"),
        "following_stop_id",
        "following_stop_arrival_time",
        delayed.alias("has_delay_alert"),
        "alert_text",
        "has_reused_trip_id",
        "is_unparsed_trip_id",
        "position_age_seconds",
        "ingest_lag_seconds",
        F.col("header_timestamp").alias("snapshot_at"),
        "fetched_at",
        status_label(delayed, F.col("current_status")).alias("status_label"),
    )


def fct_line_activity(current_trains: DataFrame) -> DataFrame:
    """What every line is doing in the newest snapshot."""

    def trains(condition):
        return F.count_if(condition)

    status = F.col("current_status")
    to_next = "minutes_to_next_stop"
    lines = (
        current_trains.filter(F.col("route_id").isNotNull())
        .groupBy("feed_key", "route_id")
        .agg(
            F.max("snapshot_at").alias("snapshot_at"),
            F.count(F.lit(1)).alias("trains_running"),
            trains(F.col("direction") == "N").alias("trains_northbound"),
            trains(F.col("direction") == "S").alias("trains_southbound"),
            trains(status == "STOPPED_AT").alias("trains_at_station"),
            trains(status == "IN_TRANSIT_TO").alias("trains_in_transit"),
            trains(status == "INCOMING_AT").alias("trains_arriving"),
            trains(F.col("has_delay_alert")).alias("trains_delayed"),
            F.round(F.median(to_next), 1).alias(f"median_{to_next}"),
            F.round(F.max(to_next), 1).alias(f"max_{to_next}"),
            trains(F.col("has_reused_trip_id")).alias("trains_with_reused_trip_id"),
            trains(F.col("next_stop_id").isNull()).alias("trains_missing_prediction"),
        )
    )
    running = F.col("trains_running")
    return lines.withColumns(
        {
            "pct_delayed": percent(F.col("trains_delayed"), running, 1),
            "pct_missing_prediction": percent(F.col("trains_missing_prediction"), running, 1),
        }
    )


def _sightings(stops: DataFrame, *more: str) -> DataFrame:
    """Each stop update as an observation of its own, ready to be merged.

    Which sighting is first or last is told by one number: the publish time,
    and among equals the sooner arrival, at both ends, so that two trains
    sharing a trip id do not seem to drift. Both are whole seconds of 13 digits
    at most, so 14 digits hold any arrival; the number has a fixed width and is
    updated in place by a hash aggregate.
    """
    arrival = F.unix_seconds("arrival_time").cast("decimal(14,0)")
    published = F.unix_seconds("header_timestamp").cast("decimal(14,0)") * F.lit(10**14).cast("decimal(15,0)")
    return stops.select(
        "trip_key",
        "stop_id",
        *OBSERVED_NAMES,
        *more,
        F.lit(1).cast("long").alias("observation_count"),
        F.col("header_timestamp").alias("first_observed_at"),
        F.col("header_timestamp").alias("last_observed_at"),
        F.col("arrival_time").alias("first_predicted_arrival"),
        F.col("arrival_time").alias("last_predicted_arrival"),
        (published + arrival).cast("decimal(38,0)").alias("_first"),
        (published - arrival).cast("decimal(38,0)").alias("_last"),
    )


_MERGE = {
    "observation_count": F.sum,
    "first_observed_at": F.min,
    "last_observed_at": F.max,
    "first_predicted_arrival": lambda arrival: F.min_by(arrival, "_first"),
    "last_predicted_arrival": lambda arrival: F.max_by(arrival, "_last"),
    "_first": F.min,
    "_last": F.max,
}


def _merged() -> list[Column]:
    return [merge(name).alias(name) for name, merge in _MERGE.items()]


def named_observations(observations: DataFrame) -> DataFrame:
    """Observations merged to one per stop of a trip, with one name of each kind."""
    names = [F.min(name).alias(name) for name in OBSERVED_NAMES]
    ahead = seconds_between(F.col("first_observed_at"), F.col("first_predicted_arrival"))
    return (
        observations.groupBy("trip_key", "stop_id")
        .agg(*names, *_merged())
        .drop("_first", "_last")
        .withColumn("first_seconds_to_arrival", ahead)
    )


def drift_observations(stops: DataFrame) -> DataFrame:
    """First and last prediction seen for every stop of every trip.

    Merged with the names as keys first: without text in its buffers that is a
    hash aggregate, which reduces the history on the map side without sorting
    it. What is left, about a row per stop and trip, is merged again.
    """
    return named_observations(partial_observations(stops))


def partial_observations(stops: DataFrame, *within: str) -> DataFrame:
    """Observations of some stop updates, apart ``within`` more columns; they merge with others."""
    return _sightings(stops, *within).groupBy("trip_key", "stop_id", *OBSERVED_NAMES, *within).agg(*_merged())


def running_observations(stops: DataFrame) -> DataFrame:
    """The same in one aggregation, as a stream may hold only one."""
    return named_observations(_sightings(stops))


def drift_from_observations(observed: DataFrame) -> DataFrame:
    """Drift per stop, and per trip as the median over its stops."""
    drift = seconds_between(F.col("first_predicted_arrival"), F.col("last_predicted_arrival"))
    window = seconds_between(F.col("first_observed_at"), F.col("last_observed_at"))
    scored = (
        observed.filter(
            (F.col("observation_count") >= 2)
            & (F.col("first_seconds_to_arrival") > AHEAD_SECONDS)
        )
        .drop("first_seconds_to_arrival")
        .withColumn("drift_seconds", drift)
        .withColumn("drift_minutes", minutes(F.col("drift_seconds")))
        .withColumn("observation_window_seconds", window)
    )
    trips = attach_group_stats(
        scored,
        ["trip_key"],
        [
            minutes(F.median("drift_seconds")).alias("trip_median_drift_minutes"),
            F.count(F.lit(1)).alias("trip_stops_observed"),
        ],
        spread_by=["stop_id"],
    )
    return trips.withColumn("drift_label", drift_label(F.col("drift_seconds")))


def fct_prediction_drift(raw: RawTables) -> DataFrame:
    """How far the predicted arrival at a stop moved between first and last sight.

    Lazy. Both the rows and their trip medians come from the observations, so a
    rebuild stores those in between.
    """
    return drift_from_observations(drift_observations(stg_trip_stop_updates(raw.stops)))


def position_health(vehicles: DataFrame) -> DataFrame:
    """Row counts and feed quality of each snapshot's positions.

    Counted per trip id first: that gives the distinct ids and the reused ones
    in one pass, with no window and no join, and sums of sums after it.
    """
    age = seconds_between(F.col("vehicle_timestamp"), F.col("header_timestamp"))
    lag = seconds_between(F.col("header_timestamp"), F.col("fetched_at"))
    by_trip = vehicles.groupBy("fetch_id", "trip_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("direction").isNull()).alias("unparsed"),
        F.count_if(F.col("route_id").isNull()).alias("no_route"),
        F.count_if(F.col("stop_id").isNull()).alias("no_stop"),
        F.sum(age).alias("age"),
        F.count(age).alias("aged"),
        F.sum(lag).alias("lag"),
        F.count(lag).alias("lagged"),
    )
    reused = F.when(F.col("rows") > 1, F.col("rows")).otherwise(0)
    return by_trip.groupBy("fetch_id").agg(
        F.sum("rows").alias("vehicle_rows"),
        F.count("trip_id").alias("distinct_trip_ids"),
        F.sum(reused).alias("rows_with_reused_trip_id"),
        F.sum("unparsed").alias("rows_with_unparsed_trip_id"),
        F.sum("no_route").alias("rows_missing_route"),
        F.sum("no_stop").alias("rows_missing_stop"),
        _mean("age", "aged").alias("avg_position_age_seconds"),
        _mean("lag", "lagged").alias("avg_ingest_lag_seconds"),
    )


def _mean(total: str, count: str):
    return F.round(F.sum(total) / F.nullif(F.sum(count), F.lit(0).cast("long")), 1)


def alert_health(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("fetch_id").agg(
        F.count(F.lit(1)).alias("alert_rows"),
        F.count_if("is_delay_alert").alias("delay_alert_rows"),
    )


def dq_ingestion_health(raw: RawTables, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Pipeline health, one row per snapshot."""
    audit = with_gaps(raw.fetches.drop("vehicle_rows", "alert_rows"), gap_seconds)
    rows = audit.join(position_health(raw.vehicles), "fetch_id", "left").join(
        alert_health(stg_alerts(raw.alerts)), "fetch_id", "left"
    )
    counts = (
        "vehicle_rows",
        "alert_rows",
        "delay_alert_rows",
        "distinct_trip_ids",
        "rows_with_reused_trip_id",
        "rows_with_unparsed_trip_id",
        "rows_missing_route",
        "rows_missing_stop",
    )
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({name: F.coalesce(name, zero) for name in counts})
    shares = {
        f"pct_{name}": percent(F.col(name), F.col("vehicle_rows"), 2)
        for name in ("rows_with_reused_trip_id", "rows_with_unparsed_trip_id")
    }
    return rows.withColumns(shares).select(
        "fetch_id",
        "feed_key",
        F.col("header_timestamp").alias("snapshot_at"),
        "fetched_at",
        "payload_bytes",
        "entity_count",
        "poll_count",
        "last_polled_at",
        "vehicle_rows",
        "trip_stop_rows",
        *counts[1:],
        "avg_position_age_seconds",
        "avg_ingest_lag_seconds",
        "seconds_since_previous_snapshot",
        *shares,
        "is_after_ingestion_gap",
    )
