"""A quick look at decoded snapshots before anything is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import clock
from headway.operators.filters import ordered, top


def trains_per_route(vehicles: DataFrame) -> DataFrame:
    known = vehicles.filter(F.col("route_id").isNotNull())
    return ordered(known.groupBy("route_id").agg(F.count(F.lit(1)).alias("trains")), "route_id")


def status_mix(vehicles: DataFrame) -> DataFrame:
    mix = vehicles.groupBy("current_status").agg(F.count(F.lit(1)).alias("trains"))
    return ordered(mix, "current_status")


def top_alerts(alerts: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent alert texts."""
    known = alerts.filter(F.col("alert_header").isNotNull())
    counts = known.groupBy("alert_header").agg(F.count(F.lit(1)).alias("alerts"))
    return top(counts, "alerts", k, "alert_header")


def first_vehicles(vehicles: DataFrame, n: int = 5) -> DataFrame:
    return ordered(vehicles, "header_timestamp", "fetch_id", "entity_id").limit(n).select(
        "route_id",
        F.coalesce("direction", F.lit("?")).alias("direction"),
        F.coalesce("stop_id", F.lit("?")).alias("stop_id"),
        "current_status",
        "trip_id",
    )


def first_arrivals(stops: DataFrame, n: int = 5) -> DataFrame:
    return ordered(stops, "header_timestamp", "fetch_id", "entity_id", "stop_index").limit(n).select(
        "route_id",
        F.coalesce("stop_id", F.lit("?")).alias("stop_id"),
        "stop_index",
        clock(F.col("arrival_time")).alias("arrival"),
        "trip_id",
    )
