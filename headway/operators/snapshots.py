"""Order among the snapshots of a feed: which is newest, what came before.

A feed publishes on whole seconds, so one feed and day hold at most 86,400
snapshots. Ordering is done within a day and stitched across days, so no task
ever sorts the history of a feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.times import seconds_between
from headway.operators.skew import salted_left_join
from headway.schemas import REUSED_IDS

GAP_SECONDS = 300


def newest_snapshots(rows: DataFrame) -> DataFrame:
    """The newest publish time of each feed: one row per feed."""
    return rows.groupBy("feed_key").agg(F.max("header_timestamp").alias("header_timestamp"))


def newest_landed(audit: DataFrame) -> DataFrame:
    """The same from the audit of a landing root, with the folder dates to look in.

    The audit tells which snapshots have trains, so the positions need not be
    read to find the newest.
    """
    with_trains = audit.filter(F.col("vehicle_rows") > 0)
    newest = only_newest(with_trains, newest_snapshots(with_trains))
    return newest.select("feed_key", "snapshot_date", "header_timestamp").distinct()


def only_newest(rows: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of each feed's newest snapshot.

    ``newest`` has one row per feed of a fixed catalogue, so it is broadcast
    and the rows, which may be the largest table there is, are not shuffled.
    On a landed table its feeds and dates also prune the folders to read.
    """
    by_folder = ["snapshot_date"] if "snapshot_date" in newest.columns else []
    latest = F.broadcast(
        newest.withColumnsRenamed({name: f"_newest_{name}" for name in newest.columns})
    )
    matches = rows["header_timestamp"].eqNullSafe(latest["_newest_header_timestamp"])
    for name in ("feed_key", *by_folder):
        matches = matches & (rows[name] == latest[f"_newest_{name}"])
    return rows.join(latest, matches, "left_semi")


def snapshot_recency(rows: DataFrame) -> DataFrame:
    """Rank of every published snapshot within its feed, newest first.

    The rank is the place within the day plus the snapshots on later days.
    Snapshots without a publish time rank last, together.
    """
    seen = rows.select("feed_key", "header_timestamp").distinct().withColumn(
        "_day", F.to_date("header_timestamp")
    )
    later = (
        Window.partitionBy("feed_key")
        .orderBy(F.desc_nulls_last("_day"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    days = (
        seen.groupBy("feed_key", "_day")
        .agg(F.count(F.lit(1)).alias("_snapshots"))
        .select(
            F.col("feed_key").alias("_feed"),
            F.col("_day").alias("_on"),
            F.coalesce(F.sum("_snapshots").over(later), F.lit(0)).alias("_newer"),
        )
    )
    in_day = Window.partitionBy("feed_key", "_day").orderBy(F.desc_nulls_last("header_timestamp"))
    # Null-safe on both: a plain equality would add a filter to one side only and
    # the two branches could no longer share one scan and shuffle.
    same_day = F.col("feed_key").eqNullSafe(F.col("_feed")) & F.col("_day").eqNullSafe(
        F.col("_on")
    )
    return (
        seen.withColumn("_place", F.row_number().over(in_day))
        .join(days, same_day)
        .select(
            "feed_key",
            "header_timestamp",
            (F.col("_place") + F.col("_newer")).cast("long").alias("snapshot_recency_rank"),
        )
    )


def landed_recency(audit: DataFrame) -> DataFrame:
    """The audit of a landing root with the rank of every snapshot that has trains.

    It has one row per snapshot, so nothing needs to be made distinct: the place
    within the day is a window, and the days, few, are joined back.
    """
    seen = audit.filter(F.col("vehicle_rows") > 0).withColumn("_day", F.to_date("header_timestamp"))
    in_day = Window.partitionBy("feed_key", "_day").orderBy(F.desc_nulls_last("header_timestamp"))
    placed = seen.withColumn("_place", F.dense_rank().over(in_day))
    later = (
        Window.partitionBy("feed_key")
        .orderBy(F.desc_nulls_last("_day"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    days = placed.groupBy("feed_key", "_day").agg(F.max("_place").alias("_snapshots"))
    days = days.withColumn("_newer", F.coalesce(F.sum("_snapshots").over(later), F.lit(0)))
    days = days.select(F.col("feed_key").alias("_feed"), F.col("_day").alias("_on"), "_newer")
    same_day = F.col("feed_key").eqNullSafe(F.col("_feed")) & F.col("_day").eqNullSafe(F.col("_on"))
    return placed.join(days, same_day).select(
        "fetch_id",
        REUSED_IDS,
        (F.col("_place") + F.col("_newer")).cast("long").alias("snapshot_recency_rank"),
    )


def with_recency(rows: DataFrame, recency: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows with the recency rank of their snapshot."""
    keys = [(name, name) for name in ("feed_key", "header_timestamp")]
    return salted_left_join(rows, recency, keys, spread_by, null_safe=True)


def last_of_previous_day(dated: DataFrame) -> DataFrame:
    """For every feed and ``_day``, the last snapshot of the day with data before it."""
    days = dated.groupBy("feed_key", "_day").agg(F.max("header_timestamp").alias("_last"))
    by_day = Window.partitionBy("feed_key").orderBy("_day")
    return days.select("feed_key", "_day", F.lag("_last").over(by_day).alias("_carried"))


def with_gaps(audit: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Audit rows with the seconds since the feed's previous snapshot.

    ``is_after_ingestion_gap`` marks a wait longer than ``gap_seconds``.
    """
    dated = audit.filter(F.col("header_timestamp").isNotNull()).withColumn(
        "_day", F.to_date("header_timestamp")
    )
    in_day = Window.partitionBy("feed_key", "_day").orderBy("header_timestamp")
    gaps = (
        dated.withColumn("_previous", F.lag("header_timestamp").over(in_day))
        .join(last_of_previous_day(dated), ["feed_key", "_day"])
        .withColumn(
            "seconds_since_previous_snapshot",
            seconds_between(F.coalesce("_previous", "_carried"), F.col("header_timestamp")),
        )
        .select(*audit.columns, "seconds_since_previous_snapshot")
    )
    undated = audit.filter(F.col("header_timestamp").isNull()).withColumn(
        "seconds_since_previous_snapshot", F.lit(None).cast("long")
    )
    waited = F.coalesce("seconds_since_previous_snapshot", F.lit(0))
    return gaps.unionByName(undated).withColumn("is_after_ingestion_gap", waited > gap_seconds)
