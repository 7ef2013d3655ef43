"""Running aggregates: polls per snapshot and predictions per stop of a trip.

Both keep one state row per key and never evict one: a late snapshot must
still count, as it does when everything is rebuilt. State grows with the
number of snapshots, or of trips and their stops, not with the rows read, so a
job without an end should use the RocksDB state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.plans.marts import drift_from_observations, running_observations
from headway.plans.staging import stg_trip_stop_updates
from headway.schemas import DRIFT_OBSERVATIONS, POLL_COUNTS
from headway.streaming.sinks import CATCH_UP, read_latest, write_updates

POLL_COUNT_TABLE = "poll_counts"
OBSERVATION_TABLE = "drift_observations"
POLL_COUNT_KEYS = ["fetch_id"]
OBSERVATION_KEYS = ["trip_key", "stop_id"]


def poll_counts(polls: DataFrame) -> DataFrame:
    return polls.groupBy("fetch_id").agg(
        F.count(F.lit(1)).alias("poll_count"), F.max("fetched_at").alias("last_polled_at")
    )


def stream_poll_count(polls: DataFrame, root: str, trigger: dict = CATCH_UP) -> StreamingQuery:
    return write_updates(
        poll_counts(polls), root, POLL_COUNT_TABLE, trigger=trigger, keys=POLL_COUNT_KEYS
    )


def read_poll_counts(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, POLL_COUNT_TABLE, POLL_COUNTS, POLL_COUNT_KEYS)


def stream_drift(stops: DataFrame, root: str, trigger: dict = CATCH_UP) -> StreamingQuery:
    """First and last prediction per trip and stop, over a stream of raw stop updates."""
    observed = running_observations(stg_trip_stop_updates(stops))
    return write_updates(observed, root, OBSERVATION_TABLE, trigger=trigger, keys=OBSERVATION_KEYS)


def read_drift(spark: SparkSession, root: str) -> DataFrame:
    """Prediction drift from the running observations; the trip medians are batch."""
    return drift_from_observations(
        read_latest(spark, root, OBSERVATION_TABLE, DRIFT_OBSERVATIONS, OBSERVATION_KEYS)
    )
