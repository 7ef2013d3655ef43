"""Noticing ingestion gaps while they happen."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headway.functions.times import seconds_between
from headway.operators.snapshots import GAP_SECONDS, last_of_previous_day
from headway.schemas import SNAPSHOT_WAITS
from headway.streaming.sinks import CATCH_UP, read_latest, write_updates

WAITS = "waits"
WAIT_KEYS = ["feed_key", "fetch_id"]
UNDATED_GROUPS = 64
_EMITTED = "feed_key string, fetch_id string, published long, waited long, opens_day boolean, is_late boolean"
_SEEN = "published array<long>, fetch_ids array<string>, late array<boolean>"


def _waits(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Seconds each snapshot of a feed and day came after the one before it.

    The state is the day so far, in order. A snapshot that comes late, older than
    one already seen, is put in its place; the one after it, which had been told
    to have waited longer, is told again. The first of a day is marked, its wait
    began on another day.
    """
    feed, _, undated = key
    if pd.notna(undated):
        for rows in chunks:
            yield _emit(feed, rows["fetch_id"], rows["published"].astype("Int64"), None, False, False)
        return
    held = state.get if state.exists else ([], [], [])
    day = pd.DataFrame(dict(zip(("published", "fetch_id", "late"), map(list, held)))).astype({"published": "int64", "late": bool})
    newest = day["published"].max() if len(day) else None
    come = pd.concat(chunks)[["published", "fetch_id"]].drop_duplicates("published")
    come = come[~come["published"].isin(day["published"])]
    come["late"] = False if newest is None else come["published"] < newest
    whole = pd.concat([day.assign(told=True), come.assign(told=False)]).sort_values("published", ignore_index=True)
    state.update(tuple(whole[name].tolist() for name in ("published", "fetch_id", "late")))
    waited = whole["published"].diff().astype("Int64")
    # The new ones, and those that stand right after a new one.
    say = ~whole["told"] | ~whole["told"].shift(1, fill_value=True)
    rows = whole[say]
    yield _emit(feed, rows["fetch_id"], rows["published"].astype("Int64"), waited[say], waited[say].isna(), rows["late"])


def _emit(feed, fetch_ids, published, waited, opens_day, late) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "feed_key": feed,
            "fetch_id": fetch_ids,
            "published": published,
            "waited": pd.Series(waited, index=fetch_ids.index, dtype="Int64"),
            "opens_day": opens_day,
            "is_late": late,
        }
    )


def stream_gaps(snapshots: DataFrame, root: str, trigger: dict = CATCH_UP) -> StreamingQuery:
    """How long each snapshot of a stream was waited for, within its day.

    A group is one feed and day, at most 86,400 snapshots, of which id and time
    are shuffled and kept. What it says of a snapshot counts until it says
    something else, when one that came late has its place before it. Snapshots without a publish time have no order; they
    pass through many groups, chunk by chunk.
    """
    spread = F.pmod(F.xxhash64("fetch_id"), F.lit(UNDATED_GROUPS)).cast("int")
    waits = (
        snapshots.select(
            "feed_key",
            F.to_date("header_timestamp").alias("day"),
            F.when(F.col("header_timestamp").isNull(), spread).alias("undated"),
            "fetch_id",
            F.unix_seconds("header_timestamp").alias("published"),
        )
        .groupBy("feed_key", "day", "undated")
        .applyInPandasWithState(
            _waits, _EMITTED, _SEEN, "update", GroupStateTimeout.NoTimeout
        )
    )
    rows = waits.withColumn("header_timestamp", F.timestamp_seconds("published"))
    return write_updates(rows.select(*SNAPSHOT_WAITS.names), root, WAITS, trigger=trigger, keys=WAIT_KEYS)


def read_gaps(spark: SparkSession, root: str, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """The waits so far, those that began on an earlier day filled in, and which are gaps."""
    rows = read_latest(spark, root, WAITS, SNAPSHOT_WAITS, WAIT_KEYS).withColumn(
        "_day", F.to_date("header_timestamp")
    )
    carried = last_of_previous_day(rows.filter(F.col("_day").isNotNull()))
    since_carried = F.when(
        F.col("opens_day"), seconds_between(F.col("_carried"), F.col("header_timestamp"))
    )
    waited = F.coalesce("waited", since_carried)
    return rows.join(carried, ["feed_key", "_day"], "left").select(
        "feed_key",
        "fetch_id",
        "header_timestamp",
        waited.alias("seconds_since_previous_snapshot"),
        "is_late",
        (F.coalesce(waited, F.lit(0)) > gap_seconds).alias("is_after_ingestion_gap"),
    )
