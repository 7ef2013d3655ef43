"""The report of all checks, for which only days with new commits are looked at.

Rows of the landed tables fail or pass on their own, or together with rows of
their day: a key of staging begins with its snapshot, which fixes its day. So
failures are counted per day, once, and again when a commit adds to the day.
Checks of the marts, and of the newest snapshots, look at those as they are.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.quality import CHECKS, DAY, as_report, failures_by_day, run_checks
from headway.operators.snapshots import newest_landed, only_newest
from headway.plans import staging
from headway.sources.store import Files, Log
from headway.sources.tables import FOLDERS, LANDED, RawTables, landed_days, read_batches

_HISTORY = ("raw_feed_fetches", "raw_vehicle_positions", "stg_vehicle_positions", "stg_trip_stop_updates", "stg_alerts")
#: Checks whose failures add up over days.
BY_DAY = [c for c in CHECKS if c.model in _HISTORY and c.where is None]
#: Checks of what there is now.
NOW = [c for c in CHECKS if c not in BY_DAY]


def _models_of(spark: SparkSession, landed_root: str, days: list[str]) -> dict[str, DataFrame]:
    """What the daily checks look at, of some days only."""

    def table(name: str) -> DataFrame:
        return read_batches(spark, landed_root, name, LANDED[name], FOLDERS[name], days)

    vehicles = table("raw_vehicle_positions")
    return {
        "raw_feed_fetches": table("raw_feed_fetches"),
        "raw_vehicle_positions": vehicles,
        "stg_vehicle_positions": staging.keyed_positions(vehicles),
        "stg_trip_stop_updates": staging.stg_trip_stop_updates(table("raw_trip_stop_updates")),
        "stg_alerts": staging.stg_alerts(table("raw_alerts")),
    }


def count_days(spark: SparkSession, landed_root: str, marts_root: str) -> tuple[Counter, list[str]]:
    """Failures of each daily check over all days, and the days that were read for it.

    What is kept is a small file with the failures of each day and how far the
    log of commits was read. Failures reach the driver as counts per day.
    """
    files, log, name = Files(spark, marts_root), Log(spark, landed_root), f"{marts_root}/checks.json"
    held = files.read(name)
    state = json.loads(held) if held else {"position": None, "days": {}}
    if state["position"] is None:
        state["position"], days = log.settle(), landed_days(spark, landed_root, "raw_feed_fetches")
    else:
        entries = log.since(state["position"])
        days = sorted({day for entry in entries for day in entry["days"]})
        state["position"] += len(entries)
    if days:
        day = F.to_date(F.coalesce("header_timestamp", "fetched_at")).cast("string")
        counts = failures_by_day(_models_of(spark, landed_root, days), BY_DAY, day).collect()
        state["days"].update({day: {} for day in days})
        for row in counts:
            state["days"][row[DAY]][row["check_name"]] = row["failures"]
    files.write(name, json.dumps(state))
    total: Counter = Counter({check.name: 0 for check in BY_DAY})
    for failures in state["days"].values():
        total.update(failures)
    return total, days


def check_landed(
    spark: SparkSession, landed_root: str, marts_root: str, raw: RawTables, models: dict[str, DataFrame]
) -> DataFrame:
    """The report of all declared checks over landed tables and the marts made of them."""
    total, _ = count_days(spark, landed_root, marts_root)
    kept = spark.createDataFrame(sorted(total.items()), "check_name string, failures long")
    newest = only_newest(raw.vehicles, newest_landed(raw.audit))
    now = models | {
        "raw_feed_fetches": raw.audit,
        "stg_vehicle_positions": newest.withColumn("snapshot_recency_rank", F.lit(1)),
    }
    return as_report(kept, BY_DAY).unionByName(run_checks(now, NOW))
