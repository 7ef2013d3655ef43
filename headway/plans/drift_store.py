"""Prediction drift kept up to date from what was landed since.

Observations merge, so those of a day of snapshots are worked out once and
stored by the service day of their trips. The commits of the landing root tell
which days have new rows: only these are read again, and drift is rebuilt only
for service days they have trips of. A version of the table is a list of
folders, one per service day, most of which it shares with the version before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.plans import marts
from headway.plans.staging import stg_trip_stop_updates
from headway.schemas import RAW_TRIP_STOP_UPDATES
from headway.sources.store import Files, Log
from headway.sources.tables import SNAPSHOT_FOLDERS, landed_days, read_batches, write_folder_list

STOPS = "raw_trip_stop_updates"
MODEL = "fct_prediction_drift"
# What stands for service days that are missing or no dates.
OTHER_DAYS = "other"


def service_day() -> Column:
    """The service day of a trip, as a folder name; a trip key ends with it."""
    day = F.substring_index("trip_key", "|", -1)
    return F.when(day.rlike("^[0-9]{4,8}$"), day).otherwise(OTHER_DAYS)


def _state_name(folder: str) -> str:
    return f"{folder}/{MODEL}.state"


def _state(files: Files, folder: str | None) -> dict:
    """How far the log was read, and the folders of each day of snapshots and of service."""
    text = files.read(_state_name(folder)) if folder else None
    return json.loads(text) if text else {"position": None, "days": {}, "services": {}}


def _days_to_read(spark: SparkSession, landed_root: str, position: int | None) -> tuple[int, list[str]]:
    """The days with rows committed after ``position``, and the last commit now."""
    log = Log(spark, landed_root)
    if position is None:
        return log.settle(), landed_days(spark, landed_root, STOPS)
    entries = log.since(position)
    return position + len(entries), sorted({day for entry in entries for day in entry["days"]})


def refresh(spark: SparkSession, landed_root: str, marts_root: str, before: str | None, folder: str) -> list[str]:
    """Bring the drift table of version folder ``before`` up to date, as that of ``folder``.

    Returns the days of snapshots that were read. A refresh that fails leaves
    folders that nothing names.
    """
    files, state = Files(spark, marts_root), _state(Files(spark, marts_root), before)
    state["position"], days = _days_to_read(spark, landed_root, state["position"])
    if days or not state["services"]:
        touched = _observe(spark, files, landed_root, marts_root, state, days)
        _rebuild(spark, files, marts_root, state, touched)
    write_folder_list(files, folder, MODEL, [_rows(marts_root, *item) for item in state["services"].items()])
    files.write(_state_name(folder), json.dumps(state))
    return days


def _rows(marts_root: str, service: str, name: str) -> str:
    return f"{marts_root}/drift/rows/{name}/service_day={service}"


def _observe(spark: SparkSession, files: Files, landed_root: str, marts_root: str, state: dict, days: list[str]) -> set[str]:
    """Store the observations of some days anew; returns the service days they had or have."""
    name = uuid.uuid4().hex
    place = f"{marts_root}/drift/parts/{name}"
    stops = read_batches(spark, landed_root, STOPS, RAW_TRIP_STOP_UPDATES, SNAPSHOT_FOLDERS, days)
    for_day = []
    if days:
        staged = stg_trip_stop_updates(stops).withColumn("snapshot_date", F.to_date(F.coalesce("header_timestamp", "fetched_at")))
        seen = marts.partial_observations(staged, "snapshot_date").withColumn("service_day", service_day())
        # One folder per day and service day, of as many files as it has rows for.
        by = ["snapshot_date", "service_day"]
        seen.hint("rebalance", *by).write.partitionBy(*by).parquet(place)
        for_day = days
    touched: set[str] = set()
    for day in for_day:
        touched.update(state["days"].pop(day, {"services": []})["services"])
        services = [n.split("=", 1)[1] for n in files.names(f"{place}/snapshot_date={day}")]
        if services:
            state["days"][day] = {"folder": name, "services": services}
            touched.update(services)
    return touched


def _rebuild(spark: SparkSession, files: Files, marts_root: str, state: dict, services: set[str]) -> None:
    """Drift of some service days from all observations of their trips."""
    parts = [
        f"{marts_root}/drift/parts/{held['folder']}/snapshot_date={day}/service_day={service}"
        for day, held in state["days"].items()
        for service in held["services"]
        if service in services
    ]
    nothing = stg_trip_stop_updates(spark.createDataFrame([], RAW_TRIP_STOP_UPDATES))
    seen = marts.partial_observations(nothing)
    if parts:
        seen = spark.read.schema(seen.schema).parquet(*parts)
    name = uuid.uuid4().hex
    place = f"{marts_root}/drift/rows/{name}"
    steps = f"{marts_root}/drift/parts/steps-{name}"
    observed = marts.named_observations(seen)
    observed.write.parquet(steps)
    drift = marts.drift_from_observations(spark.read.schema(observed.schema).parquet(steps))
    drift.withColumn("service_day", service_day()).write.partitionBy("service_day").parquet(place)
    files.remove(steps)
    for service in services:
        state["services"].pop(service, None)
    for found in files.names(place):
        state["services"][found.split("=", 1)[1]] = name
    if not state["services"]:
        # A table needs a file to be read at all.
        drift.limit(0).write.parquet(_rows(marts_root, OTHER_DAYS, name))
        state["services"][OTHER_DAYS] = name


def remove_unused(spark: SparkSession, marts_root: str, folders: list[str]) -> None:
    """Remove what no version in ``folders`` names any more."""
    files = Files(spark, marts_root)
    states = [_state(files, folder) for folder in folders]
    used = {"parts": {d["folder"] for s in states for d in s["days"].values()}}
    used["rows"] = {name for s in states for name in s["services"].values()}
    for kind, names in used.items():
        for name in files.names(f"{marts_root}/drift/{kind}"):
            if name not in names:
                files.remove(f"{marts_root}/drift/{kind}/{name}")
