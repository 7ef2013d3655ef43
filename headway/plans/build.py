"""All seven models from the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.operators.quality import columns_checked, run_checks
from headway.operators.snapshots import GAP_SECONDS
from headway.plans import drift_store, marts, staging
from headway.session import scratch_dir, stored
from headway.sources.tables import (
    RawTables,
    current_version,
    new_version,
    publish_version,
    read_models,
    register_views,
    remove_folder,
    write_models,
)

# The names of the stored models.
MARTS = (
    "fct_current_trains",
    "fct_line_activity",
    "fct_prediction_drift",
    "dq_ingestion_health",
)


def build_staging(raw: RawTables) -> dict[str, DataFrame]:
    return {
        "stg_vehicle_positions": staging.stg_vehicle_positions(raw.vehicles, raw.audit),
        "stg_trip_stop_updates": staging.stg_trip_stop_updates(raw.stops),
        "stg_alerts": staging.stg_alerts(raw.alerts),
    }


def build_marts(raw: RawTables, gap_seconds: int = GAP_SECONDS) -> dict[str, DataFrame]:
    current_trains = marts.fct_current_trains(raw)
    return {
        "fct_current_trains": current_trains,
        "fct_line_activity": marts.fct_line_activity(current_trains),
        "fct_prediction_drift": marts.fct_prediction_drift(raw),
        "dq_ingestion_health": marts.dq_ingestion_health(raw, gap_seconds),
    }


def rebuild(
    spark: SparkSession,
    raw: RawTables,
    root: str,
    gap_seconds: int = GAP_SECONDS,
    landed_root: str | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the marts under ``root`` and register all models as views.

    All marts are written to a new version, which readers see in one step when
    it is whole; a rebuild that fails leaves them the marts they had. Staging
    stays lazy, as views over the raw tables. Line activity is made from the
    stored current trains and drift from stored observations, so the raw tables
    are read once for each. With ``landed_root``, where ``raw`` was landed,
    drift is not made from all history: only days with new commits are read.
    """
    folder, before = new_version(root), current_version(spark, root)
    write_models({"fct_current_trains": marts.fct_current_trains(raw)}, folder)
    trains = spark.read.parquet(f"{folder}/fct_current_trains")
    rest = {
        "fct_line_activity": marts.fct_line_activity(trains),
        "dq_ingestion_health": marts.dq_ingestion_health(raw, gap_seconds),
    }
    if landed_root:
        drift_store.refresh(spark, landed_root, root, before, folder)
        write_models(rest, folder)
    else:
        observed = marts.drift_observations(staging.stg_trip_stop_updates(raw.stops))
        steps = scratch_dir(spark, "observations")
        observed.write.parquet(steps)
        observed = spark.read.schema(observed.schema).parquet(steps)
        write_models(rest | {"fct_prediction_drift": marts.drift_from_observations(observed)}, folder)
        remove_folder(spark, steps)
    kept = publish_version(spark, root, folder)
    drift_store.remove_unused(spark, root, kept)
    models = build_staging(raw) | read_models(spark, root, MARTS)
    register_views(models)
    return models


def check_models(raw: RawTables, models: dict[str, DataFrame]) -> DataFrame:
    """The report of all declared checks over the raw tables and rebuilt models.

    What the checks need of a lazy model is stored first if several look at it,
    so the model is worked out once.
    """
    tables = models | {"raw_feed_fetches": raw.fetches, "raw_vehicle_positions": raw.vehicles}
    name = "stg_vehicle_positions"
    slim = tables[name].select(*columns_checked(name), "snapshot_recency_rank")
    return run_checks(tables | {name: stored(slim, "to-check")})
