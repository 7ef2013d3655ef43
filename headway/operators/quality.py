"""Data checks. A check gives the rows that fail it; none means it passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import (
    DELAYED,
    LOSING_TIME,
    MAKING_UP_TIME,
    ON_PLAN,
    SCHEDULE_RELATIONSHIP,
    STATUS_LABELS,
    UNKNOWN_STATUS,
    VEHICLE_STATUS,
    percent,
)
from headway.functions.times import elapsed_seconds, instant, minutes
from headway.operators.skew import salted_left_join
from headway.sources.tables import RawTables

# Thresholds of the checks.
MAX_TRAINS_PER_LINE = 150
MIN_PREDICTION_COVERAGE = 80
WARN_AFTER_SECONDS, ERROR_AFTER_SECONDS = 5 * 60, 30 * 60

# What the checks of the numbers themselves report.
IMPLAUSIBLE_COUNT = "Implausible train count for one line"
NO_PREDICTIONS = "Arrival predictions are not joining to train positions"


def unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Values that occur more than once. NULLs do not count."""
    rows = df.filter(where) if where else df
    counts = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return counts.filter(F.col("occurrences") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_is_null(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside ``values``; NULL passes."""
    return df.filter(_is_not_accepted(column, values))


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Rows that are zero, negative or NULL."""
    return df.filter(_is_not_positive(column))


def at_most(df: DataFrame, column: str, max_value: float) -> DataFrame:
    return df.filter(F.col(column) > max_value)


def relationships(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose key the parent lacks; NULL keys pass.

    Rows of one key are spread by ``spread_by``, or by all their columns, so a
    parent with most of the children does not gather them in one task.
    """
    known = parent.select(F.col(field).alias("_known"), F.lit(True).alias("_found")).distinct()
    keyed = child.filter(F.col(column).isNotNull())
    spread = list(spread_by or child.columns)
    matched = salted_left_join(keyed, known, [(column, "_known")], spread)
    return matched.filter(F.col("_found").isNull()).drop("_found")


def source_freshness(raw: RawTables, as_of) -> DataFrame:
    """Age of the newest row of each source. The error table has no deadline."""
    newest = None
    for name in ("fetches", "vehicles", "stops", "alerts"):
        one = (
            getattr(raw, name)
            .agg(F.max("fetched_at").alias("max_loaded_at"))
            .select(F.lit(_SOURCES[name]).alias("source"), "max_loaded_at")
        )
        newest = one if newest is None else newest.unionByName(one)
    age = elapsed_seconds(F.col("max_loaded_at"), instant(as_of))
    status = (
        F.when(age.isNull() | (age > ERROR_AFTER_SECONDS), "error")
        .when(age > WARN_AFTER_SECONDS, "warn")
        .otherwise("pass")
    )
    return newest.select("*", age.alias("age_seconds"), status.alias("status"))


_SOURCES = {
    "fetches": "raw_feed_fetches",
    "vehicles": "raw_vehicle_positions",
    "stops": "raw_trip_stop_updates",
    "alerts": "raw_alerts",
}


def ingestion_gaps(health: DataFrame) -> DataFrame:
    """Snapshots that came after a hole in ingestion."""
    return health.filter("is_after_ingestion_gap").select(
        "feed_key",
        "snapshot_at",
        "seconds_since_previous_snapshot",
        minutes(F.col("seconds_since_previous_snapshot")).alias("gap_minutes"),
    )


def plausible_train_counts(lines: DataFrame, most: int = MAX_TRAINS_PER_LINE) -> DataFrame:
    """Lines with more trains than can run, as a join that multiplies rows would show."""
    running = F.col("trains_running")
    return lines.filter((running > most) | (running < 1)).select(
        "route_id", "trains_running", F.lit(IMPLAUSIBLE_COUNT).alias("failure_reason")
    )


def prediction_coverage(current_trains: DataFrame) -> DataFrame:
    """One row if too few trains found their prediction, as a join that misses would show."""
    predicted = F.count("next_stop_id")
    total = F.count(F.lit(1))
    return (
        current_trains.agg(
            total.alias("total_trains"),
            predicted.alias("trains_with_prediction"),
            percent(predicted, total, 1).alias("pct_with_prediction"),
        )
        .filter(F.col("pct_with_prediction") < MIN_PREDICTION_COVERAGE)
        .withColumn("failure_reason", F.lit(NO_PREDICTIONS))
    )


def _is_null(column: str) -> Column:
    return F.col(column).isNull()


def _is_not_accepted(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def _is_not_positive(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) <= 0)


class Check(NamedTuple):
    """One declared check; ``argument`` is the accepted values, or the parent, its key
    and the column that spreads the children."""

    model: str
    column: str
    kind: str
    argument: object = None
    severity: str = "error"
    where: str | None = None

    @property
    def name(self) -> str:
        return "_".join(part for part in (self.kind, self.model, self.column) if part)


def _each(model: str, kind: str, *columns: str) -> list[Check]:
    return [Check(model, column, kind) for column in columns]


# Which model column is held to what.
CHECKS = [
    *_each("raw_feed_fetches", "unique", "fetch_id"),
    *_each("raw_feed_fetches", "not_null", "fetch_id"),
    *_each("raw_vehicle_positions", "not_null", "entity_id"),
    *_each("stg_vehicle_positions", "unique", "snapshot_train_key"),
    *_each(
        "stg_vehicle_positions",
        "not_null",
        "snapshot_train_key",
        "trip_key",
        "fetch_id",
        "route_id",
        "current_status",
    ),
    Check(
        "stg_vehicle_positions",
        "fetch_id",
        "relationships",
        ("raw_feed_fetches", "fetch_id", "snapshot_train_key"),
    ),
    Check(
        "stg_vehicle_positions",
        "current_status",
        "accepted_values",
        tuple(VEHICLE_STATUS.values()),
    ),
    Check("stg_vehicle_positions", "direction", "accepted_values", ("N", "S"), "warn"),
    Check(
        "stg_vehicle_positions", "trip_id", "unique", None, "warn", "snapshot_recency_rank = 1"
    ),
    *_each("stg_trip_stop_updates", "unique", "snapshot_stop_key"),
    *_each("stg_trip_stop_updates", "not_null", "snapshot_stop_key", "arrival_time", "stop_id"),
    Check(
        "stg_trip_stop_updates",
        "schedule_relationship",
        "accepted_values",
        tuple(SCHEDULE_RELATIONSHIP.values()),
    ),
    *_each("stg_alerts", "not_null", "fetch_id", "is_delay_alert"),
    *_each("fct_current_trains", "unique", "snapshot_train_key"),
    *_each(
        "fct_current_trains",
        "not_null",
        "snapshot_train_key",
        "route_id",
        "status_label",
        "has_delay_alert",
    ),
    Check(
        "fct_current_trains",
        "status_label",
        "accepted_values",
        (DELAYED, *STATUS_LABELS.values(), UNKNOWN_STATUS),
    ),
    *_each("fct_line_activity", "unique", "route_id"),
    *_each("fct_line_activity", "not_null", "route_id", "trains_running"),
    *_each("fct_line_activity", "positive_value", "trains_running"),
    *_each(
        "fct_prediction_drift",
        "not_null",
        "trip_key",
        "stop_id",
        "observation_count",
        "drift_seconds",
    ),
    Check(
        "fct_prediction_drift",
        "drift_label",
        "accepted_values",
        (LOSING_TIME, MAKING_UP_TIME, ON_PLAN),
    ),
    *_each("dq_ingestion_health", "unique", "fetch_id"),
    *_each("dq_ingestion_health", "not_null", "fetch_id", "vehicle_rows"),
    Check("dq_ingestion_health", "", "ingestion_gaps", severity="warn"),
    Check("fct_line_activity", "", "plausible_train_counts"),
    Check("fct_current_trains", "", "prediction_coverage", severity="warn"),
]


def _row_condition(check: Check) -> Column | None:
    """The condition a failing row meets, for checks that look at one row at a time."""
    if check.kind == "not_null":
        return _is_null(check.column)
    if check.kind == "accepted_values":
        return _is_not_accepted(check.column, check.argument)
    if check.kind == "positive_value":
        return _is_not_positive(check.column)
    if check.kind == "at_most":
        return F.col(check.column) > check.argument
    return None


def columns_checked(model: str, checks: Sequence[Check] = CHECKS) -> list[str]:
    """The columns of a model that some check reads."""
    return list(dict.fromkeys(c.column for c in checks if c.model == model and c.column))


def _count_repeated(model: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """How many values occur more than once, for all unique checks of a model in one pass."""
    values = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            (F.when(F.expr(c.where), F.col(c.column)) if c.where else F.col(c.column))
            .cast("string")
            .alias("value"),
        )
        for c in checks
    ]
    counts = (
        model.select(F.inline(F.array(*values)))
        .filter("value IS NOT NULL")
        .groupBy("check_name", "value")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    totals = counts.agg(
        *[F.count_if((F.col("check_name") == c.name) & (F.col("occurrences") > 1)).alias(c.name) for c in checks]
    )
    return _as_rows(totals, checks)


DAY = "checked_day"


def failures_by_day(
    models: Mapping[str, DataFrame], checks: Sequence[Check], days: Column
) -> DataFrame:
    """How many rows fail each check on each day: checked_day, check_name, failures.

    For checks whose failures on one day do not depend on other days: those of
    one row, of values that fix their day, and of keys of the same day. ``days``
    tells the day of a row. Days without failures have no rows.
    """
    counts: list[DataFrame] = []
    for model in dict.fromkeys(check.model for check in checks):
        own = [c for c in checks if c.model == model]
        rows = models[model].withColumn(DAY, days)
        local = [c for c in own if _row_condition(c) is not None]
        if local:
            failing = [F.when(_row_condition(c), F.lit(c.name)) for c in local]
            counts.append(rows.select(DAY, F.explode(F.array_compact(F.array(*failing))).alias("check_name")))
        for check in own:
            if check.kind == "unique":
                known = rows.filter(F.col(check.column).isNotNull())
                again = known.groupBy(DAY, check.column).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            elif check.kind == "relationships":
                parent, field, spread_by = check.argument
                again = relationships(rows, check.column, models[parent], field, [spread_by])
            else:
                continue
            counts.append(again.select(DAY, F.lit(check.name).alias("check_name")))
    found = counts[0]
    for more in counts[1:]:
        found = found.unionByName(more)
    return found.groupBy(DAY, "check_name").agg(F.count(F.lit(1)).alias("failures"))


def _as_rows(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """A row per check of one row with a column per check."""
    pairs = [
        F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("failures")) for c in checks
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def _failing_rows(check: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    model = models[check.model]
    if check.kind == "relationships":
        parent, field, spread_by = check.argument
        return relationships(model, check.column, models[parent], field, [spread_by])
    singular = {
        "ingestion_gaps": ingestion_gaps,
        "plausible_train_counts": plausible_train_counts,
        "prediction_coverage": prediction_coverage,
    }
    return singular[check.kind](model)


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """A row per check: its severity, failing rows and status.

    All one-row checks of a model are counted in a single pass over it, and all
    its unique checks in another; only the rest take a pass of their own.
    """
    counts: list[DataFrame] = []
    for model in dict.fromkeys(check.model for check in checks):
        own = [c for c in checks if c.model == model]
        local = [c for c in own if _row_condition(c) is not None]
        if local:
            failures = [F.count_if(_row_condition(c)).alias(c.name) for c in local]
            counts.append(_as_rows(models[model].agg(*failures), local))
        if repeated := [c for c in own if c.kind == "unique"]:
            counts.append(_count_repeated(models[model], repeated))
    for check in checks:
        if _row_condition(check) is None and check.kind != "unique":
            failing = _failing_rows(check, models).agg(F.count(F.lit(1)).alias("failures"))
            counts.append(failing.select(F.lit(check.name).alias("check_name"), "failures"))

    report = counts[0]
    for more in counts[1:]:
        report = report.unionByName(more)
    return as_report(report, checks)


def as_report(report: DataFrame, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """Counts of failing rows (check_name, failures) with severity and status."""
    severity = F.lit("error")
    for check in checks:
        if check.severity != "error":
            severity = F.when(F.col("check_name") == check.name, check.severity).otherwise(severity)
    return report.select(
        "check_name",
        severity.alias("severity"),
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise(severity).alias("status"),
    )
