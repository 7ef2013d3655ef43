"""Labels: enum numbers, train status, drift and freshness tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enum labels of the feed specification.
VEHICLE_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
SCHEDULE_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}

# The labels reports and checks rely on.
DELAYED = "Delayed (MTA alert)"
STATUS_LABELS = {"STOPPED_AT": "At station", "INCOMING_AT": "Arriving", "IN_TRANSIT_TO": "In transit"}
UNKNOWN_STATUS = "Unknown"
LOSING_TIME, MAKING_UP_TIME, ON_PLAN = "Losing time", "Making up time", "On plan"


def enum_label(number: Column, labels: dict[int, str]) -> Column:
    """The label of an enum number; a number without one stays as text."""
    label = F.lit(None).cast("string")
    for value, name in labels.items():
        label = F.when(number == value, name).otherwise(label)
    return F.coalesce(label, number.cast("string"))


def status_label(has_delay_alert: Column, current_status: Column) -> Column:
    """What to show for a train. An alert outranks the reported status."""
    label = F.when(has_delay_alert, DELAYED)
    for status, text in STATUS_LABELS.items():
        label = label.when(current_status == status, text)
    return label.otherwise(UNKNOWN_STATUS)


# Seconds of drift that count, and ages at which data is no longer fresh.
DRIFT_SECONDS = 120
FRESH_SECONDS, STALE_SECONDS = 120, 900


def drift_label(drift_seconds: Column) -> Column:
    return (
        F.when(drift_seconds > DRIFT_SECONDS, LOSING_TIME)
        .when(drift_seconds < -DRIFT_SECONDS, MAKING_UP_TIME)
        .otherwise(ON_PLAN)
    )


def freshness_level(age_seconds: Column) -> Column:
    return (
        F.when(age_seconds.isNull(), "NO DATA")
        .when(age_seconds < FRESH_SECONDS, "OK")
        .when(age_seconds < STALE_SECONDS, "WARN")
        .otherwise("STALE")
    )


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share of ``whole`` in percent; NULL where ``whole`` is zero."""
    return F.round(F.lit(100.0).cast("double") * part / F.nullif(whole, F.lit(0).cast("long")), digits)
