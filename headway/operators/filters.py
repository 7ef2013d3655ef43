"""Row filters reports offer their readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import DELAYED

DIRECTIONS = {"All": None, "Northbound": "N", "Southbound": "S"}


def filter_trains(
    trains: DataFrame,
    lines: Sequence[str] = (),
    direction: str = "All",
    only_delayed: bool = False,
) -> DataFrame:
    """Trains as served, of the given lines (none means all), direction and state."""
    if lines:
        trains = trains.filter(F.col("line").isin(*lines))
    if DIRECTIONS[direction]:
        trains = trains.filter(F.col("direction") == DIRECTIONS[direction])
    if only_delayed:
        trains = trains.filter(F.col("status") == DELAYED)
    return trains


def since(column: str, as_of: Column, minutes: int) -> Column:
    """Later than ``minutes`` before ``as_of``."""
    return F.col(column) > as_of - F.make_dt_interval(mins=F.lit(minutes))


def top(df: DataFrame, column: str, k: int, *tie_break: str) -> DataFrame:
    """The ``k`` rows with the largest ``column``; NULLs last, ties in a fixed order."""
    ties = [F.asc_nulls_last(name) for name in tie_break]
    return df.orderBy(F.desc_nulls_last(column), *ties).limit(k)


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(name) for name in columns])
