"""Exact medians of groups of any size, by counting instead of holding their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values that agree in all but this many low bits are a range.
RANGE_BITS = 16


def middle_values(rows: DataFrame, keys: list[str], value: Column, bits: int = RANGE_BITS) -> DataFrame:
    """The two middle values of each group, equal where their number is odd.

    Returns ``keys``, ``lower`` and ``upper``; the median is half their sum.
    ``value`` gives whole numbers; NULLs are left out, and so are groups that have
    nothing else. NULL keys are a group.

    Equal values are counted first, on the map side and shuffled by key and
    value, so a hot group is spread. The first pass counts ranges and finds those
    with a middle rank, the second looks at the values in these alone. What one
    task sorts is at most 2 ** ``bits`` values of a range, or the ranges of a
    group: as many again for numbers of twice the bits.
    """
    counted = (
        rows.select(*keys, value.cast("long").alias("_value"))
        .filter("_value IS NOT NULL")
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_range", F.shiftright("_value", bits))
    )
    ranges = counted.groupBy(*keys, "_range").agg(F.sum("_n").alias("_n"))
    group = Window.partitionBy(*keys)
    in_order = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumns({"_end": F.sum("_n").over(in_order), "_all": F.sum("_n").over(group)})
    ranges = ranges.withColumns({"_first": F.expr("(_all + 1) div 2"), "_second": F.expr("_all div 2 + 1")})
    holds_middle = (F.col("_end") - F.col("_n") < F.col("_second")) & (F.col("_end") >= F.col("_first"))
    chosen = ranges.filter(holds_middle).select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        F.col("_range").alias("_of_range"),
        (F.col("_end") - F.col("_n")).alias("_before"),
        "_first",
        "_second",
    )
    same = counted["_range"] == chosen["_of_range"]
    for key in keys:
        same = same & counted[key].eqNullSafe(chosen[f"_of_{key}"])
    within = Window.partitionBy(*keys, "_range").orderBy("_value")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.join(chosen, same).withColumn("_end", F.col("_before") + F.sum("_n").over(within))
    middle = ranked.filter(holds_middle).groupBy(*keys)
    return middle.agg(F.min("_value").alias("lower"), F.max("_value").alias("upper"))
