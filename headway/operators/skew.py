"""Attaching one row per key to many rows when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    spread_by: list[str],
    null_safe: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """Left join where ``right`` has one row per key and ``left`` may be skewed.

    Rows of one left key, and of NULL keys, which match nothing, are spread
    over ``salts`` partitions by the hash of ``spread_by``; the right row is
    repeated once per salt. As salt and key are hashed together, both sides
    have a shuffle of their own, which is what lets the adaptive skew join
    split a partition that is still too large. A right side that turns out
    small is broadcast at run time instead, on its measured size.

    The right columns named in ``keys`` are dropped from the result.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    marked = left.withColumn("_salt", salt)
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for _, name in keys})
    repeated = renamed.withColumn(
        "_right_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)]))
    )

    def same(left_name: str, right_name: str) -> Column:
        a, b = marked[left_name], repeated[f"_right_{right_name}"]
        return a.eqNullSafe(b) if null_safe else a == b

    condition = marked["_salt"] == repeated["_right_salt"]
    for left_name, right_name in keys:
        condition = condition & same(left_name, right_name)
    helpers = ["_salt", "_right_salt", *[f"_right_{name}" for _, name in keys]]
    return marked.join(repeated, condition, "left").drop(*helpers)


def attach_group_stats(
    df: DataFrame, keys: list[str], stats: list[Column], spread_by: list[str], having: Column | None = None
) -> DataFrame:
    """Aggregates of each row's group, as a window over ``keys`` would give.

    A window brings a whole group into one task. Here the group is combined
    before the shuffle and its one result row is joined back. With ``having``
    only those groups are joined; rows of the others get NULL.
    """
    groups = df.groupBy(*keys).agg(*stats)
    if having is not None:
        groups = groups.filter(having)
    pairs = [(key, key) for key in keys]
    return salted_left_join(df, groups, pairs, spread_by, null_safe=True)
