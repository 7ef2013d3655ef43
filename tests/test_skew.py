from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from headway.operators.skew import attach_group_stats, salted_left_join


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows share one key and a quarter has none."""
    chance = random.Random(7)
    keys = ["hot"] * 500 + [None] * 250 + [f"k{chance.randrange(40)}" for _ in range(250)]
    data = [(i, key, chance.randrange(-50, 50)) for i, key in enumerate(keys)]
    return spark.createDataFrame(data, "id int, k string, v int").repartition(5).cache()


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_group_stats_equal_a_window(spark, rows, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        stats = [F.median("v").alias("middle"), F.count(F.lit(1)).alias("n")]
        got = attach_group_stats(rows, ["k"], stats, ["id"]).select("id", "middle", "n")
        rows.createOrReplaceTempView("skewed")
        want = spark.sql(
            "SELECT id, median(v) OVER (PARTITION BY k), count(1) OVER (PARTITION BY k) FROM skewed"
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_without_null_safety_leaves_null_keys_unmatched(spark, rows):
    right = spark.createDataFrame([("hot", 1), (None, 2), ("k1", 3)], "k string, w int")
    got = salted_left_join(rows, right, [("k", "k")], ["id"])
    want = {"hot": 1, "k1": 3}
    assert got.columns == ["id", "k", "v", "w"]
    collected = got.collect()
    assert len(collected) == 1000
    assert all(row.w == want.get(row.k) for row in collected)


def test_hot_key_is_spread_and_can_be_split_further(spark, rows):
    """No exchange is reused for the join, so each side is a shuffle of its own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = attach_group_stats(rows, ["k"], [F.count(F.lit(1)).alias("n")], ["id"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_salt") == 1
        assert plan.count("Exchange hashpartitioning(_right_salt") == 1
        hot = rows.filter("k = 'hot'").select(F.pmod(F.xxhash64("id"), F.lit(8)).alias("s"))
        assert hot.distinct().count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
