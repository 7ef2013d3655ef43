from __future__ import annotations

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from headway.operators.medians import middle_values


@pytest.mark.parametrize("bits", [2, 16])
def test_medians_equal_those_of_all_values(spark, bits):
    rng = random.Random(3)
    groups = {
        "hot": [rng.randrange(-100_000, 100_000) for _ in range(5001)],
        "even": [rng.randrange(-40, 40) for _ in range(500)],
        "apart": [-(2**31), -(2**31), 2**31, 2**31],
        "ties": [7] * 300 + [-1] * 299,
        "one": [-5],
        None: [rng.randrange(10) for _ in range(90)],
    }
    data = [(k, v) for k, values in groups.items() for v in values] + [("hot", None), ("none", None)]
    rows = spark.createDataFrame(data, "k string, v long").repartition(7)
    found = {r.k: (r.lower + r.upper) / 2 for r in middle_values(rows, ["k"], F.col("v"), bits).collect()}
    assert found == {k: median(values) for k, values in groups.items()}


def test_several_keys_and_no_rows(spark):
    rows = spark.createDataFrame([(1, None, 4), (1, None, 9), (1, "b", 2)], "a int, b string, v int")
    found = middle_values(rows, ["a", "b"], F.col("v"))
    assert found.columns == ["a", "b", "lower", "upper"]
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "b", 2, 2), (1, None, 4, 9)]
    assert middle_values(rows.filter("false"), ["a"], F.col("v")).count() == 0
