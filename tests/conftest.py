from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from headway.session import prepare


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("headway-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


@pytest.fixture(scope="session")
def spark():
    return make_session()
