"""Payload files dropped by a poller: ``feed_key=<key>/<epoch millis>.pb``.

Spark's file sources never list a file of no bytes. A poller that is to have
empty responses recorded as errors writes payload rows to a table instead;
decoding takes either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import PAYLOADS, project
from headway.sources.feeds import feed_url


def _as_payloads(files: DataFrame) -> DataFrame:
    key = F.regexp_extract("path", r"/feed_key=([^/]+)/", 1)
    millis = F.nullif(F.regexp_extract("path", r"/(\d{13})[^/]*$", 1), F.lit(""))
    rows = files.select(
        "path",
        key.alias("feed_key"),
        F.coalesce(feed_url(key), F.col("path")).alias("feed_url"),
        F.coalesce(
            F.timestamp_millis(millis.cast("long")), F.col("modificationTime")
        ).alias("fetched_at"),
        F.col("content").alias("payload"),
    )
    return project(rows, PAYLOADS)


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Every payload file under ``folder``, one row each."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.pb")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return _as_payloads(files)


def stream_payloads(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same rows as a stream of newly dropped files."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.pb")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
    )
    return _as_payloads(files)
