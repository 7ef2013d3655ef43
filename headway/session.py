"""Session settings and scratch space the jobs rely on."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).parent
_BATCH_ROWS = "1000"
_BATCH_BYTES = str(4 << 20)
_sent: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone, bound Arrow batches and give the Python workers this package.

    Every timestamp in the feed is a UTC instant. Decoding runs on executors,
    which import this package from the archive sent to them once per context.
    A Python worker holds a batch whole, so its memory goes by these bounds.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _sent:
        folder = tempfile.mkdtemp(prefix="package-")
        archive = shutil.make_archive(
            f"{folder}/{_PACKAGE.name}", "zip", _PACKAGE.parent, _PACKAGE.name
        )
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    That is ``spark.checkpoint.dir`` or what ``setCheckpointDir`` was given. A
    bare local session may go without and gets a temporary folder; on a cluster
    executors on other hosts would not see that, so there it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/headway/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to shared scratch and read back.

    For a reduced result that several branches of a plan need: they would each
    compute it again from the source, as column pruning makes them differ. It
    also cuts the lineage, so a lost executor costs a re-read.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
