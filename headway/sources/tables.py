"""Tables on storage: raw tables by snapshot date and feed, models rebuilt whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from headway.schemas import LANDED_FETCHES, POLL_LOG, RAW_TABLES
from headway.session import stored
from headway.sources.store import Files, failed_attempts, hidden_attempts, new_source

BATCH = "landing_batch_id"
SNAPSHOT_FOLDERS = ("snapshot_date", "feed_key")
LANDED = RAW_TABLES | {"poll_log": POLL_LOG, "raw_feed_fetches": LANDED_FETCHES}
# The folders of each landed table, the day first.
FOLDERS = dict.fromkeys(LANDED, SNAPSHOT_FOLDERS) | {
    "poll_log": ("poll_date",),
    "ingest_errors": ("error_date",),
}

# A stream compacts a day when it has so many batches of one size.
COMPACT_AT = 16
# What was compacted stays so long for those who read it, and a compaction that
# died may be taken over after that.
KEEP_SECONDS = LOCK_SECONDS = 3600


@dataclass(frozen=True)
class RawTables:
    """The five raw tables every model is built from.

    Of landed ones, also the audit as it was written, without later polls.
    """

    fetches: DataFrame
    vehicles: DataFrame
    stops: DataFrame
    alerts: DataFrame
    errors: DataFrame
    landed_audit: DataFrame | None = None

    @property
    def audit(self) -> DataFrame:
        """A row per snapshot, for what does not look at poll counts."""
        return self.fetches if self.landed_audit is None else self.landed_audit


def with_snapshot_date(df: DataFrame) -> DataFrame:
    """The folder date: the day a snapshot was published, or fetched if it says none."""
    return df.withColumn(
        "snapshot_date", F.to_date(F.coalesce("header_timestamp", "fetched_at"))
    )


def write_batch(
    df: DataFrame,
    root: str,
    table: str,
    attempt: str,
    partition_by: Iterable[str],
    instead_of: Iterable[str] = (),
) -> None:
    """File the rows of one attempt under the table's day (and feed) folders.

    ``instead_of`` are folders that the rows were read from and stand for.

    ``rebalance`` sizes files per folder and splits a folder that is too big
    for one task, so a feed or day holding most rows does not slow the write.
    The rows are written aside and their folders renamed into place, so jobs
    that write at the same time do not meet.
    """
    spark, columns = df.sparkSession, list(partition_by)
    files, aside = Files(spark, root), f"{root}/aside/{attempt}/{table}"
    df.hint("rebalance", *columns).write.partitionBy(*columns).parquet(aside)
    for folder in instead_of:
        files.remove(folder)

    def settle(folder: str, depth: int) -> None:
        for name in files.names(f"{aside}{folder}"):
            if depth > 1:
                settle(f"{folder}/{name}", depth - 1)
            else:
                place = f"{folder}/{name}/{BATCH}={attempt}"
                files.move(f"{aside}{folder}/{name}", f"{root}/{table}{place}")

    settle("", len(columns))
    files.remove(aside)


def _with_folders(schema: StructType, columns: list[str]) -> StructType:
    """A table's columns and those that its folders stand for."""
    extra = [
        StructField(name, DateType() if name == columns[0] else StringType())
        for name in (*columns, BATCH)
        if name not in schema.names
    ]
    return StructType(schema.fields + extra)


def read_batches(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    partition_by: Iterable[str],
    days: Iterable[str] | None = None,
) -> DataFrame:
    """The rows of a table that count, with its folder columns.

    With ``days`` only the folders of these days are listed, so the cost does
    not grow with what was landed on others. ``partition_by`` begins with the
    day.
    """
    columns = list(partition_by)
    full = _with_folders(schema, columns)
    files, path = Files(spark, root), f"{root}/{table}"
    if days is None:
        paths = [path] if files.names(path) else []
    else:
        paths = [p for day in days if files.exists(p := f"{path}/{columns[0]}={day}")]
    if not paths:
        return spark.createDataFrame([], full)
    # Marks are read first: a batch committed after that is hidden as a whole.
    hidden = sorted(hidden_attempts(spark, root))
    rows = spark.read.schema(full).option("basePath", path).parquet(*paths)
    for condition in _hiding(table, columns[0], hidden):
        rows = rows.filter(~condition)
    return rows


def _hiding(table: str, day_column: str, hidden: list[str]) -> list[Column]:
    found = [F.col(BATCH).isin(whole)] if (whole := [h for h in hidden if "/" not in h]) else []
    for entry in hidden:
        if entry.startswith(f"{table}/"):
            _, day, attempt = entry.split("/")
            found.append((F.col(day_column) == F.lit(day).cast("date")) & (F.col(BATCH) == attempt))
    return found


def landed_days(spark: SparkSession, root: str, table: str) -> list[str]:
    """The days a table has folders of."""
    return [name.split("=", 1)[1] for name in Files(spark, root).names(f"{root}/{table}")]


def remove_folder(spark: SparkSession, folder: str) -> None:
    Files(spark, folder).remove(folder)


def _attempt_folders(files: Files, root: str, table: str, day: str, attempts: set[str]) -> list[str]:
    """Folders of the given attempts on one day."""
    columns = FOLDERS.get(table, SNAPSHOT_FOLDERS)
    base = f"{root}/{table}/{columns[0]}={day}"
    within = [base] if len(columns) == 1 else [f"{base}/{n}" for n in files.names(base)]
    return [
        f"{folder}/{BATCH}={name}" for folder in within for name in attempts
        if files.exists(f"{folder}/{BATCH}={name}")
    ]


def give_up_landed(
    spark: SparkSession,
    root: str,
    attempt: str,
    days: list[str],
    tables: Mapping[str, StructType],
    key: str = "fetch_id",
) -> None:
    """Take out of a hidden attempt the snapshots that are landed by now on some days.

    The first table says which snapshots there are. Only folders of these days
    that the attempt has itself are written again, and only if it comes to that.
    """
    files, columns = Files(spark, root), list(SNAPSHOT_FOLDERS)

    def own(table: str, folders: list[str]) -> DataFrame:
        full = _with_folders(tables[table], columns)
        return spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*folders)

    def folders_of(table: str) -> list[str]:
        return [f for day in days for f in _attempt_folders(files, root, table, day, {attempt})]

    first = next(iter(tables))
    if not (held := folders_of(first)):
        return
    landed = read_batches(spark, root, first, tables[first], columns, days).select(key)
    twice = stored(own(first, held).select(key).join(landed, key, "left_semi"), "given-up")
    if not twice.limit(1).count():
        return
    for table in tables:
        if folders := folders_of(table):
            kept = own(table, folders).join(twice, key, "left_anti").drop(BATCH)
            write_batch(kept, root, table, attempt, columns, folders)


def remove_failed(spark: SparkSession, root: str, attempt: str) -> None:
    """Remove what a failed attempt left, and then its mark. Not while it may still run."""
    if attempt not in failed_attempts(spark, root):
        raise ValueError(f"{attempt} is not a failed attempt")
    files = Files(spark, root)
    for depth in ("*/*", "*/*/*"):
        for folder in files.matching(f"{root}/{depth}/{BATCH}={attempt}"):
            files.remove(folder)
    files.remove(f"{root}/aside/{attempt}")
    files.remove(f"{root}/marks/{attempt}")


def compact_day(
    spark: SparkSession, root: str, table: str, day: str, some: Iterable[str] | None = None
) -> int:
    """Rewrite the committed batches of a day (or some of them) as one; returns how many there were.

    The new folders are hidden by a mark. Rewriting the mark in one step shows
    them and hides the old ones, which stay for those who read them already:
    ``tidy`` removes them when ``KEEP_SECONDS`` are over. One compaction of a
    table and day runs at a time; one that finds another leaves it alone.
    """
    columns = FOLDERS[table]
    files, lock = Files(spark, root), f"{root}/compacting/{table}.{day}"
    if (age := files.age(lock)) is not None and age > LOCK_SECONDS:
        files.remove(lock)
    if not files.create(lock, "{}"):
        return 0
    try:
        rows = read_batches(spark, root, table, LANDED[table], columns, [day])
        old = {row[0] for row in rows.select(BATCH).distinct().collect()}
        if some is not None:
            old &= set(some)
        if len(old) < 2:
            return len(old)
        level = 1 + max(_level(name) for name in old)
        attempt = f"{new_source(f'compact{level}')}.{table}.{day}"
        mark = f"{root}/marks/{attempt}"
        files.write(mark, json.dumps([attempt]))
        write_batch(rows.filter(F.col(BATCH).isin(*old)).drop(BATCH), root, table, attempt, columns)
        files.write(mark, json.dumps([f"{table}/{day}/{name}" for name in sorted(old)]))
        return len(old)
    finally:
        files.remove(lock)


def _level(attempt: str) -> int:
    """How often the rows of an attempt were compacted."""
    kind = attempt.split("-", 1)[0]
    return int(kind.removeprefix("compact") or 0) if kind.startswith("compact") else 0


def compact_due(spark: SparkSession, root: str, days: Iterable[str], fan: int | None = None) -> int:
    """Compact, on some days, what a table has ``fan`` batches of one size of; returns how many times.

    Batches compacted once make a batch of the next size, so a row is written
    again a number of times that grows as the logarithm of the batches of a day,
    and folders of a day stay below ``fan`` of each size.
    """
    files, done = Files(spark, root), 0
    hidden = hidden_attempts(spark, root)
    for table in LANDED:
        for day in days:
            by_level: dict[int, list[str]] = {}
            for name in sorted(_attempts_of(files, root, table, day)):
                if name not in hidden and f"{table}/{day}/{name}" not in hidden:
                    by_level.setdefault(_level(name), []).append(name)
            for names in by_level.values():
                if len(names) >= (fan or COMPACT_AT):
                    done += compact_day(spark, root, table, day, names) > 1
    return done


def _attempts_of(files: Files, root: str, table: str, day: str) -> set[str]:
    """The attempts that have rows of a day."""
    base = f"{root}/{table}/{FOLDERS[table][0]}={day}"
    within = [base] if len(FOLDERS[table]) == 1 else [f"{base}/{n}" for n in files.names(base)]
    return {n.split("=", 1)[1] for folder in within for n in files.names(folder)}


def tidy(spark: SparkSession, root: str, keep_seconds: float | None = None) -> int:
    """Remove what was compacted into other folders long enough ago; returns how many marks went."""
    files, gone = Files(spark, root), 0
    keep = KEEP_SECONDS if keep_seconds is None else keep_seconds
    for name in files.names(f"{root}/marks"):
        mark = f"{root}/marks/{name}"
        if not name.startswith("compact") or name.endswith(".draft"):
            continue
        if (age := files.age(mark)) is None or age < keep:
            continue
        old = [entry.split("/") for entry in json.loads(files.read(mark) or "[]") if "/" in entry]
        if not old:
            continue
        for table, day, attempt in old:
            for folder in _attempt_folders(files, root, table, day, {attempt}):
                files.remove(folder)
        files.remove(mark)
        gone += 1
    return gone


def read_raw(spark: SparkSession, root: str) -> RawTables:
    """The committed raw tables of a landing root."""

    def table(name: str) -> DataFrame:
        return read_batches(spark, root, name, LANDED[name], FOLDERS[name])

    audit = table("raw_feed_fetches")
    return RawTables(
        fetches=poll_audit(audit, table("poll_log")),
        vehicles=table("raw_vehicle_positions"),
        stops=table("raw_trip_stop_updates"),
        alerts=table("raw_alerts"),
        errors=table("ingest_errors"),
        landed_audit=audit,
    )


def poll_audit(audit: DataFrame, polls: DataFrame) -> DataFrame:
    """Audit rows with how often, and when last, each snapshot was polled.

    Poll counts change after a snapshot has landed, so they are an aggregate
    over the append-only poll log and not a stored value. A snapshot polled
    very often is combined before the shuffle.
    """
    seen = polls.groupBy("fetch_id").agg(
        F.count(F.lit(1)).cast("int").alias("_polls"), F.max("polled_at").alias("_last")
    )
    counted = audit.join(seen, "fetch_id", "left").withColumns(
        {
            "poll_count": F.coalesce("_polls", "poll_count"),
            "last_polled_at": F.coalesce("_last", "last_polled_at"),
        }
    )
    return counted.select(*audit.columns)


def write_models(models: Mapping[str, DataFrame], folder: str) -> None:
    """Write each model as a table of its own under a new folder."""
    for name, model in models.items():
        model.write.parquet(f"{folder}/{name}")


def new_version(root: str) -> str:
    """The folder of a rebuild that nobody reads yet."""
    return f"{root}/versions/{uuid.uuid4().hex}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the version published last."""
    version = Files(spark, root).read(f"{root}/current")
    return f"{root}/versions/{version}" if version else None


def publish_version(spark: SparkSession, root: str, folder: str) -> list[str]:
    """Let readers of ``root`` see this rebuild from now on; all models change in one step.

    The version before stays for those who read it still, older ones go. Returns
    the folders of the versions that stay.
    """
    files, version = Files(spark, root), folder.rsplit("/", 1)[1]
    before = files.read(f"{root}/current")
    files.write(f"{root}/current", version)
    kept = [name for name in dict.fromkeys((version, before)) if name]
    for name in files.names(f"{root}/versions"):
        if name not in kept:
            files.remove(f"{root}/versions/{name}")
    return [f"{root}/versions/{name}" for name in kept]


def write_folder_list(files: Files, folder: str, name: str, folders: list[str]) -> None:
    """Let a model of a version be the rows of some folders, which other versions may have too."""
    files.write(f"{folder}/{name}.folders", json.dumps(folders))


def read_models(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The models of the version published last."""
    files, version = Files(spark, root), current_version(spark, root)
    if version is None:
        raise ModelsNotBuilt(root)

    def model(name: str) -> DataFrame:
        folders = files.read(f"{version}/{name}.folders")
        return spark.read.parquet(*(json.loads(folders) if folders else [f"{version}/{name}"]))

    return {name: model(name) for name in names}


def register_views(models: Mapping[str, DataFrame]) -> None:
    for name, model in models.items():
        model.createOrReplaceTempView(name)


def missing_models(spark: SparkSession, required: Iterable[str]) -> list[str]:
    """Required models the catalog does not have, in the order asked for."""
    return [name for name in required if not spark.catalog.tableExists(name)]


class ModelsNotBuilt(RuntimeError):
    """Some model a report needs does not exist yet."""


def check_ready(spark: SparkSession, required: Iterable[str]) -> None:
    missing = missing_models(spark, required)
    if missing:
        raise ModelsNotBuilt(", ".join(missing))
