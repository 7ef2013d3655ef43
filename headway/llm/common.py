"""What the operators share: reading, staging and Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import prepare, scratch_dir


def ready(spark: SparkSession) -> SparkSession:
    """The session prepared, with shuffle files that go early.

    Shuffle files go when the job that wrote them ends: all steps in between are
    written tables, so nothing reads them again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return prepare(spark)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(column: str) -> Column:
    """A text as UTF-8 bytes, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)).cast("int")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hash_sample(rows: DataFrame, keys: list[str], size: int, seed: int) -> DataFrame:
    """``size`` rows at most, each of another key: the first in the order of a hash of their keys.

    A threshold on the hash, taken from the number of keys, leaves twice as many
    as wanted, so no task sends the driver more than its share of them. Rows
    that repeat a key, however often, count as one.
    """
    hashed = F.xxhash64(*keys, F.lit(seed))
    share = 2.0 * size / max(1, rows.select(*keys).distinct().count())
    if share < 1:
        rows = rows.filter(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30)))
    return rows.dropDuplicates(keys).orderBy(hashed, *keys).limit(size)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def in_batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows given one by one, as batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch(schema, list(zip(*held)))
            held = []
    if held:
        yield batch(schema, list(zip(*held)))


def python_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for one in batches:
        yield from zip(*(column.to_pylist() for column in one.columns))


def slices(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes, cut at spaces; a longer word stays whole."""
    at = 0
    while len(text) - at > size:
        cut = text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def matching(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (doc_id, text_key) names, each once, with all columns."""
    names = docs.columns
    keyed = docs.withColumns(
        {
            "__id": F.col(id_col).cast("long"),
            "__key": F.xxhash64(F.col(text_col).cast("string")),
        }
    )
    keys = chosen.select(F.col("doc_id").alias("__i"), F.col("text_key").alias("__k"))
    on = keyed["__id"].eqNullSafe(keys["__i"]) & (keyed["__key"] == keys["__k"])
    return keyed.join(keys, on, "left_semi").dropDuplicates(["__id", "__key"]).select(*names)
