"""Exact duplicates by Grace hash partitioning and content tables."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import in_batches, python_rows, release, staged, text_bytes

#: The characters that do not count when texts are compared.
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of distinct content a table may hold before further content is spilled.
TABLE_BYTES = 48 << 20


class ContentTable:
    """An open-addressing hash table whose keys are complete contents.

    Linear probing; a slot whose hash agrees is compared byte by byte. For each
    content it keeps the row that stays (longest original, then smallest id,
    null ids last) and the number of rows.
    """

    def __init__(self) -> None:
        self._slots = [-1] * 1024
        self.entries: list[list] = []
        self.bytes = 0

    def _find(self, hashed: int, content: bytes) -> tuple[int, int]:
        mask = len(self._slots) - 1
        at = hashed & mask
        while (entry := self._slots[at]) >= 0:
            held = self.entries[entry]
            if held[0] == hashed and held[1] == content:
                return at, entry
            at = (at + 1) & mask
        return at, -1

    def _grow(self) -> None:
        self._slots = [-1] * (2 * len(self._slots))
        mask = len(self._slots) - 1
        for entry, held in enumerate(self.entries):
            at = held[0] & mask
            while self._slots[at] >= 0:
                at = (at + 1) & mask
            self._slots[at] = entry

    def add(self, content: bytes, chars: int, doc_id, rows: int, full: bool) -> bool:
        """Count the rows under ``content``; False if it is new and the table is full."""
        hashed = xxhash.xxh3_64_intdigest(content)
        at, entry = self._find(hashed, content)
        if entry < 0:
            if full:
                return False
            self._slots[at] = len(self.entries)
            self.entries.append([hashed, content, chars, doc_id, rows])
            self.bytes += len(content) + 200
            if 2 * len(self.entries) > len(self._slots):
                self._grow()
            return True
        held = self.entries[entry]
        held[4] += rows
        if (-chars, doc_id is None, doc_id) < (-held[2], held[3] is None, held[3]):
            held[2], held[3] = chars, doc_id
        return True


_MEMBERS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("text_sha256", pa.string()),
        ("chars", pa.int64()),
        ("content", pa.binary()),
        ("keep_id", pa.int64()),
        ("rows", pa.int64()),
    ]
)
_MEMBERS_SQL = (
    "doc_id long, text_key long, text_sha256 string, chars long,"
    " content binary, keep_id long, rows long"
)
_GROUPS_SQL = "text_sha256 string, chars long, content binary, keep_id long, rows long"
_GROUPS = pa.schema([_MEMBERS.field(n) for n in ("text_sha256", "chars", "content", "keep_id", "rows")])


def _local_groups(batches):
    """A row for each document, and for each content met in the task a row with it.

    Copies within a task meet in a table first, so a group of any size sends its
    content at most once per task and table filling.
    """

    def rows():
        table = ContentTable()
        shas: list[str] = []

        def flush():
            for (_, content, chars, doc_id, n), sha in zip(table.entries, shas):
                yield None, None, sha, chars, content, doc_id, n

        for doc_id, text_key, text in python_rows(batches):
            content = text.translate(None, WHITE_SPACE)
            sha = hashlib.sha256(content).hexdigest()
            chars = len(text.decode("utf-8", "replace"))
            yield doc_id, text_key, sha, chars, None, None, None
            if table.bytes > TABLE_BYTES // 4:
                yield from flush()
                table, shas = ContentTable(), []
            known = len(table.entries)
            table.add(content, chars, doc_id, 1, False)
            if len(table.entries) > known:
                shas.append(sha)
        yield from flush()

    return in_batches(_MEMBERS, rows(), 200)


def _buckets(table_bytes: int):
    """Groups of one partition. What does not fit the table is handed on whole."""

    def run(batches):
        def rows():
            table = ContentTable()
            shas: list[str] = []
            for sha, chars, content, keep_id, n in python_rows(batches):
                known = len(table.entries)
                if not table.add(content, chars, keep_id, n, table.bytes > table_bytes):
                    yield sha, chars, content, keep_id, n
                elif len(table.entries) > known:
                    shas.append(sha)
            for (_, _, chars, doc_id, n), sha in zip(table.entries, shas):
                yield sha, chars, None, doc_id, n

        return in_batches(_GROUPS, rows(), 200)

    return run


def exact_groups(contents: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: text_sha256, keep_id, keep_chars, group_size.

    ``contents`` (columns of ``_GROUPS_SQL``) is dealt by a hash of the content;
    each partition fills one content table. Content that comes when a table is
    full goes to spill files in the shared folder, and is dealt again by another
    hash to other partitions, until all of it has met a table. There are as many
    partitions as the content left needs, so levels do not grow with the data;
    the spill files of a level go when the next one is written.
    """
    done: list[DataFrame] = []
    before: DataFrame | None = None
    level = 0
    while True:
        # As many partitions as fill a quarter of a table each, however much is left.
        left = contents.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
        dealt = contents.repartition(1 + 4 * left // table_bytes, F.xxhash64(F.lit(level), "text_sha256"))
        out = staged(dealt.mapInArrow(_buckets(table_bytes), _GROUPS_SQL), f"grace-{level}")
        if before is not None:
            release(before)
        groups = out.filter("content IS NULL").drop("content")
        contents = out.filter("content IS NOT NULL")
        if not contents.limit(1).count():
            break
        done.append(staged(groups, f"grace-groups-{level}"))
        before, level = out, level + 1
    for more in done:
        groups = groups.unionByName(more)
    return groups.select(
        "text_sha256",
        "keep_id",
        F.col("chars").alias("keep_chars"),
        F.col("rows").alias("group_size"),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """Mark all but one of the documents whose texts are equal but for white space.

    Returns a row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (of the text without white space), text_key (xxhash64 of the
    text as it is, to find the row again). The longest original stays, then the
    smallest id; null ids come last. A null text is empty, and empty texts (or
    all white space) are equal. Of rows that repeat id and length within a
    group one is kept. Other columns of ``docs`` are not looked at. An empty
    table gives an empty result.

    Copies are collapsed within each task before their content is shuffled, and
    membership travels without content, so a hot group costs small rows only.
    """
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
        text_bytes(text_col).alias("text"),
    )
    local = staged(plain.mapInArrow(_local_groups, _MEMBERS_SQL), "exact-local")
    contents = local.filter("content IS NOT NULL").select(*_GROUPS.names)
    groups = exact_groups(contents, table_bytes)
    members = local.filter("content IS NULL").select("doc_id", "text_key", "text_sha256", "chars")
    members = staged(members, "exact-members")
    release(local)
    marked = members.join(groups, "text_sha256")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    same = Window.partitionBy("text_sha256", "text_key").orderBy("chars")
    kept = marked.filter(stays).withColumn("kept", F.row_number().over(same) == 1)
    # Rows of one id and length may still differ in their white space.
    first = Window.partitionBy("text_sha256").orderBy("text_key")
    kept = kept.withColumn("kept", F.col("kept") & (F.dense_rank().over(first) == 1))
    rest = marked.filter(~stays).withColumn("kept", F.lit(False))
    return kept.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256", "text_key"
    )
