"""Which publish seconds of a feed are landed already, as a few kilobytes per day.

A snapshot is told by its feed and the whole second it was published, so a day
of a feed is a bitmap of 86,400 places. Whoever lands a batch first files its
bitmaps; a batch whose places are all free needs no look at landed rows. What is
filed may never be committed, so a place that is taken means "look": rows decide.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.store import Files

# So many files of a day are merged into one.
MERGE_AT = 16
Places = dict[str, int]


def places(dated: DataFrame, content: Column) -> tuple[str, dict[str, Places]]:
    """A fingerprint of some polls, and the places they take on each day, in one pass.

    ``dated`` has snapshot_date, feed_key, header_timestamp and fetched_at. A
    snapshot without a publish time is told by when it was fetched, in places of
    its own. What reaches the driver is at most six bitmaps of 4 kB per feed and day.
    """
    second = F.pmod(F.unix_seconds(F.coalesce("header_timestamp", "fetched_at")), F.lit(86_400)) + 1
    rows = dated.select(
        "snapshot_date",
        "feed_key",
        F.col("header_timestamp").isNull().alias("undated"),
        F.bitmap_bucket_number(second).alias("bucket"),
        F.bitmap_bit_position(second).alias("bit"),
        content.cast("decimal(38,0)").alias("content"),
    )
    found = rows.groupBy("snapshot_date", "feed_key", "undated", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"), F.count(F.lit(1)).alias("rows"), F.sum("content").alias("content")
    )
    days: dict[str, Places] = defaultdict(dict)
    rows = total = 0
    for day, feed, undated, bucket, bits, n, content in found.collect():
        days[str(day)][f"{feed}|{int(undated)}|{bucket}"] = int.from_bytes(bits, "little")
        rows, total = rows + n, total + int(content)
    return f"{rows}:{total}", dict(days)


class Seen:
    """The places taken in one table of a root."""

    def __init__(self, spark: SparkSession, root: str, table: str) -> None:
        self._files, self._root, self._table = Files(spark, root), root, table

    def _folder(self, day: str) -> str:
        return f"{self._root}/seen/{self._table}/{day}"

    def _read(self, day: str) -> tuple[list[str], Places]:
        """The files of a day and the places they take together."""
        while True:
            names = [n for n in self._files.names(self._folder(day)) if n.endswith(".json")]
            texts = [self._files.read(f"{self._folder(day)}/{name}") for name in names]
            # A file that is gone was merged into another meanwhile.
            if None not in texts:
                break
        taken: Places = defaultdict(int)
        for text in texts:
            for key, bits in json.loads(text).items():
                taken[key] |= int.from_bytes(zlib.decompress(base64.b64decode(bits)), "little")
        return names, taken

    def _write(self, day: str, taken: Places) -> None:
        packed = {
            key: base64.b64encode(zlib.compress(bits.to_bytes((bits.bit_length() + 7) // 8, "little"))).decode()
            for key, bits in taken.items()
        }
        self._files.write(f"{self._folder(day)}/{uuid.uuid4().hex}.json", json.dumps(packed))

    def claim(self, days: dict[str, Places]) -> list[str]:
        """Take places; returns the days on which some were taken before, so rows must be looked at.

        A day that has rows but no places was landed by other means, and counts
        as taken. Files of a day are merged now and then, so there stay few.
        """
        met = []
        for day, own in days.items():
            names, taken = self._read(day)
            unknown = not names and self._files.exists(f"{self._root}/{self._table}/snapshot_date={day}")
            if unknown or any(bits & taken.get(key, 0) for key, bits in own.items()):
                met.append(day)
            if unknown:
                # Nothing is filed, so the next one looks as well.
                continue
            if any(bits & ~taken.get(key, 0) for key, bits in own.items()):
                self._write(day, own)
            if len(names) >= MERGE_AT:
                self._write(day, taken)
                for name in names:
                    self._files.remove(f"{self._folder(day)}/{name}")
        return sorted(met)
