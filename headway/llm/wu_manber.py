"""Benchmark decontamination by Wu-Manber search for many word strings at once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import in_batches, python_rows, slices, staged, text_bytes

#: Words of a window.
WINDOW = 10
#: Words of a block: what the shift table and the buckets are keyed by.
BLOCK = 2
#: Bytes of benchmark text that one pass over the documents searches for.
PASS_BYTES = 2 << 20
#: Items are handed on in parts of so many words that overlap by a window less one.
PART_WORDS = 4096

# A word is a run of ASCII digits, letters and all that is not ASCII.
_KEEP = frozenset(range(0x30, 0x3A)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
_TO_WORDS = bytes(
    low if (low := b + 32 if 0x41 <= b <= 0x5A else b) in _KEEP else 0x20 for b in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, A-Z lower-cased, some thousands at a time."""
    for part in slices(text.translate(_TO_WORDS)):
        yield part.split()


class WuManber:
    """Strings of ``length`` words that are looked for together.

    The shift table tells, for a block of words, how far a place can be moved
    on before the block could end a string; blocks of no string move it by the
    most there is. A shift of nothing leads to the bucket of the strings that
    end in the block, told apart by the block they begin with, and their words
    are compared one by one.
    """

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(BLOCK, length)
        self.far = length - self.block + 1
        self._shift: dict[tuple, int] = {}
        self._buckets: dict[tuple, dict[tuple, list[int]]] = {}
        self._strings: list[list[bytes]] = []
        self._owners: list[set[str]] = []

    def add(self, string: list[bytes], owner: str) -> None:
        b = self.block
        begins, ends = tuple(string[:b]), tuple(string[-b:])
        bucket = self._buckets.setdefault(ends, {}).setdefault(begins, [])
        for known in bucket:
            if self._strings[known] == string:
                self._owners[known].add(owner)
                return
        bucket.append(len(self._strings))
        self._strings.append(string)
        self._owners.append({owner})
        for end in range(b, self.length + 1):
            block = tuple(string[end - b : end])
            self._shift[block] = min(self._shift.get(block, self.far), self.length - end)

    def find(self, words: list[bytes], start: int) -> Iterator[tuple[int, set[str]]]:
        """(end, owners) of each string found whose end lies after ``start``."""
        length, b, far = self.length, self.block, self.far
        shift, buckets, strings = self._shift, self._buckets, self._strings
        end, size = max(start + 1, length), len(words)
        while end <= size:
            block = tuple(words[end - b : end])
            step = shift.get(block, far)
            if step:
                end += step
                continue
            for known in buckets[block].get(tuple(words[end - length : end - length + b]), ()):
                if words[end - length : end] == strings[known]:
                    yield end, self._owners[known]
                    break
            end += 1


def build(parts: list[tuple[str, str]], window: int) -> list[WuManber]:
    """A searcher for each length of string: whole windows, and short items as they are."""
    searchers: dict[int, WuManber] = {}
    for item, text in parts:
        words = text.encode().split(b" ")
        length = min(window, len(words))
        searcher = searchers.setdefault(length, WuManber(length))
        for at in range(len(words) - length + 1):
            searcher.add(words[at : at + length], item)
    return [searchers[length] for length in sorted(searchers)]


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def search(searchers: list[WuManber], text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of a text, the maximal runs of words that are hit, and the items found.

    The text is gone through in slices, each with the last words of the one
    before, so what is held of a long text is its bytes and one slice of words.
    """
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    longest = max((s.length for s in searchers), default=1)
    held: list[bytes] = []
    n = 0
    for fresh in words_of(text):
        words = held + fresh
        base = n - len(held)
        found = []
        for searcher in searchers:
            for end, owners in searcher.find(words, len(held)):
                found.append((base + end - searcher.length, base + end))
                items |= owners
        spans += joined(found)
        n += len(fresh)
        held = words[max(0, len(words) - longest + 1) :]
    return n, joined(spans), items


_PARTS_SQL = "item string, part string, bytes long"
_PARTS = pa.schema([("item", pa.string()), ("part", pa.string()), ("bytes", pa.int64())])


def _parts(window: int):
    """Items as words with a space between, in parts that have every window whole."""

    def run(batches):
        def rows():
            for item, text in python_rows(batches):
                held: list[bytes] = []
                for fresh in words_of(text):
                    held += fresh
                    while len(held) > PART_WORDS + window:
                        part = b" ".join(held[:PART_WORDS])
                        yield item, part.decode(), len(part)
                        held = held[PART_WORDS - window + 1 :]
                if held:
                    part = b" ".join(held)
                    yield item, part.decode(), len(part)

        return in_batches(_PARTS, rows(), 100)

    return run


_FOUND_SQL = (
    "doc_id long, text binary, n_words long, items array<string>,"
    " spans array<struct<start: long, end: long>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.binary()),
        ("n_words", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(_SPAN)),
    ]
)


#: The searchers of the pass a process works on, kept from task to task.
_built: dict[str, list[WuManber]] = {}


def _searchers(name: str, parts: list[tuple[str, str]], window: int) -> list[WuManber]:
    if name not in _built:
        _built.clear()
        _built[name] = build(parts, window)
    return _built[name]


def _pass(name: str, parts: list[tuple[str, str]], window: int, last: bool):
    """Search all documents for the strings of one block, adding to what was found."""

    def run(batches):
        searchers = _searchers(name, parts, window)

        def rows():
            for doc_id, text, _, items, spans in python_rows(batches):
                n, found, owners = search(searchers, text)
                both = joined([(s["start"], s["end"]) for s in spans] + found)
                yield (
                    doc_id, None if last else text, n, sorted(owners.union(items)),
                    [{"start": a, "end": b} for a, b in both],
                )

        return in_batches(_FOUND, rows(), 200)

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Find in each document the windows of words that benchmark items consist of.

    Returns a row per row of ``docs``: doc_id, n_words, items (the ids of the
    items found, as text, in byte order) and spans (the maximal runs of words
    inside any window that occurs, by word number, the end not included). An
    item of fewer words than ``window`` is one window; one without words is
    nothing to look for. Windows never cross documents. A null text has no
    words. Repeated rows of either table change nothing but the repeated rows
    of the result; items without an id count as one item named by an empty
    text. Other columns are not looked at. An empty table of documents gives an
    empty result, an empty benchmark no hits.

    The benchmark is dealt to blocks of about ``pass_bytes``, and the documents
    are searched for one block after the other: a benchmark of ordinary size is
    one pass without a shuffle, a larger one costs passes, not memory.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        text_bytes(item_text_col).alias("text"),
    )
    parts = staged(items.mapInArrow(_parts(window), _PARTS_SQL).distinct(), "benchmark-parts")
    total = parts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_bytes))
    block = F.pmod(F.xxhash64("item", "part"), F.lit(passes))
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_bytes(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
    )
    for number in range(passes):
        own = [tuple(row) for row in parts.filter(block == number).select("item", "part").collect()]
        last = number == passes - 1
        found = found.mapInArrow(_pass(uuid.uuid4().hex, own, window, last), _FOUND_SQL)
        if not last:
            found = staged(found, f"searched-{number}")
    return found.drop("text")


def hit_words(spans: str = "spans"):
    """How many words the runs of a document hold."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def drop_contaminated(docs: DataFrame, found: DataFrame, most: float = 0.0, id_col: str = "doc_id") -> DataFrame:
    """Documents of which no more than a share of ``most`` of the words is hit.

    Rows that share an id, or have none, are judged by the worst of them.
    """
    share = F.coalesce(hit_words() / F.nullif("n_words", F.lit(0).cast("long")), F.lit(0.0))
    hit = found.filter(share > most).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, F.col(id_col).cast("long").eqNullSafe(F.col("__hit")), "left_anti")
