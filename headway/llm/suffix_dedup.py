"""Passages that occur more than once, by intervals of a suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batch, in_batches, python_rows, release, staged, text_bytes

#: Length of the strings whose smallest hash anchors a window.
ANCHOR = 64
#: Suffixes of one anchor that are sorted together; more are dealt to several chunks.
CHUNK = 2000
#: Texts are hashed in pieces of so many windows.
_PIECE = 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE_BITS = np.uint64(24)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Anchors:
    """Winnowing: each window of a text is anchored at its smallest-hashed string.

    Equal windows have their anchor at the same place, so two texts can share a
    window only if they share an anchor's string.
    """

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor = window, anchor
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self._up, self._down = _powers(_BASE, n), _powers(_INVERSE, n)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of the ``anchor`` bytes at each place: a polynomial by prefix sums, well mixed."""
        if len(data) >= len(self._up):
            self._grow(2 * len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._down[: len(data)], out=sums[1:])
        value = (sums[self.anchor :] - sums[: -self.anchor]) * self._up[: len(data) - self.anchor + 1]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        return value

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor: its place, first and last start of its windows, its hash."""
        parts = []
        for start in range(0, max(0, len(text) - self.window + 1), _PIECE):
            parts.append(self._piece(text, start, text[start : start + _PIECE + self.window - 1]))
        if not parts:
            nothing = np.empty(0, np.int64)
            return nothing, nothing, nothing, np.empty(0, np.uint64)
        return tuple(np.concatenate(column) for column in zip(*parts))

    def _piece(self, text: bytes, start: int, piece: bytes):
        value = self._hashes(np.frombuffer(piece, np.uint8))
        width = self.window - self.anchor + 1
        places = np.arange(len(value), dtype=np.uint64)
        # The place breaks ties, the first of equal hashes wins.
        key = (value >> _PLACE_BITS << _PLACE_BITS) | places
        least = _sliding_min(key, width)
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        place = at[first]
        return place + start, first + start, last + start, value[place]


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(key)
    pad = -n % width
    blocks = np.pad(key, (0, pad), constant_values=np.iinfo(np.uint64).max).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def prefix_intervals(suffixes: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals of sorted suffixes, children before parents.

    A stack scan of the longest common prefixes of neighbours; yields (first,
    last, length) for each group of two or more suffixes that
    share ``length`` bytes and no more.
    """
    stack: list[tuple[int, int]] = []  # (first suffix, length)
    n = len(suffixes)
    for i in range(1, n + 1):
        length = common_prefix(suffixes[i - 1], suffixes[i]) if i < n else -1
        first = i - 1
        while stack and stack[-1][1] > length:
            first, held = stack.pop()
            yield first, i - 1, held
        if i < n and (not stack or stack[-1][1] < length):
            stack.append((first, length))


def maximal_repeats(
    lefts: list[bytes], rights: list[bytes], window: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Groups of occurrences that share at least ``window`` bytes around one anchor.

    ``rights`` are the suffixes at the anchor, ``lefts`` the text before it,
    reversed. Yields (bytes shared to the left, to the right, occurrences): for
    each interval of the suffix array, its members are told apart by what stands
    to their left. Members that agree far enough repeat; if their next byte to
    the left differs, the group is extended no further, else the longer left
    extension is found as an interval of the reversed lefts among them. All
    occurrences of a group are given, not only neighbours.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    for first, last, right in prefix_intervals([rights[i] for i in order]):
        least = window - right
        members = order[first : last + 1]
        if least <= 0:
            alike = [members]
        else:
            by_left: dict[bytes, list[int]] = {}
            for i in members:
                if len(lefts[i]) >= least:
                    by_left.setdefault(lefts[i][:least], []).append(i)
            alike = [group for group in by_left.values() if len(group) > 1]
        for group in alike:
            # Left-diverse members end here; the others go on together.
            ranked = sorted(group, key=lefts.__getitem__)
            for low, high, left in prefix_intervals([lefts[i] for i in ranked]):
                if left >= max(0, least):
                    yield left, right, ranked[low : high + 1]


def _spread(lefts: list[bytes], rights: list[bytes], window: int) -> tuple[list[int], list[int]]:
    """How far each occurrence repeats to the left and to the right; -1 if it does not."""
    left_most, right_most = [-1] * len(lefts), [-1] * len(lefts)
    if len(lefts) == 2:
        left, right = common_prefix(*lefts), common_prefix(*rights)
        if left + right >= window:
            return [left, left], [right, right]
        return left_most, right_most
    for left, right, group in maximal_repeats(lefts, rights, window):
        for i in group:
            if left > left_most[i]:
                left_most[i] = left
            if right > right_most[i]:
                right_most[i] = right
    return left_most, right_most


_DOC_SQL = "doc_id long, doc_key long, n_bytes long, sha256 string, hashes binary"
_DOC = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("doc_key", pa.int64()),
        ("n_bytes", pa.int64()),
        ("sha256", pa.string()),
        ("hashes", pa.binary()),
    ]
)


def _anchor_hashes(window: int, anchor: int):
    def run(batches):
        anchors = _Anchors(window, anchor)
        rows = (
            (doc_id, key, len(text), hashlib.sha256(text).hexdigest(), anchors.of(text)[3].tobytes())
            for doc_id, key, text in python_rows(batches)
        )
        return in_batches(_DOC, rows, 500)

    return run


def _one_row_each(batches):
    """A row per document and different hash, with how often the document has it."""
    schema = pa.schema([("hash", pa.int64()), ("doc_key", pa.int64()), ("own", pa.int64())])
    for one in batches:
        for start in range(0, one.num_rows, 200):
            keys, raw = (c.to_pylist() for c in one.slice(start, 200).columns)
            counted = [np.unique(np.frombuffer(x, np.int64), return_counts=True) for x in raw]
            owners = np.repeat(np.array(keys, np.int64), [len(x) for x, _ in counted])
            yield batch(
                schema, [np.concatenate([x for x, _ in counted]), owners, np.concatenate([n for _, n in counted])]
            )


_PLACE_SQL = "hash long, chunk int, chunks int, doc_key long, place int, before binary, after binary"
_PLACE = pa.schema(
    [
        ("hash", pa.int64()),
        ("chunk", pa.int32()),
        ("chunks", pa.int32()),
        ("doc_key", pa.int64()),
        ("place", pa.int32()),
        ("before", pa.binary()),
        ("after", pa.binary()),
    ]
)


def _occurrences(window: int, anchor: int, chunk: int):
    """Each anchor whose string occurs again, with the text of its windows around it."""

    def run(batches):
        anchors = _Anchors(window, anchor)

        def rows():
            for key, text, repeated in python_rows(batches):
                count = {x["hash"]: x["n"] for x in repeated}
                places, firsts, lasts, hashes = anchors.of(text)
                hashes = hashes.view(np.int64)
                kept = np.flatnonzero(np.isin(hashes, np.fromiter(count, np.int64, len(count))))
                for i in kept.tolist():
                    place, hashed = int(places[i]), int(hashes[i])
                    chunks = -(-count[hashed] // chunk)
                    at = xxhash.xxh3_64_intdigest(b"%d %d" % (key, place)) % chunks
                    before = text[int(firsts[i]) : place][::-1]
                    yield hashed, at, chunks, key, place, before, text[place : int(lasts[i]) + window]

        return in_batches(_PLACE, rows(), 2000)

    return run


_SPAN_SQL = "doc_key long, first long, last long, window binary"
_SPAN = pa.schema(
    [("doc_key", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("window", pa.binary())]
)


def _repeats(window: int):
    """Repeated spans of the occurrences, which come sorted by anchor.

    For an anchor in several chunks, also a row per window that is still single
    here, and one of each group: such a window may occur in another chunk.
    """

    def group_rows(held):
        lefts, rights = [r[5] for r in held], [r[6] for r in held]
        left_most, right_most = _spread(lefts, rights, window)
        split = held[0][2] > 1
        seen: set[bytes] = set()
        for row, left, right in zip(held, left_most, right_most):
            key, place = row[3], row[4]
            if left >= 0:
                yield key, place - left, place + right, None
            if split:
                text = row[5][::-1] + row[6]
                start = place - len(row[5])
                for i in range(len(text) - window + 1):
                    inside = left >= 0 and start + i >= place - left and start + i + window <= place + right
                    digest = xxhash.xxh3_128_digest(text[i : i + window])
                    if inside and digest in seen:
                        continue
                    seen.add(digest)
                    yield key, start + i, start + i + window, digest

    def run(batches):
        def rows():
            held: list[tuple] = []
            for row in python_rows(batches):
                if held and row[:2] != held[0][:2]:
                    if len(held) > 1 or held[0][2] > 1:
                        yield from group_rows(held)
                    held = []
                held.append(row)
            if held and (len(held) > 1 or held[0][2] > 1):
                yield from group_rows(held)

        return in_batches(_SPAN, rows(), 5000)

    return run


def repeated_spans(docs: DataFrame, window: int, anchor: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The documents (``_DOC_SQL`` without hashes) and the spans that repeat elsewhere, both staged.

    ``docs``: doc_id, doc_key, text. Of a document (doc_key) the spans are an
    array of (first, last), which may overlap.
    """
    shape = _anchor_hashes(window, anchor)
    described = staged(docs.mapInArrow(shape, _DOC_SQL), "anchors")
    hashes = described.select("doc_key", "hashes").mapInArrow(_one_row_each, "hash long, doc_key long, own long")
    counts = hashes.groupBy("hash").agg(F.sum("own").alias("n")).filter("n > 1")
    repeated = staged(hashes.join(counts, "hash").select("hash", "doc_key", "n"), "repeated")
    plain = staged(described.drop("hashes"), "described")
    release(described)
    per_doc = repeated.groupBy("doc_key").agg(F.collect_list(F.struct("hash", "n")).alias("repeated"))
    texts = docs.select("doc_key", "text").join(per_doc, "doc_key")
    places = texts.mapInArrow(_occurrences(window, anchor, chunk), _PLACE_SQL)
    dealt = places.repartition("hash", "chunk").sortWithinPartitions("hash", "chunk")
    found = staged(dealt.mapInArrow(_repeats(window), _SPAN_SQL), "spans")
    release(repeated)
    windows = found.filter("window IS NOT NULL")
    again = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    across = windows.join(again, "window", "left_semi")
    spans = found.filter("window IS NULL").unionByName(across).select("doc_key", "first", "last").distinct()
    per_doc = spans.groupBy("doc_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    per_doc = staged(per_doc, "doc-spans")
    release(found)
    return plain, per_doc


def merge_spans(first: list[int], last: list[int]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first, last)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes of the spans."""
    kept, at = [], 0
    for first, last in spans:
        kept.append(text[at:first])
        at = last
    kept.append(text[at:])
    return b"".join(kept)


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans drawn in to whole characters, so that what is left is a text."""
    out = []
    for first, last in spans:
        while first < last and text[first] & 0xC0 == 0x80:
            first += 1
        while last > first and last < len(text) and text[last] & 0xC0 == 0x80:
            last -= 1
        if first < last:
            out.append((first, last))
    return out


_CUT_SQL = "doc_key long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
_CUT = pa.schema(
    [
        ("doc_key", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept_text", pa.string()),
    ]
)


def _cut_rows(with_text: bool):
    def run(batches):
        def rows():
            for key, text, spans in python_rows(batches):
                merged = merge_spans([s["first"] for s in spans], [s["last"] for s in spans])
                removed = sum(b - a for a, b in merged)
                sha = hashlib.sha256(cut(text, merged)).hexdigest()
                kept = cut(text, _whole_characters(text, merged)).decode("utf-8", "replace") if with_text else None
                yield key, removed, len(merged), sha, kept

        return in_batches(_CUT, rows(), 200)

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, doc_key (of id and text) and text as bytes."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(id_col).cast("long"), text).alias("doc_key"),
        text_bytes(text_col).alias("text"),
    )


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 200,
    anchor: int = ANCHOR,
    chunk: int = CHUNK,
    with_text: bool = False,
) -> DataFrame:
    """Remove every byte covered by a string of ``window`` bytes that occurs again.

    Returns a row per row of ``docs``: doc_id, doc_key, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256; with ``with_text`` also
    kept_text, for which spans are drawn in to whole characters (null where
    nothing was removed). Null texts are empty; texts shorter than ``window``
    keep all bytes. Repeated rows repeat each other's strings, so they lose all
    of them. Other columns are ignored; an empty table gives an empty result.

    Windows are anchored by winnowing. Only anchors whose string occurs twice
    are looked at again: the suffixes at one anchor are sorted, with their
    common prefixes, and scanned for intervals whose members also agree to the
    left. An anchor with very many suffixes is dealt to chunks; windows single
    in a chunk are then counted across its chunks, a row per chunk.
    """
    plain = keyed(docs, id_col, text_col)
    described, per_doc = repeated_spans(plain, window, anchor, chunk)
    texts = plain.select("doc_key", "text")
    removed = staged(texts.join(per_doc, "doc_key").mapInArrow(_cut_rows(with_text), _CUT_SQL), "cut")
    removed = removed.dropDuplicates(["doc_key"])
    result = described.join(removed, "doc_key", "left")
    columns = [
        "doc_id",
        "doc_key",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    ]
    return result.select(*columns, *(["kept_text"] if with_text else []))
