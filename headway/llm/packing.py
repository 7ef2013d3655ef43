"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import in_batches, staged, text_bytes

#: Token that ends every document.
END = b"\0\0\0\0"
#: Pieces packed together. A shard wastes at most its last sequence.
SHARD_PIECES = 20_000
_CORE_CACHE = 1_000_000
#: Marks that end words; an apostrophe may join what follows it.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: What the vocabulary's added tokens begin with.
_ADDED = b"<|"
#: The printable stand-ins of bytes in byte-level vocabularies. Printable
#: Latin-1 characters stand for themselves, the others for characters from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_STAND_IN = [chr(b) if b in _PRINTABLE else chr(256 + _OTHERS.index(b)) for b in range(256)]


class WordTokenizer:
    """Ids of whole texts, remembered by word.

    The vocabulary's rules never look across ASCII white space: it normalises to
    a space, composes with nothing, and no split keeps it. So the ids of a text
    are those of its words, one after the other. Marks after a letter or digit
    are a piece of their own, so a word is looked up by its core and its marks.
    A core of Latin letters is one piece already: it goes straight to the
    vocabulary's merges. Any other goes through the whole tokenizer, and so does
    a word that may hold one of its added tokens, as it is, which come first.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._known: dict[bytes, bytes] = {}

    def _encode(self, core: bytes) -> bytes:
        """The ids of one core, or of a run of marks."""
        if _ADDED not in core and core.isascii() and (core.isalpha() or not core.strip(_MARKS)):
            ids = [token.id for token in self._merge(core.lower().decode())]
        else:
            word = core.decode("utf-8", "replace")
            if word.isalpha() and max(word) < "\u0250" and "\u0130" not in word:
                # Composed and lower-cased as the tokenizer would, byte by byte in stand-ins.
                raw = unicodedata.normalize("NFC", word).lower().encode()
                ids = [token.id for token in self._merge("".join([_STAND_IN[b] for b in raw]))]
            else:
                ids = self._tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _look_up(self, words: set[bytes]) -> dict[bytes, bytes]:
        known = self._known
        if len(known) > _CORE_CACHE:
            known.clear()
        found: dict[bytes, bytes] = {}
        for word in words:
            ids = known.get(word)
            if ids is None:
                core = word if _ADDED in word else word.rstrip(_MARKS)
                if len(core) == len(word) or not _ends_piece(core):
                    known[word] = ids = self._encode(word)
                else:
                    marks = word[len(core) :]
                    first, second = known.get(core), known.get(marks)
                    if first is None:
                        known[core] = first = self._encode(core)
                    if second is None:
                        known[marks] = second = self._encode(marks)
                    ids = first + second
            found[word] = ids
        return found

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        # Lower-casing ASCII alone is what the tokenizer does, too; it makes fewer words.
        split = [
            text.lower().split() if text.isascii() and _ADDED not in text else text.split() for text in texts
        ]
        ids_of = self._look_up(set().union(*split)).__getitem__
        for words in split:
            yield b"".join(map(ids_of, words))


def _ends_piece(core: bytes) -> bool:
    """Whether marks that follow are a piece of their own: after a letter or digit."""
    last = core[-1:]
    if last <= b"\x7f":
        return last.isalnum()
    end = unicodedata.normalize("NFC", core.decode("utf-8", "replace")[-1])
    return end.lower()[-1].isalpha()


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this process: what one task has learnt serves the next."""
    return WordTokenizer(path)


_PIECE_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def _pieces(tokenizer: str, capacity: int, with_ids: bool):
    def run(batches):
        words = word_tokenizer(tokenizer)

        def rows():
            for one in batches:
                ids_of = words.ids(one.column(1).to_pylist())
                for doc_id, ids in zip(one.column(0).to_pylist(), ids_of):
                    ids += END
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        yield (
                            doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own),
                            own if with_ids else None,
                        )

        return in_batches(_PIECE, rows(), 500 if with_ids else 5000)

    return run


def fullest(lengths: list[int], counts: list[int], room: int) -> dict[int, int]:
    """How many of which lengths fill ``room`` best.

    Subset sums as a bitset: bit j of ``reach`` tells whether sum j is feasible.
    ``lengths`` descend; many of one length are taken in powers of two, so that
    any number of them can be chosen. Stops once the room can be filled.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # (reach before, length, how many)
    for length, count in zip(lengths, counts):
        if length > room:
            continue
        left, lot = min(count, room // length), 1
        while left > 0:
            lot = min(lot, left)
            grown = reach | (reach << (length * lot)) & mask
            if grown != reach:
                steps.append((reach, length, lot))
                reach = grown
            left -= lot
            lot *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for before, length, lot in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + lot
            total -= length * lot
    return chosen


def bin_patterns(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Bins as (how many of which length, how many such bins), by minimum bin slack.

    Each bin holds the longest piece left, and the fullest combination of the
    others beside it. It is removed as often as the pieces allow.
    """
    counts = dict(counts)
    lengths = sorted(counts, reverse=True)
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        chosen = fullest(lengths, [counts[x] for x in lengths], capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= n * times
        yield chosen, times
        lengths = [x for x in lengths if counts[x]]


def _pack_shard(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "piece"]).reset_index(drop=True)
        length = pieces["length"].to_numpy()
        values, first, n = np.unique(length, return_index=True, return_counts=True)
        at = dict(zip(values.tolist(), first.tolist()))
        sequence = np.empty(len(pieces), np.int64)
        offset = np.empty(len(pieces), np.int64)
        number = int(pieces["shard"].iloc[0]) << 32 if len(pieces) else 0
        for chosen, times in bin_patterns(dict(zip(values.tolist(), n.tolist())), capacity):
            for _ in range(times):
                place = 0
                for own, many in sorted(chosen.items(), reverse=True):
                    for row in range(at[own], at[own] + many):
                        sequence[row], offset[row] = number, place
                        place += own
                    at[own] += many
                number += 1
        return pieces.drop(columns="shard").assign(sequence_id=sequence, offset=offset)

    return run


def pack(pieces: DataFrame, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Place pieces in sequences of at most ``capacity`` tokens.

    ``pieces`` has doc_id, piece and length (1 to ``capacity``) among its
    columns; sequence_id and offset (gapless from 0) are added. Pieces are dealt
    at random to shards of about ``shard_pieces``, however many there are, and
    each shard is packed by itself. An empty table gives an empty result.
    """
    total = pieces.count()
    shards = max(1, -(-total // shard_pieces))
    # The number of a row within its task keeps rows that are equal apart.
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards))
    own = [f for f in pieces.schema.fieldNames()]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (
        pieces.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(_pack_shard(capacity), f"{schema}, sequence_id long, offset long")
        .select(*own, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize documents, cut what is longer than a sequence, and pack the pieces.

    ``tokenizer`` is the path of a word-end BPE vocabulary. A document is its ids
    and the end token 0; null and empty texts are the end token alone. Returns a
    row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    and ids (little-endian unsigned 32-bit) with ``with_ids``. Repeated rows are
    packed each. Other columns are ignored; an empty table gives an empty result.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    pieces = staged(plain.mapInArrow(_pieces(tokenizer, capacity, with_ids), _PIECE_SQL), "pieces")
    slim = pieces.drop("ids")
    packed = pack(slim, capacity)
    if with_ids:
        same = ["doc_id", "piece", "start", "length", "ids_crc32"]
        ids = pieces.dropDuplicates(same).withColumnsRenamed({name: f"_{name}" for name in same})
        on = [packed[name].eqNullSafe(ids[f"_{name}"]) for name in same]
        packed = packed.join(ids, on).drop(*[f"_{name}" for name in same])
    return packed
