"""Byte-level BPE with a segment tree over the positions of each piece."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import in_batches, python_rows, text_bytes

_PIECE_CACHE = 300_000
#: Pieces up to this many bytes are merged side by side, longer ones one by one.
_SIDE_BY_SIDE = 64
_NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encodes pieces: the adjacent pair of lowest rank, leftmost first, is merged until none is known."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self._pairs = {
            (left << 32) | right: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        }
        keys = np.fromiter(self._pairs, np.int64, len(self._pairs))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], _NONE)
        self._values = np.append(np.fromiter(self._pairs.values(), np.int64, len(keys))[order], _NONE)
        self._known: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` if they do not merge."""
        key = (left << 32) | right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._values[at], _NONE)

    def _merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of alike length, each merged along its own segment tree.

        Row i of ``tree`` is the tree of piece i: leaf p holds the rank of the
        pair that starts at byte p, above its position, and every node the least
        below it. So the root is the leftmost pair of lowest rank. A merge
        changes three leaves and the nodes above them.
        """
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        leaves = 1 << max(1, int(length.max() - 1).bit_length())
        place_bits = leaves.bit_length()
        ids = np.full((n, leaves + 1), -1, np.int64)
        for i, piece in enumerate(pieces):
            ids[i, : len(piece)] = self._byte_ids[np.frombuffer(piece, np.uint8)]
        after = np.tile(np.arange(1, leaves + 2), (n, 1))
        before = np.tile(np.arange(-1, leaves), (n, 1))
        places = np.arange(leaves)
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        rank = self._rank_of(ids[:, :-1], np.maximum(ids[:, 1:], 0))
        paired = (places[None, :] + 1 < length[:, None]) & (rank != _NONE)
        tree[:, leaves:] = np.where(paired, (rank << place_bits) | places, _NONE)
        node = leaves
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            place = root & ((1 << place_bits) - 1)
            gone = after[rows, place]
            following = after[rows, gone]
            ids[rows, place] = root >> place_bits
            ids[rows, gone] = -1
            after[rows, place] = following
            inside = following < length[rows]
            before[rows[inside], following[inside]] = place[inside]
            self._set_leaf(tree, rows, gone, np.full(len(rows), _NONE), leaves)
            value = np.full(len(rows), _NONE)
            rank = self._rank_of(ids[rows, place], np.where(inside, ids[rows, np.minimum(following, leaves)], 0))
            good = inside & (rank != _NONE)
            value[good] = (rank[good] << place_bits) | place[good]
            self._set_leaf(tree, rows, place, value, leaves)
            back = before[rows, place]
            has = np.flatnonzero(back >= 0)
            if len(has):
                own, at = rows[has], back[has]
                rank = self._rank_of(ids[own, at], ids[own, place[has]])
                value = np.where(rank != _NONE, (rank << place_bits) | at, _NONE)
                self._set_leaf(tree, own, at, value, leaves)
            rows = rows[tree[rows, 1] != _NONE]
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    @staticmethod
    def _set_leaf(tree: np.ndarray, rows: np.ndarray, place: np.ndarray, value: np.ndarray, leaves: int) -> None:
        node = place + leaves
        tree[rows, node] = value
        while leaves > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            leaves >>= 1

    def _merge_long(self, piece: bytes) -> bytes:
        """The same for one long piece, its tree a plain list."""
        pairs = self._pairs.get
        ids = self._byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        leaves = 1 << (n - 1).bit_length()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = leaves.bit_length()
        tree = [_NONE] * (2 * leaves)

        def leaf(place: int) -> int:
            following = after[place]
            rank = pairs((ids[place] << 32) | ids[following]) if following < n else None
            return _NONE if rank is None else (rank << bits) | place

        def set_leaf(place: int, value: int) -> None:
            node = place + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                left, right = tree[2 * node], tree[2 * node + 1]
                least = left if left < right else right
                if tree[node] == least:
                    return
                tree[node] = least

        for place in range(n):
            tree[leaves + place] = leaf(place)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while (root := tree[1]) != _NONE:
            place = root & ((1 << bits) - 1)
            gone = after[place]
            ids[place], ids[gone] = root >> bits, -1
            after[place] = following = after[gone]
            if following < n:
                before[following] = place
            set_leaf(gone, _NONE)
            set_leaf(place, leaf(place))
            if (back := before[place]) >= 0:
                set_leaf(back, leaf(back))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Encode pieces not met before. A piece that is a token is that token."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            rank = self._ranks.get(raw)
            if rank is not None:
                self._known[piece] = rank.to_bytes(4, "little")
            elif len(raw) > _SIDE_BY_SIDE:
                self._known[piece] = self._merge_long(raw)
            else:
                groups.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in groups.values():
            for start in range(0, len(group), 8192):
                part = group[start : start + 8192]
                for (piece, _), ids in zip(part, self._merge_together([raw for _, raw in part])):
                    self._known[piece] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self._pattern.findall(text) for text in texts]
        if len(self._known) > _PIECE_CACHE:
            self._known.clear()
        self._learn(set().union(*split).difference(self._known))
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in split]


@lru_cache(maxsize=1)
def byte_bpe(ranks_path: str, pattern: str) -> ByteBpe:
    """The encoder of this process: what one task has learnt serves the next."""
    return ByteBpe(read_ranks(ranks_path), pattern)


_ENCODED_SQL = "doc_id long, n_tokens long, ids binary, decoded binary"
_ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
)


@lru_cache(maxsize=1)
def token_bytes(ranks_path: str) -> list[bytes]:
    """The bytes of each token, by its id."""
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes that little-endian 32-bit ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_decoded: bool = False,
) -> DataFrame:
    """Ids of every whole text: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    The text is split by ``pattern`` and each match encoded by itself, without
    special tokens. Null and empty texts have no ids. With ``with_decoded`` the
    ids are decoded again, as column ``decoded``. A row in, a row out; other
    columns are ignored.
    """

    def run(batches):
        bpe = byte_bpe(ranks_path, pattern)
        tokens = token_bytes(ranks_path) if with_decoded else []

        def rows():
            for one in batches:
                for start in range(0, one.num_rows, 300):
                    part = one.slice(start, 300)
                    texts = [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
                    for doc_id, ids in zip(part.column(0).to_pylist(), bpe.encode(texts)):
                        yield doc_id, len(ids) // 4, ids, decode(ids, tokens) if with_decoded else None

        return in_batches(_ENCODED, rows(), 300)

    plain = docs.select(F.col(id_col).cast("long"), text_bytes(text_col).alias("text"))
    encoded = plain.mapInArrow(run, _ENCODED_SQL)
    return encoded if with_decoded else encoded.drop("decoded")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, as column ``decoded``."""

    def run(batches):
        tokens = token_bytes(ranks_path)
        rows = ((doc_id, n, ids, decode(ids, tokens)) for doc_id, n, ids in python_rows(batches))
        return in_batches(_ENCODED, rows, 300)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, _ENCODED_SQL)
