"""Language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batch, python_rows, staged, text_bytes

#: A context must occur this often in training.
LEAST = 2
#: Longest context, in words.
DEPTH = 3
#: Weight of what a shorter context predicts, in tokens.
PRIOR = 2.0
#: Words of documents that are visited together.
BLOCK_TOKENS = 1_000_000

#: The end of a text; no word hashes an empty string.
END = np.uint64(xxhash.xxh3_64_intdigest(b""))


def tokens(text: bytes) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased, then an empty string for the end."""
    out = text.lower().split()
    out.append(b"")
    return out


def _pack(values: np.ndarray) -> bytes:
    """Numbers by planes: the first bytes of all, then the second bytes, and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).data)


def _unpack(packed: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and for each value which of them it is.

    Sorted by their leading bits with the place in the bits below, which is much
    faster than sorting places by value. If values share the leading bits but
    differ below, the order may be wrong, so it is looked at and made anew.
    """
    n = len(values)
    which = np.empty(n, np.int32)
    if not n:
        return values, which
    low, for_place = values.min(), n.bit_length()
    cut = max(0, int(values.max() - low).bit_length() + for_place - 64)
    marked = (((values - low) >> np.uint64(cut)) << np.uint64(for_place)) | np.arange(n, dtype=np.uint64)
    marked.sort()
    order = (marked & np.uint64((1 << for_place) - 1)).view(np.int64)
    ranked = values[order]
    if cut and (ranked[1:] < ranked[:-1]).any():
        order = np.argsort(values)
        ranked = values[order]
    new = np.ones(n, bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return ranked[new], which


# Blocks of documents: words as numbers, frequent ones first, into the block's list of word hashes

_BLOCK_SQL = "in_block long, n_tokens long, ids binary, hashes binary, doc_ids binary, nulls binary, held binary, sizes binary"
_BLOCK = pa.schema(
    [("in_block", pa.int64()), ("n_tokens", pa.int64())]
    + [(name, pa.binary()) for name in ("ids", "hashes", "doc_ids", "nulls", "held", "sizes")]
)


class _Numbers(dict):
    """Numbers of words, given in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _block(number: int, known: dict[bytes, int], docs: list[tuple]) -> pa.RecordBatch:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    doc_ids, held, ids = zip(*docs)
    places = np.concatenate(ids)
    order = np.argsort(-np.bincount(places), kind="stable")
    number_of = np.empty(len(order), np.int32)
    number_of[order] = np.arange(len(order), dtype=np.int32)
    places = number_of[places]
    columns = [
        places,
        hashes[order],
        np.array([0 if d is None else d for d in doc_ids], np.int64),
        np.array([d is None for d in doc_ids], bool),
        np.array(held, bool),
        np.array([len(i) for i in ids], np.int64),
    ]
    return batch(_BLOCK, [[number], [len(places)], *([_pack(c)] for c in columns)])


def _code_blocks(block_tokens: int):
    """A row per block of documents."""

    def run(batches):
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 24
        known = _Numbers()
        docs: list[tuple] = []
        waiting = 0
        for doc_id, held_out, text in python_rows(batches):
            words = tokens(text)
            docs.append((doc_id, held_out, np.fromiter(map(known.__getitem__, words), np.int32, len(words))))
            waiting += len(words)
            if waiting >= block_tokens:
                yield _block(number, known, docs)
                number, known, docs, waiting = number + 1, _Numbers(), [], 0
        if docs:
            yield _block(number, known, docs)

    return run


# What a block asks of all others: sums for its phrases, in buckets of their hashes

_COUNT, _GAIN = 0, 1
_ASK_SQL = "in_block long, kind int, level int, bucket long, keys binary, vals binary"
_ANSWER_SQL = "in_block long, kind int, level int, bucket long, vals binary, places binary, members long, total double"


def _asks(
    block: int, kind: int, level: int, hashes: np.ndarray, keys: np.ndarray, values: np.ndarray, buckets: int
) -> Iterator[tuple]:
    """The block's own share of each key's sum, a row per bucket of the sorted hashes that has any."""
    at = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield block, kind, level, int(at[a]), _pack_sorted(keys[a:b]), _pack(values[a:b])


def _answer(price: float, least: int):
    """Adds up a bucket: counts as they are, gains as whether they pay the price.

    ``places`` number the phrases that occur ``least`` times, so that they can be
    named by a small number when they are contexts. ``members`` and ``total`` of
    the bucket (phrases counted and their sum, or contexts retained) stand on its
    first row.
    """

    def run(_key: tuple, asks: pd.DataFrame) -> pd.DataFrame:
        count = int(asks["kind"].iloc[0]) == _COUNT
        keys = [_unpack_sorted(k) for k in asks["keys"]]
        values = np.concatenate([_unpack(v, np.int32 if count else np.float32) for v in asks["vals"]])
        distinct, place = _ranked(np.concatenate(keys))
        # Exact for counts, too: they are far below 2 ** 53.
        sums = np.bincount(place, weights=values, minlength=len(distinct))
        sums = sums.astype(np.int64) if count else sums
        out = sums if count else (sums > price).astype(np.uint8)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        members = np.zeros(len(asks), np.int64)
        total = np.zeros(len(asks))
        members[0], total[0] = np.count_nonzero(out), float(out.sum())
        answers = asks[["in_block", "kind", "level", "bucket"]].copy()
        answers["vals"] = [_pack(v) for v in np.split(out[place], ends)]
        answers["places"] = None
        if count:
            often = sums >= least
            named = (np.cumsum(often) - 1).astype(np.uint64)
            answers["places"] = [_pack_sorted(named[p[often[p]]]) for p in np.split(place, ends)]
        return answers.assign(members=members, total=total)

    return run


# The tree, as far as a block meets it


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a context and the word after it."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class _Phrases:
    """The phrases of one length in a block: where they end, which they are, their sorted hashes.

    ``context`` has the place, among the phrases one word shorter, of what stands
    before the last word. ``asked`` lists those places, each once. Once answered,
    ``places`` has the number, within its bucket, of each phrase frequent enough.
    """

    at: np.ndarray
    which: np.ndarray
    keys: np.ndarray
    context: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    asked: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    places: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))


class _Visit:
    """A block with what has been answered to it: counts of phrases of up to ``counted``
    words, which contexts of up to ``tested`` words are retained."""

    def __init__(self, block, answers: pd.DataFrame, least: int, counted: int, tested: int) -> None:
        self.number = int(block["in_block"])
        self.least = least
        hashes = _unpack(block["hashes"], np.uint64)
        order = np.argsort(hashes)
        sorted_place = np.empty(len(order), np.int32)
        sorted_place[order] = np.arange(len(order), dtype=np.int32)
        self.ids = sorted_place[_unpack(block["ids"], np.int32)]
        self.sizes = _unpack(block["sizes"], np.int64)
        self.held = _unpack(block["held"], bool)
        self.doc_ids = _unpack(block["doc_ids"], np.int64)
        self.nulls = _unpack(block["nulls"], bool)
        hashes = hashes[order]
        self.words = hashes[self.ids]
        self.goes_on = (hashes != END)[self.ids]
        self.train = np.repeat(~self.held, self.sizes)
        self.phrases = [_Phrases(np.arange(len(self.ids), dtype=np.int32), self.ids, hashes)]
        self.counts: list[np.ndarray] = []
        self.retained: list[np.ndarray] = []
        filed: dict[tuple, list] = {}
        columns = (answers[c] for c in ("kind", "level", "bucket", "vals", "places"))
        for kind, level, bucket, values, places in zip(*columns):
            filed.setdefault((kind, level), []).append((bucket, values, places))
        for parts in filed.values():
            parts.sort(key=lambda part: part[0])

        def told(kind: int, level: int, dtype) -> np.ndarray:
            parts = filed.get((kind, level), [])
            return np.concatenate([np.empty(0, dtype), *(_unpack(v, dtype) for _, v, _ in parts)])

        for level in range(1, counted + 1):
            if level > 1:
                self.phrases.append(self.longer())
            self.counts.append(told(_COUNT, level, np.int64))
            here = self.phrases[-1]
            here.places = np.zeros(len(here.keys), np.uint64)
            named = [_unpack_sorted(places) for _, _, places in filed.get((_COUNT, level), [])]
            here.places[self.counts[-1] >= least] = np.concatenate([np.empty(0, np.uint64), *named])
        for level in range(1, tested + 1):
            bits = np.zeros(len(self.phrases[level - 1].keys), bool)
            bits[self.phrases[level].asked] = told(_GAIN, level, np.uint8) > 0
            self.retained.append(bits)

    def longer(self) -> _Phrases:
        """The phrases that a word makes of frequent contexts; nothing follows an end."""
        last = self.phrases[-1]
        ok = (self.counts[-1] >= self.least)[last.which] & self.goes_on[last.at]
        at, context = last.at[ok] + 1, last.which[ok]
        keys, which = _ranked(_mix(last.keys[context], self.words[at]))
        used = np.zeros(len(last.keys), bool)
        used[context] = True
        return _Phrases(at, which, keys, context, np.flatnonzero(used))

    def own_counts(self, level: int) -> np.ndarray:
        here = self.phrases[level - 1]
        return np.bincount(here.which[self.train[here.at]], minlength=len(here.keys)).astype(np.int32)

    def root(self, n_tokens: int, n_words: int) -> np.ndarray:
        return (self.counts[0][self.ids] + 1) / (n_tokens + n_words + 1)

    def predicted(self, root: np.ndarray, prior: float) -> np.ndarray:
        """What the longest retained contexts give each token.

        A context has its counts and, for ``prior`` tokens more, what the longest
        retained context within it predicts. So it sums to one if the root does.
        """
        p = root.copy()
        for k in range(len(self.retained)):
            here = self.phrases[k + 1]
            kept = self.retained[k][here.context]
            at = here.at[kept]
            n, c = self.counts[k + 1][here.which[kept]], self.counts[k][here.context[kept]]
            p[at] = (n + prior * p[at]) / (c + prior)
        return p

    def gains(self, p: np.ndarray, prior: float, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and numbers of contexts of ``level`` words, and by how much they beat ``p`` on the block's training tokens.

        Every token is predicted from the counts without itself.
        """
        here = self.phrases[level]
        mine = self.train[here.at]
        at, context = here.at[mine], here.context[mine]
        n, c = self.counts[level][here.which[mine]], self.counts[level - 1][context]
        gain = np.log((n - 1 + prior * p[at]) / ((c - 1 + prior) * p[at]))
        shorter = self.phrases[level - 1]
        sums = np.bincount(context, weights=gain, minlength=len(shorter.keys)).astype(np.float32)
        return shorter.keys[here.asked], shorter.places[here.asked], sums[here.asked]


def _first_asks(buckets: int):
    def run(batches):
        names = ("in_block", "kind", "level", "bucket", "keys", "vals")
        nothing = pd.DataFrame(columns=["kind", "level", "bucket", "vals", "places"])
        for one in batches:
            for block in one.to_pylist():
                visit = _Visit(block, nothing, 1, 0, 0)
                keys = visit.phrases[0].keys
                rows = _asks(visit.number, _COUNT, 1, keys, keys, visit.own_counts(1), buckets)
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(rows, columns=names).astype({"kind": "int32", "level": "int32"}), preserve_index=False
                )

    return run


def _next_asks(step: int, depth: int, n_tokens: int, n_words: int, least: int, prior: float, buckets: int):
    """Counts of phrases of ``step`` + 1 words, gains of contexts of ``step`` - 1 words."""

    def run(_key: tuple, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        for _, block in blocks.iterrows():
            visit = _Visit(block, answers, least, step, max(0, step - 2))
            if step <= depth:
                visit.phrases.append(visit.longer())
                keys = visit.phrases[step].keys
                rows += _asks(visit.number, _COUNT, step + 1, keys, keys, visit.own_counts(step + 1), buckets)
            if step >= 2:
                asked = visit.gains(visit.predicted(visit.root(n_tokens, n_words), prior), prior, step - 1)
                rows += _asks(visit.number, _GAIN, step - 1, *asked, buckets)
        out = pd.DataFrame(rows, columns=["in_block", "kind", "level", "bucket", "keys", "vals"])
        return out.astype({"in_block": "int64", "kind": "int32", "level": "int32", "bucket": "int64"})

    return run


@dataclass
class SuffixTree:
    """A tree that lies with the blocks: what each was answered about its own contexts.

    ``states`` has the number of retained contexts by length, from one word.
    """

    blocks: DataFrame
    answers: list[DataFrame]
    n_tokens: int
    n_words: int
    states: list[int]
    least: int
    prior: float

    def visit(self, run, schema: str) -> DataFrame:
        rows = reduce(DataFrame.unionByName, self.answers).select("in_block", "kind", "level", "bucket", "vals", "places")
        rows = rows.withColumnRenamed("in_block", "block")
        return self.blocks.groupBy("in_block").cogroup(rows.groupBy("block")).applyInPandas(run, schema)


def grow(
    plain: DataFrame,
    depth: int = DEPTH,
    least: int = LEAST,
    prior: float = PRIOR,
    block_tokens: int = BLOCK_TOKENS,
) -> SuffixTree:
    """Learn a tree from doc_id, held_out, text (bytes).

    A context of up to ``depth`` words is a candidate if it occurs ``least``
    times in training: so their number grows with the corpus. It is retained if
    it tells its training tokens, each from the counts without itself, better
    than the longest retained context within it does: the sum of the log ratios,
    which is its count times the divergence of the two, must exceed half the
    logarithm of the number of tokens.

    Each step is one visit of all blocks. A block asks for each of its phrases
    once, in buckets by hash; a bucket is added up in one task and its answers go
    back. There are as many buckets as keep one at about half of
    ``block_tokens`` phrases, so a frequent word or phrase has one entry a block in its bucket
    and the tree is in no place as a whole.
    """
    blocks = staged(plain.mapInArrow(_code_blocks(block_tokens), _BLOCK_SQL), "blocks")
    size = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(8, 2 * size // block_tokens)
    tree = SuffixTree(blocks, [], 0, 0, [], least, prior)

    def answered(asks: DataFrame, price: float, label: str) -> DataFrame:
        found = asks.groupBy("kind", "level", "bucket").applyInPandas(_answer(price, least), _ANSWER_SQL)
        found = staged(found, label)
        tree.answers.append(found)
        return found

    words = answered(blocks.mapInArrow(_first_asks(buckets), _ASK_SQL), 0.0, "words")
    row = words.agg(F.sum("members"), F.sum("total")).first()
    tree.n_words, tree.n_tokens = int(row[0] or 0), int(row[1] or 0)
    price = 0.5 * float(np.log(max(2, tree.n_tokens)))
    for step in range(1, depth + 2):
        run = _next_asks(step, depth, tree.n_tokens, tree.n_words, least, prior, buckets)
        found = answered(tree.visit(run, _ASK_SQL), price, f"phrases-{step}")
        if step >= 2:
            tree.states.append(int(found.filter(F.col("kind") == _GAIN).agg(F.sum("members")).first()[0] or 0))
    return tree


_SCORED_SQL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score_blocks(n_tokens: int, n_words: int, least: int, prior: float, depth: int):
    def run(_key: tuple, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in blocks.iterrows():
            visit = _Visit(block, answers, least, depth + 1, depth)
            root = visit.root(n_tokens, n_words)
            starts = np.concatenate([[0], np.cumsum(visit.sizes)[:-1]])
            p = visit.predicted(root, prior)
            scored = pd.DataFrame(
                {
                    "doc_id": pd.array(visit.doc_ids, "Int64"),
                    "held_out": visit.held,
                    "n_tokens": visit.sizes,
                    "n_known": np.add.reduceat((visit.counts[0][visit.ids] > 0).astype(np.int64), starts),
                    "train_tokens": n_tokens,
                    "base_score": np.add.reduceat(np.log10(root), starts),
                    "score": np.add.reduceat(np.log10(p), starts),
                }
            )
            scored.loc[visit.nulls, "doc_id"] = pd.NA
            out.append(scored)
        return pd.concat(out)

    return run


def score(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    least: int = LEAST,
    prior: float = PRIOR,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Log probabilities of all texts under a suffix tree learnt from those not held out.

    Returns a row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (unigrams with one added), score. A text is its
    words and an end; null texts are the end alone. Without training texts every
    token has probability one. Other columns are ignored; an empty table gives
    an empty result.

    Words and phrases are told apart by 64-bit hashes. A document lies in one
    block, so one document is the unit of memory.
    """
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_bytes(text_col).alias("text"),
    )
    tree = grow(plain, depth, least, prior, block_tokens)
    run = _score_blocks(tree.n_tokens, tree.n_words, least, prior, depth)
    return tree.visit(run, _SCORED_SQL)
