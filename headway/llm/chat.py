"""Chat formatting with loss masks aligned by offsets."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import in_batches, python_rows

#: Around each turn: before its role, before its text, after its text.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_MARKED = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """A form without any control string: all of them begin with ``<|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The whole conversation, and (start, end, role) of each text in it, in order."""
    parts: list[str] = []
    spans: list[tuple[int, int, str]] = []
    at = 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        parts += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body), role))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _MARKED.finditer(formatted)]


def mask_tokens(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet one of the sorted, disjoint spans: a binary search for each token."""
    spans = [s for s in spans if s[0] < s[1]]
    if not spans or not len(starts):
        return np.zeros(len(starts), bool)
    first = np.array([s[0] for s in spans])
    last = np.array([s[1] for s in spans])
    at = np.searchsorted(last, starts, side="right")
    inside = at < len(spans)
    return inside & (first[np.minimum(at, len(spans) - 1)] < ends) & (starts < ends)


def text_under(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """What the masked tokens cover, unescaped; a character of several tokens counts once."""
    pieces: list[str] = []
    at = 0
    for a, b in zip(starts[mask].tolist(), ends[mask].tolist()):
        a = max(a, at)
        if a < b:
            pieces.append(formatted[a:b])
            at = b
    return unescape("".join(pieces))


def chat_tokenizer(path: str):
    """The vocabulary with the template's marks as special tokens, so no token crosses a mark."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, TEXT, END)])
    return tokenizer


#: A run of turns ends once it has this many characters.
RUN_CHARS = 1 << 20

_FORMATTED_SQL = (
    "conv_id long, run long, whole boolean, n_turns long, formatted string, ids binary, starts binary, ends binary, mask binary"
)
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("run", pa.int64()),
        ("whole", pa.bool_()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("ids", pa.binary()),
        ("starts", pa.binary()),
        ("ends", pa.binary()),
        ("mask", pa.binary()),
    ]
)


def _runs(rows, run_chars: int) -> Iterator[tuple]:
    """(conv_id, whole, turns) of sorted rows; the first and the last may have more turns elsewhere."""
    conversations = groupby(rows, key=lambda row: row[0])
    first = True
    held: tuple | None = None
    for conv_id, own in conversations:
        if held:
            yield held
        began, turns, chars = not first, [], 0
        first = False
        for _, role, text in own:
            if chars >= run_chars:
                yield conv_id, False, turns
                began, turns, chars = False, [], 0
            turns.append((role or "", text or ""))
            chars += len(turns[-1][0]) + len(turns[-1][1])
        # Whole only if another conversation follows.
        held = (conv_id, began, turns)
    if held:
        yield held[0], False, held[2]


def format_conversations(
    conversations: DataFrame,
    tokenizer_path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
    run_chars: int = RUN_CHARS,
) -> DataFrame:
    """Render each conversation whole, encode it once and mask the tokens to learn.

    Returns conv_id, run, whole, n_turns, formatted, ids (unsigned 32-bit),
    starts and ends (32-bit character offsets of the tokens) and mask (a byte
    per token: 1 in a text of ``loss_role``). Rows are ordered by turn, ties by
    role and text, null turns first; null roles and texts are empty. Repeated
    rows are turns of their own. Rows without a conv_id are one conversation.
    Other columns are ignored; an empty table gives an empty result.

    Rows are dealt by ranges of conversation and turn, so a conversation with
    most of the rows lies in many tasks. One that crosses a range, or has more
    than ``run_chars`` characters, is several rows, its runs of turns in the
    order of ``run``; offsets count from the start of the run. As no token
    crosses a mark, the runs' ids one after the other are those of the whole.
    ``whole`` says that a row is known to be all of its conversation. A task
    holds one run, or one longer turn, at a time.
    """

    def run(batches):
        tokenizer = chat_tokenizer(tokenizer_path)
        task = TaskContext.get()
        first_run = (task.partitionId() if task else 0) << 32

        def rows():
            for number, (conv_id, whole, turns) in enumerate(_runs(python_rows(batches), run_chars), first_run):
                formatted, spans = render(turns)
                encoded = tokenizer.encode(formatted, add_special_tokens=False)
                offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                mask = mask_tokens(starts, ends, [(a, b) for a, b, role in spans if role == loss_role])
                yield (
                    conv_id, number, whole, len(turns), formatted, np.array(encoded.ids, "<u4").tobytes(),
                    starts.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), mask.astype(np.uint8).tobytes(),
                )

        return in_batches(_FORMATTED, rows(), 20)

    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_rows.select("conv_id", "role", "text").mapInArrow(run, _FORMATTED_SQL)


_PART_SQL = (
    "conv_id long, run long, whole boolean, n_turns long, turns binary, loss_chars long, loss binary,"
    " formatted_chars long, n_tokens long, loss_tokens long"
)
_PART = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("run", pa.int64()),
        ("whole", pa.bool_()),
        ("n_turns", pa.int64()),
        ("turns", pa.binary()),
        ("loss_chars", pa.int64()),
        ("loss", pa.binary()),
        ("formatted_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("loss_tokens", pa.int64()),
    ]
)
_READ_SQL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, n_tokens long, loss_tokens long"
)
_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("loss_tokens", pa.int64()),
    ]
)


def _read_runs(batches):
    """What each run says; of whole conversations digests instead of texts."""

    def rows():
        for conv_id, run, whole, text, ids, starts, ends, mask in python_rows(batches):
            turns = read_turns(text)
            said = "".join(f"{role}\n{body}\n" for role, body in turns).encode()
            begin, end = np.frombuffer(starts, "<u4"), np.frombuffer(ends, "<u4")
            under = np.frombuffer(mask, np.uint8).astype(bool)
            loss = text_under(text, begin, end, under)
            learnt = loss.encode()
            if whole:
                said, learnt = hashlib.sha256(said).digest(), hashlib.sha256(learnt).digest()
            yield (
                conv_id, run, whole, len(turns), said, len(loss), learnt, len(text), len(ids) // 4, int(under.sum()),
            )

    return in_batches(_PART, rows(), 20)


def _join_runs(batches):
    """One row per conversation, its runs coming in order; digests are fed run by run."""

    def rows():
        for conv_id, runs in groupby(python_rows(batches), key=lambda row: row[0]):
            said, learnt = hashlib.sha256(), hashlib.sha256()
            sums = [0] * 5
            for _, _, whole, n_turns, turns, loss_chars, loss, *rest in runs:
                sums = [a + b for a, b in zip(sums, (n_turns, loss_chars, *rest))]
                if not whole:
                    said.update(turns)
                    learnt.update(loss)
            digests = (turns.hex(), loss.hex()) if whole else (said.hexdigest(), learnt.hexdigest())
            yield conv_id, sums[0], digests[0], sums[1], digests[1], *sums[2:]

    return in_batches(_READ, rows(), 1000)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the mask, from the formatted output alone.

    A digest can only be made in order, so the texts of a conversation in
    several runs stream through one task, from a sorted shuffle; those in one
    run are digested where they were formatted.
    """
    columns = ["conv_id", "run", "whole", "formatted", "ids", "starts", "ends", "mask"]
    parts = formatted.select(*columns).mapInArrow(_read_runs, _PART_SQL)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "run").mapInArrow(_join_runs, _READ_SQL)
