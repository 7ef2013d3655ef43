"""Repair of conversation structure by a rank-convergence parallel Viterbi search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import in_batches, python_rows, release, staged
from headway.operators.skew import attach_group_stats

#: Rows and bytes of text of a chunk of a conversation.
CHUNK_ROWS = 20_000
CHUNK_BYTES = 16 << 20

# What an edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# What the rows kept so far end with. A conversation may end with nothing or an
# assistant turn; a user turn follows anything else, an assistant turn a user.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_TURN_AFTER = (USER, USER, ASSISTANT, USER)
#: Costs to the end of a conversation that has no rows left, by state.
AT_END = bytes((0, 2 * INSERT, INSERT, 0))
#: What a chunk starts from that does not know the chunk after it.
_GUESS = bytes(4)

_KEPT_AS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def symbol(role: str, truncated: bool) -> int:
    """What the search needs to know of a row: its role, or 0 for others, and whether it is cut off."""
    return 2 * _KEPT_AS.get(role[:1], 0) + truncated


def _edits(sign: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row in a state, by the initials of the edits."""
    extra = TRUNCATED * (sign & 1)
    kept, turn = sign >> 1, _TURN_AFTER[state]
    out = [("D", DELETE, state)]
    if kept and (kept == turn or kept == SYSTEM and state == NOTHING):
        out.append(("K", extra, kept))
    return [*out, ("R", REROLE + extra, turn)]


def _with_inserts(costs: list[int]) -> list[int]:
    """The costs when turns may be inserted first."""
    nothing, system, user, assistant = costs
    user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return [min(nothing, user + INSERT), min(system, user + INSERT), user, assistant]


def _before(sign: int, after: bytes) -> list[int]:
    return _with_inserts(
        [min(cost + after[to] for _, cost, to in _edits(sign, state)) for state in range(4)]
    )


class _Steps(dict):
    """From a row and the costs after it to those before it, less a constant, and the constant."""

    def __missing__(self, key: tuple[int, bytes]) -> tuple[bytes, int]:
        costs = _before(*key)
        least = min(costs)
        self[key] = found = bytes(c - least for c in costs), least
        return found


_STEPS = _Steps()


def backward(signs: bytes, end: bytes, known: bytes = b"") -> tuple[bytes, bool]:
    """Costs before each row and at the end, four bytes each, all less a constant.

    ``known`` are those worked out for another end. They are run again from the
    new end until the costs of a row are the known ones but for a constant: from
    there on nothing changes. The second value tells whether it came to that.
    """
    out = bytearray(known or bytes(4 * len(signs))) + (b"" if known else end)
    out[4 * len(signs) :] = end
    costs = end
    for at in range(len(signs) - 1, -1, -1):
        costs, _ = _STEPS[signs[at], costs]
        if known and out[4 * at : 4 * at + 4] == costs:
            return bytes(out), True
        out[4 * at : 4 * at + 4] = costs
    return bytes(out), False


class _Choices(dict):
    """The least edits, in ASCII order, that lead a row in a state to the least cost."""

    def __missing__(self, key: tuple[int, int, bytes]) -> tuple[str, int]:
        sign, state, after = key
        least = _before(sign, after)
        inserts = ""
        while True:
            ways = {edit: (cost + after[to], to) for edit, cost, to in _edits(sign, state)}
            best = min(w for w, _ in ways.values())
            ahead = _TURN_AFTER[state]
            # D before I before K and R, all of the least cost.
            if ways["D"][0] == least[state]:
                edit = "D"
            elif INSERT + least[ahead] == least[state]:
                inserts, state = inserts + "I", ahead
                continue
            else:
                edit = min(e for e, (cost, _) in ways.items() if cost == best)
            self[key] = found = inserts + edit, ways[edit][1]
            return found


_CHOICES = _Choices()


def trace(signs: bytes, costs: bytes, state: int) -> tuple[list[str], int]:
    """The edits of each row, with the inserts before it, and the state after the last row."""
    out = []
    for at, sign in enumerate(signs):
        edits, state = _CHOICES[sign, state, costs[4 * at + 4 : 4 * at + 8]]
        out.append(edits)
    return out, state


def closing(state: int) -> str:
    """The inserts that end a conversation."""
    return "I" * {SYSTEM: 2, USER: 1}.get(state, 0)


# A row in its place: role and text as given, and what is done to it.
_ROWS_SQL = (
    "conv_id long, part int, chunk int, at long, step int, copies long, fault string,"
    " role string, text string, edit string, new_role string, cost long"
)
_ROWS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("chunk", pa.int32()),
        ("at", pa.int64()),
        ("step", pa.int32()),
        ("copies", pa.int64()),
        ("fault", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("edit", pa.string()),
        ("new_role", pa.string()),
        ("cost", pa.int64()),
    ]
)
_AFTER_ALL = (1 << 31) - 1
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Faults that leave a row no choice: the search does not see it.
GONE = ("blank", "duplicate")


def signs_of(rows: list[tuple]) -> bytes:
    """The symbols of the rows that have a choice; rows are (copies, fault, role, text)."""
    return bytes(symbol(role, fault == "truncated") for _, fault, role, _ in rows if fault not in GONE)


def edited(place: tuple, at: int, rows: list[tuple], edits: list[str], state: int, last: bool) -> Iterator[tuple]:
    """The rows of ``_ROWS`` for the rows of a chunk that is entered in ``state``.

    Rows that can only go take no edits from ``edits``. What is inserted before
    a row comes as rows of its own; after the last chunk, so does what closes
    the conversation, in a place after all others.
    """
    chosen = iter(edits)
    for n, (copies, fault, role, text) in enumerate(rows):
        if fault in GONE:
            yield (*place, at + n, 0, copies, fault, role, text, "D", None, DELETE * copies)
            continue
        own = next(chosen)
        for step, _ in enumerate(own[:-1]):
            state = _TURN_AFTER[state]
            yield (*place, at + n, step, 1, None, None, "", "I", _NAMES[state], INSERT)
        edit = own[-1]
        extra = TRUNCATED * (fault == "truncated" and edit != "D")
        if edit == "K":
            state, new, cost = _KEPT_AS[role[:1]], role, extra
        elif edit == "R":
            state = _TURN_AFTER[state]
            new, cost = _NAMES[state], REROLE + extra
        else:
            new, cost = None, DELETE
        yield (*place, at + n, len(own), copies, fault, role, text, edit, new, cost)
    while last and state in (SYSTEM, USER):
        state = _TURN_AFTER[state]
        yield (place[0], _AFTER_ALL, 0, 0, state, 1, None, None, "", "I", _NAMES[state], INSERT)


def _chunks(chunk_rows: int):
    """Cut sorted rows into chunks; finish conversations that lie whole in one chunk.

    The first and the last conversation of a task may go on in another task, and
    a long one is several chunks: their rows are handed on without edits. Every
    other is a chunk that knows its end and its start and is traced at once.
    """

    def runs(batches):
        for key, rows in groupby(python_rows(batches), key=lambda row: row[:2]):
            held, size = [], 0
            for *_, copies, fault, role, text in rows:
                if len(held) >= chunk_rows or size > CHUNK_BYTES:
                    yield key, held, False
                    held, size = [], 0
                if copies > 1 and fault not in GONE:
                    held.append((1, fault, role, text))
                    fault, copies = "duplicate", copies - 1
                held.append((copies, fault, role, text))
                size += len(role) + len(text)
            yield key, held, True

    def finish(key, chunk, at, held, closed):
        part, conv = key
        place = conv, part, chunk
        if not closed:
            for n, row in enumerate(held):
                yield (*place, at + n, 0, *row, None, None, None)
            return
        signs = signs_of(held)
        edits, _ = trace(signs, backward(signs, AT_END)[0], NOTHING)
        yield from edited(place, at, held, edits, NOTHING, True)

    def run(batches):
        def rows():
            chunk = at = 0
            waiting = None
            for key, held, whole in runs(batches):
                if waiting:
                    yield from finish(*waiting)
                begins = waiting is not None and waiting[0] != key
                waiting = key, chunk, at, held, begins and whole
                chunk, at = chunk + 1, at + len(held)
            if waiting:
                yield from finish(*waiting[:4], False)

        return in_batches(_ROWS, rows(), 500)

    return run


_LINK = "conv_id long, part int, chunk int, before_part int, before_chunk int, after_part int, after_chunk int"
_STATE_SQL = f"{_LINK}, signs binary, costs binary, entry int, exit int, moved boolean"
_STATE = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(f"{side}{name}", pa.int32()) for side in ("", "before_", "after_") for name in ("part", "chunk")],
        ("signs", pa.binary()),
        ("costs", pa.binary()),
        ("entry", pa.int32()),
        ("exit", pa.int32()),
        ("moved", pa.bool_()),
    ]
)
_SIGNS_SQL = "conv_id long, part int, chunk int, signs binary"
_SIGNS = pa.schema([*[_STATE.field(n) for n in ("conv_id", "part", "chunk", "signs")]])


def _gather_signs(batches):
    """The symbols of each chunk, from rows (conv_id, part, chunk, role, fault) in order."""

    def rows():
        for key, own in groupby(python_rows(batches), key=lambda row: row[:3]):
            yield (*key, bytes(symbol(role, fault == "truncated") for *_, role, fault in own))

    return in_batches(_SIGNS, rows(), 20)


def _rerun_backward(batches):
    """Chunks whose end is not what they were run from are run again from it."""

    def rows():
        for *link, signs, costs, entry, exit_, _, found in python_rows(batches):
            end = AT_END if link[5] is None else _GUESS if found is None else found
            moved = False
            if costs is None:
                costs, moved = backward(signs, end)[0], True
            elif costs[-4:] != end:
                costs, settled = backward(signs, end, costs)
                moved = not settled
            yield (*link, signs, costs, entry, exit_, moved)

    return in_batches(_STATE, rows(), 20)


def _rerun_trace(batches):
    """Chunks that are entered in another state than they were traced from are traced again."""

    def rows():
        for *link, signs, costs, entry, exit_, _, found in python_rows(batches):
            state = NOTHING if link[3] is None else ASSISTANT if found is None else found
            moved = False
            if state != entry:
                before, (_, out) = exit_, trace(signs, costs, state)
                entry, exit_, moved = state, out, out != before
            yield (*link, signs, costs, entry, exit_, moved)

    return in_batches(_STATE, rows(), 20)


def _passes(state: DataFrame, side: str, given, rerun, label: str) -> DataFrame:
    """Run all chunks, then again those to whom a neighbour hands on something new, till none is.

    A pass is a join of small rows and a written table. Chunks stop a change
    where their costs come to differ by a constant only, so there are few passes
    as a rule; in the worst case as many as a conversation has chunks.
    """
    while True:
        handed = state.select(
            F.col("part").alias("_part"), F.col("chunk").alias("_chunk"), given.alias("_found")
        )
        same = (F.col(f"{side}_part") == F.col("_part")) & (F.col(f"{side}_chunk") == F.col("_chunk"))
        joined = state.join(handed, same, "left").drop("_part", "_chunk")
        now = staged(joined.mapInArrow(rerun, _STATE_SQL), label)
        release(state)
        state = now
        if not state.filter("moved").limit(1).count():
            return state


def _finish_open(key, chunk: pa.Table, state: pa.Table) -> pa.Table:
    """The edits of an open chunk, from what the passes found for it."""
    rows = sorted(zip(*(chunk[n].to_pylist() for n in ("at", "step", "copies", "fault", "role", "text"))))
    place = (chunk["conv_id"][0].as_py(), *(k.as_py() for k in key))
    own = [row[2:] for row in rows]
    edits, entry, last = [], NOTHING, False
    if state.num_rows:
        (signs,), (costs,), (entry,) = (state[n].to_pylist() for n in ("signs", "costs", "entry"))
        edits, last = trace(signs, costs, entry)[0], state["after_part"][0].as_py() is None
    out = list(zip(*edited(place, rows[0][0], own, edits, entry, last)))
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, _ROWS)], schema=_ROWS)


def _linked(signs: DataFrame) -> DataFrame:
    """Chunks with the chunks of their conversation before and after them."""
    in_order = Window.partitionBy("conv_id").orderBy("part", "chunk")
    link = signs.select("conv_id", "part", "chunk").select(
        "*",
        *[
            way(name).over(in_order).alias(f"{side}_{name}")
            for side, way in (("before", F.lag), ("after", F.lead))
            for name in ("part", "chunk")
        ],
    )
    empty = {
        "costs": F.lit(None).cast("binary"),
        "entry": F.lit(None).cast("int"),
        "exit": F.lit(None).cast("int"),
        "moved": F.lit(True),
    }
    rows = link.join(signs.drop("conv_id"), ["part", "chunk"]).withColumns(empty)
    return rows.select(*_STATE.names)


def with_faults(conversations: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with how often they occur and their first fault.

    Equal rows are combined before they are shuffled. The content seen earlier
    is looked up by a hash of the text, in a join that is spread over the turns.
    """
    same = conversations.groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("copies")
    )
    keyed = same.withColumn("_text", F.sha2(F.col("text").cast("binary"), 256))
    seen = attach_group_stats(
        keyed,
        ["conv_id", "role", "_text"],
        [
            F.count(F.lit(1)).alias("_turns"),
            F.count("turn").alias("_dated"),
            F.min("turn").alias("_first"),
        ],
        spread_by=["turn"],
        having=F.col("_turns") > 1,
    )
    # Turns without a number come first.
    first = F.when(F.col("_dated") == F.col("_turns"), F.col("_first"))
    repeated = F.col("_turns").isNotNull() & ~F.col("turn").eqNullSafe(first)
    said = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = (
        F.when(said == "", "blank")
        .when(repeated, "duplicate")
        .when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return seen.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The cheapest edits after which each conversation is system?, (user, assistant)*.

    Returns a row per edit: conv_id; part, chunk, at, step (their order within
    the conversation); copies (how many equal rows it stands for); fault
    (``blank``, ``duplicate``: role and text seen earlier, ``truncated``: no
    full stop, or null); role and text as given (null and empty for an insert);
    edit (K, R, D or I); new_role (null if deleted); cost. Rows are ordered by
    turn, null turns first, ties by role and text. Of equally cheap ways the one
    whose edits are least in ASCII order is taken. Blank and duplicate rows can
    only go. A role counts by its first letter, s, u or a; others, and empty
    ones, cannot be kept. Null roles and texts are one space. Rows that repeat
    are adjacent duplicates. Rows without a conv_id are one conversation. Other
    columns are not looked at. An empty table gives an empty result.

    Rows are dealt by range, so one conversation may lie in many tasks. Those
    that lie whole in one chunk are solved where they are. The chunks of the
    others (at most ``chunk_rows`` rows) are run from guessed costs at their
    end, all at once, and again from what the chunk after them found until
    nothing new is handed on. The costs, stitched together, lead the trace,
    which is run from a guessed state and settled in the same way. Texts do not
    take part in the passes, and rows that can only go are left out of them.
    """
    spark = conversations.sparkSession
    space = F.lit(" ")
    plain = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
    )
    marked = staged(with_faults(plain), "repair-marked")
    rows, size = marked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = 1 + max(rows // chunk_rows, (size or 0) // CHUNK_BYTES)
    order = ["conv_id", "turn", "role", "text"]
    dealt = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("part"), "conv_id", "copies", "fault", "role", "text")
    solved = staged(dealt.mapInArrow(_chunks(chunk_rows), _ROWS_SQL), "repair-chunks")
    release(marked)
    opened = solved.filter("edit IS NULL")
    if not opened.limit(1).count():
        return solved
    live = opened.filter(~F.coalesce(F.col("fault").isin(*GONE), F.lit(False)))
    slim = live.repartition("part", "chunk").sortWithinPartitions("part", "chunk", "at", "step")
    signs = slim.select("conv_id", "part", "chunk", "role", "fault").mapInArrow(_gather_signs, _SIGNS_SQL)
    state = staged(_linked(staged(signs, "repair-signs")), "repair-links")
    state = _passes(state, "after", F.substring("costs", 1, 4), _rerun_backward, "repair-costs")
    state = _passes(state, "before", F.col("exit"), _rerun_trace, "repair-trace")
    finished = (
        opened.groupBy("part", "chunk").cogroup(state.groupBy("part", "chunk")).applyInArrow(_finish_open, _ROWS_SQL)
    )
    return solved.filter("edit IS NOT NULL").unionByName(finished)


_SUMMARY_SQL = (
    "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
_SUMMARY = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_LEGAL = ("su", "ua", "au")


def _summaries(batches):
    def rows():
        for conv_id, edits in groupby(python_rows(batches), key=lambda row: row[0]):
            faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
            illegal = total = 0
            audit: list[str] = []
            digest, before, between = hashlib.sha256(), None, b""
            for _, copies, fault, role, text, edit, new_role, cost in edits:
                total += cost
                audit.append(edit * copies)
                if role is not None:
                    if fault:
                        faults[fault] += copies
                    if before is not None:
                        illegal += before[:1] + role[:1] not in _LEGAL
                    illegal += copies - 1
                    before = role
                if new_role is not None:
                    digest.update(between + f"{new_role}:{text}".encode())
                    between = b"\n"
            yield (conv_id, *faults.values(), illegal, total, "".join(audit), digest.hexdigest())

    return in_batches(_SUMMARY, rows(), 200)


def summaries(edits: DataFrame) -> DataFrame:
    """A row per conversation with any rows: its faults, cost, audit and a digest of the repaired one.

    A digest is made from first to last, so a conversation passes through one
    task; it is streamed from a sorted shuffle, and only its edits, a letter
    each, are held.
    """
    columns = ("conv_id", "copies", "fault", "role", "text", "edit", "new_role", "cost")
    in_order = edits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "at", "step")
    return in_order.select(*columns).mapInArrow(_summaries, _SUMMARY_SQL)


def gaps(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn"):
    """How many turn numbers are missing between the least and the largest; null turns do not count."""
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn")
    ).distinct()
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0).cast("long")).alias("gaps"))
