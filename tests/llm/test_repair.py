from __future__ import annotations

import hashlib
import random
from itertools import groupby

import pytest

from headway.llm import conversation_repair as cr
from headway.llm.queries import damaged
from tests.llm.data import frame

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = text.rstrip(SPACE)
        if not said:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All ways, row by row: the best (cost, audit, texts) for each string of initials modulo pairs."""

    def state(initials, letter):
        """What initials + letter end with, None if no legal conversation begins so."""
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((initials, letter))

    def add(ways, key, way):
        if key is not None and (key not in ways or way < ways[key]):
            ways[key] = way

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for key, (cost, audit, said) in list(ways.items()):
                for name in ("user", "assistant"):
                    add(ways, state(key, name[0]), (cost + 5, audit + "I", [*said, f"{name}:"]))
        return ways

    ways = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after: dict = {}
        for key, (cost, audit, said) in ways.items():
            add(after, key, (cost + 2, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            add(after, state(key, role[:1]), (cost + more, audit + "K", [*said, f"{role}:{text}"]))
            for name in ("user", "assistant"):
                add(after, state(key, name[0]), (cost + 1 + more, audit + "R", [*said, f"{name}:{text}"]))
        ways = inserted(after)
    return min(ways[key] for key in ("", "a") if key in ways)


def expected(rows):
    out = {}
    key = lambda r: (r[0] is None, r[0] or 0)
    for _, own in groupby(sorted(rows, key=key), key=key):
        own = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in own]
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        plain = [r[1:] for r in own]
        faults = faults_of(plain)
        cost, audit, said = cheapest(plain, faults)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(plain, plain[1:])]
        out[own[0][0]] = (
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def found(spark, rows, **limits):
    table = frame(spark, [(*r, 1, "x") for r in rows], ROWS + ", part int, edit string")
    done = cr.summaries(cr.repair(table, **limits)).collect()
    got = {r.conv_id: tuple(r)[1:] for r in done}
    assert len(got) == len(done)
    return got


def random_rows(seed, sizes):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?\n", "cut", "cut off ", "", " \n", "«Oui» .", "été", "x" * 50 + ".", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "Assistant"]
    rows = []
    for conv, size in enumerate(sizes):
        for turn in range(size):
            number = rng.choice([turn, turn, turn, turn // 2, None, -turn])
            text = rng.choice([f"{turn} is it.", f"{turn} and", *texts])
            row = (conv, number, rng.choice(roles) if rng.random() < 0.5 else ("user", "assistant")[turn % 2], text)
            rows += [row] * rng.choice([1, 1, 1, 1, 3])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk_rows", [6, 20_000])
def test_edits_equal_all_ways_tried(spark, chunk_rows):
    rows = random_rows(chunk_rows, [0, 1, 2, 3, 5, 8, 13, 40, 1, 70])
    rows += [(None, t, r, x) for _, t, r, x in random_rows(9, [30])]
    assert found(spark, rows, chunk_rows=chunk_rows) == expected(rows)


def test_one_conversation_of_most_rows(spark):
    """Long runs of what no row changes, rows of one content, and all in many chunks."""
    rows = [(1, 0, "user", "again.")] * 50 + [(1, t, "user", "again.") for t in range(60)]
    rows += [(1, 100 + t, "user" if t % 2 else "assistant", f"cut {t}") for t in range(40)]
    rows += [(1, 200 + t, "user" if t % 3 else "assistant", f"said {t}.") for t in range(40)]
    rows += [(2, t, "tool", f"{t}") for t in range(20)] + [(3, t, "user", "") for t in range(20)]
    assert found(spark, rows, chunk_rows=10) == expected(rows)


def test_backward_costs_stop_where_they_differ_by_a_constant():
    rng = random.Random(4)
    stopped = 0
    for _ in range(200):
        signs = bytes(rng.randrange(8) for _ in range(rng.randrange(1, 60)))
        guess, _ = cr.backward(signs, bytes(4))
        again, settled = cr.backward(signs, cr.AT_END, guess)
        assert again == cr.backward(signs, cr.AT_END)[0]
        stopped += settled
    assert stopped > 120


def test_very_long_texts_make_chunks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK_BYTES", 4000)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "long " * 900 + ".") for t in range(9)]
    rows += [(2, 0, "user", "a" * 100_000), (2, 1, "assistant", "b.")]
    assert found(spark, rows) == expected(rows)


def test_nothing_at_all(spark):
    assert found(spark, []) == {}
    assert damaged(frame(spark, [], ROWS)).count() == 0


def test_gaps_and_original_text(spark):
    rows = [(1, 3, "user", "a."), (1, 9, "assistant", "b."), (1, 9, "user", "c."), (1, None, "user", "d."), (2, None, "user", "e.")]
    table = frame(spark, rows, ROWS)
    assert {r.conv_id: r.gaps for r in cr.gaps(table).collect()} == {1: 5, 2: 0}
    edits = cr.repair(table).collect()
    assert {(r.conv_id, r.edit, r.new_role, r.text) for r in edits if r.edit in "IR"} == {
        (1, "R", "assistant", "a."), (1, "R", "user", "b."), (1, "R", "assistant", "c."),
    }
    assert [(r.edit, r.text) for r in edits if r.conv_id == 2] == [("D", "e.")]
