from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from headway.llm import collocations, wu_manber
from tests.llm.data import ODD, documents, frame

DOCS = "doc_id long, text string, lang string, rank int, n long, items string, k int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pieces(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text))]


def phrases_of(rows, least):
    """Every phrase of one to five words, counted; then cuts, scores and what is left out."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for words in pieces(text):
            total[lang] += len(words)
            for k in range(1, 6):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: f for p, f in counts.items() if f >= least and len(p) > 2}
    inside = defaultdict(int)
    for (lang, *words), f in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, *words[i : i + size])
                inside[part] = max(inside[part], f)
    out = {}
    for (lang, *words), a in candidates.items():
        if inside[(lang, *words)] >= a:
            continue
        cuts = []
        for j in range(1, len(words)):
            left, right = counts[(lang, *words[:j])], counts[(lang, *words[j:])]
            cuts.append((1000 * a * total[lang] // (left * right), j, left, right))
        score, cut, left, right = min(cuts)
        out[lang, " ".join(words)] = (a, total[lang], score, cut, left, right)
    return out


def some_texts(seed, n, of):
    rng = random.Random(seed)
    fixed = [" ".join(f"w{rng.randrange(of)}" for _ in range(rng.randrange(3, 9))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(fixed), " ".join(f"W{rng.randrange(of)}" for _ in range(rng.randrange(1, 7)))]) for _ in range(rng.randrange(6))]
        out.append((rng.choice([" ", ". ", "\t", ",", "\n"]).join(parts), rng.choice(["en", "en", "de", None, "und"])))
    return out


def mined(spark, rows, **limits):
    table = frame(spark, [(i, t, lang, 1, 2, "x", 3) for i, (t, lang) in enumerate(rows)], DOCS)
    found = collocations.collocations(table.repartition(3), **limits).collect()
    got = {(r.lang, r.phrase): (r.a, r.n, r.score, r.cut, r.l, r.r) for r in found}
    assert len(got) == len(found)
    return got


@pytest.mark.parametrize("shards,block_words,least", [(1, 1 << 20, 4), (2, 40, 5), (3, 64, 3)])
def test_phrases_equal_a_full_count(spark, shards, block_words, least):
    rows = some_texts(shards, 120, 12)
    rows += [("a a a a a a a a", "en")] * 3 + [(t[1] if isinstance(t, tuple) else t, "en") for t in ODD] * 4
    rows += [("on and on " * 60, "en"), ("x\x00y \x1fz " * 9, "de"), ("é\xa0è ü " * 9, "fr")]
    want = phrases_of(rows, least)
    assert len(want) > 30
    assert mined(spark, rows, shards=shards, block_words=block_words, least=least) == want


def test_a_word_is_looked_up_once_in_a_block(spark, monkeypatch):
    """Later visits only look up words that have reached the threshold since the last one."""
    met = []
    plain = collocations._Shard._look_up

    def watched(self, k, *more):
        rows = plain(self, k, *more)
        if k == 1:
            met.extend((r.home, item.at) for r in rows.collect() for item in r["items"])
        return rows

    monkeypatch.setattr(collocations._Shard, "_look_up", watched)
    texts = some_texts(11, 120, 9)
    docs = frame(spark, [(i, *row, 0, 0, "x", 0) for i, row in enumerate(texts)], DOCS).repartition(3)
    out = collocations.collocations(docs, least=4, shards=2, block_words=60).collect()
    assert {(r.lang, r.phrase): (r.a, r.n, r.score, r.cut, r.l, r.r) for r in out} == phrases_of(texts, 4)
    assert met and len(met) == len(set(met))


def test_phrases_of_nothing_and_of_one_long_text(spark):
    assert mined(spark, []) == {} and mined(spark, [(None, None), ("a b", "en")]) == {}
    rows = [("one two three " * 5000 + "q" * 50_000, "en"), ("q" * 50_000, "en")]
    assert mined(spark, rows, least=100, block_words=1000) == phrases_of(rows, 100)


def test_the_strongest_phrases(spark):
    found = frame(spark, [("en", p, a, 9, s, 1, 1, 1) for p, a, s in [("b b", 3, 7), ("a z", 3, 7), ("a b", 4, 7), ("c", 9, 6)]], collocations._FOUND_SQL)
    ranked = {r.phrase: r["rank"] for r in collocations.strongest(found, 3).collect()}
    assert ranked == {"a b": 1, "a z": 2, "b b": 3}


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", lowered(text))


def hits(doc, items, window):
    """Every place of every window of every item, compared word by word."""
    own, hit, names = words(doc), set(), set()
    for item, text in items:
        theirs = words(text)
        size = min(window, len(theirs))
        for i in range(len(theirs) - size + 1) if size else ():
            for at in range(len(own) - size + 1):
                if own[at : at + size] == theirs[i : i + size]:
                    hit |= set(range(at, at + size))
                    names.add("" if item is None else str(item))
    return len(own), hit, sorted(names)


def benchmark_case(seed):
    rng = random.Random(seed)
    say = lambda n, of: " ".join(f"{rng.choice('AbÉ')}{rng.randrange(of)}" for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 4, 6, 9, 15]), 3)) for i in range(12)]
    items += [(3, say(5, 3)), (None, say(7, 4)), (40, None), (41, "-- ."), (42, items[6][1]), (43, items[6][1])]
    docs = [say(rng.randrange(0, 60), 3) for _ in range(25)] + [items[4][1] + "; " + (items[6][1] or "") for _ in range(3)]
    docs += [(t[1] if isinstance(t, tuple) else t) for t in ODD] + [say(3000, 3)]
    return items, docs


@pytest.mark.parametrize("seed,pass_bytes", [(1, 1 << 20), (2, 40)])
def test_hits_equal_every_comparison(spark, monkeypatch, seed, pass_bytes):
    items, docs = benchmark_case(seed)
    table = frame(spark, [(i, d, "x", "y") for i, d in enumerate(docs)], "doc_id long, text string, items string, spans string")
    tests = frame(spark, [(*i, "z") for i in items], "item_id long, text string, n_words string")
    found = wu_manber.decontaminate(table, tests, window=6, pass_bytes=pass_bytes).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, names = hits(docs[r.doc_id], items, 6)
        own = [(s.start, s.end) for s in r.spans]
        assert (r.n_words, set().union(*(range(a, b) for a, b in own)), r["items"]) == (n, hit, names)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))


def test_hits_across_slices_and_long_items(monkeypatch):
    from headway.llm import common

    rng = random.Random(3)
    text = " ".join(f"v{rng.randrange(4)}" for _ in range(4000)).encode()
    monkeypatch.setattr(wu_manber, "slices", lambda t: common.slices(t, 97))
    monkeypatch.setattr(wu_manber, "PART_WORDS", 20)
    item = " ".join(f"v{rng.randrange(4)}" for _ in range(300))
    import pyarrow as pa

    given = pa.RecordBatch.from_pydict({"item": ["1"], "text": [item.encode()]})
    parts = [tuple(r.values())[:2] for b in wu_manber._parts(7)([given]) for r in b.to_pylist()]
    assert len(parts) > 10
    n, spans, names = wu_manber.search(wu_manber.build(parts, 7), text)
    want = hits(text.decode(), [(1, item)], 7)
    assert (n, set().union(*(range(a, b) for a, b in spans)), sorted(names)) == want and want[1]


def test_without_a_benchmark_or_documents(spark):
    none = frame(spark, [], "item_id long, text string")
    docs = documents(spark, ODD)
    assert {len(r.spans) for r in wu_manber.decontaminate(docs, none).collect()} == {0}
    some = frame(spark, [(1, "twin row")], "item_id long, text string")
    assert wu_manber.decontaminate(docs.filter("false"), some).count() == 0
    found = wu_manber.decontaminate(docs, some)
    kept = wu_manber.drop_contaminated(docs, found)
    assert kept.count() == len(ODD) - 3 and kept.columns == docs.columns
