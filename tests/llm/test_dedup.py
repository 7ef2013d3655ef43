from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from headway.llm import exact_dedup as exact
from headway.llm import ngram_join as ngram
from headway.llm import suffix_dedup as suffix
from headway.llm.components import components
from headway.llm.exact_dedup import exact_dedup
from headway.llm.ngram_join import ngram_join
from headway.llm.suffix_dedup import suffix_dedup
from tests.llm.data import ODD, documents, frame, prose, words


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# Exact duplicates


def brute_exact(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for content, members in groups.items():
        sha = hashlib.sha256(content.encode()).hexdigest()
        best, done = min(members), False
        for m in members:
            out.append((m[2], best[2], len(members), m == best and not done, sha))
            done |= m == best
    return sorted(out, key=repr)


@pytest.mark.parametrize("table_bytes", [48 << 20, 600])
def test_exact_groups_equal_brute_force(spark, table_bytes):
    rng = random.Random(1)
    texts = [prose(i % 40, 30) for i in range(120)] + ["x y"] * 50
    texts += [t.replace(" ", rng.choice(["  ", "\n"])) for t in texts[:30]]
    pairs = [(i, t) for i, t in enumerate(texts, 100)] + [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(ODD)]
    df = exact_dedup(documents(spark, pairs).repartition(5), table_bytes=table_bytes)
    assert rows_of(df, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(pairs)


def test_exact_takes_other_names_and_empty_tables(spark):
    docs = frame(spark, [(1, "a", "z"), (2, "a", "z")], "`my id` long, content string, text string")
    got = exact_dedup(docs, "`my id`", "content")
    assert rows_of(got, "doc_id", "kept") == [(1, True), (2, False)]
    assert exact_dedup(docs.filter("false"), "`my id`", "content").count() == 0


# Shingle join


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(pairs, k, percent):
    sets = [(i, shingles(t, k)) for i, t in pairs]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if None not in (i, j) and x and y and 100 * len(x & y) >= percent * len(x | y):
                i, j = sorted((find(i), find(j)))
                parent[j] = i
    return sorted(((i, len(s), i and find(i)) for i, s in sets), key=repr)


def changed(rng, base, n):
    base = list(base)
    for _ in range(n):
        base[rng.randrange(len(base))] = f"z{rng.randrange(10**6)}"
    return base


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 90)])
def test_join_equals_brute_force(spark, k, percent):
    rng = random.Random(k)
    line = words(rng, 25)
    texts = []
    base = words(rng, 200)
    for _ in range(90):  # a large bucket in which many are not linked with the leader
        texts.append(changed(rng, base, rng.randrange(14)))
    near = changed(rng, base, 12)
    for _ in range(25):
        texts.append(changed(rng, near, rng.randrange(5)))
    for _ in range(80):  # short, mostly common words
        texts.append(line[: rng.randrange(3, 25)] + words(rng, rng.randrange(3), 50))
    for _ in range(40):
        texts.append(words(rng, rng.randrange(1, 30), 6))
    for _ in range(30):
        own = words(rng, 60)
        texts += [own, changed(rng, own, 1), own + ["tail"]]
    pairs = [(i, " ".join(t)) for i, t in enumerate(texts, 100)] + [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(ODD, 1)]
    df = ngram_join(documents(spark, pairs).repartition(4), words=k, percent=percent)
    assert rows_of(df, "doc_id", "n_shingles", "component_id") == brute_components(pairs, k, percent)


def test_join_of_nothing(spark):
    assert ngram_join(documents(spark, ["a"]).filter("false")).count() == 0


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_texts_and_sets_meet_ids_where_they_are_read(spark, monkeypatch, sent):
    plans = {}

    def staged(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return ngram.staged_before(df, label)

    monkeypatch.setattr(ngram, "staged_before", ngram.staged, raising=False)
    monkeypatch.setattr(ngram, "staged", staged)
    monkeypatch.setattr(ngram, "_IDS_SENT", sent, raising=False)
    rng = random.Random(3)
    text = " ".join(words(rng, 60))
    pairs = [(1, text), (2, text + " more"), (2, text + " more"), (3, " ".join(words(rng, 60))), (4, None), (5, text)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rows_of(ngram_join(documents(spark, pairs)), "doc_id", "component_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(1, 1), (2, 1), (2, 1), (3, 3), (4, 4), (5, 1)]
    # With few ids no text is shuffled, and with many they are joined as before.
    assert ("Exchange" in plans["sets"].replace("BroadcastExchange", "")) == (sent == 0)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_chance_groups_bring_no_whole_sets_together(spark, monkeypatch, k, percent):
    """Texts with a passage in common share keys, but their prefixes tell them apart."""
    led = []
    monkeypatch.setattr(ngram, "led_before", ngram._led_groups, raising=False)
    monkeypatch.setattr(ngram, "_led_groups", lambda *a: led.append(a) or ngram.led_before(*a))
    rng = random.Random(6)
    passage = words(rng, 90)
    texts = [words(rng, 120) + passage + words(rng, 120) for _ in range(30)]
    pairs = [(i, " ".join(t)) for i, t in enumerate(texts, 100)]
    found = rows_of(ngram_join(documents(spark, pairs), words=k, percent=percent), "doc_id", "component_id")
    assert found == [(i, i) for i, _ in pairs] and not led


def test_slices_of_groups_are_on_disk_one_at_a_time(spark, monkeypatch):
    """Groups beyond the limit, in many slices: the same result, and a slice goes before the next comes."""
    live, most = set(), []

    def staged(df, label):
        out = ngram.staged_before(df, label)
        if label in ("diffs", "led"):
            live.add(folder(out))
            most.append(len(live))
        return out

    def folder(df):
        return df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else None

    def release(df):
        live.discard(folder(df))
        ngram.release_before(df)

    for name, spy in (("staged", staged), ("release", release)):
        monkeypatch.setattr(ngram, f"{name}_before", getattr(ngram, name), raising=False)
        monkeypatch.setattr(ngram, name, spy)
    for name, value in (("GROUP_MEMBERS", 30), ("_SLICE_SHARE", 0.8), ("_PAIRS_A_MEMBER", 1)):
        monkeypatch.setattr(ngram, name, value)
    rng = random.Random(9)
    texts = []
    for size in (140, 90, 60):
        base = words(rng, size)
        texts += [changed(rng, base, rng.randrange(size // 15)) for _ in range(45)]
    pairs = [(i, " ".join(t)) for i, t in enumerate(texts, 100)]
    df = ngram_join(documents(spark, pairs))
    assert rows_of(df, "doc_id", "n_shingles", "component_id") == brute_components(pairs, 3, 90)
    assert len(most) > 2 and max(most) <= 2


@pytest.mark.parametrize("percent", [100, 90, 80])
def test_parts_by_size_hold_all_pairs_that_may_be_linked(spark, percent):
    sizes = [1, 2, 3, 9, 10, 11, 18, 20, 80, 81, 90, 99, 100, 110, 111, 125, 900, 1000, 5000]
    rows = [(7, i, n, i % 3 == 0) for i, n in enumerate(sizes)]
    parts = ngram._by_size(frame(spark, rows, "group long, rep long, n long, loose boolean"), percent).collect()
    of = defaultdict(set)
    for r in parts:
        of[r.group].add(r.rep)
    for _, i, n, a in rows:
        for _, j, m, b in rows[:i]:
            if (a or b) and 100 * min(n, m) >= percent * max(n, m):
                assert any({i, j} <= x for x in of.values())
    assert len(parts) <= 2 * len(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(components(frame(spark, edges, "u long, v long")).collect())
    assert got[60] == got[35] == 10 and got[139] == 100 and 7 not in got


# Repeated passages


def brute_repeats(pairs, window):
    texts = [(i, (t or "").encode()) for i, t in pairs]
    seen = Counter(t[p : p + window] for _, t in texts for p in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p : p + window] = b"\x01" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [2000, 3])
def test_repeats_equal_brute_force(spark, chunk):
    rng = random.Random(5)
    passages = [prose(900 + i, rng.randrange(30, 90)) for i in range(6)]
    texts = []
    for i in range(60):
        parts = [prose(i, rng.randrange(0, 60))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(passages)[rng.randrange(30) :], prose(2000 + rng.randrange(10**6), rng.randrange(20))]
        texts.append(" ".join(parts))
    texts += ["é" * 300, "é" * 150, "ab" * 400, "a" * 199, "a" * 500, texts[0], texts[0], prose(1, 50) * 3]
    pairs = list(enumerate(texts, 100)) + [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(ODD)]
    df = suffix_dedup(documents(spark, pairs).repartition(3), chunk=chunk)
    assert rows_of(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(pairs, 200)


def test_repeats_of_two_letters(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab") for _ in range(400)) for _ in range(60)]
    pairs = list(enumerate(texts, 1))
    df = suffix_dedup(documents(spark, pairs), window=14, anchor=5, chunk=50)
    assert rows_of(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(pairs, 14)
    df = suffix_dedup(documents(spark, pairs), window=14, anchor=5, chunk=10**6)
    assert rows_of(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(pairs, 14)


def test_maximal_repeats_give_all_occurrences():
    texts = [b"xxhello worldyy", b"zzhello worldqq", b"ahello worldyy", b"nothing"]
    at = [2, 2, 1, 0]
    lefts = [t[:i][::-1] for t, i in zip(texts, at)]
    rights = [t[i:] for t, i in zip(texts, at)]
    found = {(left, right, tuple(sorted(group))) for left, right, group in suffix.maximal_repeats(lefts, rights, 5)}
    assert found == {(0, 11, (0, 1, 2)), (0, 13, (0, 2))}


def test_kept_text_is_whole_characters(spark):
    common = "ö" * 150
    docs = documents(spark, [f"start é{common}ü end", f"begin è{common}ú stop"])
    got = {r.doc_id: r.kept_text for r in suffix_dedup(docs, with_text=True).collect()}
    assert got == {1: "start éü end", 2: "begin èú stop"}


@pytest.mark.parametrize("texts", [40, 160])
def test_levels_do_not_grow_with_what_is_spilled(spark, monkeypatch, texts):
    """Tables hold one text each; partitions come from the bytes that are left."""
    levels: list[str] = []
    write = exact.staged

    def spy(df, label):
        if label.startswith("grace-") and "groups" not in label:
            levels.append(label)
        return write(df, label)

    monkeypatch.setattr(exact, "staged", spy)
    docs = documents(spark, [f"{i:04d}" * 250 for i in range(texts)] * 2)
    found = exact_dedup(docs, table_bytes=1000).collect()
    assert sum(r.kept for r in found) == texts and {r.group_size for r in found} == {2}
    assert len(levels) <= 4
