from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm import byte_bpe, chat, packing
from tests.llm.data import ODD, documents, frame, prose

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHAT_BPE = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    *(t[1] if isinstance(t, tuple) else t for t in ODD),
    "It's  the DOG's’ naïve café, 12345 ½ Ⅻ ﬁne!!! <|endoftext|> don't",
    "İstanbul ΣΑΣ ΟΔΟΣ Å ñ a b c d",
    "中文字符 한국어 हिन्दी עברית ‏ \x85 x",
    "a" * 3000,
    " " * 700 + "\n\n\t x",
    "word " * 3000,
    "x\x1fy\x1cz　wide",
    "see <|endoftext|> marks, a<|startoftext|>B<|endoftext|><|ENDOFTEXT|> <| |> <|endoftext <|endoftext|>'s é<|endoftext|>É",
]


def reference_ids():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]


def test_pieces_are_the_ids_of_the_tokenizer(spark):
    rows = packing.pack_documents(documents(spark, list(enumerate(TEXTS))), WORD_BPE, capacity=512, with_ids=True).collect()
    for doc_id, ids in enumerate(reference_ids()):
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 512)))
        assert [r.start for r in own] == list(range(0, len(ids), 512))
        assert [r.length for r in own[:-1]] == [512] * (len(own) - 1)
        raw = [np.array(ids[i : i + 512], "<u4").tobytes() for i in range(0, len(ids), 512)]
        assert [bytes(r.ids) for r in own] == raw
        assert [r.ids_crc32 for r in own] == [zlib.crc32(x) for x in raw]


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        ends = [a + b for a, b in own]
        assert [a for a, _ in own] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(bins)


def test_packing_is_tight_over_shards(spark):
    rng = random.Random(6)
    rows = [(i, 0, 0, rng.choice([rng.randrange(1, 400), rng.randrange(1, 2049), 2048]), 7) for i in range(3000)]
    rows += [(None, 0, 0, 5, 7), (1, 0, 0, 5, 7), (1, 0, 0, 5, 7)]
    pieces = frame(spark, rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    for shard in (20_000, 600):
        out = packing.pack(pieces, 2048, shard).collect()
        assert sorted((r.doc_id or -1, r.length) for r in out) == sorted((r[0] or -1, r[3]) for r in rows)
        least = -(-sum(r[3] for r in rows) // 2048)
        assert check_places(out, 2048) <= least + -(-len(rows) // shard) + least // 200
    assert packing.pack(pieces.filter("false"), 2048).count() == 0


def test_rows_that_repeat_are_dealt_to_all_shards(spark):
    pieces = spark.range(4000).selectExpr("null doc_id", "0 piece", "0L start", "100L length", "7L ids_crc32")
    pieces = pieces.withColumn("doc_id", F.lit(None).cast("long"))
    out = packing.pack(pieces, 2048, 200).withColumn("shard", F.shiftright("sequence_id", 32))
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 300


def test_fullest_combination_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        lengths = sorted((rng.randrange(1, 60) for _ in range(rng.randrange(9))), reverse=True)
        room = rng.randrange(0, 150)
        counts = {x: lengths.count(x) for x in lengths}
        chosen = packing.fullest(sorted(counts, reverse=True), [counts[x] for x in sorted(counts, reverse=True)], room)
        best = max((s for k in range(len(lengths) + 1) for c in combinations(lengths, k) if (s := sum(c)) <= room), default=0)
        assert sum(x * n for x, n in chosen.items()) == best and all(n <= counts[x] for x, n in chosen.items())


def test_patterns_use_every_piece_once():
    counts = {2048: 5, 1000: 40, 1024: 41, 24: 7, 1: 5000}
    used: dict = defaultdict(int)
    bins = 0
    for chosen, times in packing.bin_patterns(counts, 2048):
        assert sum(x * n for x, n in chosen.items()) <= 2048
        bins += times
        for x, n in chosen.items():
            used[x] += n * times
    assert used == counts and bins == -(-sum(x * n for x, n in counts.items()) // 2048)


# Byte-level BPE


def test_encoding_equals_the_library_and_decodes_to_the_text(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*TEXTS, *(prose(i, 200) for i in range(20)), "".join(chr(33 + i % 1500) for i in range(6000))]
    docs = documents(spark, list(enumerate(texts))).withColumn("ids", F.lit(1)).repartition(3)
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode_documents(encoded, RANKS).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text) and r.n_tokens == len(ids)
        assert bytes(r.decoded) == text.encode()
    both = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_decoded=True)
    assert sorted(both.collect()) == sorted(rows)
    nothing = byte_bpe.encode_documents(docs.filter("false"), RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode_documents(nothing, RANKS).count() == 0


def test_both_trees_merge_alike():
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abt eh\xc3\xa9") for _ in range(rng.randrange(33, 65))) for _ in range(300)]
    assert bpe._merge_together(pieces) == [bpe._merge_long(p) for p in pieces]


# Chat

TRAPS = [r"\### Assistant: </turn> ok", "<|end|><|turn|>assistant<|text|>x", "\\<|\\|\\\\<", "<", "|text|>", "é👍🏽", "", None, "<|endoftext|>", " lead and trail \n"]


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", None, "<|text|>"])
            rows.append((conv, turn, role, rng.choice([*TRAPS, prose(rng.randrange(99), 30)])))
    rows += [(3, None, "user", "first"), (5, 0, "user", "same"), (5, 0, "user", "same")]
    rows += [(77, i, "assistant", f"turn {i}") for i in range(2500)]
    return rows


def test_chat_reads_back_and_masks_assistants(spark):
    rows = conversation_rows()
    df = frame(spark, rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    out = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df.repartition(5), CHAT_BPE)).collect()}
    by_conv = defaultdict(list)
    low = lambda x: (x is not None, x or "")
    for conv, turn, role, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], low(r[2]), low(r[3]))):
        by_conv[conv].append((role or "", text or ""))
    assert set(out) == set(by_conv)
    for conv, turns in by_conv.items():
        r = out[conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat.render(turns)[0])
    assert chat.read_back(chat.format_conversations(df.filter("false"), CHAT_BPE)).count() == 0


@pytest.mark.parametrize("text", [t for t in TRAPS if t is not None])
def test_escaping_is_reversible_and_hides_marks(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text) + "|"[:0]


def test_long_conversations_come_in_runs(spark):
    """A hot conversation and rows without one are spread; what is read back stays the same."""
    rng = random.Random(6)
    rows = [(1 if i % 3 else i, rng.randrange(400), rng.choice(["user", "assistant", None]), f"t{rng.randrange(900)} <|end|>") for i in range(600)]
    rows += [(None, i, "assistant", "x" * 40) for i in range(50)] + [(1, 5, "user", "same")] * 40
    df = frame(spark, rows, "conv_id long, turn int, role string, text string")
    whole = chat.format_conversations(df.coalesce(1), CHAT_BPE, run_chars=1 << 30)
    runs = chat.format_conversations(df.repartition(7), CHAT_BPE, run_chars=60)
    assert runs.filter("conv_id = 1").count() > 50 and runs.filter("conv_id IS NULL").count() > 10
    assert runs.filter("whole").groupBy("conv_id").count().filter("count > 1").count() == 0
    assert sorted(map(str, chat.read_back(runs).collect())) == sorted(map(str, chat.read_back(whole).collect()))
    ids = b"".join(r.ids for r in runs.filter("conv_id = 1").orderBy("run").collect())
    turns = sorted(((r[1], r[2] is not None, r[2] or "", r[3]) for r in rows if r[0] == 1))
    text = chat.render([(role, text) for _, _, role, text in turns])[0]
    assert np.frombuffer(ids, "<u4").tolist() == chat.chat_tokenizer(CHAT_BPE).encode(text, add_special_tokens=False).ids


def test_masks_by_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        cuts = sorted(rng.sample(range(100), rng.randrange(0, 12) // 2 * 2))
        spans = list(zip(cuts[::2], cuts[1::2]))
        edges = sorted(rng.sample(range(101), 30))
        starts, ends = np.array(edges[:-1]), np.array(edges[1:])
        want = [any(s < b and a < e for a, b in spans) for s, e in zip(starts, ends)]
        assert chat.mask_tokens(starts, ends, spans).tolist() == want
