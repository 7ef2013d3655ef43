from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
from headway.llm import queries
from tests.compare import TYPES, assert_same, connect
from tests.llm.data import documents, frame, prose, words
from tests.llm.test_dedup import brute_components, brute_exact, brute_repeats
from tests.llm.test_models import insulted
from tests.llm.test_tokens import check_places

SF = "/root/testdata/sf0.001"


def corpus(rng):
    """Clean and toxic documents, copies, near copies and shared passages."""
    texts = [(insulted(rng, rng.randrange(3, 20), bad), bad) for bad in [0, 0, 1] * 130]
    clean = [t for t, bad in texts if not bad]
    passage = " ".join(words(rng, 70))
    texts += [(t.replace(" ", "  "), 0) for t in clean[:20]]
    texts += [(" ".join([*t.split(), "tail"]), 0) for t in clean[20:50]]
    texts += [(f"{prose(i, 25)} {passage} {prose(i + 500, 25)}é", 0) for i in range(20)]
    rng.shuffle(texts)
    return texts


def test_stages_equal_brute_force(spark, tmp_path):
    texts = corpus(random.Random(12))
    documents(spark, [t for t, _ in texts]).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, bad) for i, (_, bad) in enumerate(texts, 1)]
    frame(spark, labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = read, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == read.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
    pairs = {i: t for i, (t, _) in enumerate(texts, 1)}
    kept = {r.doc_id for r in seen["toxicity"]}
    wrong = [i for i, bad in labels if (i in kept) == bool(bad)]
    assert len(wrong) <= 0.02 * len(labels)
    rows = [(i, pairs[i]) for i in sorted(kept)]
    kept = {r[0] for r in brute_exact(rows) if r[3]}
    assert {r.doc_id for r in seen["exact_dedup"]} == kept
    rows = [(i, t) for i, t in rows if i in kept]
    kept = {i for i, _, c in brute_components(rows, 5, 80) if i == c}
    assert {r.doc_id for r in seen["ngram_join"]} == kept
    rows = [(i, t) for i, t in rows if i in kept]
    left = {r[0]: r[1] - r[2] for r in brute_repeats(rows, 200)}
    after = {r.doc_id: r for r in seen["suffix_dedup"]}
    assert set(after) == kept and sum(left[i] < len(pairs[i].encode()) for i in kept) >= 20
    for i, r in after.items():
        # All texts are ASCII where passages begin and end.
        assert len(r.text.encode()) == left[i] and r.n_chars == len(r.text)
    assert {r.doc_id for r in seen["packing"]} == kept
    check_places(seen["packing"], 2048)
    run = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert run == {(r.doc_id, r.piece, r.ids_crc32) for r in seen["packing"]}


def test_pipeline_takes_odd_and_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc_key string, kept int"
    rows = [(1, None), (2, ""), (None, "x y z"), (None, "other"), (4, "twin"), (4, "twin"), (5, "w " * 5000)]
    odd = frame(spark, [(i, t, "en", "s", 0, "k", 1) for i, t in rows], schema)
    frame(spark, [(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs, ids in ((odd, [None, None, 1, 4, 5]), (odd.filter("false"), [])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
        assert sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x)) == ids
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert sorted({r.doc_id for r in packed}, key=lambda x: (x is not None, x)) == sorted(set(ids), key=lambda x: (x is not None, x))


def test_all_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


def test_queries_equal_their_sql(spark):
    con = connect(SF)
    for name, sql in queries.ORACLE.items():
        assert assert_same(queries.QUERIES[name](spark, SF), con, sql) > 0


def test_queries_give_a_row_per_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_toxicity", "op3_suffix_dedup", "op6_language", "op7_byte_bpe", "op8_suffix_tree_lm"):
        assert queries.QUERIES[name](spark, SF).count() == docs, name
    convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    rows = queries.QUERIES["op10_chat"](spark, SF).collect()
    assert len(rows) == convs + 1
    trap = next(r for r in rows if r.conv_id == -7)
    assert (trap.n_turns, trap.loss_chars) == (2, len(r"\### Assistant: </turn> ok"))
    assert Counter(r["rank"] for r in queries.QUERIES["op5_multi_index"](spark, SF).collect()).keys() == {1, 2, 3, 4, 5}
    packed = defaultdict(int)
    for r in queries.QUERIES["op1_pack"](spark, SF).collect():
        packed[r.sequence_id] += r.length
    assert max(packed.values()) <= 2048
