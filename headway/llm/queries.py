"""The operators over the test tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import collocations, conversation_repair, language, suffix_tree_lm, toxicity, wu_manber
from headway.llm.byte_bpe import encode_documents
from headway.llm.chat import format_conversations, read_back
from headway.llm.common import read_table, remainder
from headway.llm.exact_dedup import exact_dedup
from headway.llm.multi_index import nearest
from headway.llm.ngram_join import ngram_join
from headway.llm.packing import pack_documents
from headway.llm.suffix_dedup import suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str):
    def register(make):
        QUERIES[name] = make
        return make

    return register


@_query("op1_pack")
def _(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer)


@_query("op2_toxicity")
def _(spark, sf_dir):
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = remainder("doc_id", 5) == 0
    return toxicity.score(docs, toxicity.train(docs, labels, ~held_out), held_out)


@_query("op3_suffix_dedup")
def _(spark, sf_dir):
    found = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op4_exact_dedup")
def _(spark, sf_dir):
    found = exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op4_exact_dedup"] = r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
        FROM documents
    ),
    m AS (
        SELECT doc_id, content,
               first_value(doc_id) OVER w AS keep_id,
               row_number() OVER w = 1 AS kept,
               count(*) OVER (PARTITION BY content) AS group_size
        FROM d WINDOW w AS (PARTITION BY content ORDER BY chars DESC, doc_id)
    )
    SELECT doc_id, keep_id, group_size, kept, sha256(content) AS text_sha256 FROM m
"""


@_query("op5_multi_index")
def _(spark, sf_dir):
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)


@_query("op6_language")
def _(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    return language.predict(docs, language.train(docs, ~held_out), held_out)


@_query("op7_byte_bpe")
def _(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, with_decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("op8_suffix_tree_lm")
def _(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return suffix_tree_lm.score(docs, remainder("doc_id", 7) == 2)


@_query("op9_ngram_join")
def _(spark, sf_dir):
    found = ngram_join(read_table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


ORACLE["op9_ngram_join"] = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id,
               list_filter(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
        FROM documents
    ),
    s AS (
        SELECT doc_id,
               CASE WHEN len(words) = 0 THEN []
                    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                    ELSE list_distinct(list_transform(range(1, len(words) - 1),
                         lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
        FROM w
    ),
    t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
    p AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ),
    e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
    r AS (
        SELECT doc_id AS node, doc_id AS seen FROM s
        UNION
        SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
    )
    SELECT s.doc_id, len(s.shingles) AS n_shingles, c.component_id
    FROM s JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON s.doc_id = c.node
"""


#: A conversation whose texts look like the marks of a template.
_TRAP = r"\### Assistant: </turn> ok"


@_query("op10_chat")
def _(spark, sf_dir):
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", _TRAP), (-7, 1, "assistant", _TRAP)], rows.schema)
    formatted = format_conversations(rows.unionByName(trap), public_tokenizers.path("byte_bpe_50k.json"))
    return read_back(formatted)


@_query("op12_wu_manber")
def _(spark, sf_dir):
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = wu_manber.decontaminate(docs, benchmark).withColumn("n_hit", wu_manber.hit_words())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op12_wu_manber"] = r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ),
    i AS (
        SELECT coalesce(item_id::VARCHAR, '') AS item,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ),
    s AS (
        SELECT DISTINCT item, least(len(words), 10) AS size,
               array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS string
        FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p
              FROM i WHERE len(words) > 0)
    ),
    w AS (
        SELECT row, size, p, array_to_string(words[p : p + size - 1], ' ') AS string
        FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS p
              FROM d, (SELECT DISTINCT size FROM s) WHERE len(words) >= size)
    ),
    f AS (SELECT row, item, p, w.size FROM w JOIN s ON w.size = s.size AND w.string = s.string),
    h AS (
        SELECT row, count(DISTINCT word) AS n_hit
        FROM (SELECT row, unnest(range(p, p + size)) AS word FROM f) GROUP BY row
    ),
    o AS (
        SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT row, item FROM f) GROUP BY row
    )
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (row) LEFT JOIN o USING (row)
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that a repair has to find, chosen by a hash of id and turn."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    harm = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = (F.coalesce(name, space) for name in ("role", "text"))
    return (
        rows.withColumn("harm", harm)
        .filter("harm != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("harm") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("harm") == 1, "")
            .when(F.col("harm") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


@_query("op13_conversation_repair")
def _(spark, sf_dir):
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    harmed = damaged(rows)
    found = conversation_repair.summaries(conversation_repair.repair(harmed))
    names = [name for name in found.columns if name != "conv_id"]
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    known = conversation_repair.gaps(harmed).withColumnRenamed("conv_id", "gaps_id")
    found = found.withColumnRenamed("conv_id", "found_id")
    nothing = {n: 0 for n in ("gaps", *names[:-2])} | {"audit": "", "repaired_sha256": _SHA_OF_NOTHING}
    return (
        ids.join(known, F.col("conv_id").eqNullSafe(F.col("gaps_id")), "left")
        .join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
        .select("conv_id", "gaps", *names)
        .fillna(nothing, [*nothing])
    )


_SHA_OF_NOTHING = hashlib.sha256(b"").hexdigest()

#: crc32 of an ASCII text, bit by bit.
_CRC32 = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)),
        lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
                                   lambda x, y: xor(x // 2, 3988292384 * (x % 2)))))"""

_BEST = "list_sort(list_filter([{options}], lambda x: x IS NOT NULL))[1]"


def _move(state: str, cost: str, letter: str, said: str) -> str:
    text = f"list_append({state}.t, {said})" if said else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _repair_sql() -> str:
    """The search as a recursive query: the best way into each of the four states, row by row."""
    best = lambda *options: _BEST.format(options=", ".join(options))
    gone = "r.fault IN ('blank', 'duplicate')"
    cut = "CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END"
    live = lambda option: f"CASE WHEN NOT coalesce({gone}, false) THEN {option} END"
    kept = lambda initial, option: f"CASE WHEN left(r.role, 1) = '{initial}' AND NOT coalesce({gone}, false) THEN {option} END"
    stay = [_move(f"s{n}", "2", "D", "") for n in range(4)]
    said = "r.role || ':' || r.text"
    into = {
        0: [stay[0]],
        1: [stay[1], kept("s", _move("s0", cut, "K", said))],
        2: [stay[2]],
        3: [stay[3], kept("a", _move("s2", cut, "K", said)), live(_move("s2", f"1 + {cut}", "R", "'assistant:' || r.text"))],
    }
    for n in (0, 1, 3):
        into[2] += [kept("u", _move(f"s{n}", cut, "K", said)), live(_move(f"s{n}", f"1 + {cut}", "R", "'user:' || r.text"))]
    rows = ", ".join(f"{best(*into[n])} AS s{n}" for n in range(4))

    def closed(source: str) -> str:
        users = [_move(f"s{n}", "5", "I", "'user:'") for n in (0, 1, 3)]
        return f"""
            SELECT conv, i, s0, s1, u AS s2, {best("s3", _move("u", "5", "I", "'assistant:'"))} AS s3
            FROM (SELECT *, {best("s2", *users)} AS u FROM (
                SELECT * REPLACE ({best("s3", _move("s2", "5", "I", "'assistant:'"))} AS s3) FROM ({source})))"""

    start = "{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}"
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"
    first = f"SELECT conv, 0::BIGINT AS i, {start} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM ids"
    step = f"SELECT r.conv, r.i, {rows} FROM way JOIN r ON r.conv = way.conv AND r.i = way.i + 1"
    return rf"""
    WITH RECURSIVE ids AS (SELECT row_number() OVER () AS conv, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
    h AS (
        SELECT i.conv, c.turn, coalesce(c.role, ' ') AS role, coalesce(c.text, ' ') AS text,
               {_CRC32.format(text="coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(c.turn::VARCHAR, ' ')")} % 20 AS harm
        FROM conversations c JOIN ids i ON c.conv_id IS NOT DISTINCT FROM i.conv_id
    ),
    d AS (
        SELECT conv, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
               CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM h, range(2) AS twice(n) WHERE harm != 0 AND (n = 0 OR harm = 3)
    ),
    o AS (
        SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i,
               regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last
        FROM d
    ),
    r AS (
        SELECT *, left(lag(role) OVER (PARTITION BY conv ORDER BY i), 1) || left(role, 1) AS pair,
               CASE WHEN last = '' THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
        FROM o
    ),
    way AS (
        {closed(first)}
        UNION ALL
        {closed(step)}
    ),
    ended AS (
        SELECT conv, {best("s0", "s3")} AS e FROM way
        WHERE i = (SELECT count(*) FROM r WHERE r.conv = way.conv)
    ),
    f AS (
        SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM r GROUP BY conv
    )
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit,
           sha256(array_to_string(e.t, chr(10))) AS repaired_sha256
    FROM ids JOIN ended USING (conv) LEFT JOIN f USING (conv)
    """


ORACLE["op13_conversation_repair"] = _repair_sql()


@_query("op11_collocations")
def _(spark, sf_dir):
    found = collocations.collocations(read_table(spark, sf_dir, "documents"))
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return collocations.strongest(found, 2000).select(*columns)


ORACLE["op11_collocations"] = r"""
    WITH w AS (
        SELECT piece, lang, regexp_extract_all(part, '[^\x20\x09]+') AS words FROM (
            SELECT row_number() OVER () AS piece, lang, part FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[.,;:!?\x0A-\x0D]')) AS part
                FROM documents))
    ),
    n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
    f AS (
        SELECT lang, k, words[p : p + k - 1] AS words, count(*) AS f
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS p
              FROM w, range(1, 6) AS lengths(k) WHERE len(words) >= k)
        GROUP BY ALL HAVING f >= 100
    ),
    c AS (
        SELECT f.lang, f.words, f.k, f.f AS a, l.f AS l, r.f AS r, n, cut,
               (1000::HUGEINT * f.f * n) // (l.f::HUGEINT * r.f) AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k >= 2) f
        JOIN n ON n.lang = f.lang
        JOIN f l ON l.lang = f.lang AND l.words = f.words[1 : cut]
        JOIN f r ON r.lang = f.lang AND r.words = f.words[cut + 1 : f.k]
    ),
    best AS (
        SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1
    ),
    inside AS (
        SELECT DISTINCT lang, f AS longer, words[p : p + size - 1] AS words
        FROM (SELECT *, unnest(range(1, k - size + 2)) AS p
              FROM (SELECT *, unnest(range(2, k)) AS size FROM f WHERE k >= 3))
    ),
    kept AS (
        SELECT *, array_to_string(words, ' ') AS phrase FROM best b
        WHERE NOT EXISTS (
            SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.words = b.words AND 100 * i.longer >= 100 * b.a)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000
"""
