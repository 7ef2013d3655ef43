"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and gives it, read again, to the next stage. All but the
last return the columns they were given. Near-duplicates share five-word
shingles with a similarity of 0.8 or more. SQL can express neither the
classifier nor the tokenizer, so there is no SQL twin.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import toxicity
from headway.llm.common import matching, read_table, ready, remainder, staged
from headway.llm.exact_dedup import exact_dedup
from headway.llm.ngram_join import ngram_join
from headway.llm.packing import pack_documents
from headway.llm.suffix_dedup import suffix_dedup


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; learnt from the labels of four fifths of them."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder("doc_id", 5) != 0)
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest."""
    ready(spark)
    return matching(docs, exact_dedup(docs).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    ready(spark)
    found = ngram_join(docs, words=5, percent=80)
    return matching(docs, found.filter("doc_id <=> component_id"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur again anywhere."""
    ready(spark)
    names = docs.columns
    found = suffix_dedup(docs, with_text=True).filter("n_removed > 0")
    found = found.select(F.col("doc_key").alias("__key"), F.col("kept_text").alias("__kept"))
    found = found.dropDuplicates(["__key"])
    keyed = docs.withColumn("__doc", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    joined = keyed.join(found, keyed["__doc"] == found["__key"], "left")
    cut = F.col("__kept").isNotNull()
    new = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in names:
        new["n_chars"] = F.when(cut, F.length("__kept").cast("long")).otherwise(F.col("n_chars"))
    return joined.withColumns(new).select(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces placed in sequences of 2048 tokens."""
    ready(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_repeated_passages),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
