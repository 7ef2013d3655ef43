"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark: SparkSession, rows: list[tuple], schema: str = DOCS) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def documents(spark: SparkSession, texts: list) -> DataFrame:
    """Documents numbered from 1 over the texts given (or (id, text) pairs)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
    return frame(spark, [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows])


def words(rng: random.Random, n: int, of: int = 5000) -> list[str]:
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def prose(seed: int, n: int, of: int = 5000) -> str:
    return " ".join(words(random.Random(seed), n, of))


#: Null, empty, blank and odd texts, repeated whole rows and a null id.
ODD = [None, "", " \n\t", "é", "a b", "a  b\n", "A b", (3, "twin row"), (3, "twin row"), (None, "no id"), "\x00​", "👍🏽 👍"]
