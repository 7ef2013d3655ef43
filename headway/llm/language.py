"""Language identification by sparse multinomial regression on TF-IDF of character n-grams."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import hash_sample, in_batches, python_rows

#: n-grams are hashed to so many features.
BUCKETS = 1 << 15
SIZES = (1, 2, 3)
#: Labelled documents that the weights are fitted on (the frequencies are of all of them).
TRAIN_DOCS = 6000
#: The fit reads so much of a longer document, from its first letter on (frequencies and predictions read all).
TRAIN_BYTES = 20_000
#: Every language has up to so many documents in the fit, however rare it is.
LANGUAGE_DOCS = 32
_KEY_BITS = 62
_KEY = (1 << _KEY_BITS) - 1
#: A tenth of the sample calibrates the temperature.
_CALIBRATE_EVERY = 10
_ALPHA, _BETA, _L1, _L2 = 0.5, 1.0, 0.02, 0.02
_EPOCHS = 3
_PIECE = 1 << 20

UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text and how often they occur; characters lower-cased, runs of blanks as one."""
    chars = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    mask = np.uint32(BUCKETS - 1)
    # In pieces that overlap by the longest n-gram less one, so memory is bounded.
    for start in range(0, len(chars), _PIECE):
        for size in SIZES:
            end = min(len(chars), start + _PIECE + size - 1)
            own = chars[start:end]
            n = len(own) - size + 1
            if n <= 0:
                continue
            value = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(size):
                value = (value ^ own[i : i + n]) * np.uint32(0x85EBCA6B)
                value ^= value >> np.uint32(15)
            counts += np.bincount((value ^ (value >> np.uint32(13))) & mask, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class LanguageModel:
    """Class scores are linear in the TF-IDF vector of unit length, divided by the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages, mostly zero
    bias: np.ndarray
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, counts = ngram_counts(text)
        value = (1 + np.log(counts)) * self.idf[found]
        norm = math.sqrt(float(value @ value))
        return found, value / norm if norm else value

    def logits(self, text: str) -> np.ndarray:
        found, value = self.vector(text)
        return value @ self.weights[found] + self.bias

    def probabilities(self, text: str) -> np.ndarray:
        return _softmax(self.logits(text) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not has_letter(text) or not self.languages:
            return UNDETERMINED, 0.0
        p = self.probabilities(text)
        best = int(p.argmax())
        return self.languages[best], min(1.0, float(p[best]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_regularised_leader(
    examples: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal with an elastic-net penalty, one example at a time.

    Of each coordinate the sum of adjusted gradients and of squared gradients is
    kept; its weight follows from them, and is zero while the sum is within L1.
    """
    sums = np.zeros((features + 1, classes))
    squares = np.zeros((features + 1, classes))

    def weights_of(rows):
        z, n = sums[rows], squares[rows]
        rate = (_BETA + np.sqrt(n)) / _ALPHA + _L2
        return np.where(np.abs(z) <= _L1, 0.0, (np.sign(z) * _L1 - z) / rate)

    rng = np.random.default_rng(0)
    for _ in range(_EPOCHS):
        for i in rng.permutation(len(examples)).tolist():
            found, value, label = examples[i]
            rows = np.append(found, features)
            x = np.append(value, 1.0)
            held = weights_of(rows)
            slope = _softmax(x @ held)
            slope[label] -= 1
            gradient = x[:, None] * slope[None, :]
            before = squares[rows]
            squares[rows] = before + gradient**2
            sums[rows] += gradient - (np.sqrt(squares[rows]) - np.sqrt(before)) / _ALPHA * held
    weights = weights_of(slice(None))
    return weights[:-1], weights[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""

    def loss(log_t: float) -> float:
        p = _softmax(logits / math.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())

    low, high, ratio = math.log(0.01), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return math.exp((low + high) / 2)


def opening(text: str) -> str:
    """At most TRAIN_BYTES of a text with a letter, from the first letter on if it is longer."""
    if len(text.encode("utf-8", "replace")) <= TRAIN_BYTES:
        return text
    first = next(i for i, c in enumerate(text) if c.isalpha())
    return text[first : first + TRAIN_BYTES].encode("utf-8", "replace")[:TRAIN_BYTES].decode("utf-8", "ignore")


_SEEN_SQL = "lang string, feature long, docs long, first long"
_SEEN = pa.schema([("lang", pa.string()), ("feature", pa.int64()), ("docs", pa.int64()), ("first", pa.int64())])


def _seen(batches):
    """How many documents have a feature (no lang), and the first document of each slot of a language.

    A language's documents with a letter are dealt to LANGUAGE_DOCS slots by
    their keys; first are the shorter ones, then the smallest keys.
    """
    counts = np.zeros(BUCKETS + 1, np.int64)
    first: dict[tuple[str, int], int] = {}
    for text, lang, key, is_long in python_rows(batches):
        found, _ = ngram_counts(text)
        counts[found] += 1
        counts[BUCKETS] += 1
        slot, code = (lang, key % LANGUAGE_DOCS), key | is_long << _KEY_BITS
        if code < first.get(slot, 1 << 63) and has_letter(text):
            first[slot] = code
    found = np.flatnonzero(counts)
    features = ((None, feature, n, None) for feature, n in zip(found.tolist(), counts[found].tolist()))
    slots = ((lang, slot, None, code) for (lang, slot), code in first.items())
    yield from in_batches(_SEEN, chain(features, slots), 10_000)


_SAMPLE = pa.schema([("text", pa.string()), ("lang", pa.string())])


def _openings(batches):
    rows = ((opening(text), lang) for text, lang in python_rows(batches) if has_letter(text))
    return in_batches(_SAMPLE, rows, 100)


def _split(examples: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Every tenth to calibrate, the others to fit; the first of each language is fitted."""
    held, fitted, met = [], [], set()
    for i, example in enumerate(examples):
        label = example[2]
        (fitted if i % _CALIBRATE_EVERY or label not in met else held).append(example)
        met.add(label)
    return held, fitted


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> LanguageModel:
    """Learn from the documents that meet ``learn`` and have a language and a letter.

    Inverse document frequencies are of all of them, and so are the languages.
    The weights are fitted on a sample, ``train_docs`` first in hash order and up
    to LANGUAGE_DOCS more of each language, so none is without; of a long text on
    its first TRAIN_BYTES. What reaches the driver grows with the number of
    languages alone. Without any such document the model knows no language.
    """
    texts = docs.filter(learn).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    )
    texts = texts.filter("lang IS NOT NULL AND text IS NOT NULL")
    texts = texts.withColumn("key", F.xxhash64("id", "lang", "text").bitwiseAND(F.lit(_KEY)))
    is_long = (F.octet_length("text") > TRAIN_BYTES).cast("int")
    seen = texts.select("text", "lang", "key", is_long).mapInArrow(_seen, _SEEN_SQL).groupBy("lang", "feature")
    # BUCKETS + 1 rows at most, and LANGUAGE_DOCS for each language.
    found = seen.agg(F.sum("docs").alias("docs"), F.min("first").alias("first")).collect()
    docs_with = np.zeros(BUCKETS + 1)
    for row in found:
        if row["lang"] is None:
            docs_with[row["feature"]] = row["docs"]
    total = docs_with[BUCKETS]
    idf = np.log((1 + total) / (1 + docs_with[:BUCKETS])) + 1
    firsts = [(row["first"] & _KEY,) for row in found if row["lang"] is not None]
    chosen = hash_sample(texts.select("key"), ["key"], train_docs, 6)
    chosen = chosen.unionByName(docs.sparkSession.createDataFrame(firsts, "key long"))
    # Rows that repeat whole are drawn together, so they are made one.
    sample = texts.join(F.broadcast(chosen.distinct()), "key", "left_semi").dropDuplicates(["key"])
    sample = sample.select("text", "lang").mapInArrow(_openings, "text string, lang string")
    sample = sorted((row["text"], row["lang"]) for row in sample.collect())
    languages = sorted({lang for _, lang in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    model = LanguageModel(languages, idf, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)), 1.0)
    if not sample:
        return model
    examples = [(*model.vector(text), number[lang]) for text, lang in sample]
    held, fitted = _split(examples) if len(examples) >= 10 * _CALIBRATE_EVERY else ([], examples)
    model.weights, model.bias = follow_the_regularised_leader(fitted, BUCKETS, len(languages))
    if held:
        logits = np.array([value @ model.weights[found] + model.bias for found, value, _ in held])
        model.temperature = best_temperature(logits, np.array([label for _, _, label in held]))
    return model


_PREDICTED_SQL = "doc_id long, held_out boolean, lang_pred string, score double"
_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


def predict(
    docs: DataFrame, model: LanguageModel, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The language of every whole text: doc_id, held_out, lang_pred, score (calibrated probability).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text if no language was learnt. A row in, a row out; other columns are
    ignored.
    """

    def run(batches):
        rows = (
            (doc_id, held, *model.predict(text)) for doc_id, held, text in python_rows(batches)
        )
        return in_batches(_PREDICTED, rows, 1000)

    plain = docs.select(
        F.col(id_col).cast("long"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    return plain.mapInArrow(run, _PREDICTED_SQL)
