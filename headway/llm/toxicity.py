"""Toxicity by multiple-instance learning: sentences are judged, documents are labelled."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import hash_sample, in_batches, python_rows

#: Labelled documents the model is fitted on, per label at most.
TRAIN_DOCS = 1500
#: Longer documents are left out of the fit (never of the scoring).
TRAIN_BYTES = 40_000
#: A feature must occur in so many of these documents.
_LEAST_DOCS = 4
_ROUNDS = 100
_L1 = 0.1
_RATE = 0.3
#: Words of a sentence at least; shorter ones are not judged by themselves.
_LEAST_WORDS = 5
_WORD_CACHE = 300_000

_SENTENCE = re.compile(r"[.!?\n\r  。]+")
_NOT_WORD = re.compile(r"\W+")


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence, lower-cased; what is too short is joined with what follows."""
    out: list[list[str]] = []
    held: list[str] = []
    for part in _SENTENCE.split(text.lower()):
        held += part.split()
        if len(held) >= _LEAST_WORDS:
            out.append(held)
            held = []
    if held:
        out.append(held)
    return out


def word_features(word: str) -> list[str]:
    """A word and its strings of four and five characters, with its ends marked."""
    word = _NOT_WORD.sub("", word)
    if not word:
        return []
    marked = f"<{word}>"
    return [marked, *{marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1)} - {marked}]


@dataclass
class ToxicityModel:
    """Sentence logit: the bias and the weights of the features of its distinct words."""

    bias: float
    weights: dict[str, float]

    def word_score(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in word_features(word))


class SentenceScorer:
    """Scores of words are remembered, as a sentence's logit is a sum over words."""

    def __init__(self, model: ToxicityModel) -> None:
        self._model = model
        self._known: dict[str, float] = {}

    def logits(self, text: str) -> list[float]:
        known, model = self._known, self._model
        if len(known) > _WORD_CACHE:
            known.clear()
        out = []
        for words in sentences(text):
            logit = model.bias
            for word in set(words):
                score = known.get(word)
                if score is None:
                    known[word] = score = model.word_score(word)
                logit += score
            out.append(logit)
        return out


def noisy_or(logits: list[float]) -> float:
    """The probability that at least one sentence offends."""
    # -log(1 - sigmoid(z)) is softplus(z).
    total = sum(z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z)) for z in logits)
    return -math.expm1(-total)


def fit(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Fit sentence weights to document labels by gradients through the noisy-or.

    Full-batch AdaGrad with an L1 proximal step. Each distinct word's features
    are held once; sentences are lists of words, documents lists of sentences.
    Without documents of both labels nothing can be told apart, and no sentence
    offends.
    """
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(-30.0, {})
    vocabulary: dict[str, int] = {}
    word_at: list[int] = []
    sentence_of: list[int] = []
    doc_of: list[int] = []
    for doc, text in enumerate(texts):
        for words in sentences(text):
            for word in dict.fromkeys(words):
                word_at.append(vocabulary.setdefault(word, len(vocabulary)))
                sentence_of.append(len(doc_of))
            doc_of.append(doc)
    words = np.array(word_at, np.int64)
    sentence = np.array(sentence_of, np.int64)
    doc = np.array(doc_of, np.int64)
    in_doc = Counter()
    pairs = np.unique(doc[sentence] * len(vocabulary) + words) % max(1, len(vocabulary))
    docs_with = np.bincount(pairs, minlength=len(vocabulary))
    of_word = [word_features(word) for word in vocabulary]
    for found, n in zip(of_word, docs_with.tolist()):
        for feature in found:
            in_doc[feature] += n
    names = sorted(f for f, n in in_doc.items() if n >= _LEAST_DOCS)
    number = {f: i for i, f in enumerate(names)}
    feature, owner = [], []
    for i, found in enumerate(of_word):
        own = [number[f] for f in found if f in number]
        feature += own
        owner += [i] * len(own)
    feature, owner = np.array(feature, np.int64), np.array(owner, np.int64)

    weights, bias = np.zeros(len(names)), -8.0
    spread, bias_spread = np.full(len(names), 1e-8), 1e-8
    for _ in range(_ROUNDS):
        score = np.bincount(owner, weights[feature], len(vocabulary))
        z = bias + np.bincount(sentence, score[words], len(doc))
        soft = np.logaddexp(0, z)
        total = np.maximum(np.bincount(doc, soft, len(y)), 1e-9)
        by_doc = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-9), 1.0)
        by_sentence = by_doc[doc] * np.exp(z - soft)
        by_word = np.bincount(words, by_sentence[sentence], len(vocabulary))
        slope = np.bincount(feature, by_word[owner], len(names))
        spread += slope**2
        step = _RATE / np.sqrt(spread)
        moved = weights - step * slope
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * _L1, 0)
        slope = float(by_sentence.sum())
        bias_spread += slope**2
        bias -= _RATE * slope / math.sqrt(bias_spread)
    kept = np.flatnonzero(weights)
    return ToxicityModel(float(bias), {names[i]: float(weights[i]) for i in kept})


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
    train_bytes: int = TRAIN_BYTES,
) -> ToxicityModel:
    """Fit on a bounded sample: per label the ``train_docs`` rows first in hash order.

    ``learn`` is a condition on ``docs``. Rows without text or with a label other
    than 0 and 1 are left out; a document with several labels counts for each.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    texts = docs.filter(learn).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    texts = texts.filter(F.octet_length("_text") <= train_bytes)
    sample = []
    for label in (0, 1):
        # A document is named by id and text, so that one is drawn and not all that share an id.
        named = texts.withColumn("_key", F.xxhash64("_id", "_text"))
        labelled = named.select("_id", "_key").join(marks.filter(F.col("_label") == label), "_id")
        keys = hash_sample(labelled.select("_key"), ["_key"], train_docs, 7)
        rows = named.join(F.broadcast(keys), "_key", "left_semi").dropDuplicates(["_key"])
        sample += [(row["_text"], label) for row in rows.select("_text").collect()]
    sample.sort()
    return fit([s[0] for s in sample], [s[1] for s in sample])


_SCORE_SQL = "doc_id long, held_out boolean, score double, predicted int, worst_sentence int, worst_score double"
_SCORE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("score", pa.float64()),
        ("predicted", pa.int32()),
        ("worst_sentence", pa.int32()),
        ("worst_score", pa.float64()),
    ]
)


def _score(model: ToxicityModel):
    def run(batches):
        scorer = SentenceScorer(model)

        def rows():
            for doc_id, held_out, text in python_rows(batches):
                logits = scorer.logits(text or "")
                score = noisy_or(logits)
                worst = max(range(len(logits)), key=logits.__getitem__) if logits else None
                at = None if worst is None else 1 / (1 + math.exp(-max(-500.0, logits[worst])))
                yield doc_id, held_out, score, int(score >= 0.5), worst, at

        return in_batches(_SCORE, rows(), 1000)

    return run


def score(
    docs: DataFrame, model: ToxicityModel, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted, worst_sentence, worst_score.

    A document's score is the noisy-or of its sentences'; the worst sentence is
    given by its number (from 0, among sentences with words) and its own score.
    Null and wordless texts have no sentence and score 0. A row in, a row out;
    other columns are ignored.
    """
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return plain.mapInArrow(_score(model), _SCORE_SQL)


_SPAN = pa.schema([("doc_id", pa.int64()), ("sentence", pa.string()), ("score", pa.float64())])


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under one half."""
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = SentenceScorer(model)
        for one in batches:
            texts = one.column(at).to_pylist()
            clean = [noisy_or(scorer.logits(text or "")) < 0.5 for text in texts]
            yield one.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def offending_sentences(
    docs: DataFrame,
    model: ToxicityModel,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The sentences that score ``threshold`` or more: doc_id, sentence (its words), score."""

    def run(batches):
        scorer = SentenceScorer(model)

        def rows():
            for doc_id, text in python_rows(batches):
                text = text or ""
                for words, z in zip(sentences(text), scorer.logits(text)):
                    own = 1 / (1 + math.exp(-max(-500.0, z)))
                    if own >= threshold:
                        yield doc_id, " ".join(words), own

        return in_batches(_SPAN, rows(), 1000)

    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return plain.mapInArrow(run, "doc_id long, sentence string, score double")
