"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic unless all its sentences are clean: P = 1 - prod(1 - p), p = sigmoid(bias + weights of the words). Words
count by hash, and by the hashes of their first four and five bytes. Weights are learned from document labels alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.words import chunks, words_of

# At most about so many rows of each label are learned from.
SAMPLE_ROWS = 4_000
FOLDS = 5
_BITS = 18
_SIZE = 1 << _BITS
_PREFIXES = (4, 5)
# Features whose gradient is below _SLOW learn slowly, so that rare words of toxic texts aren't learned by heart.
_EPOCHS, _RATE, _DECAY, _START, _SLOW = 100, 0.3, 1e-6, -7.0, 1e-3
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


class Sentences(NamedTuple):
    doc: np.ndarray
    first: np.ndarray  # of its features
    start: np.ndarray  # bytes in the data
    end: np.ndarray
    features: list[np.ndarray]


def sentences_of(texts: list[str | None]) -> tuple[Sentences, object]:
    """Sentences end at . ! ? and line ends; those without words are left out."""
    words = words_of(texts, _PREFIXES)
    number = np.cumsum(_ENDS[words.data])[words.start] if len(words.start) else np.zeros(0, np.int64)
    first = np.flatnonzero(_changes(number))
    last = np.append(first[1:], len(number)) - 1
    # A word counts once in a sentence.
    key = np.cumsum(_changes(number)).astype(np.uint64) << np.uint64(32) | words.hash >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    once = order[_changes(key[order])]
    hashes = [words.hash, *(words.prefix[k] for k in _PREFIXES)]
    features = [(h[once] & np.uint64(_SIZE - 1)).astype(np.int32) + i * _SIZE for i, h in enumerate(hashes)]
    begin = np.flatnonzero(_changes(number[once]))
    return Sentences(words.doc[first], begin, words.start[first], words.end[last] if len(first) else last, features), words


def _changes(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _logits(weights: np.ndarray, bias: float, s: Sentences) -> np.ndarray:
    if not len(s.first):
        return np.zeros(0)
    total = weights[s.features[0]].astype(np.float64)
    for f in s.features[1:]:
        total += weights[f]
    return np.add.reduceat(total, s.first) + bias


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit(texts: list[str | None], labels: np.ndarray, importance: np.ndarray) -> Model:
    """Full-batch Adam on the noisy-or likelihood. Without both labels nothing is learned and every score is near 0."""
    s, _ = sentences_of(texts)
    weights, bias = np.zeros(_SIZE * 3, np.float32), _START
    if not len(s.first) or labels.min(initial=1) == labels.max(initial=0):
        return Model(weights, -30.0)
    n_words = np.diff(np.append(s.first, len(s.features[0])))
    importance = importance / importance.sum()
    m, v, mb, vb = np.zeros(_SIZE * 3), np.zeros(_SIZE * 3), 0.0, 0.0
    for epoch in range(1, _EPOCHS + 1):
        z = _logits(weights, bias, s)
        amount = np.maximum(np.bincount(s.doc, _softplus(z), minlength=len(texts)), 1e-9)
        slope = importance * np.where(labels == 1, -1 / np.expm1(np.minimum(amount, 50)), 1.0)
        by_sentence = slope[s.doc] * _sigmoid(z)
        by_word = np.repeat(by_sentence, n_words)
        grad = sum(np.bincount(f, by_word, minlength=_SIZE * 3) for f in s.features) + _DECAY * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * by_sentence.sum(), 0.99 * vb + 0.01 * by_sentence.sum() ** 2
        rate = _RATE * np.sqrt(1 - 0.99**epoch) / (1 - 0.9**epoch)
        weights -= (rate * m / (np.sqrt(v) + _SLOW)).astype(np.float32)
        bias -= rate * mb / (np.sqrt(vb) + 1e-8)
    return Model(weights, float(bias))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels, importance = [], [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        labels += batch.column("toxic").to_pylist()
        importance += batch.column("importance").to_pylist()
    # Tasks may deliver rows in any order; sums of floats must not depend on it.
    order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i] or ""))
    model = fit([texts[i] for i in order], np.array([labels[i] for i in order], int), np.array([importance[i] for i in order], float))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])


def _remainder(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from a sample of at most about SAMPLE_ROWS rows of each label outside the held-out fold, in one task."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(_remainder(F.col("doc_id")) != 0)
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {c: min(1.0, SAMPLE_ROWS / n) for c, n in counts.items()}
    least = F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < least * 1_000_000).withColumn("importance", 1 / least)
    # At most about 2 * SAMPLE_ROWS rows of three numbers.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "importance")
    row = sample.repartition(1).mapInArrow(_trained, "weights binary, bias double").collect()
    if not row:
        return Model(np.zeros(_SIZE * 3, np.float32), -30.0)
    return Model(np.frombuffer(row[0]["weights"], np.float32), row[0]["bias"])


def score_texts(texts: list[str | None], model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Probability of each text; its sentences with a probability of one half or more, as code points.

    A text that reaches one half by weaker sentences alone has the first of its best ones.
    """
    s, words = sentences_of(texts)
    z = _logits(model.weights, model.bias, s)
    amount = np.bincount(s.doc, _softplus(z), minlength=len(texts))
    value = -np.expm1(-amount)
    shown = z >= 0
    bare = (value >= 0.5) & (np.bincount(s.doc[shown], minlength=len(texts)) == 0)
    order = np.lexsort((-z, s.doc))
    best = order[_changes(s.doc[order])]
    shown[best[bare[s.doc[best]]]] = True
    found: list[list[dict]] = [[] for _ in texts]
    for i in np.flatnonzero(shown):
        d = s.doc[i]
        start = len(words.data[words.offset[d] : s.start[i]].tobytes().decode("utf-8", "replace"))
        size = len(words.data[s.start[i] : s.end[i]].tobytes().decode("utf-8", "replace"))
        found[d].append({"start": start, "end": start + size, "score": float(_sigmoid(z[i]))})
    return value, found


_SENTENCES = "sentences array<struct<start: long, end: long, score: double>>"
_SENTENCE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, sentences), one row per input row.

    Only the text is scored, whole. A NULL or empty text, or one without words, scores 0. `sentences` are those with a
    probability of one half or more, or the best one of a text that scores so without any, from their first to their last
    word in code points. held_out is false where doc_id is NULL. Equal texts score alike. Other columns are not read; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                value, found = score_texts(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(value), pa.array(found, _SENTENCE)], names=["doc_id", "score", "sentences"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, f"doc_id long, score double, {_SENTENCES}")
    return rows.select(
        "doc_id", F.coalesce(_remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences",
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that score below one half, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                value, _ = score_texts(part.column("text").to_pylist(), shared.value)
                yield part.filter(pa.array(value < 0.5))

    return docs.mapInArrow(clean, docs.schema)
