"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its words' character n-grams, hashed into a table; a
linear layer and a softmax give the languages.  Both are trained by stochastic gradient descent on a
bounded sample.  A temperature, fitted on sampled texts that the training did not use, calibrates
the probabilities, and the threshold of rejection is the score that 99 % of those texts reach.

The average and the linear layer commute, so scoring needs one row of sums per distinct word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, char_grams, class_sample, crc32_of_id, pieces_of, small_batches, sums_by, texts_of

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 800  # texts learned from
SAMPLE_WORDS = 192_000  # words of all texts of a language; fewer texts are drawn if theirs are more
BUCKETS, DIMENSIONS = 1 << 16, 16
GRAMS = (1, 2, 3, 4)
EPOCHS, STEPS, RATE, SEED = 4, 15_000, 0.5, 11  # passes over the sample, and least steps
REJECTED = 0.01

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def subwords(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the words in units, and the words themselves; second, the unit of each."""
    words, owner = [], []
    for i, unit in enumerate(units):
        lowered = unit.lower()
        for word in [lowered] if lowered.isalpha() and lowered.isascii() else _WORD.findall(lowered):
            words.append(f"<{word}>")
            owner.append(i)
    ids, of = char_grams(words, GRAMS, BUCKETS)
    whole = np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words), np.int64, len(words))
    of, ids = np.concatenate([of, np.arange(len(words))]), np.concatenate([ids, whole])
    order = np.argsort(of, kind="stable")
    return ids[order], np.array(owner, np.int64)[of[order]]


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def word_rows(self, units: list[str]) -> np.ndarray:
        """Per unit: the sum of its subwords' logits, and their number."""
        ids, owner = subwords(units)
        sums = sums_by(owner, self.embedding[ids], len(units))
        return np.column_stack([sums @ self.weights, np.bincount(owner, minlength=len(units))])

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """Calibrated probabilities from summed word rows; even where nothing was counted."""
        logits = (sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str]) -> Model:
    """Fit on texts; every fifth is kept back for calibration."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(SEED)
    model = Model(
        languages,
        (rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS,
        np.zeros((DIMENSIONS, len(languages))),
        np.zeros(len(languages)),
    )
    examples, kept_back = [], []
    for n, (text, label) in enumerate(zip(texts, labels, strict=True)):
        units, y = text.split(), languages.index(label)
        if n % 5 == 4:
            kept_back.append((text, y))
            continue
        start = 0
        while start < len(units):  # parts of several sizes, as texts come short and long
            size = int(rng.choice((4, 12, 60, 200)))
            ids, _ = subwords(units[start : start + size])
            start += size
            if len(ids):
                unique, count = np.unique(ids, return_counts=True)
                examples.append((unique, (count / len(ids))[:, None], y))
    epochs = max(EPOCHS, -(-STEPS // max(1, len(examples))))
    steps, done = epochs * len(examples), 0
    e, w, b = model.embedding, model.weights, model.bias
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ids, share, y = examples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            x = (share * e[ids]).sum(axis=0)
            logits = x @ w + b
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = w @ p
            w -= rate * np.outer(x, p)
            b -= rate * p
            e[ids] -= rate * share * back
    if kept_back:
        _calibrate(model, kept_back)
    return model


def _calibrate(model: Model, kept_back: list[tuple[str, int]]) -> None:
    sums = np.array([model.word_rows(t.split() or [""]).sum(axis=0) for t, _ in kept_back])
    truth = np.array([y for _, y in kept_back])
    has = sums[:, -1] > 0
    if not has.any():
        return
    sums, truth = sums[has], truth[has]

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(model.probabilities(sums)[np.arange(len(truth)), truth] + 1e-12).mean()

    model.temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    model.threshold = float(np.quantile(model.probabilities(sums).max(axis=1), REJECTED))


def held_out(docs: DataFrame) -> F.Column:
    return crc32_of_id(docs["doc_id"]) % 5 == 0


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Train on whole texts: a bounded sample of rows with text and language that are not held out."""
    known = docs.where(~held_out(docs)).where("text is not null and lang is not null")
    rows = class_sample(known.select("doc_id", "lang", "text"), "lang", "text", per_language, SAMPLE_WORDS, "language")
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Language of every text: ``doc_id, held_out, lang_pred, score, rejected``.

    ``lang_pred`` is the likeliest learned language, ``und`` with score 0 for a text without letters,
    for null, and where nothing could be learned.  ``rejected`` says that the calibrated score is
    below the model's threshold.  Texts are read whole; repeated rows and equal or null ids are kept
    apart; other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    small_batches(docs.sparkSession)
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = WordTable(own.word_rows)
        for batch in pieces_of(batches, "text", 4 << 20):
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            units: list[str] = []
            sizes = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(texts_of(batch, "text")):
                cut = text.split()
                sizes[i] = len(cut)
                units.extend(cut)
            has = np.flatnonzero(sizes)
            if len(has) and own.languages:
                rows = table.lookup(units)
                sums = np.add.reduceat(table.rows[rows], (np.cumsum(sizes) - sizes)[has], axis=0)
                p = own.probabilities(sums)
                for i, s, best, top in zip(has, sums[:, -1], p.argmax(axis=1), p.max(axis=1), strict=True):
                    if s:
                        names[i], scores[i] = own.languages[best], top
            rejected = pa.array((scores < own.threshold) | (np.array(names) == UNKNOWN))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(scores), rejected],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    inputs = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return inputs.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
