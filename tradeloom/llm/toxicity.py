"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

A word enters as a hashed word embedding and the mean of its hashed character n-gram embeddings.
Two gated recurrent layers read a window in both directions, attention pools their states and a
linear layer scores the window.  A text scores as its worst window; all overlapping windows of the
whole text are scored.  Labels belong to texts, so training alternates: the current network picks
the window of each text that it finds worst, and that window learns the text's label.  A logistic
curve, fitted on sampled texts that the training did not use, turns scores into probabilities.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import WordTable, char_grams, crc32_of_id, hash_sample, pieces_of, small_batches, sums_by, texts_of

WINDOW, STRIDE = 48, 36
WORD_BUCKETS, CHAR_BUCKETS, WIDTH, HIDDEN = 1 << 14, 1 << 15, 8, 8
GRAMS = (3, 4, 5)
SAMPLE_PER_LABEL = 900  # texts learned from, at most
SAMPLE_WORDS = 720_000  # words of all texts of a label; fewer texts are drawn if theirs are more
ROUNDS, BATCH, RATE, SEED = 6, 64, 0.01, 5
PREDICTED_FROM = 0.7

_LETTERS = regex.compile(r"[^\p{L}\p{M}\p{N}]+")


def plain(unit: str) -> str:
    """Letters, marks and digits of a unit, in lower case."""
    lowered = unit.lower()
    return lowered if lowered.isalpha() else _LETTERS.sub("", lowered)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Features:
    """Distinct words of a sample, with their buckets; entry 0 is no word."""

    place: dict[str, int]
    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, units: list[str]) -> Features:
        words = [plain(u) for u in units]
        buckets = [1 + zlib.crc32(w.encode()) % (WORD_BUCKETS - 1) if w else 0 for w in words]
        gram, owner = char_grams([f"<{w or u}>" for w, u in zip(words, units, strict=True)], GRAMS, CHAR_BUCKETS)
        share = 1 / np.sqrt(np.bincount(owner, minlength=len(units))[owner])
        return cls({u: i for i, u in enumerate(units)}, np.array(buckets, np.int64), gram, owner, share.astype(np.float32))


@dataclass
class Network:
    parameters: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    state: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @classmethod
    def new(cls) -> Network:
        rng = np.random.default_rng(SEED)

        def draw(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": draw(WORD_BUCKETS, WIDTH), "char": draw(CHAR_BUCKETS, WIDTH), "attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for d in ("f", "b"):
            p |= {f"x{d}": draw(2 * WIDTH, 3 * HIDDEN), f"h{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        return cls(p)

    def inputs(self, f: Features) -> np.ndarray:
        p = self.parameters
        chars = sums_by(f.owner, p["char"][f.gram] * f.share[:, None], len(f.word))
        return np.concatenate([p["word"][f.word], chars], axis=1)

    def projected(self, words: list[str]) -> np.ndarray:
        """Rows of a word table: what a word adds to the gates, forwards and backwards."""
        x = self.inputs(Features.of(words))
        p = self.parameters
        return np.concatenate([x @ p["xf"] + p["cf"], x @ p["xb"] + p["cb"]], axis=1)

    def run(self, rows: np.ndarray, windows: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of windows of row numbers, and what the backward pass needs."""
        p, n, steps = self.parameters, len(windows), windows.shape[1]
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        gates = {}
        for d, lo, order in (("f", 0, range(steps)), ("b", 3 * HIDDEN, range(steps - 1, -1, -1))):
            h, u = np.zeros((n, HIDDEN), np.float32), p[f"h{d}"]
            side = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in order:
                x = rows[windows[:, t], lo : lo + 3 * HIDDEN]
                a = h @ u
                zr = sigmoid(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
                keep = mask[:, t, None]
                new = h + keep * (1 - z) * (c - h)
                gates[d, t] = (h, z, r, c, a[:, 2 * HIDDEN :])
                h = new
                states[t, :, side] = h
        score = states @ p["attend"] + (mask.T - 1) * 1e4
        weight = np.exp(score - score.max(axis=0))
        weight *= mask.T
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        return pooled @ p["out"] + p["bias"][0], {"states": states, "gates": gates, "weight": weight, "pooled": pooled}

    def scores(self, rows: np.ndarray, windows: np.ndarray, mask: np.ndarray, chunk: int = 4096) -> np.ndarray:
        return np.concatenate([self.run(rows, windows[i : i + chunk], mask[i : i + chunk])[0] for i in range(0, len(windows), chunk)])

    def learn(self, f: Features, windows: np.ndarray, mask: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """One step of gradient descent (Adam) on the logistic loss of windows."""
        p = self.parameters
        x = self.inputs(f)
        rows = np.concatenate([x @ p["xf"] + p["cf"], x @ p["xb"] + p["cb"]], axis=1)
        out, kept = self.run(rows, windows, mask)
        delta = ((sigmoid(out) - labels) * weights / len(labels)).astype(np.float32)
        g = {"out": kept["pooled"].T @ delta, "bias": np.array([delta.sum()], np.float32)}
        pooled = delta[:, None] * p["out"]
        states, weight = kept["states"], kept["weight"]
        inner = (states * pooled).sum(axis=2)
        score = weight * (inner - (weight * inner).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", score, states)
        back = weight[:, :, None] * pooled + score[:, :, None] * p["attend"]
        rows_back = np.zeros_like(rows)
        steps = windows.shape[1]
        for d, lo, order in (("f", 0, range(steps - 1, -1, -1)), ("b", 3 * HIDDEN, range(steps))):
            u, side = p[f"h{d}"], slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            dh, du = np.zeros((len(windows), HIDDEN), np.float32), np.zeros_like(u)
            for t in order:
                h, z, r, c, a = kept["gates"][d, t]
                dh = dh + back[t, :, side]
                keep = mask[:, t, None]
                dc = dh * keep * (1 - z) * (1 - c * c)
                dz = dh * keep * (h - c) * z * (1 - z)
                dr = dc * a * r * (1 - r)
                through = np.concatenate([dz, dr, dc * r], axis=1)
                np.add.at(rows_back[:, lo : lo + 3 * HIDDEN], windows[:, t], np.concatenate([dz, dr, dc], axis=1))
                du += h.T @ through
                dh = dh * (1 - keep * (1 - z)) + through @ u.T
            side_rows = rows_back[:, lo : lo + 3 * HIDDEN]
            g |= {f"h{d}": du, f"x{d}": x.T @ side_rows, f"c{d}": side_rows.sum(axis=0)}
        dx = rows_back[:, : 3 * HIDDEN] @ p["xf"].T + rows_back[:, 3 * HIDDEN :] @ p["xb"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], f.word, dx[:, :WIDTH])
        np.add.at(g["char"], f.gram, dx[f.owner, WIDTH:] * f.share[:, None])
        for name, grad in g.items():
            m, v = self.state.get(name, (np.zeros_like(grad), np.zeros_like(grad)))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            self.state[name] = (m, v)
            p[name] = (p[name] - RATE * m / (np.sqrt(v) + 1e-6)).astype(np.float32)


def windows_of(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of texts laid end to end: row numbers, mask and the text of each window."""
    starts = np.cumsum(sizes) - sizes
    count = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = nth[:, None] * STRIDE + np.arange(WINDOW)
    inside = at < sizes[text][:, None]
    padded = np.append(rows, 0)
    numbers = padded[np.where(inside, starts[text][:, None] + at, len(rows))]
    return numbers, inside.astype(np.float32), text


def worst(scores: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest score of each text and its window."""
    order = np.lexsort((-scores, text))
    first = order[np.searchsorted(text[order], np.arange(n))]
    return scores[first], first


def train(texts: list[str], labels: list[int], odds: float = 1.0) -> Network:
    """Fit on texts with labels 0 and 1; every fifth is kept back for the logistic curve.

    ``odds`` is how much rarer label 1 is in the sample than among all rows, as a ratio of odds; the
    curve is shifted by it.
    """
    network = Network.new()
    if len(set(labels)) < 2:
        network.parameters["out"][:] = 0
        network.parameters["bias"][:] = 3.0 if set(labels) == {1} else -3.0
        return network
    rng = np.random.default_rng(SEED)
    units = [t.split() for t in texts]
    f = Features.of(list(dict.fromkeys(["", *(u for cut in units for u in cut)])))
    rows = np.array([f.place[u] for cut in units for u in cut], np.int64)
    sizes, truth = np.array([len(u) for u in units]), np.array(labels)
    numbers, mask, text = windows_of(rows, sizes)
    learned = np.arange(len(texts)) % 5 != 4
    for step in range(ROUNDS):
        if step == 0:  # any window of a text
            chosen = np.array([rng.choice(np.flatnonzero(text == i)) for i in np.flatnonzero(learned)])
        else:  # the worst window of each text, and one more of the clean ones
            _, first = worst(network.scores(network_rows(network, f), numbers, mask), text, len(texts))
            clean = np.flatnonzero(learned & (truth == 0))
            more = np.array([rng.choice(np.flatnonzero(text == i)) for i in clean])
            chosen = np.concatenate([first[learned], more])
        share = truth[text[chosen]].mean()
        weights = np.where(truth[text] == 1, 0.5 / max(share, 0.05), 0.5 / max(1 - share, 0.05))
        order = rng.permutation(np.concatenate([chosen, chosen]))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            used, local = np.unique(numbers[part], return_inverse=True)
            network.learn(_subset(f, used), local.reshape(numbers[part].shape), mask[part], truth[text[part]], weights[part])
    top, _ = worst(network.scores(network_rows(network, f), numbers, mask), text, len(texts))
    network.slope, network.shift = _logistic(top[~learned], truth[~learned])
    network.shift += math.log(odds)
    network.state = {}
    return network


def network_rows(network: Network, f: Features) -> np.ndarray:
    x, p = network.inputs(f), network.parameters
    return np.concatenate([x @ p["xf"] + p["cf"], x @ p["xb"] + p["cb"]], axis=1)


def _subset(f: Features, used: np.ndarray) -> Features:
    inside = np.isin(f.owner, used)
    owner = np.searchsorted(used, f.owner[inside])
    return Features({}, f.word[used], f.gram[inside], owner, f.share[inside])


def _logistic(scores: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability; softened targets keep a perfect split finite."""
    good, bad = (truth == 1).sum(), (truth == 0).sum()
    target = np.where(truth == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(500):
        p = sigmoid(slope * scores + shift)
        slope -= 0.3 * ((p - target) * scores).mean() / max(1.0, (scores**2).mean())
        shift -= 0.3 * (p - target).mean()
    return max(float(slope), 0.05), float(shift)


def held_out(docs: DataFrame) -> F.Column:
    return crc32_of_id(docs["doc_id"]) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Network:
    """Train on a bounded sample of labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic in (0, 1) and doc_id is not null")
    known = known.where(~held_out(known)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen, sizes = hash_sample(known, "doc_id", "toxic", per_label, "toxicity")
    if not chosen:
        return train([], [])
    spark = docs.sparkSession
    # At most about two samples' worth of rows, so they reach every task.
    wanted = F.broadcast(spark.createDataFrame([(r.doc_id, r.toxic) for r in chosen], "doc_id long, toxic int"))
    words = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    place = F.xxhash64(F.lit("toxic text"), "doc_id", "text")
    # Labels belong to whole texts, so texts are read whole; the bound of words decides how many.
    rows = stored(docs.where("text is not null").join(wanted, "doc_id").select("doc_id", "toxic", "text", words.alias("words"), place.alias("place")), "labelled")
    drawn = Window.partitionBy("toxic").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(drawn), F.lit(0))
    kept = rows.select("doc_id", "toxic", "place", "words").withColumn("before", before).where(F.col("before") + F.when(F.col("before") > 0, F.col("words")).otherwise(0) <= SAMPLE_WORDS)
    last = {r["toxic"]: r["last"] for r in kept.groupBy("toxic").agg(F.max("place").alias("last")).collect()}
    limit = F.lit(None).cast("long")
    for label, value in sorted(last.items()):
        limit = F.when(F.col("toxic") == label, F.lit(value)).otherwise(limit)
    texts = sorted(rows.where(F.col("place") <= limit).select("doc_id", "toxic", "text").collect(), key=lambda r: (r.doc_id, r.text))
    odds = 1.0
    if len(sizes) == 2:
        sampled = [sum(r["toxic"] == k for r in texts) + 0.5 for k in (0, 1)]
        odds = sizes[1] / sizes[0] * sampled[0] / sampled[1]
    return train([r["text"] for r in texts], [r["toxic"] for r in texts], odds)


def score(docs: DataFrame, labels: DataFrame, network: Network | None = None) -> DataFrame:
    """Toxicity of every text: ``doc_id, held_out, score, predicted``.

    Null and empty texts score as a window without words.  Without usable labels of both kinds all
    texts get one score.  Repeated rows and equal or null ids are kept apart; other columns are
    ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    network = network or fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = WordTable(own.projected, 150_000)
        for batch in pieces_of(batches, "text", 2 << 20):
            units: list[str] = []
            sizes = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(texts_of(batch, "text")):
                cut = text.split()
                sizes[i] = len(cut)
                units.extend(cut)
            numbers, mask, text_of = windows_of(table.lookup(units), sizes)
            top, _ = worst(own.scores(table.rows, numbers, mask), text_of, batch.num_rows)
            p = sigmoid(own.slope * top.astype(np.float64) + own.shift)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= PREDICTED_FROM).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    inputs = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return inputs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
