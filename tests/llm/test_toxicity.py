from __future__ import annotations

import zlib

import numpy as np
import pytest

from tradeloom.llm import toxicity

from .helpers import frame

BAD = ["grobble", "snarkle", "vilefex"]


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    out = []
    for i in range(n):
        words = list(rng.choice(vocabulary, rng.integers(5, 150)))
        label = int(i % 3 == 0)
        if label:
            for _ in range(3):
                words[rng.integers(len(words))] = rng.choice(BAD) + rng.choice(["", ",", "s"])
        out.append((" ".join(words), label))
    return out


def scores(network, cut):
    sizes = np.array([len(c) for c in cut])
    words = list(dict.fromkeys(["", *(u for c in cut for u in c)]))
    rows = np.array([words.index(u) for c in cut for u in c])
    numbers, mask, text = toxicity.windows_of(rows, sizes)
    return toxicity.worst(network.scores(network.projected(words), numbers, mask), text, len(cut))[0]


def test_training_learns():
    known, new = texts(300), texts(150, 0)[90:]
    network = toxicity.train([t for t, _ in known], [y for _, y in known])
    top = scores(network, [t.split() for t, _ in new])
    truth = np.array([y for _, y in new])
    assert top[truth == 1].mean() > top[truth == 0].mean()
    p = toxicity.sigmoid(network.slope * top + network.shift)
    assert ((p >= 0.5) == truth).mean() > 0.9


def test_gradients_equal_differences():
    network, f = toxicity.Network.new(), toxicity.Features.of(["", "ab", "cd", "efg", "x"])
    windows = np.array([[1, 2, 3, 0], [4, 1, 0, 0], [2, 2, 4, 1]])
    mask = np.array([[1, 1, 1, 0], [1, 1, 0, 0], [1, 1, 1, 1]], np.float32)
    labels, weights = np.array([1, 0, 1]), np.ones(3)
    p = network.parameters
    for k in p:
        p[k] = p[k].astype(np.float64)

    def loss():
        z = network.run(toxicity.network_rows(network, f), windows, mask)[0]
        return np.mean(np.log1p(np.exp(-z * (2 * labels - 1))))

    before = {k: v.copy() for k, v in p.items()}
    network.learn(f, windows, mask, labels, weights)
    gradients = {k: m / 0.1 for k, (m, _) in network.state.items()}
    p.update({k: v.astype(np.float64) for k, v in before.items()})
    rng = np.random.default_rng(0)
    for name, gradient in gradients.items():
        flat = np.flatnonzero(np.abs(gradient).ravel() > 1e-5)
        for i in rng.choice(flat, min(4, len(flat)), replace=False):
            old = p[name].ravel()[i]
            values = []
            for step in (1e-4, -1e-4):
                p[name].ravel()[i] = old + step
                values.append(loss())
            p[name].ravel()[i] = old
            assert (values[0] - values[1]) / 2e-4 == pytest.approx(gradient.ravel()[i], rel=0.05, abs=2e-4), name


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 47, 48, 49, 84, 85, 500])
    rows = np.arange(1, sizes.sum() + 1)
    numbers, mask, text = toxicity.windows_of(rows, sizes)
    starts = np.cumsum(sizes) - sizes
    for i, n in enumerate(sizes):
        seen = set(numbers[text == i][mask[text == i] > 0])
        assert seen == set(range(starts[i] + 1, starts[i] + n + 1))
    assert (text == 7).sum() == 14


def labelled(spark, n):
    known = texts(n)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(known)], "doc_id long, toxic int")
    return known, labels


def test_odd_texts(spark):
    known, labels = labelled(spark, 240)
    odd = [None, "", " ", "grobble " * 30_000, "a" * 10_000, "same text", "same text"]
    got = {r.doc_id: r for r in toxicity.score(frame(spark, [t for t, _ in known] + odd), labels).collect()}
    assert len(got) == 247 and got[240].score == got[241].score == got[242].score
    assert got[245].score == got[246].score and got[243].predicted == 1 and got[240].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())


def test_nothing_to_learn(spark):
    _, labels = labelled(spark, 30)
    assert toxicity.score(frame(spark, []), labels).count() == 0
    none = labels.where("false")
    assert len({r.score for r in toxicity.score(frame(spark, ["a", "b c", None]), none).collect()}) == 1
    one = labels.where("toxic = 0")
    assert {r.predicted for r in toxicity.score(frame(spark, ["a"] * 30), one).collect()} == {0}


def test_held_out_accuracy(spark):
    known, labels = labelled(spark, 600)
    got = toxicity.score(frame(spark, [t for t, _ in known]), labels).collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == known[r.doc_id][1] for r in held]) > 0.9


def test_whole_table(spark, tiny):
    from tradeloom.llm.queries import op8_toxicity

    assert op8_toxicity(spark, tiny).count() == spark.read.parquet(f"{tiny}/documents.parquet").count()


def test_training_reads_whole_texts(spark, monkeypatch):
    """A toxic passage after word 800 and clean long texts: both reach the training as they are."""
    clean = " ".join(f"w{i % 50}" for i in range(2000))
    known = [(f"{clean} grobble{i}" if i % 2 else f"{clean} fine{i}", i % 2) for i in range(60)]
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, odds=1.0: seen.append((texts, labels)) or toxicity.Network.new())
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(known)], "doc_id long, toxic int")
    docs = frame(spark, [t for t, _ in known])
    toxicity.fit(docs, labels)
    texts, truth = seen.pop()
    assert sorted(texts) == sorted(t for i, (t, _) in enumerate(known) if zlib.crc32(str(i).encode()) % 3 != 1)
    assert all(("grobble" in t) == bool(y) for t, y in zip(texts, truth, strict=True))
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 10_100)
    toxicity.fit(docs, labels)
    assert sorted(seen.pop()[1]) == [0] * 5 + [1] * 5
