from __future__ import annotations

import zlib

import numpy as np

from tradeloom.llm import language
from tradeloom.llm.common import class_sample

from .helpers import frame

WORDS = {
    "en": "the and of house water walking think there where bright morning light",
    "de": "der und ein haus wasser gehen denken schön straße morgen licht größe",
    "fr": "le et une maison eau marcher penser où très matin lumière été",
}


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        out.append((" ".join(rng.choice(WORDS[lang].split(), 3 + i % 40)), lang))
    return out


def test_gradient_training_learns_languages():
    known = texts(300)
    model = language.train([t for t, _ in known], [lang for _, lang in known])
    sums = np.array([model.word_rows(t.split()).sum(axis=0) for t, _ in texts(200, 1)])
    guessed = [model.languages[i] for i in model.probabilities(sums).argmax(axis=1)]
    assert np.mean([g == lang for g, (_, lang) in zip(guessed, texts(200, 1), strict=True)]) > 0.95
    assert np.allclose(model.probabilities(sums).sum(axis=1), 1)


def test_average_commutes_with_the_linear_layer():
    known = texts(60)
    model = language.train([t for t, _ in known], [lang for _, lang in known])
    ids, _ = language.subwords(known[7][0].split())
    direct = model.embedding[ids].mean(axis=0) @ model.weights
    sums = model.word_rows(known[7][0].split()).sum(axis=0)
    assert np.allclose(direct, sums[:-1] / sums[-1])


def test_odd_texts(spark):
    known = texts(200)
    odd = [None, "", "123 456 !!", "é", "der " * 60_000, "日本語", "Straße", "Straße"]
    docs = frame(spark, [t for t, _ in known] + odd, lang=[lang for _, lang in known] + [None] * len(odd))
    got = {r.doc_id: r for r in language.predict(docs).collect()}
    assert [got[200 + i].lang_pred for i in range(3)] == ["und"] * 3 and got[202].score == 0
    assert got[204].lang_pred == got[206].lang_pred == got[207].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_nothing_to_learn(spark):
    assert language.predict(frame(spark, [])).count() == 0
    assert [r.lang_pred for r in language.predict(frame(spark, ["a b"])).collect()] == ["und"]


def test_labels_are_not_inputs(spark):
    known = texts(120)
    right = frame(spark, [t for t, _ in known], lang=[lang for _, lang in known])
    model = language.fit(right)
    wrong = frame(spark, [t for t, _ in known], lang=["xx"] * len(known), source=["s"] * len(known))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.predict(d, model).collect()} for d in (right, wrong))
    assert a == b


def test_held_out_accuracy(spark, tiny):
    from tradeloom.llm.queries import op2_language

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    held = [r for r in op2_language(spark, tiny).collect() if r.held_out]
    assert len(held) > 20
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.9


def test_whole_texts_are_learned_from(spark, monkeypatch):
    """A language that shows only at the end of long texts is learned; equal rows are drawn once."""
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, labels: seen.append((texts, labels)))
    long = "1 " * 5000 + "der und ein haus"
    language.fit(frame(spark, [long] + ["the and of"] * 3000, lang=["de"] + ["en"] * 3000, ids=[1] + [2] * 3000))
    texts, labels = seen[0]
    assert sorted(zip(labels, texts, strict=True)) == [("de", long), ("en", "the and of")]
    language.fit(frame(spark, [f"w{i} the" for i in range(900)], lang=["en"] * 900), per_language=50)
    assert len(seen[1][0]) == 50
    monkeypatch.setattr(language, "SAMPLE_WORDS", 60)
    language.fit(frame(spark, [f"w{i} the" for i in range(900)], lang=["en"] * 900))
    assert len(seen[2][0]) == 30


def test_the_sample_shuffles_no_texts_that_it_does_not_draw(spark, monkeypatch):
    """Class sizes reach the rows by broadcast, also where nothing is known about table sizes."""
    docs = frame(spark, ["a b"] * 9 + ["c"] * 9, lang=["x"] * 9 + ["y"] * 9)
    plans, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: (plans.append(df._jdf.queryExecution().sparkPlan().toString()), collect(df))[1])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = class_sample(docs, "lang", "text", 2, 100, "s")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(rows) == 4
    assert "SortMergeJoin" not in plans[-1] and "BroadcastHashJoin" in plans[-1]
