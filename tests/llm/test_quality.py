from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tradeloom.llm import quality

from .helpers import frame


def features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": sum(c.isupper() for c in text),
    }


def base_failed(f):
    return f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]


def kept(f):
    return not (
        base_failed(f) or 10 * f["n_symbols"] > f["n_words"] or 100 * f["n_dup_lines"] > 50 * f["n_lines"]
        or not 2 * f["n_words"] <= f["word_chars"] <= 20 * f["n_words"] or 100 * f["n_upper"] > 50 * f["word_chars"]
    )


def texts():
    rng = random.Random(3)
    vocabulary = [["a", "b", "c"], [f"w{i}" for i in range(300)], ["Über", "|", "##", "NOISE"], ["x" * 30]]
    out = []
    for _ in range(400):
        chosen = rng.choice(vocabulary) + rng.choice(vocabulary)
        cut = [rng.choice(chosen) + rng.choice([" ", " ", "\n", "\t ", "\x0b", "\x0c", "\xa0"]) for _ in range(rng.randrange(200))]
        out.append("".join(cut))
    lines = [" ".join(rng.choice(vocabulary[1]) for _ in range(12)) for _ in range(9)]
    return out + [None, "", " \n\t", "one two three", "a b c a b c", "same " * 40_000, "\n".join(lines * 2), "\n".join(lines), "\n".join(lines)]


def test_features_and_verdict_equal_brute_force(spark):
    every = texts()
    got = {r.doc_id: r for r in quality.judge(frame(spark, every)).collect()}
    for i, text in enumerate(every):
        f = features(text)
        assert {k: got[i][k] for k in f} == f, repr(text)
        assert (got[i].base_failed, got[i].kept) == (base_failed(f), kept(f))


def test_rules_behind_the_base_verdict_run_for_texts_that_reach_them(spark):
    """A rule that fails when it is run does so only behind the base verdict and behind earlier rules.

    The verdict is the same with all features as columns and with none.
    """
    docs = frame(spark, [None, "few words", "# " + " ".join(f"w{i}" for i in range(99)) + " #" * 20, "same " * 200])
    stops = quality.Rule("stops", "raise_error('reached') is null")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "order_rules", lambda docs, rules, **_: list(rules))
        got = quality.judge(docs, [quality.MORE[0], stops]).collect()
        assert [r.kept for r in got] == [False] * 4
        with pytest.raises(Exception, match="reached"):
            quality.judge(docs, [stops]).collect()
    every = frame(spark, texts())
    few = quality.judge(every, features=())
    assert few.columns == ["doc_id", "base_failed", "kept"]
    assert sorted(few.collect()) == sorted(quality.judge(every).select(few.columns).collect())


def test_order_counts_what_earlier_rules_left(spark, monkeypatch):
    """Texts that the base rules reject and features computed before do not weigh in the order."""
    long = " ".join(f"w{i}" for i in range(60))
    symbols = [f"{long} {'#' * 30} {n}" for n in range(120)]
    docs = frame(spark, [f"X{n}" for n in range(400)] + symbols + [f"{long} {long.upper()} {n}" for n in range(30)])
    ticks = iter(range(10_000))
    monkeypatch.setattr(quality.time, "perf_counter", lambda: next(ticks))
    rules = [quality.Rule("upper", "{n_upper} > 0"), quality.Rule("symbols", "{n_symbols} > 0")]
    assert [r.name for r in quality.order_rules(docs, rules)] == ["upper", "symbols"]
    assert [r.name for r in quality.order_rules(docs, rules, after=quality.BASE, known=tuple(quality.FEATURES)[:-1])] == ["symbols", "upper"]
    assert quality.order_rules(frame(spark, ["X"]), rules, after=quality.BASE) == rules


def test_kept_rows_do_not_depend_on_the_order(spark):
    every = texts()
    docs = frame(spark, every)
    want = [i for i, t in enumerate(every) if kept(features(t))]
    for rules in (quality.RULES, quality.RULES[::-1]):
        rows = quality.keep(docs, rules)
        assert rows.columns == docs.columns
        assert sorted(r.doc_id for r in rows.collect()) == want


def test_order_by_rejection_per_cost(spark, monkeypatch):
    """With equal costs the rule that rejects more is first, and a covered one last."""
    docs = frame(spark, ["a"] * 30 + ["b b"] * 20 + ["c c c"] * 60)
    ticks = iter(range(10_000))
    monkeypatch.setattr(quality.time, "perf_counter", lambda: next(ticks))
    rules = [quality.Rule("small", "{n_words} < 2"), quality.Rule("covered", "text = 'a'"), quality.Rule("large", "{n_words} > 2")]
    assert [r.name for r in quality.order_rules(docs, rules, 1000)][0] == "large"
    assert quality.order_rules(frame(spark, []), rules) == rules


def test_first_rule_that_holds_is_named(spark):
    docs = frame(spark, ["a b", "| | |", None])
    rules = [quality.Rule("few", "{n_words} < 1"), quality.Rule("symbols", "{n_symbols} > 2")]
    named = quality.cut(docs).select("doc.doc_id", quality.cascade(rules, quality.FEATURES).alias("why")).collect()
    assert {r.doc_id: r.why for r in named} == {0: None, 1: "symbols", 2: "few"}
    assert docs.select(quality.cascade([], {}).alias("w")).where("w is null").count() == 3


def test_odd_tables(spark):
    """Null ids, repeated rows, clashing names and empty tables have a defined result."""
    good = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, words string, lines int, doc string, pieces long, kept string, n_words int"
    values = [(None, good), (None, None), (7, good), (7, good), (8, "")]
    docs = spark.createDataFrame([(i, t, None, 1, "d", 2, "k", 3) for i, t in values], schema)
    got = sorted((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in quality.judge(docs).collect())
    assert got == [(-1, 0, True, False), (-1, 60, False, True), (7, 60, False, True), (7, 60, False, True), (8, 0, True, False)]
    kept_rows = quality.keep(docs)
    assert kept_rows.columns == docs.columns
    assert sorted((r.doc_id or -1, r.words, r.lines, r.kept) for r in kept_rows.collect()) == [(-1, None, 1, "k"), (7, None, 1, "k"), (7, None, 1, "k")]
    none = docs.where("false")
    assert quality.judge(none).collect() == [] and quality.keep(none).collect() == []
    assert quality.judge(none).columns == quality.judge(docs).columns
    nulls = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert [(r.base_failed, r.kept) for r in quality.judge(nulls).collect()] == [(True, False)] * 2
