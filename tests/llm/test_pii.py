from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pytest

from tradeloom.llm import pii

from .helpers import frame

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def brute_force(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if holds(k, m[0]))


def with_luhn(rng, n):
    body = "".join(rng.choice(string.digits) for _ in range(n - 1))
    return next(body + d for d in string.digits if pii.luhn(body + d))


def random_text(rng):
    pieces = ["a", "b.c", "@", "x-y.z", ".", "+", "1", "25", "256", "192.168.", "10.0.0.1", " ", "-", "(", ")", "+1 (409) 555-8387",
              "é", "😀", "٣", "me@mail.example.com", with_luhn(rng, 16), with_luhn(rng, 19), "%", "\n"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))


def test_patterns_equal_brute_force():
    rng = random.Random(1)
    for _ in range(20_000):
        text = random_text(rng)
        assert pii.pattern_spans(text) == brute_force(text), text
    assert pii.pattern_spans("1" * 20_000 + ".1.1.1 " + "a" * 20_000 + "@" + "b" * 20_000) == []


def natural(rng, extra):
    words = ["thing", "over", "the", "wall", "2024", "in", "3.5", "no", "items"]
    cut = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
    for x in extra:
        cut.insert(rng.randrange(len(cut) + 1), x)
    return " ".join(cut)


def personal(rng):
    return [
        f"{rng.choice(['ann', 'bob.lee', 'x'])}{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
        ".".join(str(rng.randrange(256)) for _ in range(4)),
        with_luhn(rng, 16),
        f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
    ]


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(2)
    texts = [natural(rng, rng.sample(personal(rng), rng.randrange(4))) for _ in range(400)]
    return pii.train(texts, [pii.pattern_spans(t) for t in texts])


def test_gradients_equal_differences():
    tagger, rng = pii.Tagger.new(), np.random.default_rng(4)
    x = rng.integers(1, 30, (3, 7))
    mask = np.array([[1] * 7, [1] * 5 + [0] * 2, [1] * 7], float)
    tags = np.array([[0, 1, 2, 2, 0, 0, 0], [3, 4, 0, 0, 0, 0, 0], [0, 0, 0, 5, 6, 6, 6]])
    _, g = tagger.gradients(x, mask, tags)
    for name, gradient in g.items():
        flat = np.flatnonzero(np.abs(gradient).ravel() > 1e-6)
        for i in rng.choice(flat, min(5, len(flat)), replace=False):
            w = tagger.parameters[name].ravel()
            old, values = w[i], []
            for step in (1e-5, -1e-5):
                w[i] = old + step
                tagger.parameters[name] = w.reshape(gradient.shape)
                values.append(tagger.gradients(x, mask, tags)[0])
            w[i] = old
            tagger.parameters[name] = w.reshape(gradient.shape)
            assert (values[0] - values[1]) / 2e-5 == pytest.approx(gradient.ravel()[i], rel=1e-3, abs=1e-6), name


def test_decoding_equals_enumeration():
    tagger, rng = pii.Tagger.new(), np.random.default_rng(6)
    tagger.parameters["move"] = rng.standard_normal((pii.TAGS, pii.TAGS))
    x, mask = rng.integers(1, 30, (4, 4)), np.ones((4, 4))
    tags, _ = tagger.decode(x, mask)
    e, move = tagger.emissions(x, mask), tagger.parameters["move"] + pii.allowed()
    paths = np.array(list(np.ndindex(*(pii.TAGS,) * 4)))
    paths = paths[(paths[:, 0] == 0) | (paths[:, 0] % 2 == 1)]
    for k in range(4):
        score = e[k][np.arange(4), paths].sum(axis=1) + move[paths[:, :-1], paths[:, 1:]].sum(axis=1)
        assert (paths[score.argmax()] == tags[k]).all()


def test_network_finds_held_out_spans(tagger):
    rng = random.Random(99)
    texts = [natural(rng, personal(rng)) for _ in range(100)]
    want = got = right = 0
    for text in texts:
        points = pii.codes(text)
        x, mask, starts = pii.windows(points, np.array([m.start() for m in pii.TRIGGER.finditer(text)]))
        spans = {s for s, _ in pii.reconciled(len(text), starts, *tagger.decode(x, mask))}
        truth = set(pii.pattern_spans(text))
        want, got, right = want + len(truth), got + len(spans), right + len(spans & truth)
    assert right / want > 0.85 and right / got > 0.85


def test_skipped_windows_change_nothing(tagger):
    rng = random.Random(5)
    for _ in range(20):
        text = natural(rng, ["word"] * 300 + personal(rng) + ["word"] * 300)
        everything = pii.windows(pii.codes(text))
        near = pii.windows(pii.codes(text), np.array([m.start() for m in pii.TRIGGER.finditer(text)]))
        found = []
        for x, mask, starts in (everything, near):
            spans = pii.reconciled(len(text), starts, *tagger.decode(x, mask))
            found.append([s for s, trust in spans if trust >= pii.SURE and pii.plausible(s[1], text[s[0] : s[2]])])
        assert found[0] == found[1]


def test_clean_texts_and_base_spans_stay(spark, tagger):
    rng = random.Random(7)
    texts = [natural(rng, []) for _ in range(100)] + [random_text(rng) for _ in range(300)]
    texts += [None, "", "x " * 60_000 + "me@a.bc", "me@a.bc", "me@a.bc"]
    got = {r.doc_id: r for r in pii.detect(frame(spark, texts), tagger).collect()}
    for i, text in enumerate(texts):
        listed = pii.written(brute_force(text))
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(got[i].spans.split(",")) or not listed
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == n for _, k, _ in brute_force(text)) for n in range(4)]
    assert sum(got[i].spans != "" for i in range(100)) == 0


def test_redacted_rows(spark, tagger):
    docs = frame(spark, ["mail me@a.bc or +1 (409) 555-8387.", None, "clean", "é 10.0.0.1"])
    got = {r.doc_id: r for r in pii.redact(docs, tagger).collect()}
    assert [got[i].text for i in range(4)] == ["mail <EMAIL> or <PHONE>.", None, "clean", "é <IP>"]
    assert [got[i].n_chars for i in range(4)] == [24, None, 5, 6] and got[0].size == "s"
    assert pii.redacted_text("abcdef", [(1, 2, 4), (2, 3, 5)]) == "a<CARD>f"


def test_empty_table(spark):
    assert pii.detect(frame(spark, [])).count() == 0
    assert pii.redact(frame(spark, [])).count() == 0


def test_whole_table(spark, tiny):
    from tradeloom.llm.queries import op6_pii

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in op6_pii(spark, tiny).collect():
        listed = pii.written(brute_force(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert not listed or set(listed.split(",")) <= set(r.spans.split(","))


def test_network_finds_forms_that_the_patterns_miss(tagger):
    rng = random.Random(31)
    asked, hit = 0, 0
    for i in range(400):
        span = pii.varied(i % 4, rng)
        before, after = natural(rng, []), natural(rng, [])
        start = len(before) + 1
        base, every = pii.find([f"{before} {span} {after}"], tagger)[0]
        if not any(s < start + len(span) and start < e for s, _, e in base):
            asked += 1
            hit += (start, i % 4, start + len(span)) in every
    assert asked > 350 and hit / asked >= 0.8


def test_clean_numbers_are_left_alone(tagger):
    rng = random.Random(32)
    texts = [f"{natural(rng, [])} {pii.harmless(rng)} {natural(rng, [])}" for _ in range(300)]
    found = pii.find(texts, tagger)
    assert sum(every != base for base, every in found) <= 30


def test_marginals_equal_enumeration():
    tagger, rng = pii.Tagger.new(), np.random.default_rng(8)
    tagger.parameters["move"] = rng.standard_normal((pii.TAGS, pii.TAGS))
    x, mask = rng.integers(1, 30, (3, 4)), np.ones((3, 4))
    e, move = tagger.emissions(x, mask), tagger.parameters["move"] + pii.allowed()
    single = tagger.marginals(e, mask > 0)
    paths = np.array(list(np.ndindex(*(pii.TAGS,) * 4)))
    paths = paths[(paths[:, 0] == 0) | (paths[:, 0] % 2 == 1)]
    for k in range(3):
        weight = np.exp(e[k][np.arange(4), paths].sum(axis=1) + move[paths[:, :-1], paths[:, 1:]].sum(axis=1))
        for t in range(4):
            want = np.bincount(paths[:, t], weight, pii.TAGS) / weight.sum()
            assert np.allclose(single[k, t], want)


def test_added_spans_of_a_table(spark, tagger):
    """The query's spans are the patterns' and those of every window of the whole text."""
    rng = random.Random(41)
    texts = [natural(rng, [pii.varied(k, rng) for k in range(4)] + personal(rng)[:2]) for _ in range(60)]
    texts += [natural(rng, ["word"] * 30_000) + " call (409) 555-8387 now", "call (409) 555-8387 now", "call (409) 555-8387 now"]
    got = {r.doc_id: r.spans for r in pii.detect(frame(spark, texts), tagger).collect()}
    added = 0
    for i, text in enumerate(texts):
        base = pii.pattern_spans(text)
        every = list(base)
        x, mask, starts = pii.windows(pii.codes(text))
        for span, trust in pii.reconciled(len(text), starts, *tagger.decode(x, mask)):
            start, kind, end = pii.whole_tokens(text, span)
            if trust >= pii.SURE and pii.plausible(kind, text[start:end]) and not any(s < end and start < e for s, _, e in every):
                every.append((start, kind, end))
                added += 1
        assert got[i] == pii.written(sorted(every))
    assert added > 150


def test_sample_is_bounded_and_reaches_late_spans(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", lambda texts, spans: seen.append((texts, spans)) or pii.Tagger.new())
    late = "word " * 3000 + "me@a.bc"
    pii.fit(frame(spark, ["call me@a.bc"] * 20_000 + [late, "clean", None]))
    texts, spans = seen[0]
    assert sorted(texts) == sorted(["call me@a.bc", late]) and all(spans)
    pii.fit(frame(spark, [f"{i} me@a.bc" for i in range(500)]), sample=100)
    assert len(seen[1][0]) == 100
