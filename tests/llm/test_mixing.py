from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import pytest

from tradeloom.llm import mixing

from .helpers import frame


def targets(totals, weights=(1, 2, 3), most=3):
    """Iterated sharing of the excess, as the rule is stated."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    whole = sum(totals.values())
    while True:
        left, open_weight = whole - sum(most * totals[s] for s in full), sum(weight[s] for s in order if s not in full)
        share = {s: most * totals[s] if s in full else weight[s] * left / open_weight for s in order}
        more = {s for s in order if share[s] > most * totals[s]} - full
        if not more:
            return share
        full |= more


def taken(rows, totals, share):
    """Whole epochs, then documents in the order of the draw until the target is met."""
    out = [0] * len(rows)
    for source, total in totals.items():
        whole = min(3, math.floor(share[source] / total)) if total else 0
        rest = math.floor(share[source] + 0.5) - whole * total
        groups = defaultdict(list)
        for i, (doc_id, s, size) in enumerate(rows):
            if s == source:
                place = hashlib.md5(f"mix-1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
                groups[place, size].append(i)
                out[i] = whole * size
        for (_, size), held in sorted(groups.items()):
            for i in held:
                out[i] += max(0, min(size, rest // len(held)))
            rest -= size * len(held)
    return out


def case(sizes, sources, ids=None):
    ids = list(range(len(sizes))) if ids is None else ids
    rows = list(zip(ids, sources, sizes, strict=True))
    totals = defaultdict(int)
    for _, s, n in rows:
        totals[s] += n
    share = targets(totals)
    return rows, totals, share, taken(rows, totals, share)


def check(spark, sizes, sources, ids=None):
    rows, totals, share, want = case(sizes, sources, ids)
    texts = [None if n == 0 and i % 2 else " ".join(["w"] * n) for i, n in enumerate(sizes)]
    got = mixing.mix(frame(spark, texts, source=sources, ids=ids)).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted([(r.doc_id, r["size"], r.source_size, r.taken) for r in got], key=key) == sorted(
        [(i, n, totals[s], t) for (i, s, n), t in zip(rows, want, strict=True)], key=key
    )
    for s in totals:
        assert {round(r.target, 6) for r in got if r.source_size == totals[s]} >= {round(share[s], 6)}
    assert all(r.taken <= 3 * r["size"] for r in got)
    return got


def test_equals_brute_force(spark):
    rng = random.Random(1)
    sources = [rng.choice(["a", "b", "Z", "é", None, "c"] + ["hot"] * 6) for _ in range(800)]
    check(spark, [rng.randrange(80) if s != "b" else rng.randrange(4) for s in sources], sources)


def test_targets_are_met_to_the_word(spark):
    rng = random.Random(2)
    sources = [rng.choice("abcdefgh") for _ in range(500)]
    sizes = [rng.randrange(1, 60) for _ in sources]
    _, totals, share, _ = case(sizes, sources)
    sums = defaultdict(int)
    for r in check(spark, sizes, sources):
        sums[sources[r.doc_id]] += r.taken
    assert all(abs(sums[s] - share[s]) <= 1 for s in totals)


def test_equal_and_null_ids(spark):
    check(spark, [5, 5, 5, 7, 0, 9], ["a", "a", "a", "a", "b", None], ids=[1, 1, 1, 1, None, None])


def test_small_tables(spark):
    check(spark, [0, 0], ["a", "b"])
    check(spark, [4], [None])
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


def test_mixed_rows(spark):
    rng = random.Random(3)
    sources = [rng.choice("abc") for _ in range(60)]
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(30))) for _ in sources]
    docs = frame(spark, texts, source=sources)
    want = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    words = defaultdict(int)
    for r in rows.collect():
        words[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r["size"] == "s"
    assert {k: v for k, v in want.items() if v} == dict(words)


def test_water_level(spark):
    df = spark.createDataFrame([("a", 10, 1), ("b", 1, 2), ("c", 100, 3)], "source string, total long, weight long")
    level = mixing.water_level(df, 3)
    assert (level.words, level.weights) == (111 - 3 - 0, 4) or level.words / level.weights == pytest.approx(27.0)
