from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark.sql import functions as F

from tradeloom.llm import repeats

from .helpers import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(texts):
    cut = [WORD.findall(t or "") for t in texts]
    width = repeats.WINDOW
    seen = Counter(tuple(w[i : i + width]) for w in cut for i in range(len(w) - width + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def check(spark, texts, ids=None, parts=3):
    docs = frame(spark, texts, ids=ids).repartition(parts)
    for clash in ("batch", "bucket", "words", "kept"):
        docs = docs.withColumn(clash, F.lit(1))
    found = repeats.without_repeats(docs)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]
    ids = range(len(texts)) if ids is None else ids
    want = [(i, *b) for i, b in zip(ids, brute_force(texts), strict=True)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    return sum(w[2] for w in want)


def words(rng, n, size=5000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_planted_passages_at_any_offset(spark):
    rng = random.Random(1)
    texts = []
    for n in (34, 35, 36, 40, 53, 90):
        passage = words(rng, n)
        for _ in range(3):
            texts.append(" ".join(words(rng, rng.randrange(60)) + passage + words(rng, rng.randrange(60))))
    rng.shuffle(texts)
    assert check(spark, texts) >= 3 * (35 + 36 + 40 + 53 + 90)


def test_odd_texts(spark):
    rng = random.Random(2)
    whole = " ".join(words(rng, 80))
    tabs = whole.replace(" ", "\t\n", 20)
    texts = [None, "", " \n", "a " * 34, "a " * 35, "a " * 36, "b " * 35, whole, whole, tabs, whole + "x", "é" * 300 + "   ", "c d " * 40]
    texts += ["\x0b".join(words(rng, 200, 3)) for _ in range(5)] + ["x" * 100_000 + " " + whole[:200]]
    check(spark, texts, [None, None, 5, 5] + list(range(len(texts) - 4)))


def test_small_vocabulary_against_brute_force(spark):
    rng = random.Random(3)
    base = [words(rng, 300, 400) for _ in range(4)]
    texts = []
    for _ in range(120):
        a, b = rng.choice(base), rng.choice(base)
        i, j = rng.randrange(280), rng.randrange(280)
        texts.append(" ".join(a[i : i + rng.randrange(120)] + words(rng, rng.randrange(40), 400) + b[j : j + rng.randrange(80)]))
    assert check(spark, texts, parts=7) > 1000


def test_hot_passage_and_long_text(spark):
    rng = random.Random(4)
    passage = " ".join(words(rng, 50))
    texts = [f"{' '.join(words(rng, 20, 10**6))} {passage} tail{i}" for i in range(300)]
    texts.append(" ".join(words(rng, 150_000, 10**7)))
    assert check(spark, texts, parts=5) == 300 * 50


def test_repeats_inside_one_text(spark):
    rng = random.Random(5)
    passage = words(rng, 41)
    check(spark, [" ".join(passage + words(rng, 9) + passage + passage[:37])])


def test_empty_table(spark):
    assert repeats.without_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_entries_round_trip(n):
    values = np.sort(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    assert (repeats.decoded(repeats.encoded(values)) == values).all()


def test_texts_in_small_parts(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(words(rng, rng.randrange(50))) for _ in range(50)] + ["", "x" * 999, "y"]
    data = [t.encode() for t in texts]
    sizes = np.array([len(d) for d in data])
    whole = repeats.Texts(b"".join(data), sizes).hash
    monkeypatch.setattr(repeats, "_PART", 64)
    assert (repeats.Texts(b"".join(data), sizes).hash == whole).all()
    distinct = {w for t in texts for w in t.split()}
    assert len(set(whole.tolist())) == len(distinct)


def test_entries_are_small_however_they_lie():
    rng = np.random.default_rng(1)
    for bits in (20, 36, 50, 64):
        values = np.unique(rng.integers(0, 2**bits, 50_000, dtype=np.uint64, endpoint=bits < 64))
        size = len(repeats.encoded(values)) * 8 / len(values)
        assert size < max(0, bits - np.log2(len(values))) + 3.1
        assert (repeats.decoded(repeats.encoded(values)) == values).all()
    for values in ([0, 2**64 - 1], [7] * 9, [0, 1, 2, 2**63], [*range(1000), 2**40, 2**64 - 1]):
        values = np.array(values, np.uint64)
        assert len(repeats.encoded(values)) < 30 + 9 * len(values)
        assert (repeats.decoded(repeats.encoded(values)) == values).all()


def by_bucket(sent, made, buckets):
    """What the buckets make of what batches sent."""
    table = repeats._table_of(sent)
    return [made((pa.scalar(b),), table.filter(pc.equal(table["bucket"], b))) for b in range(buckets)]


def size_of(table):
    return sum(len(x or b"") for name in ("entries", "more") for x in table[name].to_pylist())


def test_bytes_sent():
    rng = random.Random(7)
    passages = [words(rng, 200) for _ in range(60)]
    data = [" ".join(words(rng, 300) + rng.choice(passages)).encode() for _ in range(600)]
    n, buckets = sum(len(d.split()) for d in data), 8
    bits = repeats.block_bits(n)
    row = {"batch": 1, "sizes": np.array([len(d) for d in data]).tobytes(), "texts": zstandard.compress(b"".join(data))}
    sent = repeats.probes(row, bits, buckets)
    assert size_of(repeats._table_of(sent)) < 3 * n
    hits = pa.concat_tables(by_bucket(sent, repeats.found_hits, buckets))
    asked = repeats.anchored(row, repeats.hits_of(hits), bits, buckets)
    distinct = sum(len(repeats.decoded(r[2])) for r in asked)
    assert distinct > 60 * 160
    answers = pa.concat_tables(by_bucket(asked, repeats.found_repeats, buckets))
    assert answers.num_rows == buckets
    assert size_of(answers) <= distinct / 8 + buckets


def test_texts_are_sent_once(spark):
    rng = random.Random(8)
    passage = " ".join(words(rng, 60))
    docs = frame(spark, [f"{' '.join(words(rng, 30, 10**9))} {passage}" for _ in range(40)]).repartition(3)
    found = repeats.without_repeats(docs)
    assert sum(r["n_removed"] for r in found.collect()) == 40 * 60
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
