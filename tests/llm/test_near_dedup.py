from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradeloom.llm import components, near_dedup

from .helpers import frame


def brute_force(texts):
    """Class of every text: connected texts with a similarity of at least 0.8, or equal texts."""
    sets = [near_dedup.shingle_set((t or "").encode()) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    first = {}
    for i, t in enumerate(texts):
        if t is not None:
            join(i, first.setdefault(t, i))
    common = defaultdict(int)
    for held in holders.values():
        if len(held) > 1:
            for n, i in enumerate(held):
                for j in held[n + 1 :]:
                    common[i, j] += 1
    for (i, j), n in common.items():
        if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
            join(i, j)
    return [find(i) for i in range(len(texts))]


def check(got, texts):
    want = brute_force(texts)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].class_id for i in range(len(texts))] == want
    assert [by_id[i].kept for i in range(len(texts))] == [i == c for i, c in enumerate(want)]


def variants(rng, n_words, n, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(n_words)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(n_words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [None, None, "", "", " ", "one", "one ", "a b c", "a  b c", "a b c d e", "a b c d e f"]
    texts += variants(rng, 300, 60, 8) + variants(rng, 60, 40, 3) + variants(rng, 2000, 6, 60)
    passage = " ".join(f"p{i}" for i in range(60))  # shared by texts that are not near copies
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(80)]
    rng.shuffle(texts)
    check(near_dedup.near_duplicates(frame(spark, texts)).collect(), texts)


def test_second_pass_connects_what_the_centre_misses(spark):
    """A chain: each text is near the next, few are near the smallest node."""
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(words))
        words = [f"n{len(texts)}_{i}" if i == (7 * len(texts)) % 200 else w for i, w in enumerate(words)]
    check(near_dedup.near_duplicates(frame(spark, texts)).collect(), texts)


def test_whole_table(spark, tiny):
    from tradeloom.llm.queries import op5_near_dedup

    docs = spark.read.parquet(f"{tiny}/documents.parquet").orderBy("doc_id").collect()
    ids = [r.doc_id for r in docs]
    assert ids == list(range(len(ids)))
    check(op5_near_dedup(spark, tiny).collect(), [r.text for r in docs])


def test_kept_rows(spark):
    texts = ["same text of six words here", "same text of six words here", None, None, "other", "other"]
    docs = frame(spark, texts, ids=[3, 3, 1, 1, None, 9])
    got = near_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == [(1, ""), (1, ""), (3, texts[0]), (9, "other")]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("weights", [(1.0, 1.0), (0.5, 3.0)])
def test_signatures_estimate_weighted_similarity(weights):
    rng = np.random.default_rng(1)
    k = 2048
    a, b, both = (rng.integers(1, 2**63, n).astype(np.uint64) for n in (40, 60, 100))
    element = np.concatenate([a, both, b, both])
    owner = np.repeat([0, 1], [140, 160])
    weight = np.concatenate([np.full(40, weights[0]), np.full(100, weights[1]), np.full(60, weights[0]), np.full(100, weights[1])])
    got = near_dedup.signatures(owner, element, weight, 2, k)
    want = 100 * weights[1] / (100 * weights[1] + 100 * weights[0])
    assert abs((got[0] == got[1]).mean() - want) < 0.04


def test_components(spark):
    links = [(5, 9), (9, 2), (2, 30), (7, 8), (40, 41), (41, 42), (42, 43), (43, 44), (44, 40)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 2, 5: 2, 9: 2, 30: 2, 7: 7, 8: 7, 40: 40, 41: 40, 42: 40, 43: 40, 44: 40}


def near_misses(rng, kind, n):
    """Variants of one template that are mostly below 0.8 to it, some linked to each other."""
    words = [f"w{i}" for i in range(150)]
    pool = [(i, f"v{i}") for i in range(0, 150, 3)]
    out = []
    for k in range(n):
        if k % 10 == 9:  # a close relative of an earlier variant
            own = rng.choice(out).split()
            own[rng.randrange(len(own))] = f"y{k}"
        elif kind == "deleted":
            gone = set(rng.sample(range(150), rng.randrange(3, 7)))
            own = [w for i, w in enumerate(words) if i not in gone]
        else:
            own = list(words)
            for i, v in rng.sample(pool, rng.randrange(2, 6)):
                own[i] = v
        out.append(" ".join(own))
    return [" ".join(words)] * 3 + out


def brute_force_of_family(texts):
    """Like brute_force, with all pairs compared by one product of matrices."""
    sets = [near_dedup.shingle_set(t.encode()) for t in texts]
    held = Counter(x for s in sets for x in s)
    place = {x: i for i, x in enumerate(x for x, n in held.items() if n > 1)}
    matrix = np.zeros((len(texts), len(place)), np.float32)
    for i, s in enumerate(sets):
        matrix[i, [place[x] for x in s if x in place]] = 1
    size = np.array([len(s) for s in sets])
    common = matrix @ matrix.T
    linked = 5 * common >= 4 * (size[:, None] + size - common)
    np.fill_diagonal(linked, True)
    label = np.arange(len(texts))
    while True:
        least = np.array([label[row].min() for row in linked])
        if (least == label).all():
            return label.tolist()
        label = least


@pytest.mark.parametrize("kind", ["deleted", "pool"])
def test_family_of_near_misses_equals_brute_force(spark, kind):
    texts = near_misses(random.Random(3), kind, 3000)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_force_of_family(texts)


def test_blocks_of_a_family_find_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 40)
    texts = near_misses(random.Random(4), "pool", 300) + near_misses(random.Random(5), "deleted", 300)
    check(near_dedup.near_duplicates(frame(spark, texts)).collect(), texts)


def test_odd_tables(spark):
    """Null ids and texts, repeated rows and clashing names: one row of each class stays, rows without text too."""
    one = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    schema = "doc_id long, text string, digest string, class string, kept int, doc string, k_doc_id long, b long"
    values = [(None, one), (None, one + " end"), (7, other), (7, other), (8, None), (8, None), (9, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "d", None, 1, "x", 2, 3) for i, t in values], schema)
    found = near_dedup.near_duplicates(docs)
    assert found.count() == len(values)
    left = near_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert sum((r.text or "").startswith("w0 ") for r in rows) == 1
    assert sum(r.text == other for r in rows) == 1
    assert sum(r.text is None for r in rows) == 3
    assert all((r.digest, r.kept, r.doc) == ("d", 1, "x") for r in rows)
