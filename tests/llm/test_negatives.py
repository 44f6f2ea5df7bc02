from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, panel string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "p") for r in rows], SCHEMA)


def brute_force(rows):
    clean = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    last = 2**63

    def order(x):
        return (-x[0], last if x[1] is None else x[1], x[2])

    for i, (anchor, a, label) in enumerate(clean):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, b, strict=False)), other, j, kind) for j, (other, b, kind) in enumerate(clean) if j != i]
        for score, positive, _, _ in sorted((s for s in scored if s[3] == label), key=order)[:5]:
            window = sorted((s for s in scored if s[3] != label and 30 * score <= 100 * s[0] <= 90 * score), key=order)
            out += [(anchor, positive, k + 1, s[1], score, s[0]) for k, s in enumerate(window[:10])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, negatives.hard_negatives(df).collect()), key=str)


def clusters(n, width, seed, labels=4, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, width))
    rows = []
    for i in range(n):
        v = centres[i % len(centres)] + spread * rng.normal(size=width)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("spread", [0.01, 0.3, 3.0])
def test_equals_brute_force(spark, spread):
    rows = clusters(700, 8, 3, spread=spread)
    assert found(frame(spark, rows).repartition(5, "vec_id")) == brute_force(rows)


def test_bounds_leave_rows_out():
    rows = clusters(2000, 8, 5, spread=0.01)
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int32)
    ids, labels = np.arange(len(rows)), np.array([r[2] for r in rows])
    at = np.arange(0, 2000, 40)
    order, parents, edges = negatives.spanning_tree(x[at])
    at = at[order]
    panel = dict(panel=0, a_ids=ids[at].tobytes(), a_rows=ids[at].tobytes(), a_labels=labels[at].tobytes(), a_vectors=x[at].tobytes(),
                 a_width=8, parents=parents.astype(np.int64).tobytes(), edges=edges.tobytes())
    block = dict(ids=ids.tobytes(), rows=ids.tobytes(), labels=labels.tobytes(), vectors=x.tobytes(), width=8)
    scores = x[at].astype(np.int64) @ x.T.astype(np.int64)
    walk = negatives.Walk(panel, block)
    for i, low, high in walk.anchors():
        assert (low <= scores[i]).all() and (scores[i] <= high).all()
        near = np.flatnonzero(high >= scores[i].max() * 0.9)
        walk.rescore(i, near, low, high)
    assert walk.rescored < scores.size / 2
    for i, parent in enumerate(parents.tolist()):
        assert parent < i
    whole = [np.sqrt(((x[a].astype(float) - x[b]) ** 2).sum()) for a in at for b in at if a < b]
    assert sum(edges) <= min(len(at) - 1, len(whole)) * max(whole)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clusters(320, 4, 9, labels=2)
    rows += [(400, None, 1), (500, [1.0, 0.0, 0.0, 0.0], None), (600, [nan, 0.0, 0.0, 0.0], 1), (700, [1.0, None, 0.0, 0.0], 1)]
    rows += [(800, [inf, 0.0, 0.0, 0.0], 1), (None, rows[0][1], 0), (None, rows[0][1], 1), (100, rows[100][1], 0), (900, [], 1)]
    rows += [(7, rows[7][1], rows[7][2])] * 3 + [(1000, [1.0, 1.0], 0), (1100, [0.5] * 9, 1), (-100, [-1.0, 2.0, 300.0, 4.0], 0)]
    got = negatives.hard_negatives(frame(spark, rows).coalesce(1))
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)


def test_ties_and_hot_label(spark):
    rows = [(i, [0.5, 0.5] if i % 3 else [0.4, 0.1], 0 if i % 5 else 1) for i in range(301)]
    assert found(frame(spark, rows).repartition(7, "vec_id")) == brute_force(rows)


def test_no_rows(spark):
    empty = negatives.hard_negatives(frame(spark, []))
    assert empty.count() == 0
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found(frame(spark, [(1, [1.0], 0), (2, [1.0], 1)])) == []
    assert found(frame(spark, [(0, [1.0], 0)])) == []


def test_several_panels(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PANEL_ROWS", 3)
    rows = clusters(1500, 6, 1)
    assert found(frame(spark, rows)) == brute_force(rows)


def test_relabelled(spark):
    got = negatives.relabelled(frame(spark, [(0, [1.0], 9), (7, [1.0], 3), (8, [1.0], 3), (None, [1.0], 4)]))
    assert [r.label for r in got.orderBy(F.asc_nulls_last("vec_id")).collect()] == [0, 4, 3, 4]
