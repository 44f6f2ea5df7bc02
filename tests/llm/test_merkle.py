from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import merkle

from .helpers import frame


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(nodes, fan_out):
    """Root of a list of digests, and the siblings of each by level."""
    paths, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for start in range(0, len(nodes), fan_out):
            run = nodes[start : start + fan_out]
            for k in range(len(run)):
                for i in held[start + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            below.append([i for k in range(len(run)) for i in held[start + k]])
        nodes, held = up, below
    return nodes[0], paths


def brute_force(rows, fan_out=8):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    grown = []
    for t in order:
        trees[t].sort(key=lambda x: x[:3])
        grown.append(grow([x[2] for x in trees[t]], fan_out))
    root, above = grow([g[0] for g in grown], fan_out)
    out = []
    for k, t in enumerate(order):
        subroot, paths = grown[k]
        for (_, _, digest, r), path in zip(trees[t], paths, strict=True):
            path = path + above[k]
            now = digest
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for before, after in path:
                now = sha(before, now, after)
            out.append((r["doc_id"], digest, subroot, root, sha(*[b + a for b, a in path]), now, now == root))
    return sorted(out, key=str)


def check(spark, texts, lang, ids=None, source=None):
    docs = frame(spark, texts, source, lang, ids)
    rows = [r.asDict() for r in docs.collect()]
    for clash in ("digest", "idx", "tree", "n", "leaf"):
        docs = docs.withColumn(clash, F.lit("x"))
    found = merkle.tamper_check(docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)
    return found


def test_odd_rows_equal_brute_force(spark):
    texts = [None, "", "Same", "Same", "ÄB c" * 30_000, "x:y", "-", "lower only", "UP"] + [f"Text {i}" for i in range(80)]
    lang = [None, None, "en", "en", "de", "de", "", "é", "zz"] + ["en" if i % 3 else None for i in range(80)]
    ids = [None, None, 7, 7, 3, 3, -5, 2**62, 0] + [i // 2 for i in range(80)]
    found = check(spark, texts, lang, ids, [None if i % 4 == 0 else f"s{i % 5}" for i in range(89)])
    assert 0 < found.where("not verified").count() < 89


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_one_language(spark, n):
    check(spark, [f"A{i}" for i in range(n)], ["en"] * n)


def test_many_languages(spark):
    check(spark, [f"A{i}" for i in range(70)], [f"l{i}" for i in range(70)])


def test_empty_table(spark):
    found = merkle.tamper_check(frame(spark, []))
    assert found.count() == 0
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_binary_tree(spark):
    docs = frame(spark, [f"A{i}" for i in range(13)], None, ["en"] * 9 + [None] * 4)
    found = merkle.manifest(docs, fan_out=2).select("doc_id", merkle.hex_of(F.col("root")), merkle.hex_of(merkle.proof_digest(F.col("siblings"))))
    want = brute_force([r.asDict() for r in docs.collect()], 2)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(w[0], w[3], w[4]) for w in want], key=str)
