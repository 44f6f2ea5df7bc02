from __future__ import annotations

import hashlib
import random
import re

import xxhash

from tradeloom.llm import fingerprints as fp

from .helpers import frame


def hash64(parts):
    """Spark's xxhash64 of strings: each hash seeds the next."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def winnow(text):
    tokens = re.findall(fp.TOKEN, text)
    if not tokens:
        return []
    if len(tokens) < fp.K:
        return [(0, hash64([" ".join(tokens)]))]
    grams = [hash64(tokens[i : i + fp.K]) for i in range(len(tokens) - fp.K + 1)]
    kept = []
    for j in range(max(1, len(grams) - fp.WINDOW + 1)):
        window = range(j, min(j + fp.WINDOW, len(grams)))
        best = min(window, key=lambda p: (grams[p] >> 24, -p))
        if best not in kept[-1:]:
            kept.append(best)
    return [(p, grams[p]) for p in dict.fromkeys(kept)]


def likeness(a, b):
    a, b = ({h for _, h in x} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def written(prints):
    return ",".join(f"{p}:{h % 2**64:x}" for p, h in prints)


def expected(ids, texts):
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, -(ids[i] or 0), texts[i] or ""))
    out = []
    for n, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(n + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = winnow(text), winnow(edited), winnow(after)
        out.append((ids[i], len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c)))
    return out


def check(df, ids, texts):
    got = [tuple(r) for r in df.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(expected(ids, texts), key=key)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["längeres-wort-über-acht", "日本語テキスト" * 3, "😀"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["", None, " \n ", "a", "a b c", "a b c d", "same same " * 50, "x" * 5000, "same same " * 50]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    check(fp.fingerprints(frame(spark, texts, ids=ids)), ids, texts)


def test_equal_and_null_ids_and_few_rows(spark):
    texts, ids = ["b c d e f", "a b", "z " * 30, "q", "q"], [5, 5, None, 9, 9]
    check(fp.fingerprints(frame(spark, texts, ids=ids)), ids, texts)
    check(fp.fingerprints(frame(spark, ["only one text"], ids=[3])), [3], ["only one text"])
    check(fp.fingerprints(frame(spark, ["no id"], ids=[None])), [None], ["no id"])
    assert fp.fingerprints(frame(spark, [])).count() == 0


def test_shared_passage_shares_a_hash():
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(1000)}" for _ in range(fp.K + fp.WINDOW - 1))
    for _ in range(200):
        a, b = (" ".join([f"{x}{rng.randrange(1000)}" for _ in range(rng.randrange(30))] + [passage] + [f"{x}{rng.randrange(1000)}" for _ in range(9)]) for x in "ab")
        assert {h for _, h in winnow(a)} & {h for _, h in winnow(b)}


def test_whole_table(spark, tiny):
    from tradeloom.llm.queries import op7_fingerprints

    rows = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    check(op7_fingerprints(spark, tiny), [r.doc_id for r in rows], [r.text for r in rows])


def test_unspaced_passage_at_every_offset(spark):
    """A passage of 22 code points inside a run shares a kept hash wherever it begins."""
    rng = random.Random(6)
    letters = [chr(0x4E00 + i) for i in range(2000)]
    runs = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(3)]
    passage = "".join(rng.choice(letters) for _ in range(22))
    texts = [runs[0] + passage + runs[1]] + [runs[2][: 9 + i] + passage + runs[0][::-1] for i in range(8)]
    df = fp.with_fingerprint(frame(spark, texts), "text", "own_")
    first, *others = [set(r.own_kept) for r in df.orderBy("doc_id").select("own_kept").collect()]
    assert all(first & other for other in others)
