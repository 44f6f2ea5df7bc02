from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import secrets

from .helpers import frame

BASE = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def base_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if {"assign": lambda m=m: len(m[2]) >= 6, "access": lambda m=m: len(m[0]) >= 20, "hex": lambda m=m: len(m[0]) >= 24}[name]():
                out.append((m.start(), kind, name, m.end()))
    return sorted(out)


def check(got, texts):
    by_id = {r.doc_id: r for r in got}
    assert set(by_id) == set(texts)
    for k, text in texts.items():
        spans, r = base_spans(text), by_id[k]
        listed = [f"{n}:{s}:{e}" for s, _, n, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), text
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(n == x for _, _, n, _ in spans) for x in BASE]
        assert set(listed) <= set(r.spans.split(","))
        assert [int(x.split(":")[1]) for x in r.spans.split(",") if x] == sorted(int(x.split(":")[1]) for x in r.spans.split(",") if x)


def random_text(rng):
    pieces = ["token", "Secret", "api_key", "APIKEY", "passwd", "password", "=", ": ", " = '", '"', "abc", "abcdef", "AKIA", "X" * 9,
              "0123456789abcdef", "A1B2C3D4E5F6G7H8", " ", "\n", "é", "😀", "ſecret", "to", "ken", "_", "-", "f" * 12]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [random_text(rng) for _ in range(1500)]
    texts += [None, "", "secret=token : abcdefgh", "token=token=abcdef", "password = short", "w " * 50_000 + "token=abcdef1", "a" * 30_000, "g" * 30_000]
    check(secrets.scan(frame(spark, texts)).collect(), dict(enumerate(texts)))


def test_empty_table_and_repeats(spark):
    assert secrets.scan(frame(spark, [])).count() == 0
    got = secrets.scan(frame(spark, ["token=abcdef", "token=abcdef", "x"], ids=[1, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in got) == [(0, ""), (1, "assign:0:12"), (1, "assign:0:12")]


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(7)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(base64) for _ in range(n)) for n in (32, 40, 48, 64) for _ in range(60)]
    words = ["donaudampfschifffahrtsgesellschaft", "internationalization-and-localization", "path/to/some/longer/directory/name",
             "some_function_name_with_words", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ABABABABABABABABABABABABABABABAB", "11112222333344445555666677778888",
             "--------------------------------", "getElementByIdentifierOrFallback", "2024-01-02-03-04-05-06-07-08-09"]
    texts = [f"see {x} there" for x in keys + words * 20]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, texts)).collect()}
    found = [got[i] == f"random:4:{4 + len(x)}" for i, x in enumerate(keys)]
    assert sum(found) >= 0.9 * len(keys)
    assert not any("random" in got[i] for i in range(len(keys), len(texts)))


def test_battery_statistics(spark):
    strings = ["0123456789abcdef0011223344", "abcabcabcabcabcabcabc1", "Zk9+Qx/LmP2rTyUvB7nC"]
    df = spark.createDataFrame([(x,) for x in strings], "hit string")
    for r in secrets.battery(df).collect():
        plain = r.body.lower() if r.encoding in ("hex", "base36") else r.body
        codes, n, a = [r.letters.index(c) for c in plain], len(plain), len(r.letters)
        squares = sum(codes.count(c) ** 2 for c in set(codes))
        assert r.z_chi == pytest.approx((a / n * squares - n - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n))
        high = [2 * c >= a for c in codes]
        assert r.runs == 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
        mean = sum(codes) / n
        assert r.serial == pytest.approx(sum((x - mean) * (y - mean) for x, y in zip(codes, codes[1:], strict=False)) / sum((c - mean) ** 2 for c in codes))


def benjamini_hochberg(ps, eligible, rate):
    """Plain step-up procedure: the largest p-value that may be rejected, or None."""
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    rank, best = 0, None
    for i in order:
        rank += eligible[i]
        same = sum(eligible[j] for j in order if ps[j] <= ps[i])
        if same and ps[i] * len(ps) <= rate * same:
            best = ps[i]
    return best


def test_discoveries_are_benjamini_hochberg(spark):
    rng = random.Random(9)
    # p-values at the ends of steps, so that steps lose nothing.
    natural = lambda: 10.0 ** (-rng.choice([0, 1, 2, 3, 70, 100, 200, 330, 500]) * secrets.STEP)
    chance = lambda: 10.0 ** (-rng.choice([0, 5, 30, 64, 128, 192, 200, 400]) * secrets.STEP)
    rows = [(i, natural() * 0.9999, chance() * 0.9999, rng.choice([24.0, 50.0, 100.0])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, p_natural double, p_random double, n double")
    got = {r.id for r in secrets.discoveries(df, rate=0.05, random_rate=0.02).collect()}
    want, rejected = set(), 0
    for stratum in {math.floor(math.log2(n)) for *_, n in rows}:
        mine = [r for r in rows if math.floor(math.log2(r[3])) == stratum]
        limit = benjamini_hochberg([q for _, _, q, _ in mine], [True] * len(mine), 0.02)
        kept = [limit is None or q > limit for _, _, q, _ in mine]
        rejected += len(kept) - sum(kept)
        limit = benjamini_hochberg([p for _, p, _, _ in mine], kept, 0.05)
        want |= {i for (i, p, _, _), k in zip(mine, kept, strict=True) if limit is not None and k and p <= limit}
    assert got == want
    assert 0 < len(want) < 300 and 0 < rejected < 300


def test_tails_equal_the_normal_distribution(spark):
    zs = [x / 8 for x in range(-40, 240)] + [36.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select("z", F.expr(secrets._upper_tail("z")).alias("p"), F.expr(secrets._two_sided("z")).alias("q")).collect()
    for r in got:
        assert r.p == pytest.approx(max(math.erfc(r.z / math.sqrt(2)) / 2, 1e-250), rel=3e-7)
        assert r.q == pytest.approx(max(math.erfc(abs(r.z) / math.sqrt(2)), 2e-250), rel=3e-7)


def test_planted_keys_in_the_whole_table(spark, tiny):
    """Keys of every encoding planted in the given texts, one hot document with thousands among them."""
    rng = random.Random(12)
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    alphabets = {"base64": secrets.ENCODINGS["base64"][1], "base32": secrets.ENCODINGS["base32"][1], "base36": secrets.ENCODINGS["base36"][1]}
    texts, planted = {}, {}
    for r in docs:
        text = r.text or ""
        if r.doc_id % 3 == 0:
            key = "".join(rng.choice(alphabets[rng.choice(list(alphabets))]) for _ in range(rng.choice([40, 48, 64])))
            at = text.find(" ", rng.randrange(len(text) + 1)) + 1
            text, planted[r.doc_id] = f"{text[:at]}{key} {text[at:]}", (at, at + len(key), key)
        texts[r.doc_id] = text
    hot = max(texts) + 1
    keys = ["".join(rng.choice(alphabets["base64"]) for _ in range(40)) for _ in range(3000)]
    texts[hot] = " ".join(keys)
    got = {r.doc_id: r for r in secrets.scan(frame(spark, list(texts.values()), ids=list(texts))).collect()}
    check(got.values(), texts)
    hit = {k for k, (s, e, key) in planted.items() if f"random:{s}:{e}" in got[k].spans.split(",")}
    assert len(hit) >= 0.9 * len(planted)
    assert got[hot].spans.count("random:") >= 0.95 * len(keys)
    extra = [x for k, r in got.items() if k != hot for x in r.spans.split(",") if x.startswith("random")
             and (k not in planted or x != f"random:{planted[k][0]}:{planted[k][1]}")]
    assert len(extra) <= 2


def test_whole_table(spark, tiny):
    from tradeloom.llm.queries import op9_secrets

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    check(op9_secrets(spark, tiny).collect(), texts)


def test_native(spark, tiny):
    from tradeloom.llm.queries import op1_quality_rules, op7_fingerprints, op9_secrets

    for query in (op1_quality_rules, op7_fingerprints, op9_secrets):
        plan = query(spark, tiny).select(F.col("*"))._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
