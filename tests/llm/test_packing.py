from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradeloom.llm import packing

from .helpers import frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def spread(placements):
    """Every piece of a plan as (length, number, sequence, offset)."""
    return [
        (p.length, p.first + j, p.sequence + j // p.each, p.offset + j % p.each * p.length)
        for p in placements for j in range(p.count)
    ]


def check(pieces, capacity):
    sequences = defaultdict(list)
    for length, sequence, offset in pieces:
        sequences[sequence].append((offset, length))
    for items in sequences.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40)))
def test_plan_places_every_piece_once(histogram):
    pieces = spread(packing.plan(histogram, 60))
    assert sorted((n, k) for n, k, _, _ in pieces) == sorted((n, k) for n, c in histogram.items() for k in range(c))
    sequences = check([(n, s, o) for n, _, s, o in pieces], 60)
    total = sum(n * c for n, c in histogram.items())
    assert len(sequences) <= 1.5 * total / 60 + 20 or all(3 * n > 60 for n in histogram)
    assert all(sum(3 * n > 60 for _, n in items) <= 2 for items in sequences.values())


def test_plan_fills_gaps_tightest_first():
    # 60 - 41 leaves 19 and 60 - 45 leaves 15: the 15 takes the tight gap, 7 + 7 the other one.
    by_sequence = defaultdict(list)
    for n, _, s, _ in spread(packing.plan({41: 1, 45: 1, 15: 1, 7: 2}, 60)):
        by_sequence[s].append(n)
    assert sorted(map(sorted, by_sequence.values())) == [[7, 7, 41], [15, 45]]


def test_few_sequences():
    rng = random.Random(3)
    histogram = defaultdict(int)
    for _ in range(20_000):
        histogram[min(4096, max(1, int(rng.lognormvariate(6, 1.2))))] += 1
    used = 1 + max(s for _, _, s, _ in spread(packing.plan(histogram)))
    assert used <= 1.01 * sum(n * c for n, c in histogram.items()) / 4096 + 1


def reference_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def verify(got, texts, library):
    check([(r.length, r.sequence_id, r.offset) for r in got], packing.CAPACITY)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(texts)
    for k, text in texts.items():
        ids = reference_ids(library, text)
        cut = [ids[i : i + packing.CAPACITY] for i in range(0, len(ids), packing.CAPACITY)]
        crc = [zlib.crc32(np.array(c, "<u4").tobytes()) for c in cut]
        assert sorted(pieces[k]) == [(i, i * packing.CAPACITY, len(c), x) for i, (c, x) in enumerate(zip(cut, crc, strict=True))]


def test_pieces_equal_the_library(spark, library):
    rng = random.Random(2)
    texts = [
        None, "", " ", "It's HERE, they'LL go!?", "a b " * 9000, "ÀÉ ñ ß ŉ İı Σς ΑΣ", "é Å", "x y", "日本 1234",
        "<|endoftext|> a<|startoftext|>", "<|x|>", "''s !'s", "z" * 5000,
    ]
    texts += ["".join(rng.choice(" \n'abcÉß.,!1½A") for _ in range(rng.randrange(90))) for _ in range(300)]
    got = packing.pack(frame(spark, texts), PATH).collect()
    verify(got, dict(enumerate(texts)), library)


def test_every_familiar_code_point(library):
    encoder = packing.Encoder(PATH)
    known = [c for c in map(chr, range(0x2100)) if not packing.FAMILIAR.search(c)]
    assert len(known) > 500
    for c in known:
        text = f"a{c}b {c} 1{c}'s{c}{c}"
        assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(c)


def test_repeats_ids_and_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
    got = packing.pack(frame(spark, ["a b", "a b", "a b"], ids=[1, 1, None]), PATH).collect()
    assert sorted(r.offset for r in got) == [0, 3, 6]


def test_whole_table(spark, tiny, library):
    from tradeloom.llm.queries import op10_packing

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    got = op10_packing(spark, tiny).collect()
    verify(got, texts, library)
    assert len({r.sequence_id for r in got}) <= 1.02 * sum(r.length for r in got) / packing.CAPACITY + 1


def test_units_are_learned_once_and_by_the_model_alone(library):
    """Of familiar texts the library's whole encoding sees nothing, and upper case is no other unit."""
    encoder = packing.Encoder(PATH)
    encoder.tokenizer = None
    text = "Straße, THE the The It's it'S naïve¼—x2024 foo_bar.baz <|x|> ŒUVRE œuvre"
    assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(encoder.cache) == sorted({u.lower() for u in text.split()})


def test_special_strings_in_any_case(library):
    encoder = packing.Encoder(PATH)
    texts = ["a<|ENDOFTEXT|>b", "<|StartOfText|>", "x <|endoftext|>Y", "<|endof text|>"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_batch(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
