from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradeloom.llm import tokens

from .helpers import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a", "a  b", "a \n b", "a\n\n\nb  ", "it's they'll I'M 'tis ''s", "x" * 3000, "1 22 333,44.5",
    "über naïve Ærø ñandú", "日本語 テスト", "a b c", "\x1c \x85", "😀😀 ok", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "<|endoftext", "ﬁne ², ½ and ⅷ", "tab\tsep \t x", "\r\n\r\n end ", "don’t “quote”…",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" \n'abcéß.,!1½A") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += [None, texts[5], texts[5], "word " * 30_000]
    got = tokens.count_tokens(frame(spark, texts), PATH, head_size=20).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == [
        (i, len((t or "").encode()), expected(library, t)) for i, t in enumerate(texts)
    ]
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_same_cuts_for_every_familiar_code_point(library):
    known = [c for c in map(chr, range(0x2100)) if not tokens.FAMILIAR.search(c)]
    assert len(known) > 500
    for c in known:
        for text in (f"a{c}b", f"1{c}2", f" {c} {c}{c}", f"!{c}!", f"\n{c}\n {c}"):
            cut = [p for chunk in tokens.chunks(text) for p in tokens.split(chunk, library)]
            assert cut == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)], repr(text)


def test_empty_table_and_equal_ids(spark):
    assert tokens.count_tokens(frame(spark, []), PATH).count() == 0
    got = tokens.count_tokens(frame(spark, ["a", "a b", None], ids=[None, 7, 7]), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 1), (7, 0), (7, 2)]


def test_whole_table(spark, tiny, library):
    from tradeloom.llm.queries import op3_token_counts

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in op3_token_counts(spark, tiny).collect()}
    assert got == {k: expected(library, t) for k, t in texts.items()}


def test_scans_need_no_vocabulary_and_workers_read_it_once(library, monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    monkeypatch.setattr(tokens, "_TOKENIZERS", {})
    assert tokens.tokenizer_of(PATH) is tokens.tokenizer_of(PATH)
    assert tokens.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    for text in [t for t in ODD if tokens.SPECIAL not in t]:
        assert tokens.split(text, library.pre_tokenizer) == tokens.split(text, library)


def test_only_the_pre_tokens_are_sorted_for_a_join(spark):
    got = tokens.count_tokens(frame(spark, ["unheard words", None], ids=[None, None]), PATH, head_size=0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens > 0) for r in got.collect()) == [(None, 0, False), (None, 13, True)]
