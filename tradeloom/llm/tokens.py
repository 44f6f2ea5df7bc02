"""Token counts: pieces are counted once per distinct pre-token and joined to the documents.

A byte-level vocabulary never merges across pre-tokens, so a document's count is the sum over its
pre-tokens of frequency times pieces.  No token ids of a document are ever built.

The frequent pre-tokens of a bounded sample (the head) are counted first and reach every task; the
rest (the tail) is shuffled: distinct pre-tokens are counted once each and joined to the
frequencies of the documents that hold them.  The head only saves work.  What it misses is in the
tail, so the counts do not depend on the sample.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import PreTokenizer

from ..session import stored
from .common import pieces_of, small_batches, texts_of

HEAD_SIZE = 1 << 17  # bound of the broadcast head
SAMPLE_ROWS = 4000  # documents from which the head is chosen
CACHE_SIZE = 120_000  # entries a worker keeps

#: The pre-token pattern of the byte-level vocabulary and its special text.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPECIAL = "<|endoftext|>"
#: Code points on which this module's pattern and the library's are tested to agree.
FAMILIAR = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ‐-‧€]")
SPACES = re.compile(r" [ \t\n\r]")

_DOCS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("known", pa.int64()),
        ("rest", pa.list_(pa.struct([("pre_token", pa.string()), ("n", pa.int64())]))),
    ]
)
_DOCS_DDL = "row long, doc_id long, n_bytes long, known long, rest array<struct<pre_token:string,n:long>>"


def split(text: str, tokenizer: Tokenizer | PreTokenizer) -> list[str]:
    """Pre-tokens of a text without special strings, exactly as the library cuts them."""
    if FAMILIAR.search(text) is None:
        return PRE_TOKEN.findall(text)
    cutter = getattr(tokenizer, "pre_tokenizer", tokenizer)
    return [text[a:b] for _, (a, b) in cutter.pre_tokenize_str(text)]


def chunks(text: str) -> list[str]:
    """Cut a text before each space that a visible character follows; no pre-token crosses a cut.

    A text with white space behind a space is not cut.
    """
    if SPACES.search(text) or text.endswith(" ") or FAMILIAR.search(text):
        return [text]
    first, *others = text.split(" ")
    return [first, *[" " + x for x in others]] if first else [" " + x for x in others]


def frequencies(text: str, tokenizer: Tokenizer, cache: dict[str, list[str]]) -> tuple[Counter, int]:
    """Pre-token frequencies of a text and its number of special tokens."""
    parts = text.split(SPECIAL)
    found: Counter = Counter()
    for part in parts:
        for chunk, n in Counter(chunks(part)).items():
            cut = cache.get(chunk)
            if cut is None:
                cut = split(chunk, tokenizer)
                if len(chunk) < 64:
                    if len(cache) >= CACHE_SIZE:
                        cache.clear()
                    cache[chunk] = cut
            for pre in cut:
                found[pre] += n
    return found, len(parts) - 1


def n_pieces(pre_tokens: list[str], tokenizer: Tokenizer) -> list[int]:
    return list(map(len, tokenizer.encode_batch_fast(pre_tokens, add_special_tokens=False)))


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    """The worker's tokenizer of a vocabulary: read once for all its tasks, on the task's own core.

    Without the library's threads, each of which would keep memory of its own.
    """
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[path] = load(path)
    return _TOKENIZERS[path]


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 1024, head_size: int = HEAD_SIZE, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Tokens per document: ``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.

    ``vocabulary`` is the path of a byte-level BPE file for ``tokenizers``; every executor reads
    it.  Null and empty texts have no bytes and no tokens.  Repeated rows and rows with the same
    or a null ``doc_id`` are counted one by one.  Texts of any length are counted whole.  Other
    columns of ``docs`` are ignored.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    reader = load(vocabulary)
    cutter = reader.pre_tokenizer  # all that a scan needs of the library
    shared = spark.sparkContext.broadcast(_head(docs, reader, head_size, sample_rows))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        # Per chunk: pieces of its pre-tokens in the head, and the others.
        cache: dict[str, tuple[int, tuple[str, ...]]] = {}
        row = TaskContext.get().partitionId() << 36

        def lookup(chunk: str) -> tuple[int, tuple[str, ...]]:
            cut = split(chunk, cutter)
            value = (sum(known.get(x, 0) for x in cut), tuple(x for x in cut if x not in known))
            if len(chunk) < 64:
                if len(cache) >= CACHE_SIZE:
                    cache.clear()
                cache[chunk] = value
            return value

        for batch in pieces_of(batches, "text"):
            rows, sizes, totals, offsets, names, counts = [], [], [], [0], [], []
            for text in texts_of(batch, "text"):
                parts = text.split(SPECIAL)
                total, rest = len(parts) - 1, {}
                for part in parts:
                    for chunk, n in Counter(chunks(part)).items():
                        pieces, others = cache.get(chunk) or lookup(chunk)
                        total += n * pieces
                        for pre in others:
                            rest[pre] = rest.get(pre, 0) + n
                rows.append(row)
                row += 1
                sizes.append(len(text.encode()))
                totals.append(total)
                names.extend(rest)
                counts.extend(rest.values())
                offsets.append(len(names))
            pairs = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(counts, pa.int64())], fields=list(_DOCS.field("rest").type.value_type)
            )
            rest_column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), rest_column.cast(_DOCS.field("rest").type)],
                schema=_DOCS,
            )

    scanned = stored(docs.mapInArrow(scan, _DOCS_DDL), "token-scan")
    tail = scanned.select("row", F.explode("rest").alias("r")).select("row", "r.pre_token", "r.n")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(vocabulary)
        for batch in pieces_of(batches, "pre_token"):
            names = batch.column("pre_token")
            yield pa.RecordBatch.from_arrays([names, pa.array(n_pieces(names.to_pylist(), tokenizer), pa.int64())], names=["pre_token", "pieces"])

    distinct = tail.select("pre_token").distinct().mapInArrow(count, "pre_token string, pieces long")
    more = tail.join(distinct, "pre_token").select("row", (F.col("n") * F.col("pieces")).alias("n_tokens"))
    # Each row's own line and its counted pre-tokens are summed in one exchange; no second join sorts them.
    lines = scanned.select("row", "doc_id", "n_bytes", F.col("known").alias("n_tokens")).unionByName(more, allowMissingColumns=True)
    sums = lines.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _head(docs: DataFrame, tokenizer: Tokenizer, size: int, sample_rows: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens of a sample of documents."""
    found, cache = Counter(), {}
    sample = docs.select(F.substring("text", 1, 20_000).alias("text")).where("text is not null")
    for (text,) in sample.take(sample_rows):  # only the choice of the head; all texts are counted whole
        found.update(frequencies(text, tokenizer, cache)[0])
    frequent = sorted(x for x, _ in found.most_common(size) if len(x) <= 64)
    return dict(zip(frequent, n_pieces(frequent, tokenizer), strict=True)) if frequent else {}
