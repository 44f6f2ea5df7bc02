"""Best-fit packing of token sequences by large-item matching.

Lengths are whole numbers up to the capacity, so a plan needs only the number of pieces of each
length: at most ``capacity`` cells, however many documents there are.  Pieces above a third of the
capacity are paired greedily, at most two per sequence, each with the longest partner that still
fits.  Shorter pieces then go, longest first, into the tightest gap that holds them, and into new
sequences when no gap is left.  The plan is a short list of ranges "the n-th to m-th piece of
length L go to these sequences at this offset"; Spark numbers the pieces of each length and every
task looks its pieces up.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from ..session import stored
from .common import pieces_of, small_batches, texts_of

CAPACITY = 4096
END = 1  # id written after each document
CACHE_SIZE = 1_200_000  # units that a worker keeps between batches

#: The word pattern and the special texts of the lower-case vocabulary.
TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPECIAL = re.compile(r"<\|startoftext\|>|<\|endoftext\|>")
#: Code points that the library neither composes nor splits differently from this module (tested).
FAMILIAR = re.compile("[^\t\n\r\x20-\x7e\xa1-įĲ-ɏ‐-‧€]")


@dataclass(frozen=True)
class Placement:
    """Pieces ``first .. first + count - 1`` of one length: ``each`` per sequence from ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Placement]:
    """Placements of all pieces, given how many pieces have each length."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece must be longer than 0 and fit into a sequence")
    placed: dict[int, int] = defaultdict(int)
    out: list[Placement] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
    sequences = 0

    def place(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        out.append(Placement(length, placed[length], count, sequence, each, offset))
        placed[length] += count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left.get(n, 0):
            partner = next((m for m in large if m <= n and n + m <= capacity and left[m] and (m < n or left[n] > 1)), None)
            if partner is None:
                many = left[n]
                place(n, many, sequences, 1, 0)
            elif partner == n:
                many = left[n] // 2
                place(n, 2 * many, sequences, 2, 0)
            else:
                many = min(left[n], left[partner])
                place(n, many, sequences, 1, 0)
                place(partner, many, sequences, 1, n)
                left[partner] -= many
            left[n] -= 2 * many if partner == n else many
            gaps[capacity - n - (partner or 0)].append((sequences, many))
            sequences += many

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        for gap in sorted(g for g in gaps if g >= n):
            each = gap // n
            keep = []
            for first, many in gaps.pop(gap):
                full = min(many, count // each)
                if full:
                    place(n, full * each, first, each, capacity - gap)
                    gaps[gap - full_size(n, each)].append((first, full))
                    count -= full * each
                if full < many and count:  # the last few pieces share one more sequence
                    place(n, count, first + full, count, capacity - gap)
                    gaps[gap - full_size(n, count)].append((first + full, 1))
                    count, full = 0, full + 1
                if full < many:
                    keep.append((first + full, many - full))
            if keep:
                gaps[gap].extend(keep)
            if not count:
                break
        if count:
            each = capacity // n
            many = count // each
            if many:
                place(n, many * each, sequences, each, 0)
                gaps[capacity - full_size(n, each)].append((sequences, many))
                sequences, count = sequences + many, count - many * each
            if count:
                place(n, count, sequences, count, 0)
                gaps[capacity - full_size(n, count)].append((sequences, 1))
                sequences += 1
    return out


def full_size(length: int, count: int) -> int:
    return length * count


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte (read as a Latin-1 character)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class Units(dict):
    """Ids of lower-case units, as bytes of little-endian 32-bit numbers; a missing unit is learned."""

    def __init__(self, model: models.Model) -> None:
        self.model = model

    def __missing__(self, unit: str) -> bytes:
        ids = []
        for word in [unit] if unit.isalpha() else TOKEN.findall(unit):
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_LETTERS)
            ids += [t.id for t in self.model.tokenize(word)]
        found = self[unit] = struct.pack(f"<{len(ids)}I", *ids)
        return found


class Encoder:
    """Token ids of texts, as bytes of little-endian 32-bit numbers.

    Every unit (a run without white space, in lower case) is looked up once; the vocabulary's model
    reads the words of an unknown one, without the library's normalizing and offsets.  A text with
    code points beyond the tested ones, or with special strings, goes through the library as a whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache = Units(self.tokenizer.model)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_SIZE:
            self.cache.clear()
        ids_of = self.cache.__getitem__
        out = []
        for text in texts:
            lower = text.lower()
            if FAMILIAR.search(text) or ("<|" in text and SPECIAL.search(lower)):
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(b"".join(map(ids_of, lower.split())))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder of a vocabulary; the tasks that a worker runs share its known units."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
)
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
_OUT = pa.schema([*list(_PIECES)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])
_OUT_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pack documents into sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and ``end``; null and empty texts are ``end`` alone.  Only longer
    documents are cut, into pieces of ``capacity`` whose last may be shorter.  Pieces of a sequence
    follow each other without gaps from offset 0.  Repeated rows, equal and null ids are packed one
    by one; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tail = np.array([end], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in pieces_of(batches, "text", 4 << 20):
            rows = []
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), encoder.encode_batch(texts_of(batch, "text")), strict=True):
                ids = body + tail
                for k, at in enumerate(range(0, len(ids), width)):
                    piece = ids[at : at + width]
                    n = len(piece) // 4
                    rows.append((doc_id, k, at // 4, n, zlib.crc32(piece), part, seen[n]))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    pieces = stored(docs.mapInArrow(cut, _PIECES_DDL), "pieces")
    # How many pieces of a length the earlier parts hold: one row per part and length.
    parts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("many"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(parts.select("length", "part", "many", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before")), "piece-counts")
    histogram = {r["length"]: r["many"] for r in before.groupBy("length").agg(F.sum("many").alias("many")).collect()}  # at most `capacity` rows
    ranges = sorted(plan(histogram, capacity), key=lambda p: (p.length, p.first))
    table = np.array([(p.length, p.first, p.count, p.sequence, p.each, p.offset) for p in ranges], np.int64).reshape(-1, 6)
    span = 1 << 42  # (length, number) as one sortable key
    shared = spark.sparkContext.broadcast((table, table[:, 0] * span + table[:, 1]))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, keys = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            found = places[np.searchsorted(keys, length * span + number, side="right") - 1]
            inside = number - found[:, 1]
            each = found[:, 4]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(found[:, 3] + inside // each), pa.array(found[:, 5] + inside % each * length)], schema=_OUT
            )

    numbered = pieces.join(before.drop("many"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number")
    )
    return numbered.mapInArrow(assign, _OUT_DDL)
