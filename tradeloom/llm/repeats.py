"""Removal of repeated passages by fixed-block anchors.

A window is 35 consecutive words.  If its words also start anywhere else, it is a repeat, and every
word that a repeat covers goes.

1.  Index: the non-overlapping blocks of 18 words of every text.  A repeat of 35 words or more covers
    a whole block of either text, since ``35 >= 2 * 18 - 1``.
2.  Probe: every rolling window of 18 words looks for an equal block elsewhere.  Such a hit anchors
    the 18 windows of 35 words around it.
3.  Extend: an anchored window that starts anywhere else too is a repeat; moving the anchored window
    by one word extends the repeat by one word, so overlapping repeats join to a maximal exact one.

Neither probing nor extending pairs occurrences.  Texts are packed into batches of a few megabytes.  A
batch sends every distinct hash once, with two flags (is there a block? is it here twice?), to the
bucket of the hash; the bucket finds the hashes of which there are two and answers the batches that
asked: with the hashes that hit, which are few, and with one bit per whole window.  So a passage in a
third of all texts costs one entry per batch, and the work is linear in the words.

Blocks are compared by 11 bits more than number them, 48 at most: what collides only anchors windows
in vain.  Whole windows are compared by 96 bits.  Entries are sorted and sent as differences: two to
three bytes per word, and ten per anchored window.  Texts are stored once and sent once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import small_batches

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
BATCH_BYTES = 8 << 20
_PART = 1 << 20
#: Hashes that a bucket receives on average.
BUCKET_ENTRIES = 1 << 21
#: Bits by which blocks are compared: the fewest and most, and those beyond the number of blocks.
_LEAST_BITS, _MOST_BITS, _SPARE_BITS = 32, 48, 11

_U = np.uint64
_PACKED = "batch long, ids binary, known binary, sizes binary, texts binary, words long"
_SENT = "bucket int, batch long, entries binary, more binary"
_KEPT = "doc_id long, n_words long, n_removed long, kept string"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _starts(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and which are the first of one; texts stand side by side."""
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = (np.cumsum(sizes) - sizes)[sizes > 0]
    first[at] |= inside[at]
    return inside, first


class Texts:
    """Words of several texts: their hashes, and the text of each."""

    def __init__(self, data: bytes, sizes: np.ndarray) -> None:
        raw = np.frombuffer(data, np.uint8)
        inside, first = _starts(raw, sizes)
        begin = np.flatnonzero(first)
        self.sizes = sizes
        self.text = np.searchsorted(np.cumsum(sizes), begin, "right")
        self.count = np.bincount(self.text, minlength=len(sizes))
        self.start = np.cumsum(self.count) - self.count
        self.left = (self.start + self.count)[self.text] - np.arange(len(begin))  # words up to the text's end
        self.hash = np.empty(len(begin), _U)
        # A part of the words at a time: eight-byte numbers per byte of text would add up.
        cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, len(raw), _PART)), len(begin)))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            low, high = int(begin[a]), int(begin[b]) if b < len(begin) else len(raw)
            place = np.flatnonzero(inside[low:high])
            heads = np.searchsorted(place, begin[a:b] - low)
            offset = np.arange(len(place)) - np.repeat(heads, np.diff(np.append(heads, len(place))))
            # Every place in a word has a random factor of its own.
            factor = _mixed(np.arange(1, int(offset.max()) + 2, dtype=_U) * _U(0xD1B54A32D192ED03)) | _U(1)
            value = _BYTE[raw[low:high][place]] * factor[offset]
            self.hash[a:b] = _mixed(np.add.reduceat(value, heads) + _U(0x9E3779B97F4A7C15))

    def windows(self, width: int, at: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
        """Hashes of the windows that start at the given words, or at all."""
        factor = _mixed(np.arange(1, width + 1, dtype=_U) * _U(0xA0761D6478BD642F) + _U(seed)) | _U(1)
        if at is None:
            n = len(self.hash)
            padded = np.concatenate([self.hash, np.zeros(width, _U)])
            out = np.zeros(n, _U)
            for j in range(width):
                out += padded[j : j + n] * factor[j]
        else:
            out = np.zeros(len(at), _U)
            for j in range(width):
                out += self.hash[at + j] * factor[j]
        return _mixed(out + _U(seed))


def pack(batches: Iterable[pa.RecordBatch], bound: int = 0) -> Iterator[pa.RecordBatch]:
    """Batches of whole texts, compressed together; a text beyond the bound is a batch by itself."""
    bound = bound or BATCH_BYTES
    part, count = TaskContext.get().partitionId() << 32, 0
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal count, held
        data, sizes = b"".join(texts), np.array([len(t) for t in texts], np.int64)
        n = int(_starts(np.frombuffer(data, np.uint8), sizes)[1].sum())
        known = np.array([x is not None for x in ids])
        numbers = np.array([x or 0 for x in ids], np.int64)
        blob = zstandard.ZstdCompressor(level=3).compress(data)
        values = [part + count, numbers.tobytes(), known.tobytes(), sizes.tobytes(), blob, n]
        count += 1
        held = 0
        ids.clear()
        texts.clear()
        types = [pa.int64(), *[pa.binary()] * 4, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], [x.split()[0] for x in _PACKED.split(", ")])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = (text or "").encode()
            if held and held + len(data) > bound:
                yield flush()
            ids.append(doc_id)
            texts.append(data)
            held += len(data) + 1
    if ids:
        yield flush()


def unpack(row: dict) -> tuple[bytes, Texts]:
    data = zstandard.ZstdDecompressor().decompress(row["texts"])
    return data, Texts(data, np.frombuffer(row["sizes"], np.int64))


def encoded(values: np.ndarray) -> bytes:
    """Ascending numbers as differences: their lower bits, and the upper ones as runs of zeros before a one.

    There are as many lower bits as a mean difference has below its first, so the runs have less than
    two zeros on average, however the numbers lie.
    """
    if not len(values):
        return b""
    steps = np.diff(values)
    mean = int(values[-1] - values[0]) // max(1, len(steps))
    low = max(0, mean.bit_length() - 1)
    parts = [bytes([low]), np.uint64(len(steps)).tobytes(), values[:1].tobytes()]
    parts.append(steps.view(np.uint8).reshape(-1, 8)[:, : low // 8].tobytes())
    parts += [np.packbits((steps >> _U(j)).astype(np.uint8) & 1).tobytes() for j in range(low // 8 * 8, low)]
    ones = np.cumsum((steps >> _U(low)) + _U(1)).astype(np.int64) - 1
    runs = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, bool)
    runs[ones] = True
    return b"".join([*parts, np.packbits(runs).tobytes()])


def decoded(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, _U)
    low, (n, start) = data[0], np.frombuffer(data, _U, 2, 1).tolist()
    whole, at = low // 8, 17
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :whole] = np.frombuffer(data, np.uint8, n * whole, at).reshape(n, whole)
    steps = steps.view(_U).ravel()
    at += n * whole
    for j in range(whole * 8, low):
        steps |= np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at), count=n).astype(_U) << _U(j)
        at += (n + 7) // 8
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=at))) if n else np.empty(0, np.int64)
    steps |= (np.diff(ones, prepend=-1) - 1).astype(_U) << _U(low)
    return np.cumsum(np.concatenate([np.array([start], _U), steps]), dtype=_U)


def _runs(values: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Starts of runs of equal sorted rows."""
    new = np.ones(len(values), bool)
    if len(values):
        new[1:] = values[1:] != values[:-1]
        for m in more:
            new[1:] |= m[1:] != m[:-1]
    return np.flatnonzero(new)


def _cuts(values: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, int, int]]:
    """The buckets of ascending entries of so many bits, by their upper bits, and where each begins and ends."""
    upper = (values >> _U(bits - 32)).astype(_U)
    bucket = ((upper * _U(buckets)) >> _U(32)).astype(np.int64)  # ascending, too
    cuts = np.append(_runs(bucket), len(values)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[a]), a, b


def _table_of(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "batch", "entries", "more"])


def block_bits(words: int) -> int:
    return min(_MOST_BITS, max(_LEAST_BITS, (words // BLOCK).bit_length() + _SPARE_BITS))


def probes(row: dict, bits: int, buckets: int) -> list[tuple]:
    """Every distinct rolling window of a batch; the lowest bits say: there are two, one is a block."""
    _, texts = unpack(row)
    whole = texts.left >= BLOCK
    at = np.flatnonzero(whole)
    if not len(at):
        return []
    block = (at - texts.start[texts.text[at]]) % BLOCK == 0
    values = (texts.windows(BLOCK)[at] >> _U(64 - bits) << _U(1)) | block.astype(_U)
    values.sort()
    hashes = values >> _U(1)
    first = _runs(hashes)
    last = np.append(first[1:], len(values)) - 1  # a block sorts behind
    entries = (hashes[first] << _U(2)) | ((last > first).astype(_U) << _U(1)) | (values[last] & _U(1))
    return [(bucket, row["batch"], encoded(entries[a:b]), None) for bucket, a, b in _cuts(entries, bits + 2, buckets)]


def _anchored(texts: Texts, hits: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of 35 words around hits, in the order of their 64 and 32 bits of hash: starts, hashes, where runs of equal ones begin."""
    n = len(texts.hash)
    near = _member(texts.windows(BLOCK) >> _U(64 - bits), hits) & (texts.left >= BLOCK)
    # A window is anchored if a hit starts in its first 18 words.
    sums = np.concatenate([[0], np.cumsum(near)])
    start = np.flatnonzero(texts.left >= WINDOW)
    start = start[sums[np.minimum(start + WINDOW - BLOCK + 1, n)] > sums[start]]
    hashes = texts.windows(WINDOW, start)
    further = (texts.windows(WINDOW, start, 1) >> _U(32)).astype(np.uint32)
    order = np.lexsort((further, hashes))
    hashes, further = hashes[order], further[order]
    return start[order], hashes, further, _runs(hashes, further)


def anchored(row: dict, hits: np.ndarray, bits: int, buckets: int) -> list[tuple]:
    """Distinct anchored windows of a batch; behind the further bits of hash, one bit each says: there are two."""
    _, hashes, further, first = _anchored(unpack(row)[1], hits, bits)
    twice = np.diff(np.append(first, len(hashes))) > 1
    hashes, further = hashes[first], further[first]
    return [
        (bucket, row["batch"], encoded(hashes[a:b]), further[a:b].tobytes() + np.packbits(twice[a:b]).tobytes())
        for bucket, a, b in _cuts(hashes, 64, buckets)
    ]


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def found_hits(key: tuple, sent: pa.Table) -> pa.Table:
    """Hashes of a bucket that are a block and another window, for each batch that has them."""
    batches = sent.column("batch").to_pylist()
    lists = [decoded(x) for x in sent.column("entries").to_pylist()]
    values = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    hashes = values >> _U(2)
    first = _runs(hashes)
    copies = np.add.reduceat(1 + ((values >> _U(1)) & _U(1)).astype(np.int64), first)
    block = np.bitwise_or.reduceat(values & _U(1), first).astype(bool)
    hit = np.repeat((copies > 1) & block, np.diff(np.append(first, len(values))))
    owner, hashes = owner[hit], hashes[hit]
    order = np.argsort(owner, kind="stable")  # hashes stay ascending
    owner, hashes = owner[order], hashes[order]
    cuts = np.append(_runs(owner), len(owner)).tolist()
    rows = [(key[0].as_py(), batches[owner[a]], encoded(hashes[a:b]), None) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return _table_of(rows)


def found_repeats(key: tuple, sent: pa.Table) -> pa.Table:
    """For each batch, one bit per window that it sent to a bucket: does it start twice?"""
    batches = sent.column("batch").to_pylist()
    lists = [decoded(x) for x in sent.column("entries").to_pylist()]
    more = sent.column("more").to_pylist()
    values = np.concatenate(lists)
    further = np.concatenate([np.frombuffer(m, np.uint32, len(x)) for m, x in zip(more, lists, strict=True)])
    twice = [np.unpackbits(np.frombuffer(m, np.uint8, offset=4 * len(x)), count=len(x)) for m, x in zip(more, lists, strict=True)]
    order = np.lexsort((further, values))
    values, further = values[order], further[order]
    first = _runs(values, further)
    copies = np.add.reduceat(1 + np.concatenate(twice)[order].astype(np.int64), first)
    hit = np.empty(len(values), bool)
    hit[order] = np.repeat(copies > 1, np.diff(np.append(first, len(values))))
    parts = np.split(hit, np.cumsum([len(x) for x in lists])[:-1])
    rows = [(key[0].as_py(), batch, None, np.packbits(part).tobytes()) for batch, part in zip(batches, parts, strict=True) if part.any()]
    return _table_of(rows)


def hits_of(answers: pa.Table) -> np.ndarray:
    """All hashes that came back to a batch, ascending."""
    rows = sorted((b, e) for b, e in zip(answers.column("bucket").to_pylist(), answers.column("entries").to_pylist(), strict=True) if e is not None)
    return np.concatenate([np.empty(0, _U), *[decoded(e) for _, e in rows]])


def _repeated(texts: Texts, answers: pa.Table, bits: int, buckets: int) -> np.ndarray:
    """Words at which a repeat starts."""
    marks = {b: m for b, m in zip(answers.column("bucket").to_pylist(), answers.column("more").to_pylist(), strict=True) if m is not None}
    if not marks:
        return np.empty(0, np.int64)
    start, hashes, _, first = _anchored(texts, hits_of(answers), bits)
    twice = np.zeros(len(first), bool)
    for bucket, a, b in _cuts(hashes[first], 64, buckets):  # as they were sent
        if bucket in marks:
            twice[a:b] = np.unpackbits(np.frombuffer(marks[bucket], np.uint8), count=b - a)
    return start[np.repeat(twice, np.diff(np.append(first, len(hashes))))]


def kept_words(row: dict, answers: pa.Table, bits: int, buckets: int) -> pa.Table:
    """The texts of a batch without the words that repeats cover."""
    data, texts = unpack(row)
    start = _repeated(texts, answers, bits, buckets)
    edges = np.zeros(len(texts.hash) + WINDOW + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + WINDOW, -1)
    gone = np.cumsum(edges)[: len(texts.hash)] > 0
    removed = np.bincount(texts.text[gone], minlength=len(texts.sizes))
    ends = np.cumsum(texts.sizes)
    kept = []
    for i, end in enumerate(ends.tolist()):
        words = data[end - int(texts.sizes[i]) : end].split()
        if removed[i]:
            here = ~gone[texts.start[i] : texts.start[i] + len(words)]
            words = [words[k] for k in np.flatnonzero(here).tolist()]
        kept.append(b" ".join(words))
    ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
    text = pa.array(kept, pa.binary()).cast(pa.string())
    return pa.table([pa.array(ids, mask=~known), pa.array(texts.count), pa.array(removed), text], ["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every document; ``kept`` is its remaining words, joined by one space.

    Words are runs without space, tab and line breaks, taken as they are.  A window of 35 words is a
    repeat if its words start at any other place of any document, the same one included; repeats are
    judged on the input.  Null and empty texts have no words.  Rows are documents of their own, also
    with equal or null ids, so equal texts of 35 words or more lose all words.  Texts of any length
    are treated whole.  An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    taken = docs.select(F.col("doc_id").cast("long"), "text")
    packed = stored(taken.mapInArrow(pack, _PACKED), "repeats")
    words = packed.agg(F.sum("words")).first()[0] or 0
    bits = block_bits(words)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // BUCKET_ENTRIES))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = probes(batch.slice(i, 1).to_pylist()[0], bits, buckets)
                yield from _table_of(rows).to_batches()

    def extended(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in own.to_pylist() if answers.num_rows else []:
            rows += anchored(row, hits_of(answers), bits, buckets)
        return _table_of(rows)

    def finished(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        found = [kept_words(row, answers, bits, buckets) for row in own.to_pylist()]
        if not found:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
        return pa.concat_tables(found)

    hits = packed.mapInArrow(asked, _SENT).groupBy("bucket").applyInArrow(found_hits, _SENT)
    hits = stored(hits, "repeats")
    texts = packed.groupBy("batch")
    anchors = texts.cogroup(hits.groupBy("batch")).applyInArrow(extended, _SENT)
    repeats = anchors.groupBy("bucket").applyInArrow(found_repeats, _SENT)
    # Nothing is stored in between, so that both steps read one exchange of the texts.
    return texts.cogroup(hits.union(repeats).groupBy("batch")).applyInArrow(finished, _KEPT)
