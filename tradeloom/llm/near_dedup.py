"""Near duplicates by DartMinHash, banding and exact checks.

Similarity is the Jaccard similarity of the sets of five-word shingles; a text of fewer words is one
shingle.  Texts are near duplicates from 0.8 on, and a class is a connected group of them.

1.  Equal texts become one node, by a 128-bit digest.
2.  DartMinHash gives every node a signature.  A shingle owns a plane of weight times rank that is
    cut into unit cells; hashing decides how many darts (Poisson, mean 1) lie in a cell and where.
    Darts inside the shingle's weight and below a rank limit count, each for one hashed coordinate;
    a coordinate keeps its earliest dart.  The limit follows the text's total weight, so a text
    costs about ``k ln k + 2 k`` darts or one per shingle, and is raised where a coordinate is empty.
3.  Nodes that agree on all rows of a band share a bucket.  A bucket is not expanded into pairs: its
    members are compared with its centre, exactly, on the whole texts.  The centre is the member with
    the largest buckets over all bands, so a family of copies has the same centre in most of them.
4.  What this leaves open are links between members of one bucket of which one is unlike the centre.
    All members beside such a centre are compared with each other exactly, by what sets them apart
    from the centre (``_differences``): if X and the centre are not linked, but X and Y are, then X
    and Y share more than a ninth of the centre's shingles as common differences.  So members meet
    in posting lists of differences, the template itself is never read, and their similarity
    follows from sizes and the number of shared differences.

No bucket, member or pair is capped: two nodes that share a bucket are always decided, by themselves
or by links through others.  A pair at exactly 0.8 shares no band with probability
``(1 - 0.8 ** 6) ** 32`` = 6e-5.  The work is linear in the members of buckets, besides the posting
lists of a family with near misses, which grow with the square of its members that share a
difference.  Large families are cut into blocks, and pairs of blocks are dealt over the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import pieces_of, small_batches
from .components import components

SHINGLE = 5
ROWS, BANDS = 6, 32
SIMILARITY = (4, 5)  # at least 4 / 5

_U = np.uint64
_RANK_BITS = 38
_FRACTION = 26
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A good 64-bit mixer (multiply and shift)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts: text number and hash, sorted by text."""
    words: list[bytes] = []
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        cut = text.split()
        sizes[i] = len(cut)
        words.extend(cut)
    if not words:
        return np.empty(0, np.int64), np.empty(0, _U)
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], _U)[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - starts[owner]
    left = sizes[owner] - place
    first = (left >= width) | ((place == 0) & (left < width))
    at = np.flatnonzero(first)
    value = np.zeros(len(at), _U)
    for j in range(width):
        here = j < left[at]
        step = mixed(hashes[np.minimum(at + j, len(words) - 1)] + _U(1))
        value = np.where(here, value * _U(0x9E3779B97F4A7C15) + step, value)
    value = mixed(value)
    owner = owner[at]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int, seed: int = 0) -> np.ndarray:
    """DartMinHash: for texts 0 to n - 1 the rank of the earliest dart at each of k coordinates.

    ``owner`` says which text an element with its weight belongs to.  Texts without weight get the
    largest rank everywhere.  Two texts agree on a coordinate with the probability of their weighted
    Jaccard similarity.
    """
    out = np.full((n, k), np.iinfo(np.uint64).max, _U)
    element = mixed(element + _U(seed) * _U(0x9E3779B97F4A7C15))
    darts = k * math.log(k) + 2 * k
    total = np.bincount(owner, weight, n)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        active = np.zeros(n, bool)
        active[todo] = True
        mine = active[owner]
        filled = _throw(owner[mine], element[mine], weight[mine], darts / np.maximum(total, 1e-12), k)
        slot = (filled >> _U(_RANK_BITS)).astype(np.int64)
        out.reshape(-1)[slot] = filled & _U((1 << _RANK_BITS) - 1)
        missing = (out[todo] == np.iinfo(np.uint64).max).any(axis=1)
        todo, darts = todo[missing], darts * 2
    return out


def _throw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray, k: int) -> np.ndarray:
    """Earliest dart per text and coordinate, as ``(text * k + coordinate) << 38 | rank``."""
    across = np.ceil(weight).astype(np.int64)
    along = np.ceil(limit[owner]).astype(np.int64)
    cells = across * along
    which = np.repeat(np.arange(len(owner)), cells)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
    rank_cell, weight_cell = inside % along[which], inside // along[which]
    seed = mixed(element[which] + mixed((rank_cell.astype(_U) << _U(20)) + weight_cell.astype(_U) + _U(1)))
    count = np.searchsorted(_POISSON, (seed >> _U(11)) * 2.0**-53, side="right")
    dart = np.repeat(np.arange(len(which)), count)
    nth = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
    draw = mixed(seed[dart] + (nth.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    rank = (rank_cell[dart].astype(_U) << _U(_FRACTION)) + (draw >> _U(64 - _FRACTION))
    other = mixed(draw)
    item = which[dart]
    above = weight_cell[dart] + (other >> _U(40)) * 2.0**-24
    good = (above < weight[item]) & (rank * 2.0**-_FRACTION < limit[owner[item]])
    coordinate = (other & _U(0xFFFFFFFF)) % _U(k)
    key = ((owner[item[good]].astype(_U) * _U(k) + coordinate[good]) << _U(_RANK_BITS)) | rank[good]
    key.sort()
    slot = key >> _U(_RANK_BITS)
    first = np.ones(len(key), bool)
    first[1:] = slot[1:] != slot[:-1]
    return key[first]


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One key per band; texts share it if they agree on all its rows."""
    grouped = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), grouped.shape[:2]).copy()
    for i in range(rows):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + grouped[:, :, i])
    return key.view(np.int64)


def shingle_set(text: bytes, width: int = SHINGLE) -> set[tuple[bytes, ...]]:
    words = text.split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(width)], strict=False))


_SCAN = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])
_PAIR = pa.schema([(n, pa.int64()) for n in ("a", "b", "size_a", "size_b", "common")])
_APART = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("apart", pa.list_(pa.int64()))])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
BLOCK_MEMBERS, BLOCK_ELEMENTS = 1024, 1 << 21  # of a family, in one block


def _digest() -> F.Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _bands_of(texts: list[bytes], rows: int, bands: int, seed: int) -> pa.Array:
    """Band keys of texts, as a list per text; none for a text without words."""
    owner, value = shingle_hashes(texts)
    keys = band_keys(signatures(owner, value, np.ones(len(value)), len(texts), rows * bands, seed), rows, bands)
    has = np.bincount(owner, minlength=len(texts)) > 0
    offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[has].reshape(-1)))
    return lists.cast(pa.list_(pa.int64()))


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.large_binary()).to_pylist()]


def _scan(docs: DataFrame, rows: int, bands: int) -> DataFrame:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in pieces_of(batches, "text", 4 << 20):
            numbers = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([numbers, batch.column("doc_id"), batch.column("digest"), _bands_of(_bytes(batch), rows, bands, 0)], schema=_SCAN)

    return docs.mapInArrow(scan, "row long, doc_id long, digest binary, bands array<long>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """Members of buckets with company, and the centre of each bucket: ``bucket, node, centre``."""
    keys = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    company = stored(keys.join(sizes, "bucket"), "company")
    # The text that the others are copies of shares most of its buckets with most of them.  As the
    # centre of all these buckets it is compared with each copy once.
    score = company.groupBy("node").agg(F.sum("n").alias("score"))
    ranked = company.select("bucket", "node").join(score, "node")
    centres = ranked.groupBy("bucket").agg(F.min(F.struct(-F.col("score"), "node")).alias("c")).select("bucket", F.col("c.node").alias("centre"))
    return stored(company.select("bucket", "node").join(centres, "bucket"), "buckets")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with both texts; they go to b, the node that many pairs share."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact shingle counts of pairs of nodes: ``a, b, size_a, size_b, common``."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            out = []
            for a, b, mine, other in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "a_text", "b_text")], strict=True):
                if b != last:
                    last, held = b, shingle_set(other.encode())
                own = shingle_set(mine.encode())
                out.append((a, b, len(own), len(held), len(own & held)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PAIR, strict=True)], schema=_PAIR)

    return _with_texts(pairs, texts).mapInArrow(compare, ", ".join(f"{n} long" for n in _PAIR.names))


def _differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Hashes of the shingles that only one text of a pair has: ``a, b, apart``."""

    def differ(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.empty(0, _U)
        for batch in batches:
            for piece in pieces_of([batch], "a_text", 4 << 20):
                owner, value = shingle_hashes([x.encode() for x in piece.column("a_text").to_pylist()])
                ends = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                apart = []
                for i, b in enumerate(piece.column("b").to_pylist()):
                    if b != last:
                        last, held = b, shingle_hashes([piece.column("b_text")[i].as_py().encode()])[1]
                    apart.append(np.setxor1d(value[ends[i] : ends[i + 1]], held, assume_unique=True).view(np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in apart])])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(apart)))
                yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b"), lists.cast(_APART.field("apart").type)], schema=_APART)

    return _with_texts(pairs, texts).mapInArrow(differ, "a long, b long, apart array<long>")


def linked_members(size: np.ndarray, unlike: np.ndarray, label: np.ndarray, block: np.ndarray, apart: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join components, among the members of a family: pairs of places.

    A member has a size, its differences from the centre, whether it is unlike the centre, and the
    component known so far.  With blocks of two numbers only members of different blocks are
    compared.  Links within a component, also one that earlier links made, are left out, so there are
    fewer links than members.
    """
    n = len(size)
    distance = np.array([len(x) for x in apart], np.int64)
    owner = np.repeat(np.arange(n), distance)
    _, element = np.unique(np.concatenate(apart), return_inverse=True)
    held = np.bincount(element)
    common = held[element] > 1  # what only one member has is never shared
    owner, element = owner[common], element[common]
    order = np.argsort(element, kind="stable")
    posting, first = owner[order], np.cumsum(held * (held > 1)) - held * (held > 1)
    ends = np.searchsorted(owner, np.arange(n + 1))
    label, out = label.copy(), []
    two = len(np.unique(block)) > 1
    for x in np.flatnonzero(unlike):
        mine = element[ends[x] : ends[x + 1]]
        length = held[mine]
        at = np.repeat(first[mine] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        shared = np.bincount(posting[at], minlength=n)
        # Texts are linked if at most a ninth of their sizes sets them apart.
        near = 9 * (distance[x] + distance - 2 * shared) <= size[x] + size
        if two:
            near &= block != block[x]
        for y in np.flatnonzero(near & (label != label[x])):
            if label[y] != label[x]:
                out.append((int(x), int(y)))
                label[label == label[y]] = label[x]
    return out


def _links_beside(compared: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of different components between members beside one centre, ``a, b``."""
    known = labels.select(F.col("node").alias("a"), "component")
    members = compared.withColumn("unlike", ~linked()).join(known, "a", "left").withColumn("component", F.coalesce("component", "a"))
    members = members.withColumn("distance", F.col("size_a") + F.col("size_b") - 2 * F.col("common"))
    # A family of one component, or without a member unlike its centre, has no open links.
    family = members.groupBy("b").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("distance").alias("elements"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.bool_or("unlike").alias("any"),
    )
    family = family.where("any and n > 1 and least <> most")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("elements") / BLOCK_ELEMENTS), F.lit(1)).cast("int")
    family = family.select("b", blocks.alias("blocks"))
    wanted = stored(members.join(family, "b").select("a", "b", "size_a", "unlike", "component", "blocks"), "open")
    apart = _differences(wanted, texts)
    block = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    row = apart.join(wanted, ["a", "b"]).withColumn("block", block)
    # A block meets every block of its family, itself included.
    row = row.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    row = row.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    dealt = row.select("b", "i", "j", "a", "size_a", "unlike", "component", "block", "apart").repartition("b", "i", "j").sortWithinPartitions("b", "i", "j", "a")

    def link(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        node, size, unlike, label, block = (t.column(c).to_numpy() for c in ("a", "size_a", "unlike", "component", "block"))
        lists = [x for c in t.column("apart").chunks for x in np.split(c.flatten().to_numpy(), np.cumsum(np.diff(c.offsets.to_numpy()))[:-1])]
        found = linked_members(size, unlike, label, block, lists) if unlike.any() else []
        return pa.RecordBatch.from_arrays([pa.array([int(node[f[k]]) for f in found], pa.int64()) for k in (0, 1)], schema=_LINK)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("b", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if tuple(key[start]) != last and held:
                    yield link(held)
                    held = []
                last = tuple(key[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield link(held)

    return dealt.mapInArrow(meet, "a long, b long")


def classes(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Near-duplicate classes: ``doc_id, class_id, kept`` and the inner ``row, digest``, per input row.

    ``class_id`` is the smallest ``doc_id`` of the class; ``kept`` marks one row of it, the first
    with that id.  A null text is a class of its own; empty texts and texts of white space have no
    shingles and are only duplicates of equal texts.  Repeated rows are copies.  Null ids come last
    and give a null ``class_id`` only if a class has no other.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("digest", _digest())
    scanned = stored(_scan(own, rows, bands), "signatures")
    named = scanned.where("digest is not null")
    # The row that stands for all copies of a text; ids are read again with the texts.
    nodes = stored(
        named.groupBy("digest").agg(F.min(F.struct("row", "doc_id", "bands")).alias("s")).select("digest", "s.row", "s.doc_id", "s.bands").withColumnRenamed("row", "node"),
        "nodes",
    )
    labels = _components(own, nodes, rows, bands)
    member = named.select("row", "doc_id", "digest").join(nodes.select("digest", "node"), "digest").join(labels, "node", "left")
    member = member.select("row", "doc_id", "digest", F.coalesce("component", "node").alias("class"))
    member = stored(member.union(scanned.where("digest is null").select("row", "doc_id", "digest", F.col("row").alias("class"))), "members")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("class_id"), F.col("row").alias("first"))
    heads = member.groupBy("class").agg(F.min(first).alias("head")).select("class", "head.class_id", "head.first")
    return member.join(heads, "class").select("doc_id", "class_id", (F.col("row") == F.col("first")).alias("kept"), "row", "digest")


def _components(own: DataFrame, nodes: DataFrame, rows: int, bands: int) -> DataFrame:
    """Component of every node that is linked to another one."""
    shared = _buckets(nodes.select("node", "bands"))
    beside = shared.where("node <> centre")
    pairs = stored(beside.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    involved = shared.select("node").distinct()
    wanted = nodes.join(involved, "node").select("node", F.col("digest").alias("w_digest"), F.col("doc_id").alias("w_doc_id"))
    texts = own.join(wanted, (F.col("digest") == F.col("w_digest")) & F.col("doc_id").eqNullSafe(F.col("w_doc_id")))
    texts = stored(texts.select("node", "text").dropDuplicates(["node"]), "texts")
    compared = stored(_compare(pairs, texts), "compared")
    links = compared.where(linked()).select("a", "b")
    labels = stored(components(links), "components")
    found = stored(_links_beside(compared, labels, texts), "links")
    if not found.take(1):
        return labels
    return stored(components(links.union(found)), "components")


def linked() -> F.Column:
    """Whether a compared pair is similar enough."""
    either = F.col("size_a") + F.col("size_b") - F.col("common")
    return F.col("common") * SIMILARITY[1] >= either * SIMILARITY[0]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, kept`` for every row; see ``classes``."""
    return classes(docs).select("doc_id", "class_id", "kept")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns; rows without text stay."""
    held = classes(docs).where("kept and digest is not null").select(F.col("doc_id").alias("k_doc_id"), F.col("digest").alias("k_digest"))
    wrapped = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = wrapped.select("doc", "doc_id", _digest().alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & (F.col("digest") == F.col("k_digest"))
    kept = keyed.join(held, same, "left_semi").dropDuplicates(["doc_id", "digest"])
    return kept.select("doc.*").union(keyed.where("digest is null").select("doc.*"))
