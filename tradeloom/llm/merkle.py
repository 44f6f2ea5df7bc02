"""Merkle manifest of a table: every row is a leaf, every group a subtree, and one root above all.

A level is built by a sibling-shift self-join.  Node ``i`` of a tree computes the indices of its
siblings, the other slots of its run of ``fan_out`` nodes (``i XOR 1`` for binary trees, slot offsets
otherwise), and sends them its digest; nodes equijoin what was sent to their own index.  Afterwards
every node knows its siblings, and the nodes in slot zero emit the parents.  No run is gathered by a
group key that holds more than ``fan_out`` nodes, so a group with most of the rows costs no more than
many small ones.

Going back down, the siblings of a node are put before its parent's: a child joins its parent, so no
key has more than ``fan_out`` rows, however many leaves lie below it.

Indices come from a range sort of the digests (texts are not shuffled) and the row counts of the
ranges.  Ranges are cut by (group, id, digest, place in the scan), so neither a hot group nor rows
with one id meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import crc32_of_id

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(data: Column) -> Column:
    """SHA-256 of bytes or text, as 32 bytes."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def parent_of(digests: Column) -> Column:
    """Digest over concatenated digests, which count as lowercase hex text."""
    return digest_of(hex_of(digests))


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf_of(values: list[Column]) -> Column:
    """Digest of a row: every value as its UTF-8 length, a colon and itself, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return digest_of(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``idx``, the place of a row among those of its ``tree``, and ``n``, how many there are."""
    keys = ["tree", *order, "tie_"]
    placed = nodes.withColumn("tie_", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The id holds the range in its upper bits and the place in the range below.
    placed = stored(placed.drop("tie_").withColumn("at_", F.monotonically_increasing_id()), "merkle")
    placed = placed.withColumn("range_", F.shiftright("at_", 33))
    runs = placed.groupBy("tree", "range_").agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("rows_"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before_", F.coalesce(F.sum("rows_").over(before), F.lit(0))).withColumn("n", F.sum("rows_").over(whole))
    found = placed.join(runs, ["tree", "range_"])
    return found.withColumn("idx", F.col("at_") - F.col("first_") + F.col("before_")).drop("at_", "range_", "first_", "rows_", "before_")


def with_siblings(nodes: DataFrame, fan_out: int, carry: list[str]) -> DataFrame:
    """Nodes of one level with the digests ``before`` and ``after`` them in their run."""
    idx, slot = F.col("idx"), F.col("idx") % fan_out
    if fan_out == 2:
        siblings = F.array(idx.bitwiseXOR(F.lit(1).cast("long")))
    else:
        siblings = F.array(*[idx - slot + (slot + step) % fan_out for step in range(1, fan_out)])
    sent = nodes.select("tree", F.explode(siblings).alias("idx"), idx.alias("from_"), F.col("digest").alias("sent_"), "n")
    sent = sent.where(F.col("idx") < F.col("n")).drop("n")
    own = nodes.select("tree", "idx", "digest", "n", *carry)
    met = own.join(sent, ["tree", "idx"], "left")
    kept = [F.first(c).alias(c) for c in ["digest", "n", *carry]]
    heard = F.when(F.col("from_").isNotNull(), F.struct("from_", "sent_"))
    found = met.groupBy("tree", "idx").agg(*kept, F.sort_array(F.collect_list(heard)).alias("heard_"))

    def joined(side) -> Column:
        return F.aggregate(F.filter("heard_", side), F.lit(b""), lambda out, x: F.concat(out, x["sent_"]))

    return found.select(
        "tree", "idx", "digest", "n", *carry,
        joined(lambda x: x["from_"] < F.col("idx")).alias("before"), joined(lambda x: x["from_"] > F.col("idx")).alias("after"),
    )


def climb(leaves: DataFrame, fan_out: int, carry: list[str]) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels with siblings, from the leaves up, and per level the tops of the trees that end there."""
    levels, tops, nodes = [], [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most:
        tops.append(nodes.where("n = 1"))
        if most == 1:
            break
        level = stored(with_siblings(nodes.where("n > 1"), fan_out, carry), "merkle")
        levels.append(level)
        parent = parent_of(F.concat("digest", "after")).alias("digest")
        up = [F.expr(f"idx div {fan_out}").alias("idx"), F.ceil(F.col("n") / fan_out).alias("n")]
        nodes = level.where(F.col("idx") % fan_out == 0).select("tree", parent, *up)
        most, carry = -(-most // fan_out), []
    return levels, tops


def descend(levels: list[DataFrame], tops: list[DataFrame], above: DataFrame, fan_out: int, carry: list[str]) -> DataFrame:
    """Leaves with ``siblings`` from their own level to the root.

    ``above`` has one row per tree: its ``top`` digest and the siblings of its top.
    """
    known = None
    for k in range(len(tops) - 1, -1, -1):
        payload = carry if k == 0 else []
        ends = tops[k].select("tree", "idx", "digest", *payload).join(above, "tree")
        here = ends.select("tree", "idx", "digest", *payload, "top", "siblings")
        if k < len(levels):
            parents = known.select("tree", F.col("idx").alias("parent_"), "top", F.col("siblings").alias("further_"))
            level = levels[k].withColumn("parent_", F.expr(f"idx div {fan_out}")).join(parents, ["tree", "parent_"])
            own = F.array(F.struct("before", "after"))
            here = here.unionByName(
                level.select("tree", "idx", "digest", *payload, "top", F.concat(own, F.col("further_")).alias("siblings"))
            )
        known = here
    return known


def _no_siblings() -> Column:
    return F.array().cast("array<struct<before:binary,after:binary>>")


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, leaf, lambda node, x: parent_of(F.concat(x["before"], node, x["after"])))


def proof_digest(siblings: Column) -> Column:
    """Digest over all siblings, level by level, from left to right."""
    return parent_of(F.aggregate(siblings, F.lit(b""), lambda out, x: F.concat(out, x["before"], x["after"])))


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, siblings`` and the ``extra`` columns, digests as bytes.

    A leaf covers ``doc_id, source, lang, n_chars, text``.  Leaves of one ``lang`` (null is a group of
    its own) form a subtree in the order of ``doc_id``, null first, rows with one id by their digest;
    equal rows have equal digests, so their order does not matter.  A lone leaf is its subroot.
    Subroots, null first and then by UTF-8 bytes, form the tree of the root.  ``siblings`` holds per
    level the concatenated digests before and after the node.  An empty table gives an empty manifest.
    Null and empty texts are different leaves; texts of any length are hashed whole; further columns
    are ignored, whatever their names.
    """
    extra = extra or {}
    values = [F.col(f) for f in FIELDS]
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    leaves = docs.select(
        tree.alias("tree"), "doc_id", leaf_of(values).alias("digest"), *[c.alias(f"extra_{name}") for name, c in extra.items()]
    )
    carry = ["doc_id", *[f"extra_{name}" for name in extra]]
    leaves = stored(numbered(stored(leaves, "merkle"), ["doc_id", "digest"]), "merkle")
    levels, tops = climb(leaves, fan_out, carry)
    if not tops:
        empty = leaves.select("doc_id", *[F.col("digest").alias(c) for c in ("leaf", "subroot", "root")], _no_siblings().alias("siblings"), *_named(extra))
        return empty
    subroots = tops[0].select("tree", "digest")
    for top in tops[1:]:
        subroots = subroots.unionByName(top.select("tree", "digest"))
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = stored(numbered(subroots, ["name"]), "merkle")
    upper, ends = climb(subroots, fan_out, ["name"])
    root = ends[-1].first()["digest"]
    whole = ends[-1].select("tree", F.col("digest").alias("top"), _no_siblings().alias("siblings"))
    above = descend(upper, ends, whole, fan_out, ["name"])
    above = stored(above.select(F.col("name").alias("tree"), F.col("digest").alias("top"), "siblings"), "merkle")
    found = descend(levels, tops, above, fan_out, carry)
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(bytes(root)).alias("root"), "siblings", *_named(extra)
    )


def _named(extra: dict[str, Column]) -> list[Column]:
    return [F.col(f"extra_{name}").alias(name) for name in extra]


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest with proofs, checked against rows of which every third id has its capitals lowered.

    A row without id is not altered, nor is a null text.
    """
    altered = F.col("doc_id").isNotNull() & (crc32_of_id(F.col("doc_id")) % 3 == 0)
    lowered = F.translate("text", _UPPER, _LOWER)
    values = [lowered if f == "text" else F.col(f) for f in FIELDS]
    found = manifest(docs, {"now": F.when(altered, leaf_of(values))})
    folded = found.withColumn("folded", fold(F.coalesce("now", "leaf"), F.col("siblings")))
    return folded.select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), hex_of(F.col("root")).alias("root"),
        hex_of(proof_digest(F.col("siblings"))).alias("proof_sha256"), hex_of(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
