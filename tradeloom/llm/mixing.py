"""Mixing sources to target weights by capped water-filling.

A mix is as large as all documents together.  Sources share it by weight; a source stops at
``max_epochs`` times its words and the excess is shared again by weight until none is above.  A
document is then taken whole ``floor(target / source)`` times.  What is left of the target is one
more, fractional epoch: documents in the order of a seeded hash, whole, until the target is met;
the document at the edge gives its first words only.  The mix hits each target to the word.

Only the edge of each source has to be found.  Words are summed per source and hash range (4096
ranges), the range that holds the edge is picked by a running total, and only its documents are
sorted.  No step holds a source in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import word_array

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
_PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Place of a document in the fractional epoch; rows with equal ids share a place."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


@dataclass(frozen=True)
class Level:
    """Water level: a source below its cap gets ``weight * words / weights``."""

    words: int
    weights: int


def water_level(sources: DataFrame, max_epochs: int) -> Level | None:
    """Raise the level until no source above its cap has excess to share.

    Every round is one small aggregate; the level only rises, so the capped sources of a round stay
    capped and rounds end when their number stands still.
    """
    cap = F.col("total") * max_epochs
    whole, weights = sources.agg(F.sum("total"), F.sum("weight")).first()
    if not whole:
        return None
    level, capped = Level(int(whole), int(weights)), -1
    while True:
        full = cap.cast("double") < F.col("weight") * F.lit(float(level.words)) / F.lit(float(level.weights))
        n, held, open_weights = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if n == capped or not open_weights:
            return level
        level, capped = Level(int(whole) - int(held), int(open_weights)), n


def _weighted(totals: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights in the order of the sources' names, null last, without one big sort."""
    ranged = stored(
        totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    placed = ranged.withColumn("at", F.row_number().over(inside) - 1).join(starts, "part")
    choice = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(choice, (F.pmod(F.col("start") + F.col("at"), F.lit(len(weights))) + 1).cast("int"))
    return placed.select("source", "total", weight.cast("long").alias("weight"))


def quotas(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: its words, target, whole epochs, and the edge of the fractional epoch.

    ``sized`` has ``source, size, place`` and is read several times, so pass a stored frame.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("total"))
    sources = stored(_weighted(totals, weights), "weights")
    level = water_level(sources, max_epochs)
    cap = (F.col("total") * max_epochs).cast("double")
    if level is None:
        target: Column = F.lit(0.0)
    else:
        share = F.col("weight") * F.lit(float(level.words)) / F.lit(float(level.weights))
        target = F.when(cap < share, cap).otherwise(share)
    need = sources.select("source", "total", target.alias("target")).withColumn(
        "whole", F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long")
    )
    need = stored(
        need.withColumn("rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("total")), "targets"
    )
    wanted = need.where("rest > 0").select(F.col("source").alias("of"), "rest")

    # The hash range in which the running total of a source reaches the rest.
    bucketed = sized.withColumn("range", F.substring("place", 1, 3))
    ranges = bucketed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    running = ranges.withColumn("upto", F.sum("words").over(upto))
    edge_range = (
        running.join(wanted, F.col("source").eqNullSafe(F.col("of")))
        .where("upto >= rest and upto - words < rest")
        .select("of", F.col("range").alias("in_range"), "rest", (F.col("upto") - F.col("words")).alias("before"))
    )
    near = bucketed.join(edge_range, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in_range")))
    places = near.groupBy("of", "rest", "before", "place", "size").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("of").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, 0)
    reached = places.withColumn("upto", F.col("before") + F.sum(F.col("size") * F.col("rows")).over(order))
    held_before = F.col("upto") - F.col("size") * F.col("rows")
    edges = reached.where(F.col("upto") >= F.col("rest")).where(held_before < F.col("rest")).select(
        "of",
        F.col("place").alias("edge_place"),
        F.col("size").alias("edge_size"),
        F.floor((F.col("rest") - held_before) / F.col("rows")).cast("long").alias("edge_words"),
    )
    # Stored, so that the next join knows how small it is.
    return stored(need.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "quotas")


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        draw(F.col("doc_id"), seed).alias("place"),
    )


def _extra(place: Column, size: Column) -> Column:
    """Words of a document in the fractional epoch."""
    before = (place < F.col("edge_place")) | ((place == F.col("edge_place")) & (size < F.col("edge_size")))
    at = (place == F.col("edge_place")) & (size == F.col("edge_size"))
    return F.when(before, size).when(at, F.col("edge_words")).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Words taken of each document: ``doc_id, size, source_size, target, taken``.

    Null and empty texts have size 0 and are taken 0 times.  A null source is a source of its own.
    Rows with the same id and size at the edge of the fractional epoch share what is left of the
    target evenly, rounded down.  Other columns are ignored; an empty table gives no rows.
    """
    sized = stored(_sized(docs, seed), "sizes")
    per_source = quotas(sized, weights, max_epochs).withColumnRenamed("source", "of")
    joined = sized.join(per_source, F.col("source").eqNullSafe(F.col("of")))
    taken = F.col("whole") * F.col("size") + _extra(F.col("place"), F.col("size"))
    return joined.select("doc_id", "size", F.col("total").alias("source_size"), "target", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The mix itself: rows repeated as often as they are taken, with all columns of ``docs``.

    A document at the edge of its source's fractional epoch appears once more with its first words;
    its ``n_chars``, if there is such a column, follows the shortened text.
    """
    sized = stored(_sized(docs, seed), "sizes")
    per_source = quotas(sized, weights, max_epochs).withColumnRenamed("source", "of")
    whole_rows = docs.select(
        F.struct("*").alias("doc"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        draw(F.col("doc_id"), seed).alias("place"),
    )
    joined = whole_rows.join(per_source, F.col("source").eqNullSafe(F.col("of")))
    extra = _extra(F.col("place"), F.col("size"))
    counted = joined.select("doc", "size", "whole", extra.alias("extra")).where("size > 0")
    rows = (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).cast("int")
    repeated = counted.where(rows > 0).select("doc", "size", "whole", "extra", F.explode(F.sequence(F.lit(1), rows)).alias("nth"))
    part = (F.col("nth") > F.col("whole")) & (F.col("extra") < F.col("size"))
    pieces = F.regexp_extract_all(F.col("doc.text"), F.lit(_PIECE), F.lit(0))
    text = F.when(part, F.array_join(F.slice(pieces, F.lit(1), F.col("extra").cast("int")), "")).otherwise(F.col("doc.text"))
    cut = repeated.select("doc", text.alias("text"), part.alias("part"))
    columns = []
    for name in docs.columns:
        column = F.col("doc")[name]
        if name == "text":
            column = F.col("text")
        elif name == "n_chars":
            column = F.when(F.col("part"), F.length("text")).otherwise(column).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return cut.select(*columns)
