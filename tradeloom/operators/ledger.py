"""Append-only stock ledger: edits and deletions of documents are written as reversing movements.

A document (a sale or a purchase) arrives in versions.  The ledger never changes a row: a new version
books the difference to what the ledger holds of the document, product by product, and a deletion
books all of it back.  So the balance at any day, and the balance as it was known at any moment, are sums
of movements, and the ledger's total equals a rebuild from the last versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Columns of a movement: ``quantity`` is signed, ``version`` says which change of the document booked it.
MOVEMENT = "kind string, document_id long, version long, product_id long, date date, quantity long, reversal boolean"
_KEY = ["kind", "document_id", "product_id", "date"]


def versions_of(items: DataFrame, headers: DataFrame, kind: str, sign: int) -> DataFrame:
    """Signed quantities per document version, product and day.

    ``headers`` has ``id, version, date, deleted``; ``items`` has ``id, version, product_id, quantity``.
    """
    summed = items.groupBy("id", "version", "product_id").agg((F.sum(F.col("quantity").cast("long")) * sign).alias("quantity"))
    return headers.join(summed, ["id", "version"], "left").select(
        F.lit(kind).alias("kind"), F.col("id").cast("long").alias("document_id"), F.col("version").cast("long").alias("version"),
        F.col("product_id").cast("long").alias("product_id"), F.col("date").cast("date").alias("date"),
        F.coalesce("quantity", F.lit(0)).cast("long").alias("quantity"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
    )


def new_movements(ledger: DataFrame, versions: DataFrame) -> DataFrame:
    """Movements that bring the ledger to the last of some document versions.

    Versions that the ledger already holds, or that are older than what it holds, book nothing, so a
    repeated or late batch is harmless.  Only documents that occur in ``versions`` are read of the
    ledger.  A document whose date moves is booked out on the old day and in on the new one.
    """
    document = ["kind", "document_id"]
    versions = stored(versions, "versions")
    held = ledger.join(versions.select(*document).distinct(), document, "left_semi")
    counted = (~F.col("deleted")).alias("counted")
    rows = versions.select(*_KEY, "version", "quantity", counted, F.lit(True).alias("came")).unionByName(
        held.select(*_KEY, "version", "quantity", F.lit(True).alias("counted"), F.lit(False).alias("came"))
    )
    # One exchange by document: what came last, what is known, and the sums all follow within it.
    own, came = Window.partitionBy(*document), F.col("came")
    rows = rows.withColumns(
        {"_last": F.max(F.when(came, F.col("version"))).over(own), "_known": F.max(F.when(~came, F.col("version"))).over(own)}
    )
    fresh = rows.where(F.col("_known").isNull() | (F.col("_last") > F.col("_known")))
    whole = F.col("document_id").isNotNull() & F.col("kind").isNotNull() & F.col("product_id").isNotNull()
    counts = whole & F.col("counted") & (~came | (F.col("version") == F.col("_last")))
    zero = F.lit(0).cast("long")
    # Every version leaves a mark, also one that moves nothing, so that older ones stay harmless.
    side = F.struct(
        F.lit(False).alias("mark"), "product_id", "date", F.when(came, F.col("quantity")).otherwise(zero).alias("wanted"),
        F.when(came, zero).otherwise(F.col("quantity")).alias("held"),
    )
    mark = F.struct(
        F.lit(True).alias("mark"), F.lit(None).cast("long").alias("product_id"), F.lit(None).cast("date").alias("date"),
        zero.alias("wanted"), zero.alias("held"),
    )
    sides = fresh.select(*document, "_last", F.explode(F.when(counts, F.array(side, mark)).otherwise(F.array(mark))).alias("s"))
    moved = sides.select(*document, "_last", "s.*").groupBy(*_KEY, "mark").agg(
        F.max("_last").alias("version"), F.sum("wanted").alias("wanted"), F.sum("held").alias("held")
    )
    return moved.where(F.col("mark") | (F.col("wanted") != F.col("held"))).select(
        *document, "version", "product_id", "date", (F.col("wanted") - F.col("held")).alias("quantity"),
        (F.col("held") != 0).alias("reversal"),
    )


def balance(ledger: DataFrame, until: str | None = None, known_at: int | None = None) -> DataFrame:
    """Stock change per product, up to a day, and as the ledger knew it after a version."""
    rows = ledger.where("product_id IS NOT NULL")
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(until).cast("date"))
    if known_at is not None:
        rows = rows.where(F.col("version") <= known_at)
    return rows.groupBy("product_id").agg(F.sum("quantity").alias("on_hand"))


def running_balance(ledger: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Balance at the end of every day with a movement; days are summed first, so a window holds one row per day."""
    days = ledger.where("product_id IS NOT NULL").groupBy(*keys, "date").agg(F.sum("quantity").alias("change"))
    order = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("on_hand", F.sum("change").over(order))
