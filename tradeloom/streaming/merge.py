"""Streaming merge: changes of keyed rows, applied once, whatever their order or repetition.

A change is a complete row with a key, a ``_sequence`` and an optional ``_deleted`` flag.  Of several
changes of a key the one with the greatest sequence counts, within a batch and across batches: a row
only gives way to a greater sequence.  A deletion leaves its row behind as a tombstone, so that an
older change that arrives later does not bring it back.

Every batch has a folder named by its id.  A repeated batch finds it and changes nothing; a batch that
broke off is published from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..sources import rewrite
from ..sources.rewrite import Rewrite

SEQUENCE, DELETED = "_sequence", "_deleted"


def newest(changes: DataFrame, key: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """The last change of every key, reduced on the map side; equal sequences give way to the hash.

    With ``columns`` only these are kept; the hash is that of the whole change.
    """
    order = F.struct(F.col(SEQUENCE), F.xxhash64(*[F.col(c).cast("string") for c in changes.columns]))
    columns = columns or changes.columns
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return last.select(*[F.col("_row")[c].alias(c) for c in columns])


def newer(changes: DataFrame, held: DataFrame, key: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Changes that the rows held so far give way to.

    They meet the held rows first: the reduction then finds its rows together and in order by the key, and
    changes that are known already are not reduced.
    """
    known = held.select(*[F.col(k).alias(f"_key_{k}") for k in key], F.col(SEQUENCE).alias("_known"))
    met = changes.join(known, [F.col(k) == F.col(f"_key_{k}") for k in key], "left")
    met = met.where(F.col("_known").isNull() | (F.col(SEQUENCE) > F.col("_known"))).select(*changes.columns)
    return newest(met, key, columns)


def live(rows: DataFrame) -> DataFrame:
    """A merged table without tombstones and without the columns of the merge."""
    if DELETED in rows.columns:
        rows = rows.where(~F.coalesce(DELETED, F.lit(False)))
    return rows.drop(SEQUENCE, DELETED)


def merge_batch(
    changes: DataFrame, path: str, schema: T.StructType, key: Sequence[str], partition: str | None, folder: str
) -> Rewrite:
    """Merge one batch; ``folder`` belongs to the batch and makes its repetition harmless."""
    spark = changes.sparkSession
    found = rewrite.resume(spark, folder)
    if found is not None:
        return found
    held = rewrite.read_rows(spark, path, schema)
    return rewrite.replace_rows(newer(changes, held, key), path, schema, key, partition, folder=folder)


def stream_merge(
    stream: DataFrame, path: str, key: Sequence[str], partition: str | None, checkpoint: str
) -> StreamingQuery:
    """Merge everything that is available on a stream of changes into a table, then stop.

    The table is created empty where there is none.  ``partition`` is a column of the stream, such as
    a month or ``rewrite.bucket_of(key, n)``; each batch rewrites the partitions it touches.
    """
    spark, schema = stream.sparkSession, stream.schema
    create_empty(spark, path, schema, partition)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, path, schema, key, partition, f"{checkpoint}-batches/{batch_id}")

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def create_empty(spark: SparkSession, path: str, schema: T.StructType, partition: str | None) -> None:
    """A table without rows, unless there is a table."""
    if not rewrite.exists(spark, path):
        rewrite.create(spark.createDataFrame([], schema), path, partition)
