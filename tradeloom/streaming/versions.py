"""Type-2 history kept up to date with late and out-of-order changes.

The events of a dimension are merged by key and day (``merge``): a repeated or older event changes
nothing, a deletion stays as a tombstone.  Then the versions of the keys concerned are spliced anew
from their events and replaced in the buckets that hold them.  So the history is the same for every
order in which the changes arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import history
from ..sources import rewrite
from ..sources.rewrite import BUCKET, bucket_of
from .merge import create_empty, merge_batch

BUCKETS = 16


class MaintainedHistory:
    """Events and versions of a dimension below a folder.

    Changes have the key, the tracked columns, ``valid_from``, ``_sequence`` and optionally
    ``_deleted``.  Of several events of a key and day the one with the greatest sequence counts.
    """

    def __init__(self, spark: SparkSession, key: str, tracked: Sequence[str], root: str, changes: T.StructType) -> None:
        self.spark, self.key, self.tracked, self.root = spark, key, list(tracked), root
        bucket = T.StructField(BUCKET, T.StringType())
        self.events_schema = T.StructType([*changes, bucket])
        versions = history.history_of(spark.createDataFrame([], changes), key, self.tracked).schema
        self.versions_schema = T.StructType([*versions, bucket])
        create_empty(spark, f"{root}/events", self.events_schema, BUCKET)
        create_empty(spark, f"{root}/versions", self.versions_schema, BUCKET)

    def apply(self, changes: DataFrame, folder: str) -> rewrite.Rewrite:
        """Apply a batch of changes; ``folder`` belongs to the batch and makes its repetition harmless."""
        key, placed = self.key, bucket_of([self.key], BUCKETS)
        rows = rewrite.once(changes.withColumn(BUCKET, placed), f"{folder}/changes")
        merge_batch(rows, f"{self.root}/events", self.events_schema, [key, "valid_from"], BUCKET, f"{folder}/events")
        events = rewrite.read_rows(self.spark, f"{self.root}/events", self.events_schema)
        # The buckets of the changed keys are all that has to be read of the events.
        keys = rows.select(key, BUCKET).distinct()
        own = rewrite.once(events.join(keys, [key, BUCKET], "left_semi"), f"{folder}/own")
        versions = history.history_of(own, key, self.tracked).withColumn(BUCKET, placed)
        path = f"{self.root}/versions"
        return rewrite.replace_rows(
            versions, path, self.versions_schema, [key], BUCKET, removed=keys, folder=f"{folder}/versions"
        )

    def versions(self) -> DataFrame:
        return rewrite.read_rows(self.spark, f"{self.root}/versions", self.versions_schema).drop(BUCKET)


def stream_history(
    stream: DataFrame, key: str, tracked: Sequence[str], root: str, checkpoint: str
) -> StreamingQuery:
    """Keep a type-2 history up to date with a stream of changes; takes what is available, then stops."""
    held = MaintainedHistory(stream.sparkSession, key, tracked, root, stream.schema)
    query = (
        stream.writeStream.foreachBatch(lambda batch, n: held.apply(batch, f"{checkpoint}-batches/{n}") and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
