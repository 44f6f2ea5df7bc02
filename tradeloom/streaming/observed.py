"""Expectations on a stream, counted by ``observe`` while the rows are written.

Every batch is written by one job, split by whether a drop rule rejects the row; the counts of all
rules come from the progress of the query.  Nothing is persisted and no rule costs a job.  Every
batch has a folder by its id, for its rows and for its counts, which a repeated batch replaces.

Progress is kept by the driver alone and only for the last batches, so counts can be lost: a driver
that ends between a batch and its record, or a backlog of more batches than the query remembers.
Such batches are counted again from their rows, which are all kept, with the same rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.quality import FAIL, Rule, expectation_metrics, failed_rules, of_action
from ..sources.rewrite import exists

METRICS = (
    "batch bigint, table_name string, rule string, condition string, action string, violations bigint, "
    "checked_rows bigint"
)
_EVENT = "expectations"


def observed(stream: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The stream with ``failed_rules`` and ``quarantined``, and its rules under observation.

    A row that a fail rule rejects ends the query, unless a drop rule rejects it as well.
    """
    rows = stream.withColumn("failed_rules", failed_rules(of_action(rules, "drop")))
    rows = rows.withColumn("quarantined", F.size("failed_rules") > 0)
    for rule in of_action(rules, FAIL):
        message = F.lit(f"expectation failed: rule='{rule.name}', condition='{rule.condition}'")
        stops = ~F.col("quarantined") & rule.violated()
        rows = rows.where(F.when(stops, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    counts = [F.count_if(r.violated()).alias(f"_v{i}") for i, r in enumerate(rules)]
    return rows.observe(_EVENT, F.count(F.lit(1)).alias("_rows"), *counts)


def progress_metrics(query: StreamingQuery, rules: Sequence[Rule], table: str) -> list[tuple]:
    """Rows of ``METRICS`` for the batches that the query still remembers."""
    out = []
    for step in query.recentProgress:
        seen = step.observedMetrics.get(_EVENT)
        if seen is not None:
            out += [
                (step.batchId, table, r.name, r.condition, r.action, seen[f"_v{i}"], seen["_rows"])
                for i, r in enumerate(rules)
            ]
    return out


def stream_dq(
    stream: DataFrame, rules: Sequence[Rule], table: str, path: str, metrics_path: str, checkpoint: str
) -> StreamingQuery:
    """Take what has arrived: rows go to ``path``, counts per batch and rule to ``metrics_path``.

    Empty batches leave no rows and count as zero.  Repeated rows count as often as they arrive.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("quarantined").parquet(f"{path}/batch={batch_id}")

    rows = observed(stream, rules)
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = progress_metrics(query, rules, table)
    record(stream.sparkSession, seen, rules, table, path, metrics_path, rows.schema)
    return query


def record(
    spark: SparkSession, seen: list[tuple], rules: Sequence[Rule], table: str, path: str, metrics_path: str,
    schema: T.StructType,
) -> None:
    """Store observed counts, and count the batches that have rows (of the schema) but no counts."""
    _replace(spark.createDataFrame(seen, METRICS), metrics_path)
    if not exists(spark, path):
        return
    # One number per batch; the scan reads no column.
    written = {r.batch for r in _rows(spark, path, schema).select("batch").distinct().collect()}
    counted = {r.batch for r in metrics(spark, metrics_path).select("batch").distinct().collect()}
    for lost in sorted(written - counted):
        again = expectation_metrics(_rows(spark, path, schema).where(F.col("batch") == lost), rules, table)
        _replace(again.withColumn("batch", F.lit(lost).cast("bigint")), metrics_path)


def _replace(counts: DataFrame, metrics_path: str) -> None:
    writer = counts.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(metrics_path)


def _rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    # The reader guesses types of partition columns from the names of folders.
    typed = {"batch": F.col("batch").cast("bigint"), "quarantined": F.col("quarantined").cast("boolean")}
    reader = spark.read.option("basePath", path)
    if schema is not None:  # folders of empty batches have no file to tell it
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    return reader.parquet(path).withColumns(typed)


def metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Counts per batch, rule and table so far."""
    names = [f.split()[0] for f in METRICS.split(", ")]
    return spark.read.schema(METRICS).parquet(metrics_path).select(*names)


def totals(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Counts per rule over all batches, in the columns of ``expectation_metrics``."""
    return metrics(spark, metrics_path).groupBy("table_name", "rule", "condition", "action").agg(
        F.sum("violations").alias("violations"), F.sum("checked_rows").alias("checked_rows")
    )


def good_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows that passed every drop rule; only their folders are read."""
    return _rows(spark, path, schema).where(~F.col("quarantined")).drop("failed_rules", "quarantined", "batch")


def quarantined_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rejected rows with the names of the rules they fail; only their folders are read."""
    return _rows(spark, path, schema).where("quarantined").drop("quarantined", "batch")
