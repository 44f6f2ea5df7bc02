"""Incremental layers: new files only, the batch functions unchanged, exactly-once file sinks.

Facts are streams and the tables they look up stay static: children of an order or contract are
summed on the static side, so no stream keeps state and no watermark is needed.  Each run uses
``availableNow``: it takes what has arrived since the last run and stops.

Tables without a stream (employees, geography, contracts as a dimension, cost centres, sectors,
actuals, inventory) are rebuilt in batch.  Aging depends on the day of reading, so the stored
stream keeps dates and ``aging_at_read`` adds ages when the table is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import columns as c
from ..operators import dims, facts, silver
from ..session import stored, tidy
from ..sources.ingest import CORRUPT, csv_schema

AsOf = dt.date | str | None


def run_available(
    stream: DataFrame, path: str, checkpoint: str, table: str | None = None
) -> StreamingQuery:
    """Append everything that is available to a parquet folder, then stop.

    The sink's commit log makes the output exactly-once even when a batch is repeated.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("compression", "zstd")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with tidy(stream.sparkSession):
        query = (writer.queryName(table) if table else writer).start()
    query.awaitTermination()
    return query


# ---- raw ---------------------------------------------------------------------------------------


def stream_bronze(
    spark: SparkSession, folder: str, table: str, batch_id: str, max_files: int = 1000
) -> DataFrame:
    """Raw rows of new CSV files, with load time, file and the id of the run.

    ``max_files`` bounds a micro-batch, so a large backlog is worked off in steps.  A file whose
    header does not fit stops the stream instead of shifting values.
    """
    rows = (
        spark.readStream.schema(csv_schema(table))
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
    )
    return rows.withColumns(
        {
            "_ingest_timestamp": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_name"),
            "_batch_id": F.lit(batch_id),
        }
    )


def incremental_ingest(
    spark: SparkSession, folder: str, table: str, target: str, checkpoint: str, batch_id: str
) -> DataFrame:
    """Append the rows of files not seen before, and return the well-formed rows so far.

    All fields are parsed and stored with the text of malformed rows, so every header is checked;
    ``rejected_rows`` shows what did not fit.
    """
    stream = stream_bronze(spark, folder, table, batch_id)
    run_available(stream, target, checkpoint, f"bronze_{table}")
    return spark.read.parquet(target).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_rows(spark: SparkSession, target: str) -> DataFrame:
    """Malformed rows of an incrementally filled raw table, with file and run."""
    bad = spark.read.parquet(target).where(F.col(CORRUPT).isNotNull())
    return bad.select(CORRUPT, "_source_file", "_batch_id", "_ingest_timestamp")


def stream_parquet(
    spark: SparkSession, folder: str, like: DataFrame, max_files: int = 1000, glob: str = "*"
) -> DataFrame:
    """New parquet files of a folder as a stream, with the schema of a known table."""
    return (
        spark.readStream.schema(like.schema)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", glob)
        .parquet(folder)
    )


# ---- cleansed and star -------------------------------------------------------------------------


def stream_silver(raw: DataFrame, table: str, as_of: AsOf = None) -> DataFrame:
    """The batch cleansing job over a stream: transforms and drop rules are per row."""
    return silver.cleanse(table, raw, as_of)


def stream_dims(table: str, cleansed: DataFrame) -> DataFrame:
    """Vendor, project and material dimensions as projections of a stream."""
    jobs: dict[str, Callable[[DataFrame], DataFrame]] = {
        "dim_vendor": dims.dim_vendor,
        "dim_project": dims.dim_project,
        "dim_material": dims.dim_material,
    }
    return jobs[table](cleansed)


def stream_facts(table: str, stream: DataFrame, as_of: AsOf = None, **static: DataFrame) -> DataFrame:
    """A fact over a stream of its main table and static lookups.

    The static side is aggregated and stored once, so every micro-batch only does a lookup join.
    A static row that arrives later than its stream row is picked up by the next batch rebuild.
    """
    if table == "fact_purchase_orders":
        totals = stored(facts.line_totals(static["po_line_items"]), "line_totals")
        return facts.purchase_orders_from(stream, totals)
    if table == "fact_invoices":
        return facts.fact_invoices(stream, as_of)
    if table == "fact_goods_receipts":
        prices = stored(facts.line_prices(static["po_line_items"]), "line_prices")
        projects = stored(facts.order_projects(static["purchase_orders"]), "order_projects")
        return facts.goods_receipts_from(stream, prices, projects)
    if table == "fact_project_costs":
        totals = stored(facts.actual_totals(static["project_actuals"]), "actual_totals")
        return facts.project_costs_from(stream, totals)
    if table == "fact_vendor_performance":
        return facts.fact_vendor_performance(stream)
    if table == "fact_contracts":
        totals = stored(facts.item_totals(static["contract_items"]), "item_totals")
        return facts.contracts_from(stream, totals)
    if table == "fact_sales":
        return facts.fact_sales(stream, stored(static["materials"], "materials"))
    raise ValueError(f"{table} is rebuilt in batch")


def aging_at_read(stored_invoices: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Payment status, days overdue and bucket as of the day of reading."""
    today = c.as_of_date(as_of)
    unpaid = F.col("payment_date").isNull() & F.col("due_date").isNotNull()
    age = F.when(unpaid, F.datediff(today, "due_date")).otherwise(F.lit(0))
    aged = stored_invoices.withColumns({"days_overdue": age, "days_outstanding": age})
    status = (
        F.when(F.col("payment_date").isNotNull(), "PAID")
        .when(F.col("due_date") < today, "OVERDUE")
        .otherwise("PENDING")
    )
    return aged.withColumns(
        {"aging_bucket": facts.aging_bucket("days_overdue"), "payment_status": status}
    )
