"""Materialization: raw files to cleansed tables, star schema and cube views, layer by layer.

Each layer is written before the next one reads it, so a failure repeats one layer at most and no
plan grows across layers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dims, quality, silver
from ..sources import ingest, tables
from ..sources.schemas import SOURCES
from .layers import CUBES, GOLD, Layers

AsOf = dt.date | str | None


def run_bronze(spark: SparkSession, root: str, layer: str = "bronze") -> DataFrame:
    """Load every source file into the raw layer and return the audit of what was written.

    Malformed rows go to ``rejected_<table>``; a file that cannot be read fails alone.
    """
    written: dict[str, DataFrame] = {}
    rejected: dict[str, DataFrame] = {}
    failures: dict[str, str] = {}
    for table in SOURCES:
        try:
            path = f"{root.rstrip('/')}/{table}.csv"
            good, bad = ingest.corrupt_row_gate(spark, path, table)
            tables.write_layer(good, layer, table, f"Raw {table} as loaded from CSV")
            tables.write_layer(bad, layer, f"rejected_{table}", "Malformed rows")
            written[table] = tables.read_upper_layer(spark, layer, table)
            rejected[table] = tables.read_upper_layer(spark, layer, f"rejected_{table}")
        except Exception as error:  # noqa: BLE001 - one bad file must not stop the others
            failures[table] = f"FAILED: {str(error)[:200]}"
    audit = ingest.load_audit(spark, ingest.Loaded(written, failures, rejected))
    tables.write_layer(audit, layer, "load_audit", "Rows and status of the last load per table")
    return tables.read_upper_layer(spark, layer, "load_audit")


def run_silver(
    spark: SparkSession,
    run_id: str,
    as_of: AsOf = None,
    bronze: str = "bronze",
    layer: str = "silver",
    only: Iterable[str] = tuple(SOURCES),
) -> DataFrame:
    """Cleanse, quarantine and measure every raw table; returns the rule metrics of the run."""
    history: list[tuple] = []
    for table in only:
        rules = silver.RULES[table]
        rows = silver.JOBS[table](tables.read_upper_layer(spark, bronze, table), as_of)
        # The rules are counted while the good rows are written, not in a pass of their own.
        watched, observation = quality.expect_warn(rows, rules)
        tables.write_layer(quality.keep_valid(watched, rules), layer, table, f"Cleansed {table}")
        tables.write_layer(
            quality.quarantine(rows, rules), layer, f"quarantine_{table}", "Rejected rows"
        )
        history += [
            (table, *row) for row in quality.observed_metrics(observation, rules)
        ]
    schema = (
        "table_name string, rule string, condition string, action string, violations long, "
        "checked_rows long"
    )
    metrics = quality.dq_metrics(spark.createDataFrame(history, schema), run_id)
    return record_metrics(metrics, run_id, f"{layer}.dq_metrics")


def record_metrics(metrics: DataFrame, run_id: str, table: str) -> DataFrame:
    """Add the metrics of a run to their history; a run that is repeated replaces its own part."""
    spark = metrics.sparkSession
    if spark.catalog.tableExists(table):
        known = run_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_id = '{known}')")
    writer = metrics.coalesce(1).write.mode("append").format("parquet").partitionBy("run_id")
    writer.saveAsTable(table)
    return spark.read.table(table)


def stored_layers(
    spark: SparkSession,
    as_of: AsOf = None,
    calendar: tuple[str, str] = dims.CALENDAR,
    silver_layer: str = "silver",
    gold_layer: str | None = None,
) -> Layers:
    """Layers that read stored tables: silver always, gold when named."""
    out = Layers(spark, {}, as_of, calendar)
    for table in SOURCES:
        name = tables.full_name(silver_layer, table)
        if spark.catalog.tableExists(name):
            out.use("silver", table, tables.read_upper_layer(spark, silver_layer, table))
    if gold_layer is not None:
        for table in GOLD:
            if spark.catalog.tableExists(tables.full_name(gold_layer, table)):
                out.use("gold", table, tables.read_upper_layer(spark, gold_layer, table))
    return out


def run_gold(
    spark: SparkSession,
    as_of: AsOf = None,
    calendar: tuple[str, str] = dims.CALENDAR,
    silver_layer: str = "silver",
    layer: str = "gold",
) -> None:
    source = stored_layers(spark, as_of, calendar, silver_layer)
    for table in GOLD:
        tables.write_layer(source.gold(table), layer, table, f"Star schema table {table}")


def run_cubes(
    spark: SparkSession,
    as_of: AsOf = None,
    calendar: tuple[str, str] = dims.CALENDAR,
    gold_layer: str = "gold",
) -> dict[str, DataFrame]:
    """Register the fifteen cubes as views over the stored star schema."""
    source = stored_layers(spark, as_of, calendar, gold_layer=gold_layer)
    built = {name: source.cube(name) for name in CUBES}
    tables.create_cube_views(built)
    return built


def run_all(
    spark: SparkSession,
    root: str,
    run_id: str,
    as_of: AsOf = None,
    calendar: tuple[str, str] = dims.CALENDAR,
) -> dict[str, DataFrame]:
    run_bronze(spark, root)
    run_silver(spark, run_id, as_of)
    run_gold(spark, as_of, calendar)
    return run_cubes(spark, as_of, calendar)
