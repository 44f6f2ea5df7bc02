"""Tables of the layers: write, read, views over cubes, backups, and copy-on-write replacement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edits
from ..session import PACKED, fresh_path, tidy
from . import rewrite

# Date column by which the large facts are split into months on disk.
FACT_DATES: dict[str, str] = {
    "fact_purchase_orders": "po_date",
    "fact_invoices": "invoice_date",
    "fact_goods_receipts": "receipt_date",
    "fact_inventory": "movement_date",
    "fact_sales": "order_date",
}
MONTH = "_year_month"


def full_name(layer: str, table: str) -> str:
    return f"{layer}.{table}"


def write_layer(
    df: DataFrame, layer: str, table: str, comment: str = "", quality: str | None = None
) -> None:
    """Create or replace a table with comment and properties.

    Facts are partitioned by month.  Rows are spread over the month's writers by a hash, so a
    month with many rows is written by several tasks (AQE splits large partitions), while small
    months do not leave many small files.  In a file rows are ordered by the first column, the key:
    neighbouring keys share most of their digits.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    date = FACT_DATES.get(table)
    if date is not None and date in df.columns:
        key = df.columns[0]
        df = df.withColumn(MONTH, F.date_format(date, "yyyy-MM")).hint("rebalance", MONTH)
        writer = df.sortWithinPartitions(MONTH, key).write.partitionBy(MONTH)
    else:
        writer = df.write
    writer = writer.options(**PACKED)
    with tidy(spark):
        writer.mode("overwrite").format("parquet").saveAsTable(full_name(layer, table))
    text = comment.replace("'", "''")
    spark.sql(f"COMMENT ON TABLE {full_name(layer, table)} IS '{text}'")
    spark.sql(
        f"ALTER TABLE {full_name(layer, table)} "
        f"SET TBLPROPERTIES ('quality' = '{quality or layer}')"
    )


def read_upper_layer(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """A table of a layer, without the column that only serves the file layout."""
    return spark.read.table(full_name(layer, table)).drop(MONTH)


def between(
    spark: SparkSession, layer: str, table: str, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Rows of a stored fact with a date from ``start`` to ``end``, both included.

    The months of the period are added as a filter on the file layout, so only their folders are
    listed and read.  A row without a date has no month and belongs to no period.
    """
    rows = spark.read.table(full_name(layer, table))
    date = F.col(FACT_DATES[table])
    first, last = (F.date_format(F.lit(d).cast("date"), "yyyy-MM") for d in (start, end))
    inside = date.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return rows.where(inside & F.col(MONTH).between(first, last)).drop(MONTH)


def join_on_month(fact: DataFrame, calendar: DataFrame, date: str) -> DataFrame:
    """A stored fact, with its month, joined to some days of a calendar (``date``).

    Joining the month as well as the day lets Spark read only the months that the filtered calendar
    names (dynamic partition pruning).
    """
    days = calendar.withColumns({"_day": F.col("date"), "_day_month": F.date_format("date", "yyyy-MM")})
    days = days.drop("date") if date == "date" else days
    same = (F.col(date) == F.col("_day")) & (F.col(MONTH) == F.col("_day_month"))
    return fact.join(days, same).drop("_day", "_day_month")


def create_cube_view(cube: DataFrame, name: str) -> None:
    """Register a cube as a view that is computed on read."""
    cube.createOrReplaceTempView(name)


def create_cube_views(cubes: dict[str, DataFrame]) -> None:
    for name, cube in cubes.items():
        create_cube_view(cube, name)


def backup_tables(
    spark: SparkSession, layer: str, tables: Iterable[str], backup_layer: str
) -> None:
    """Plain copies of tables in a backup schema."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {backup_layer}")
    for table in tables:
        writer = spark.table(full_name(layer, table)).write.options(**PACKED)
        with tidy(spark):
            writer.mode("overwrite").format("parquet").saveAsTable(full_name(backup_layer, table))


def replace_table(spark: SparkSession, layer: str, table: str, new_rows: DataFrame) -> None:
    """Swap in a new version of a table that may be computed from the old one.

    The new version is written completely, to a folder of its own, before the names are switched;
    a lost executor or a failed job leaves the old table as it was.  The folder does not move with
    the name, so the locations of its partitions stay valid.
    """
    target, staged, old = (
        full_name(layer, t) for t in (table, f"{table}__new", f"{table}__old")
    )
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    writer = new_rows.write.format("parquet")
    if MONTH in new_rows.columns:
        writer = writer.partitionBy(MONTH)
    writer.option("path", fresh_path(spark, table)).saveAsTable(staged)
    spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    spark.sql(f"DROP TABLE {old}")


# ---- changes of stored tables -------------------------------------------------------------------


def location(spark: SparkSession, layer: str, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name(layer, table)}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def _with_month(rows: DataFrame, table: str) -> DataFrame:
    return rows.withColumn(MONTH, F.date_format(FACT_DATES[table], "yyyy-MM"))


def _changed(
    spark: SparkSession, layer: str, table: str, change: Callable[[str, DataFrame, str | None], rewrite.Rewrite]
) -> rewrite.Rewrite:
    name = full_name(layer, table)
    now = spark.read.table(name)
    partition = MONTH if MONTH in now.columns else None
    done = change(location(spark, layer, table), now, partition)
    if partition is not None:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return done


def edit_table(spark: SparkSession, layer: str, edit: edits.Edit) -> rewrite.Rewrite:
    """Apply an edit to a stored table; only the months of the touched rows are rewritten."""

    def change(path: str, now: DataFrame, partition: str | None) -> rewrite.Rewrite:
        keys = edits.touched_keys(now, edit).distinct()
        rows = now.join(keys, F.col(edit.key) == F.col("_touched"), "left_semi")
        rows = edits.edited(rows, edit)
        if partition is not None:
            rows = _with_month(rows, edit.table)
        return rewrite.replace_rows(rows, path, now.schema, [edit.key], partition)

    return _changed(spark, layer, edit.table, change)


def undo_edit(
    spark: SparkSession, layer: str, edit: edits.Edit, done: rewrite.Rewrite
) -> rewrite.Rewrite:
    """Give the columns of an edit their old values; later changes of other rows and columns stay."""
    columns = list(edit.changes)
    if FACT_DATES.get(edit.table) in columns:
        columns.append(MONTH)
    return _changed(
        spark, layer, edit.table, lambda path, now, partition: rewrite.undo(spark, done, columns)
    )


def undo_change(spark: SparkSession, layer: str, table: str, done: rewrite.Rewrite) -> rewrite.Rewrite:
    """Take back a change of a stored table with whole rows; later changes of other rows stay."""
    return _changed(spark, layer, table, lambda path, now, partition: rewrite.undo(spark, done))


def merge_table(
    spark: SparkSession, layer: str, table: str, changes: DataFrame, key: str, latest: str | None = None
) -> rewrite.Rewrite:
    """``upsert_merge`` into a stored table; only the months of old and new rows are rewritten."""

    def change(path: str, now: DataFrame, partition: str | None) -> rewrite.Rewrite:
        rows = edits.last_changes(changes, key, latest)
        if partition is not None:
            rows = _with_month(rows, table)
        return rewrite.replace_rows(rows, path, now.schema, [key], partition)

    return _changed(spark, layer, table, change)
