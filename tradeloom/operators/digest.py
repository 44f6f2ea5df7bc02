"""Order-free digest of a table: equal for equal sets of rows, however they are stored.

Every row is written as one text, column by column, and hashed; the digest is the sum of the hashes.
Sums do not depend on order or partitioning, add up over parts of a table, and count repeated rows.
So two tables are compared by one pass over each, and neither is sorted, joined or collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits behind the point that count in a number that is no whole one.
DIGITS = 6


def canonical(field: T.StructField) -> Column:
    """A value as text that other engines write alike; null stays null.

    Numbers that are no whole ones count to six digits behind the point.
    """
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType | T.FloatType | T.DecimalType):
        return value.cast(f"decimal(38,{DIGITS})").cast("string")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(value, F.lit("true")).when(~value, F.lit("false"))
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.to_json(F.struct(value))
    return value.cast("string")


def row_number_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """60 bits of a hash over the named columns, with their names, so that swapped columns differ."""
    fields = {f.name: f for f in df.schema.fields}
    parts = [F.concat(F.lit(f"{n}="), F.coalesce(canonical(fields[n]), F.lit("\\N"))) for n in columns]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")


def table_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count`` and ``digest`` (text) over the columns, by default all but load times."""
    if columns is None:
        columns = sorted(f.name for f in df.schema.fields if not isinstance(f.dataType, T.TimestampType))
    total = F.coalesce(F.sum(row_number_of(df, columns)), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.cast("decimal(38,0)").cast("string").alias("digest"))


def differences(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per named pair of tables their counts and digests, and whether they hold the same rows.

    A column that only one side has is a difference of its own.
    """
    out = None
    for name, (left, right) in tables.items():
        shared = sorted(set(left.columns) & set(right.columns))
        shared = [c for c in shared if not isinstance(left.schema[c].dataType, T.TimestampType)]
        odd = sorted(set(left.columns) ^ set(right.columns))
        sides = [
            table_digest(df, shared).select(F.lit(name).alias("table_name"), F.struct("row_count", "digest").alias(side))
            for side, df in (("left", left), ("right", right))
        ]
        both = sides[0].join(sides[1], "table_name").select(
            "table_name", F.col("left.row_count").alias("rows_left"), F.col("right.row_count").alias("rows_right"),
            F.lit(",".join(odd)).alias("odd_columns"),
            ((F.col("left") == F.col("right")) & F.lit(not odd)).alias("same"),
        )
        out = both if out is None else out.unionByName(both)
    return out
