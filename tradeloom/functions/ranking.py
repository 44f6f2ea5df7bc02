"""Ranks and running totals over groups of any size.

``Window.partitionBy(group).orderBy(value)`` sorts a whole group inside one task.  That is right
for groups with a known small bound (the months of one vendor) and wrong for groups that grow with
the data (all vendors, all customers of the largest country).  For the latter the value axis is
cut into ordered buckets by a monotone function of the value.  Ranks are taken inside a bucket,
and a running total over the buckets, whose number is bounded, gives the offset of each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import from_units, units

_PER_OCTAVE = 4096  # buckets per doubling of the value
_SMALLEST = 2.0**-7  # values closer to zero share bucket 0
_AFTER_ALL = 2**30  # bucket of NULL, behind every value


def order_bucket(value: Column) -> Column:
    """Monotone bucket number of a value: logarithmic in its size, mirrored for negatives.

    A bucket spans 0.017 % of the value, so a bucket of amounts below 1e8 holds at most 1.8 million
    different cents, whatever the distribution.  Up to 1e16 there are half a million buckets.
    """
    v = value.cast("double")
    steps = F.floor((F.log2(F.greatest(F.abs(v), F.lit(_SMALLEST))) + 7) * _PER_OCTAVE)
    return F.when(F.abs(v) < _SMALLEST, F.lit(0)).otherwise(F.signum(v) * (steps + 1)).cast("int")


def ordered_totals(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    measure: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """One row per (group, distinct value) with its rank, dense rank and running total.

    The frame is read twice, so pass a stored table, or one that is cheap to compute.

    Columns: ``by``, ``value``, ``_rank``, ``_dense_rank`` and, with a ``measure``, ``_running``
    (sum of a money measure over all rows up to and including this value).
    """
    by = list(by)
    # Equal values collapse before the shuffle, so a value shared by most rows costs one row.
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if measure:
        aggs.append(F.sum(units(measure)).alias("_measure"))
    bucket = order_bucket(F.col(value)) * (-1 if descending else 1)
    points = (
        df.groupBy(*by, value)
        .agg(*aggs)
        .withColumn("_bucket", F.coalesce(bucket, F.lit(_AFTER_ALL)))
    )
    column = F.col(value)
    order = column.desc_nulls_last() if descending else column.asc_nulls_last()
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    up_to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = points.withColumns(
        {
            "_dense_in": F.row_number().over(inside),
            "_rows_in": F.sum("_rows").over(up_to_here),
            **({"_measure_in": F.sum("_measure").over(up_to_here)} if measure else {}),
        }
    )
    # The bucket totals are bounded per group, so one ordered window over them is safe.
    buckets = points.groupBy(*by, "_bucket").agg(
        F.count(F.lit(1)).alias("_dense_all"),
        F.sum("_rows").alias("_rows_all"),
        *([F.sum("_measure").alias("_measure_all")] if measure else []),
    )
    before = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = buckets.select(
        *[F.col(b).alias(f"_g_{b}") for b in by],
        F.col("_bucket").alias("_g_bucket"),
        F.coalesce(F.sum("_dense_all").over(before), F.lit(0)).alias("_dense_before"),
        F.coalesce(F.sum("_rows_all").over(before), F.lit(0)).alias("_rows_before"),
        *(
            [F.coalesce(F.sum("_measure_all").over(before), F.lit(0)).alias("_measure_before")]
            if measure
            else []
        ),
    )
    same = F.col("_bucket") == F.col("_g_bucket")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_g_{b}"))
    out = [
        *by,
        value,
        (F.col("_rows_before") + F.col("_rows_in") - F.col("_rows") + 1).alias("_rank"),
        (F.col("_dense_before") + F.col("_dense_in")).alias("_dense_rank"),
    ]
    if measure:
        running = F.col("_measure_before") + F.col("_measure_in")
        out.append(from_units(running).alias("_running"))
    return local.join(offsets, same).select(*out)


def with_rank(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str,
    dense: bool = False,
    descending: bool = True,
) -> DataFrame:
    """Add RANK or DENSE_RANK of ``value`` inside each ``by`` group; NULL values rank last.

    The frame is read three times, so pass a stored table, or one that is cheap to compute.
    """
    return with_ranks(df, value, {name: (tuple(by), dense)}, descending)


def with_ranks(
    df: DataFrame,
    value: str,
    ranks: dict[str, tuple[Sequence[str], bool]],
    descending: bool = True,
) -> DataFrame:
    out = df
    for name, (by, dense) in ranks.items():
        totals = ordered_totals(df, by, value, descending=descending)
        keys = totals.select(
            *[F.col(b).alias(f"_k_{b}") for b in by],
            F.col(value).alias("_k_value"),
            F.col("_dense_rank" if dense else "_rank").cast("int").alias(name),
        )
        same = F.col(value).eqNullSafe(F.col("_k_value"))
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"_k_{b}"))
        out = out.join(keys, same, "left").drop("_k_value", *[f"_k_{b}" for b in by])
    return out
