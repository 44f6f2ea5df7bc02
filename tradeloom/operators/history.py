"""Type-2 history of a dimension: one row per key and period of validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def row_hash(columns: Sequence[str]) -> Column:
    """Hash over the tracked columns; NULL and empty text stay different."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def start_history(
    snapshot: DataFrame, key: str, tracked: Sequence[str], valid_from: str
) -> DataFrame:
    """The first version of every key."""
    return snapshot.select(
        key,
        *tracked,
        row_hash(tracked).alias("row_hash"),
        F.lit(valid_from).cast("date").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str,
    close_missing: bool = False,
) -> DataFrame:
    """History after a new snapshot.

    A changed key gets its open version closed the day before and a new version; a new key gets
    its first version; with ``close_missing`` a key that left the snapshot is closed.  Only the
    open versions take part in the join; closed versions pass through untouched.
    """
    today = F.lit(as_of).cast("date")
    new = snapshot.select(
        F.col(key).alias("_key"),
        *[F.col(t).alias(f"_n_{t}") for t in tracked],
        row_hash(tracked).alias("_new_hash"),
    )
    closed = history.filter(~F.col("is_current"))
    pairs = history.filter("is_current").join(new, F.col(key) == F.col("_key"), "full_outer")
    arrived = F.col("_key").isNotNull()
    existed = F.col(key).isNotNull()
    changed = existed & arrived & (F.col("row_hash") != F.col("_new_hash"))
    gone = existed & ~arrived if close_missing else F.lit(False)

    def version(values: list[Column], start: Column, end: Column, is_open: Column) -> Column:
        return F.struct(
            *values,
            start.alias("valid_from"),
            end.alias("valid_to"),
            is_open.alias("is_current"),
        )

    old_values = [F.col(n).alias(n) for n in (key, *tracked, "row_hash")]
    new_values = [
        F.col("_key").alias(key),
        *[F.col(f"_n_{t}").alias(t) for t in tracked],
        F.col("_new_hash").alias("row_hash"),
    ]
    open_end = F.lit(OPEN_END).cast("date")
    ends = changed | gone
    old = version(
        old_values,
        F.col("valid_from"),
        F.when(ends, F.date_sub(today, 1)).otherwise(F.col("valid_to")),
        ~ends,
    )
    fresh = version(new_values, today, open_end, F.lit(True))
    # Each pair yields its old version, its new version, or both.
    versions = F.array_compact(
        F.array(F.when(existed, old), F.when(~existed | changed, fresh))
    )
    moved = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return closed.select(*moved.columns).unionByName(moved)


def scd2_dimension(
    changes: DataFrame, key: str, tracked: Sequence[str], effective: str
) -> DataFrame:
    """History from a change log with one row per key and day."""
    events = changes.select(key, *tracked, F.col(effective).alias("valid_from"))
    return history_of(events, key, tracked)


DELETED = "_deleted"


def history_of(events: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """History from the events of a dimension: at most one per key and ``valid_from`` date.

    Events may have arrived in any order; a version lasts until the next event that differs, so an
    event between two versions splits one and equal neighbours are one version.  An event with
    ``_deleted`` ends a version without starting one.

    No window holds more than the days of a year of one key: what crosses the years is taken from one
    row per key and year.
    """
    gone = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in events.columns else F.lit(False)
    marked = events.select(
        key, *tracked, "valid_from", F.year("valid_from").alias("_year"), gone.alias("_gone"),
        row_hash(tracked).alias("row_hash"),
    ).withColumn("_mark", F.when(F.col("_gone"), F.lit("")).otherwise(F.col("row_hash")))
    within = Window.partitionBy(key, "_year").orderBy("valid_from")
    years = Window.partitionBy(key).orderBy("_year")
    last = marked.groupBy(key, "_year").agg(F.max_by("_mark", "valid_from").alias("_last"))
    earlier = last.select(key, "_year", F.lag("_last").over(years).alias("_earlier"))
    seen = marked.withColumn("_before", F.lag("_mark").over(within)).join(earlier, [key, "_year"])
    before = F.coalesce("_before", "_earlier")
    starts = seen.where(before.isNull() | (before != F.col("_mark")))

    first = starts.groupBy(key, "_year").agg(F.min("valid_from").alias("_first"))
    later = first.select(key, "_year", F.lead("_first").over(years).alias("_later"))
    following = starts.withColumn("_after", F.lead("valid_from").over(within))
    following = following.join(later, [key, "_year"]).where(~F.col("_gone"))
    end = F.coalesce("_after", "_later")
    return following.select(
        key,
        *tracked,
        "row_hash",
        "valid_from",
        F.coalesce(F.date_sub(end, 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        end.isNull().alias("is_current"),
    )
