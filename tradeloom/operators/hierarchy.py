"""Closure of a self-reference: root, level and status of every row, by pointer doubling.

Every row points to its parent.  In each round a row takes over the pointer of the row that it points
to, so pointers reach twice as far and a chain of n rows needs log2(n) rounds instead of n.  Rows that
reached the end of their chain drop out.  A round is one join on the unique id, stored so that lineage
stays short; a parent with very many children is a skewed side that Spark splits.

Chains that never end lead into a cycle: after more jumps than there are rows every open pointer lies
on a cycle, and every row of a cycle is pointed to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

ROOT, CHILD, ORPHAN, BELOW_ORPHAN, CYCLE, BELOW_CYCLE = "ROOT CHILD ORPHAN BELOW_ORPHAN CYCLE BELOW_CYCLE".split()


def closure(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """``key, root, level, status`` of every row.

    A row without parent is a root at level 0.  A row whose parent is not there is an orphan, the top of
    its chain, also at level 0.  Rows of a cycle and rows that lead into one have neither root nor
    level.  A row that is its own parent is a cycle of one.  Keys are unique; a row without key is left out.
    """
    own = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(parent).alias("up"))
    ids = own.select(F.col("id").alias("up"), F.lit(True).alias("_there"))
    known = own.join(ids, "up", "left")
    orphan = F.col("up").isNotNull() & F.col("_there").isNull()
    top = F.col("up").isNull() | orphan
    # ``up`` is the row that the pointer has reached, ``level`` how many steps away it is.
    state = known.select(
        "id", F.when(top, F.col("id")).otherwise(F.col("up")).alias("up"),
        F.when(top, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("level"), top.alias("ended"), orphan.alias("lost"),
    )
    state = stored(state, "closure")
    open_rows, reach = state.where("NOT ended").count(), 1
    chain = open_rows
    while open_rows and reach <= chain:
        ahead = state.select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("level").alias("_level"),
            F.col("ended").alias("_ended"), F.col("lost").alias("_lost"),
        )
        moved = state.where("NOT ended").join(ahead, "up").select(
            "id", F.col("_up").alias("up"), (F.col("level") + F.col("_level")).alias("level"),
            F.col("_ended").alias("ended"), F.col("_lost").alias("lost"),
        )
        state = stored(state.where("ended").unionByName(moved), "closure")
        open_rows, reach = state.where("NOT ended").count(), reach * 2
    on_cycle = state.where("NOT ended").select(F.col("up").alias("id"), F.lit(True).alias("_on")).distinct()
    found = state.join(on_cycle, "id", "left")
    is_top = F.col("id") == F.col("up")
    status = (
        F.when(~F.col("ended"), F.when(F.col("_on"), CYCLE).otherwise(BELOW_CYCLE))
        .when(F.col("lost"), F.when(is_top, ORPHAN).otherwise(BELOW_ORPHAN))
        .otherwise(F.when(is_top, ROOT).otherwise(CHILD))
    )
    return found.select(
        F.col("id").alias(key), F.when(F.col("ended"), F.col("up")).alias("root"),
        F.when(F.col("ended"), F.col("level")).alias("level"), status.alias("status"),
    )


def report(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows and greatest level per status."""
    return closure(rows, key, parent).groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("level").alias("max_level"), F.count_distinct("root").alias("roots")
    )
