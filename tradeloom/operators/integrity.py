"""Integrity rules of the data set, as jobs that return the rows that violate them.

An empty result means the rule holds.  Rules that look at one row are plain filters and run in one
pass with the scan; only uniqueness and foreign keys need a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


def check_row_count(df: DataFrame, expected: int) -> DataFrame:
    """One row with both counts when the table does not have exactly the expected rows."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("expected", F.lit(expected).cast("long")).filter(
        "row_count <> expected"
    )


def check_unique(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once.  Copies are counted on the map side first."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is missing or not in the list."""
    accepted = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return df.filter(~accepted)


def check_foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows without a parent."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def check_conditional(df: DataFrame, when: str, then: str) -> DataFrame:
    """Rows where the first condition holds and the second does not (or is unknown)."""
    consequence = F.coalesce(F.expr(then), F.lit(False))
    return df.filter(F.expr(when) & ~consequence)


def check_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside the bounds, or without a value."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(column) >= F.lit(low))
    if high is not None:
        inside = inside & (F.col(column) <= F.lit(high))
    return df.filter(~F.coalesce(inside, F.lit(False)))


def check_row_arithmetic(
    df: DataFrame, value: str, expected: Column | str, tolerance: float
) -> DataFrame:
    """Rows whose value is further from the expected expression than the tolerance."""
    target = F.expr(expected) if isinstance(expected, str) else expected
    gap = F.abs(c.dbl(value) - c.dbl(target))
    return df.withColumn("expected_value", c.dbl(target)).filter(gap > tolerance)


def check_sign(
    df: DataFrame,
    kind: str,
    value: str,
    positive: Sequence[str] = ("RECEIPT", "RETURN"),
    negative: Sequence[str] = ("ISSUE", "WRITEOFF"),
) -> DataFrame:
    """Rows whose sign does not fit their kind."""
    k, v = F.col(kind), F.col(value)
    return df.filter((k.isin(*positive) & ~(v > 0)) | (k.isin(*negative) & ~(v < 0)))


# The recommendation for each lower bound of the composite score.
RECOMMENDATIONS = [(80, "PREFERRED"), (60, "APPROVED"), (40, "CONDITIONAL")]


def check_threshold_label(
    df: DataFrame,
    score: str,
    label: str,
    steps: Sequence[tuple[float, str]] = RECOMMENDATIONS,
    otherwise: str = "DELIST",
) -> DataFrame:
    """Rows whose label is not the one of their score's band."""
    expected = c.band(F.col(score), steps, otherwise)
    return df.withColumn("expected_label", expected).filter(
        ~F.col(label).eqNullSafe(F.col("expected_label"))
    )


def check_share(
    df: DataFrame, condition: str, low: float = 0.0, high: float = 1.0
) -> DataFrame:
    """One row with the share of rows that meet a condition, when it is out of bounds."""
    totals = df.agg(
        F.count_if(F.expr(condition)).alias("matching"), F.count(F.lit(1)).alias("total")
    )
    return totals.withColumn("share", c.safe_div("matching", "total")).filter(
        ~((F.col("share") > low) & (F.col("share") < high))
    )


def composite_score(delivery: str, quality: str, commercial: str, hse: str) -> Column:
    """Weighted vendor score.  Fixed values: the weights .30, .30, .20, .20."""
    return (
        F.col(delivery) * 0.30 + F.col(quality) * 0.30 + F.col(commercial) * 0.20
        + F.col(hse) * 0.20
    )


# Business rules "if A then B" per cleansed table.
BUSINESS_RULES: list[tuple[str, str, str, str]] = [
    ("blacklisted_low_rating", "vendors", "risk_category = 'BLACKLISTED'",
     "performance_rating < 2"),
    ("civil_project_sector", "projects",
     "project_type IN ('BUILDING', 'HIGHWAY', 'APARTMENT', 'BRIDGE')",
     "sector = 'CIVIL_CONSTRUCTION'"),
    ("oil_gas_project_sector", "projects",
     "project_type IN ('REFINERY', 'PIPELINE', 'DRILLING', 'LNG')", "sector = 'OIL_GAS'"),
    ("product_without_parent", "materials", "material_level = 'PRODUCT'",
     "parent_material_id IS NULL"),
    ("top_grade_unlimited", "employees", "grade = 'L6'", "approval_limit IS NULL"),
    ("emergency_is_critical", "purchase_orders", "po_type = 'EMERGENCY'",
     "priority = 'CRITICAL'"),
    ("discount_only_when_paid", "invoices", "early_payment_discount > 0",
     "invoice_status IN ('PAID', 'PARTIALLY_PAID')"),
    ("rejected_accepts_nothing", "goods_receipts", "grn_status = 'REJECTED'",
     "qty_accepted = 0"),
    ("accepted_within_delivered", "goods_receipts", "qty_accepted IS NOT NULL",
     "qty_accepted <= qty_delivered"),
    ("posted_has_invoice", "project_actuals", "cost_status = 'POSTED'",
     "invoice_id IS NOT NULL"),
    ("cancelled_is_unbilled", "sales_orders", "order_status = 'CANCELLED'",
     "payment_status = 'UNBILLED'"),
]


def check_business_rules(
    tables: Callable[[str], DataFrame],
    rules: Sequence[tuple[str, str, str, str]] = BUSINESS_RULES,
) -> DataFrame:
    """Violations per rule; all rules of a table share one pass over it."""
    by_table: dict[str, list[tuple[str, str, str]]] = {}
    for name, table, when, then in rules:
        by_table.setdefault(table, []).append((name, when, then))
    parts: list[DataFrame] = []
    for table, listed in by_table.items():
        counts = []
        for i, (_, when, then) in enumerate(listed):
            broken = F.expr(when) & ~F.coalesce(F.expr(then), F.lit(False))
            counts += [
                F.count_if(F.expr(when)).alias(f"_rows{i}"),
                F.count_if(broken).alias(f"_bad{i}"),
            ]
        entries = [
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"_rows{i}").alias("concerned_rows"),
                F.col(f"_bad{i}").alias("violations"),
            )
            for i, (name, _, _) in enumerate(listed)
        ]
        one_row = tables(table).agg(*counts)
        parts.append(one_row.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_cancelled_lines(po_line_items: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Lines of cancelled orders that still received goods."""
    cancelled = purchase_orders.filter("po_status = 'CANCELLED'").select("po_id")
    received = po_line_items.filter("qty_received <> 0")
    return received.join(cancelled, "po_id", "left_semi")


# ---- contracts between layers ------------------------------------------------------------------


def missing_columns(upper: DataFrame, lower: DataFrame, ignore: Sequence[str] = ()) -> list[str]:
    """Columns of the upper layer's source contract that the lower layer lacks; schema only."""
    return sorted(set(upper.columns) - set(lower.columns) - set(ignore))


def layer_contract(
    lower: DataFrame, upper: DataFrame, key: str, table: str
) -> DataFrame:
    """One row about a hand-over: counts, null keys, and whether the contract holds.

    The upper table must not have more rows than the lower one, and no null keys.
    """
    zero = F.lit(0).cast("long")
    sides = lower.select(F.lit(1).alias("_low"), F.lit(0).alias("_up"), zero.alias("_null"))
    ups = upper.select(
        F.lit(0).alias("_low"),
        F.lit(1).alias("_up"),
        F.col(key).isNull().cast("long").alias("_null"),
    )
    totals = sides.unionByName(ups).agg(
        F.sum("_low").alias("lower_rows"),
        F.sum("_up").alias("upper_rows"),
        F.sum("_null").alias("null_keys"),
    )
    holds = (F.col("upper_rows") <= F.col("lower_rows")) & (F.col("null_keys") == 0)
    return totals.select(
        F.lit(table).alias("table_name"), "lower_rows", "upper_rows", "null_keys",
        holds.alias("holds"),
    )


def row_balance(
    lower: DataFrame, kept: DataFrame, rejected: DataFrame, table: str
) -> DataFrame:
    """One row about a cleansing step: every row must be kept or set aside, once.

    The expected row count is the lower table's own.  ``lost_rows`` is positive where rows went
    missing, negative where a join or a repeated load multiplied them; stored tables are counted
    from their file footers.
    """
    sides = {"lower_rows": lower, "kept_rows": kept, "rejected_rows": rejected}
    zero = F.lit(0).cast("long")
    counted = [
        df.agg(F.count(F.lit(1)).alias("_n")).select(
            *[(F.col("_n") if name == side else zero).alias(name) for name in sides]
        )
        for side, df in sides.items()
    ]
    rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
    totals = rows.agg(*[F.sum(name).alias(name) for name in sides])
    lost = F.col("lower_rows") - F.col("kept_rows") - F.col("rejected_rows")
    return totals.select(
        F.lit(table).alias("table_name"), *sides, lost.alias("lost_rows"), (lost == 0).alias("holds")
    )


def star_contract(
    lower: DataFrame, upper: DataFrame, key: str, columns: Sequence[str], table: str
) -> DataFrame:
    """One row about a table of the star schema and the cleansed table it comes from.

    It must not have more rows, no null and no repeated keys, and every column that cubes read;
    the columns it lacks are listed.  Without its key every row counts as one with a null key.
    Rows of one key collapse before the shuffle.
    """
    lacking = sorted({key, *columns} - set(upper.columns))
    value = F.col(key) if key in upper.columns else F.lit(None).cast("string")
    copies = upper.groupBy(value.alias("_key")).agg(F.count(F.lit(1)).alias("_copies"))
    zero = F.lit(0).cast("long")
    above = copies.agg(
        zero.alias("lower_rows"),
        F.coalesce(F.sum("_copies"), zero).alias("upper_rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_copies"))), zero).alias("null_keys"),
        F.count_if(F.col("_key").isNotNull() & (F.col("_copies") > 1)).alias("repeated_keys"),
    )
    below = lower.agg(
        F.count(F.lit(1)).alias("lower_rows"),
        *[zero.alias(n) for n in ("upper_rows", "null_keys", "repeated_keys")],
    )
    names = ("lower_rows", "upper_rows", "null_keys", "repeated_keys")
    totals = above.unionByName(below).agg(*[F.sum(n).alias(n) for n in names])
    fits = (F.col("upper_rows") <= F.col("lower_rows")) & (F.col("null_keys") == 0) & (F.col("repeated_keys") == 0)
    return totals.select(
        F.lit(table).alias("table_name"), *names, F.lit(" ".join(lacking)).alias("missing_columns"),
        (fits & F.lit(not lacking)).alias("holds"),
    )


def reference_counts(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str, table: str
) -> DataFrame:
    """One row about a reference: rows without a value, and values and rows without a parent.

    Rows of one value are counted before the join, so a hot value is one row of it.
    """
    used = child.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    met = used.join(keys, F.col("_value") == F.col("_parent_key"), "left")
    orphan = F.col("_value").isNotNull() & F.col("_parent_key").isNull()
    zero = F.lit(0).cast("long")
    return met.agg(
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_rows"))), zero).alias("null_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), zero).alias("orphan_rows"),
    ).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "null_rows",
        "orphan_keys", "orphan_rows",
    )
