"""Targeted table edits: update the first n matching rows, inspect, and restore exactly.

An edit yields the new version of a table and a small pre-image (key and old values of the touched
rows).  Stored tables are edited month by month, see ``sources.tables.edit_table``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edit:
    """Set columns on the first n rows, by key, that meet a condition."""

    table: str
    key: str
    n: int
    changes: Mapping[str, Callable[[], Column]]
    condition: str | None = None


def touched_keys(df: DataFrame, edit: Edit) -> DataFrame:
    """Keys of the first n matching rows: a distributed top-n, at most n rows."""
    rows = df if edit.condition is None else df.filter(edit.condition)
    return rows.select(F.col(edit.key).alias("_touched")).orderBy("_touched").limit(edit.n)


def edited(rows: DataFrame, edit: Edit) -> DataFrame:
    """Rows that an edit touches, with its changes."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.withColumns({n: build().cast(types[n]) for n, build in edit.changes.items()})


def update_first_n(df: DataFrame, edit: Edit) -> DataFrame:
    """The table after the edit.

    The table is joined to the list of at most ``edit.n`` keys, which Spark broadcasts if it is
    small.  A stored table is edited by ``sources.tables.edit_table``, which rewrites only the
    months concerned.
    """
    # Equal keys would multiply rows in the join, so the list is made distinct.
    keys = touched_keys(df, edit).distinct()
    joined = df.join(keys, F.col(edit.key) == F.col("_touched"), "left")
    hit = F.col("_touched").isNotNull()
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        name: F.when(hit, build().cast(types[name])).otherwise(F.col(name))
        for name, build in edit.changes.items()
    }
    return joined.withColumns(changed).select(*df.columns)


def pre_image(df: DataFrame, edit: Edit) -> DataFrame:
    """Key and old values of the rows an edit will touch; keep it to undo the edit."""
    keys = touched_keys(df, edit).distinct()
    return df.join(keys, F.col(edit.key) == F.col("_touched"), "left_semi").select(
        edit.key, *edit.changes
    )


def verify_after_update(df: DataFrame, edit: Edit, before: DataFrame) -> DataFrame:
    """The touched rows with old and new values."""
    old = before.select(
        F.col(edit.key).alias("_key"), *[F.col(n).alias(f"old_{n}") for n in edit.changes]
    )
    return df.join(old, F.col(edit.key) == F.col("_key")).select(
        edit.key,
        *[col for n in edit.changes for col in (F.col(f"old_{n}"), F.col(n).alias(f"new_{n}"))],
    )


def revert_update(df: DataFrame, edit: Edit, before: DataFrame) -> DataFrame:
    """Undo an edit from its pre-image.

    Restoring by key is exact after any later edit of other rows, which picking rows by a
    condition again would not be.
    """
    old = before.select(
        F.col(edit.key).alias("_key"), *[F.col(n).alias(f"_old_{n}") for n in edit.changes]
    )
    joined = df.join(old, F.col(edit.key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    restored = {n: F.when(hit, F.col(f"_old_{n}")).otherwise(F.col(n)) for n in edit.changes}
    return joined.withColumns(restored).select(*df.columns)


# ---- set expressions ---------------------------------------------------------------------------


def scale(column: str, factor: str) -> Callable[[], Column]:
    """Multiply by an exact decimal factor and round to cents."""
    return lambda: F.round(
        F.col(column).cast("decimal(18,2)") * F.lit(factor).cast("decimal(6,2)"), 2
    )


def set_to(value: object) -> Callable[[], Column]:
    return lambda: F.lit(value)


def add(column: str, amount: float) -> Callable[[], Column]:
    return lambda: F.round(F.col(column) + F.lit(amount), 4)


def subtract_floored(column: str, amount: float) -> Callable[[], Column]:
    """Subtract, but not below zero."""
    return lambda: F.greatest(F.round(F.col(column) - F.lit(amount), 4), F.lit(0))


def _po(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_purchase_orders", "po_id", n, changes, condition)


def _invoice(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_invoices", "invoice_id", n, changes, condition)


def _contract(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_contracts", "contract_id", n, changes, condition)


def _cost(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_project_costs", "budget_id", n, changes, condition)


def _receipt(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_goods_receipts", "grn_id", n, changes, condition)


def _sale(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_sales", "sales_order_id", n, changes, condition)


def _score(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("fact_vendor_performance", "performance_id", n, changes, condition)


def _vendor(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("dim_vendor", "vendor_id", n, changes, condition)


def _project(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("dim_project", "project_id", n, changes, condition)


def _material(n: int, changes: dict, condition: str | None = None) -> Edit:
    return Edit("dim_material", "material_id", n, changes, condition)


# The 44 edits.  Labels use the vocabulary of the star schema (the last aging bucket
# is '90+ DAYS', tiers are names), rates are percentages, and payment terms are read as a number
# of days.
EDITS: dict[str, Edit] = {
    "A01": _po(5, {"po_value": scale("po_value", "1.30")}, "po_status = 'APPROVED'"),
    "A02": _po(5, {"total_amount": scale("total_amount", "1.20")}),
    "A03": _po(3, {"po_status": set_to("CANCELLED")}, "po_status = 'OPEN'"),
    "A04": _po(5, {"priority": set_to("HIGH")}, "priority = 'NORMAL'"),
    "A05": _po(
        5,
        {"payment_terms": set_to("90")},
        "try_cast(regexp_extract(payment_terms, '[0-9]+', 0) AS INT) < 90",
    ),
    "A06": _po(3, {"po_type": set_to("EMERGENCY")}, "po_type = 'STANDARD'"),
    "A07": _invoice(
        5,
        {"invoice_amount": scale("invoice_amount", "1.25")},
        "payment_status IN ('UNPAID', 'PENDING')",
    ),
    "A08": _invoice(5, {"days_overdue": set_to(95)}, "days_overdue > 0"),
    "A09": _invoice(3, {"aging_bucket": set_to("90+ DAYS")}, "aging_bucket != '90+ DAYS'"),
    "A10": _invoice(3, {"payment_status": set_to("DISPUTED")}, "payment_status = 'PENDING'"),
    "A11": _invoice(5, {"net_amount": scale("net_amount", "1.20")}),
    "A12": _invoice(5, {"gross_amount": scale("gross_amount", "1.15")}),
    "A13": _contract(
        3, {"contract_value": scale("contract_value", "1.25")}, "contract_status = 'ACTIVE'"
    ),
    "A14": _contract(3, {"revised_value": scale("revised_value", "1.30")}),
    "A15": _contract(3, {"value_utilisation_pct": set_to(97.0)}, "value_utilisation_pct < 90"),
    "A16": _contract(3, {"change_order_count": add("change_order_count", 5)}),
    "A17": _contract(2, {"contract_status": set_to("AT_RISK")}, "contract_status = 'ACTIVE'"),
    "A18": _cost(5, {"actual_amount": scale("actual_amount", "1.40")}),
    "A19": _cost(5, {"variance_amount": add("variance_amount", -75000)}),
    "A20": _cost(3, {"budget_status": set_to("OVERSPENT")}, "budget_status != 'OVERSPENT'"),
    "A21": _cost(3, {"utilization_pct": set_to(115.0)}, "utilization_pct < 100"),
    "A22": _cost(
        5, {"remaining_amount": scale("remaining_amount", "0.50")}, "remaining_amount > 0"
    ),
    "A23": _receipt(5, {"rejection_rate": set_to(40.0)}, "rejection_rate < 20"),
    "A24": _receipt(5, {"quantity_rejected": add("quantity_rejected", 50)}),
    "A25": _receipt(3, {"grn_status": set_to("REJECTED")}, "grn_status = 'RECEIVED'"),
    "A26": _receipt(5, {"acceptance_rate": set_to(60.0)}, "acceptance_rate > 80"),
    "A27": _receipt(5, {"receipt_value": scale("receipt_value", "1.25")}),
    "A28": _sale(5, {"revenue": scale("revenue", "1.50")}, "order_status = 'COMPLETED'"),
    "A29": _sale(5, {"margin_pct": add("margin_pct", -15.0)}),
    "A30": _sale(3, {"order_status": set_to("CANCELLED")}, "order_status = 'PENDING'"),
    "A31": _sale(5, {"unit_price": scale("unit_price", "1.30")}),
    "A32": _score(3, {"overall_score": set_to(35.0)}, "overall_score > 60"),
    "A33": _score(3, {"recommendation": set_to("REVIEW")}, "recommendation = 'APPROVED'"),
    "A34": _score(3, {"quality_score": set_to(30.0)}, "quality_score > 60"),
    "A35": _vendor(
        3,
        {"performance_rating": set_to(1.5)},
        "performance_rating >= 4.0 AND status = 'ACTIVE'",
    ),
    "A36": _vendor(3, {"risk_category": set_to("HIGH")}, "risk_category = 'LOW'"),
    "A37": _vendor(5, {"tier": set_to("STANDARD")}, "tier IN ('STRATEGIC', 'PREFERRED')"),
    "A38": _vendor(2, {"status": set_to("SUSPENDED")}, "status = 'ACTIVE'"),
    "A39": _project(3, {"project_status": set_to("ON_HOLD")}, "project_status = 'ACTIVE'"),
    "A40": _project(3, {"risk_level": set_to("CRITICAL")}, "risk_level = 'LOW'"),
    "A41": _project(3, {"approved_budget_usd": scale("approved_budget_usd", "1.35")}),
    "A42": _material(5, {"unit_price": scale("unit_price", "1.45")}, "is_active"),
    "A43": _material(5, {"lead_time_days": set_to(60)}, "lead_time_days < 30"),
    "A44": _material(3, {"is_active": set_to(False)}, "is_active"),
}


# ---- merge -------------------------------------------------------------------------------------


def last_changes(changes: DataFrame, key: str, latest: str | None = None) -> DataFrame:
    """One change per key, reduced on the map side: the one with the greatest ``latest``.

    A null in ``latest`` comes before all values, equal values are decided by a hash of the row.
    Without that column a repeated key fails.
    """
    row = F.struct(*changes.columns)
    if latest is None:
        clash = F.raise_error(F.concat(F.lit(f"several changes of {key} "), F.col(key).cast("string")))
        found = changes.groupBy(key).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_rows"))
        found = found.where(F.when(F.col("_rows") > 1, clash.cast("boolean")).otherwise(F.lit(True)))
    else:
        text = [F.col(c).cast("string") for c in changes.columns]
        found = changes.groupBy(key).agg(
            F.max_by(row, F.struct(F.col(latest), F.xxhash64(*text))).alias("_row")
        )
    return found.select(*[F.col("_row")[c].alias(c) for c in changes.columns])


def upsert_merge(
    current: DataFrame, changes: DataFrame, key: str, latest: str | None = None
) -> DataFrame:
    """Rows of both tables by key; where both have the key, the changed row replaces the old one.

    An anti join and a union move only the keys of the change set against the table, and leave
    the untouched rows unaltered.  Of several changes of a key the one with the greatest
    ``latest`` counts; without that column a repeated key fails the merge.
    """
    changes = last_changes(changes, key, latest)
    keys = changes.select(F.col(key).alias("_changed"))
    kept = current.join(keys, F.col(key) == F.col("_changed"), "left_anti")
    return kept.unionByName(changes.select(*current.columns))
