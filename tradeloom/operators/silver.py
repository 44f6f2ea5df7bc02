"""Cleansed layer: typed, trimmed and enriched copies of the fifteen raw feeds.

Casts are lenient (a bad value becomes NULL) and the expectations then decide what happens to the
row.  Money is rounded to cents and quantities to four digits, so that later sums are exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from .quality import DROP, WARN, Checked, Rule, check, keep_valid

AsOf = dt.date | str | None

# Load metadata of the raw layer, which the cleansed layer does not carry on.
_LOAD_COLUMNS = ("_ingest_timestamp", "_source_file", "_batch_id", "_corrupt_record")


def _finish(df: DataFrame, *drop: str) -> DataFrame:
    return df.drop(*_LOAD_COLUMNS, *drop).withColumn("_silver_timestamp", F.current_timestamp())


def _typed(cast: Callable[[str], Column], names: str) -> dict[str, Column]:
    return {name: cast(name) for name in names.split()}


def silver_vendors(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            _typed(c.text, "vendor_name city")
            | _typed(c.code, "country state")
            | _typed(c.number, "performance_rating")
            | _typed(c.money, "credit_limit_usd annual_turnover_usd")
            | _typed(c.whole, "payment_terms_days")
        )
    )


def silver_projects(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        {"project_name": c.text("project_name"), "country": c.code("country")}
        | _typed(c.money, "contract_value_usd approved_budget_usd")
        | _typed(c.day, "start_date planned_completion_date actual_completion_date")
    )
    excess = F.col("contract_value_usd") - F.col("approved_budget_usd")
    return _finish(
        typed.withColumns(
            {
                "planned_duration_days": F.datediff("planned_completion_date", "start_date"),
                "budget_variance_pct": c.percent_or_zero(excess, "approved_budget_usd"),
            }
        )
    )


def silver_materials(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            _typed(c.text, "material_name sub_category")
            | {"category": c.code("category"), "is_active": c.flag("active")}
            | _typed(c.money, "unit_price")
            | _typed(c.number, "weight_kg")
            | _typed(c.whole, "lead_time_days")
        ),
        "active",
    )


def silver_employees(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            {
                "full_name": F.concat(c.text("first_name"), F.lit(" "), c.text("last_name")),
                "department": c.code("department"),
                "is_active": c.flag("active"),
                "approval_limit": c.money("approval_limit"),
                "hire_date": c.day("hire_date"),
            }
        ),
        "active",
    )


def silver_purchase_orders(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            _typed(c.day, "po_date delivery_date approval_date")
            | _typed(c.money, "po_value tax_amount total_value")
            | {"po_status": c.code("po_status"), "order_date": c.day("po_date")}
        )
    )


def silver_po_line_items(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        _typed(c.quantity, "qty_ordered qty_received qty_accepted unit_price")
        | _typed(c.money, "line_value")
        | _typed(c.day, "delivery_date actual_delivery_date")
    )
    return _finish(
        typed.withColumns(
            {
                "fulfillment_rate": c.percent_or_zero("qty_received", "qty_ordered"),
                "acceptance_rate": c.percent_or_zero("qty_accepted", "qty_received"),
            }
        )
    )


def silver_contracts(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        {"contract_value": c.money("original_value")}
        | _typed(c.money, "original_value revised_value")
        | _typed(c.day, "start_date end_date")
        | _typed(c.code, "contract_status contract_type")
    )
    return _finish(
        typed.withColumn("contract_duration_days", F.datediff("end_date", "start_date"))
    )


def silver_contract_items(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            {
                "quantity": c.quantity("quantity"),
                "unit_price": c.quantity("unit_rate"),
                "line_value": c.money("amount"),
            }
        )
    )


def silver_invoices(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        _typed(c.day, "invoice_date due_date")
        | {
            "payment_date": c.day("paid_date"),
            "invoice_amount": c.money("gross_amount"),
            "total_amount": c.money("net_amount"),
            "invoice_status": c.code("invoice_status"),
        }
        | _typed(c.money, "gross_amount net_amount tax_amount paid_amount retention_amount")
    )
    unpaid = F.col("payment_date").isNull() & F.col("due_date").isNotNull()
    return _finish(
        typed.withColumns(
            {
                "days_to_pay": F.datediff("payment_date", "invoice_date"),
                "days_overdue": F.when(
                    unpaid, F.datediff(c.as_of_date(as_of), "due_date")
                ).otherwise(F.lit(0)),
            }
        )
    )


def silver_goods_receipts(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        {
            "receipt_date": c.day("receipt_date"),
            "qty_received": c.quantity("qty_delivered"),
            "grn_status": c.code("grn_status"),
            "storage_location": c.text("storage_location"),
        }
        | _typed(c.quantity, "qty_delivered qty_accepted qty_rejected")
    )
    return _finish(
        typed.withColumn("rejection_rate", c.percent_or_zero("qty_rejected", "qty_delivered"))
    )


def silver_project_budgets(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    typed = raw.withColumns(
        {
            "budget_amount": c.money("revised_amount"),
            "original_budget": c.money("original_amount"),
            "spent_amount": c.money("actual_spent"),
            "wbs_code": c.text("wbs_code"),
        }
        | _typed(c.money, "original_amount revised_amount committed_amount actual_spent")
        | _typed(c.code, "cost_type budget_status")
        | _typed(c.day, "period_start period_end")
    )
    return _finish(
        typed.withColumns(
            {
                "remaining_amount": c.difference("budget_amount", "spent_amount"),
                "utilization_pct": c.percent_or_zero("spent_amount", "budget_amount"),
            }
        )
    )


def silver_project_actuals(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            _typed(c.day, "transaction_date posting_date")
            | {"amount": c.money("actual_amount"), "cost_category": c.code("cost_type")}
            | _typed(c.money, "actual_amount budget_amount variance")
            | _typed(c.code, "cost_type cost_status")
            | _typed(c.text, "wbs_code fiscal_period")
        )
    )


def silver_sales_orders(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            _typed(c.day, "order_date delivery_date")
            | {"order_value": c.money("revenue"), "total_value": c.money("total_amount")}
            | _typed(c.money, "revenue tax_amount total_amount cogs gross_margin")
            | _typed(c.code, "order_status payment_status order_type customer_type")
            | {"customer_name": c.text("customer_name")}
            | _typed(c.quantity, "quantity unit_price")
            | _typed(c.number, "margin_pct")
        )
    )


def silver_inventory(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _finish(
        raw.withColumns(
            {"movement_date": c.day("movement_date"), "total_cost": c.money("total_value")}
            | _typed(c.quantity, "quantity unit_cost")
            | _typed(c.money, "total_value")
            | _typed(c.code, "movement_type unit_of_measure reason_code")
            | _typed(c.text, "from_location to_location")
        )
    )


def silver_vendor_performance(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    scores = "delivery_score quality_score commercial_score hse_score"
    typed = raw.withColumns(
        {"evaluation_date": c.day("evaluation_date")}
        | _typed(c.number, scores)
        | {
            "overall_score": c.number("composite_score"),
            "recommendation": c.text("recommendation"),
            "evaluation_period": c.code("evaluation_period"),
        }
    )
    total = sum((F.col(s) for s in scores.split()[1:]), F.col(scores.split()[0]))
    return _finish(typed.withColumn("compliance_score", total / 4), "composite_score")


JOBS: dict[str, Callable[..., DataFrame]] = {
    "vendors": silver_vendors,
    "projects": silver_projects,
    "materials": silver_materials,
    "employees": silver_employees,
    "purchase_orders": silver_purchase_orders,
    "po_line_items": silver_po_line_items,
    "contracts": silver_contracts,
    "contract_items": silver_contract_items,
    "invoices": silver_invoices,
    "goods_receipts": silver_goods_receipts,
    "project_budgets": silver_project_budgets,
    "project_actuals": silver_project_actuals,
    "sales_orders": silver_sales_orders,
    "inventory": silver_inventory,
    "vendor_performance": silver_vendor_performance,
}


def _present(name: str, column: str) -> Rule:
    return Rule(name, f"{column} IS NOT NULL", DROP)


# The names and conditions of the thirty expectations.
RULES: dict[str, list[Rule]] = {
    "vendors": [
        _present("valid_vendor_id", "vendor_id"),
        _present("valid_vendor_name", "vendor_name"),
        Rule("valid_rating", "performance_rating BETWEEN 0 AND 5", WARN),
    ],
    "projects": [
        _present("valid_project_id", "project_id"),
        Rule("valid_budget", "approved_budget_usd > 0", WARN),
    ],
    "materials": [
        _present("valid_material_id", "material_id"),
        Rule("valid_price", "unit_price >= 0", WARN),
    ],
    "employees": [_present("valid_employee_id", "employee_id")],
    "purchase_orders": [
        _present("valid_po_id", "po_id"),
        _present("valid_vendor_ref", "vendor_id"),
        Rule("valid_po_value", "po_value >= 0", WARN),
    ],
    "po_line_items": [
        _present("valid_line_id", "line_id"),
        _present("valid_po_ref", "po_id"),
    ],
    "contracts": [
        _present("valid_contract_id", "contract_id"),
        Rule("valid_value", "original_value > 0", WARN),
    ],
    "contract_items": [
        _present("valid_item_id", "item_id"),
        _present("valid_contract_ref", "contract_id"),
    ],
    "invoices": [
        _present("valid_invoice_id", "invoice_id"),
        Rule("valid_amount", "gross_amount > 0", WARN),
    ],
    "goods_receipts": [
        _present("valid_grn_id", "grn_id"),
        _present("valid_po_ref", "po_id"),
    ],
    "project_budgets": [
        _present("valid_budget_id", "budget_id"),
        Rule("valid_budget_amount", "revised_amount >= 0", WARN),
    ],
    "project_actuals": [
        _present("valid_transaction_id", "transaction_id"),
        Rule("valid_amount", "actual_amount > 0", WARN),
    ],
    "sales_orders": [
        _present("valid_sales_order_id", "sales_order_id"),
        Rule("valid_order_value", "revenue > 0", WARN),
    ],
    "inventory": [_present("valid_movement_id", "movement_id")],
    "vendor_performance": [
        _present("valid_performance_id", "performance_id"),
        _present("valid_vendor_ref", "vendor_id"),
    ],
}


def cleanse(table: str, raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The cleansed table: transforms, then the drop and fail rules."""
    return keep_valid(JOBS[table](raw, as_of), RULES[table])


def cleanse_checked(table: str, raw: DataFrame, as_of: AsOf = None) -> Checked:
    """Cleansed rows, quarantined rows and rule metrics of one feed."""
    return check(JOBS[table](raw, as_of), RULES[table], table)
