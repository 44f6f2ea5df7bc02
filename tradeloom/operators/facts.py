"""Star schema, facts: nine tables with natural keys.

Child rows are summed to the parent's grain before the join, so a parent with very many children
is reduced on the map side and never skews the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c

# The aging buckets, by days overdue.
AGING_BUCKETS = ("CURRENT", "1-30 DAYS", "31-60 DAYS", "61-90 DAYS", "90+ DAYS")


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("_gold_timestamp", F.current_timestamp())


def line_totals(po_line_items: DataFrame) -> DataFrame:
    """Line items per purchase order."""
    return po_line_items.groupBy("po_id").agg(
        c.exact_sum("line_value").alias("line_total"),
        c.exact_sum("qty_ordered").alias("total_quantity"),
    )


def purchase_orders_from(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """``fact_purchase_orders`` from orders and the line totals per order."""
    zero = F.lit(0.0)
    return _stamp(
        orders.join(totals, "po_id", "left").select(
            "po_id",
            "vendor_id",
            "project_id",
            "po_date",
            "delivery_date",
            F.col("delivery_date").alias("expected_delivery_date"),
            "approval_date",
            "po_value",
            "tax_amount",
            "total_value",
            F.col("total_value").alias("total_amount"),
            "po_status",
            "po_type",
            "priority",
            "currency",
            "payment_terms",
            F.coalesce("line_total", zero).alias("line_total"),
            F.coalesce("total_quantity", zero).alias("total_quantity"),
        )
    )


def fact_purchase_orders(orders: DataFrame, po_line_items: DataFrame) -> DataFrame:
    return purchase_orders_from(orders, line_totals(po_line_items))


def aging_bucket(days: str) -> Column:
    overdue = F.col(days)
    return (
        F.when(overdue <= 0, AGING_BUCKETS[0])
        .when(overdue <= 30, AGING_BUCKETS[1])
        .when(overdue <= 60, AGING_BUCKETS[2])
        .when(overdue <= 90, AGING_BUCKETS[3])
        .otherwise(AGING_BUCKETS[4])
    )


def fact_invoices(invoices: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Invoices with payment status and aging bucket.

    ``gross_amount`` and ``net_amount`` keep the meaning of the source columns, so
    ``invoice_amount`` is the gross and ``total_amount`` the net amount.
    """
    status = (
        F.when(F.col("payment_date").isNotNull(), "PAID")
        .when(F.col("due_date") < c.as_of_date(as_of), "OVERDUE")
        .otherwise("PENDING")
    )
    return _stamp(
        invoices.select(
            "invoice_id",
            "vendor_id",
            "po_id",
            "project_id",
            "contract_id",
            F.col("invoice_ref").alias("invoice_number"),
            "invoice_type",
            status.alias("payment_status"),
            "invoice_date",
            "due_date",
            "payment_date",
            "invoice_amount",
            F.col("total_amount").alias("net_amount"),
            "tax_rate",
            "tax_amount",
            "total_amount",
            F.col("invoice_amount").alias("gross_amount"),
            "paid_amount",
            "retention_amount",
            "days_to_pay",
            "days_overdue",
            F.col("days_overdue").alias("days_outstanding"),
            aging_bucket("days_overdue").alias("aging_bucket"),
            "currency",
            "approved_by",
            F.col("description").alias("notes"),
        )
    )


def line_prices(po_line_items: DataFrame) -> DataFrame:
    """One price per line: copies of a line must not multiply its receipts."""
    return po_line_items.groupBy(F.col("line_id").alias("line_item_id")).agg(
        F.max("unit_price").alias("_price")
    )


def order_projects(orders: DataFrame) -> DataFrame:
    """One project per order.  Grouped by the key, so that the lookup is dropped where it is not read."""
    return orders.groupBy("po_id").agg(F.max("project_id").alias("_project"))


def fact_goods_receipts(
    receipts: DataFrame, po_line_items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Receipts with the project of their order, acceptance rate (percent) and value."""
    return goods_receipts_from(receipts, line_prices(po_line_items), order_projects(orders))


def goods_receipts_from(
    receipts: DataFrame, prices: DataFrame, projects: DataFrame
) -> DataFrame:
    """``fact_goods_receipts`` from receipts, line prices and the projects of orders.

    A receipt that names a project itself keeps it.
    """
    value = F.col("qty_accepted") * F.coalesce("_price", F.lit(0.0))
    known = receipts.join(prices, "line_item_id", "left").join(projects, "po_id", "left")
    return _stamp(
        known.select(
            "grn_id",
            "po_id",
            "line_item_id",
            "vendor_id",
            "material_id",
            F.coalesce("project_id", "_project").alias("project_id"),
            "receipt_date",
            F.col("qty_received").alias("quantity_received"),
            F.col("qty_accepted").alias("quantity_accepted"),
            F.col("qty_rejected").alias("quantity_rejected"),
            "rejection_rate",
            (F.lit(100.0) - F.col("rejection_rate")).alias("acceptance_rate"),
            c.settled(value).alias("receipt_value"),
            "grn_status",
            "storage_location",
            F.col("received_by").alias("inspector"),
        )
    )


def actual_totals(actuals: DataFrame) -> DataFrame:
    """Actual spend per project, work package and cost type."""
    return actuals.groupBy("project_id", "wbs_code", "cost_type").agg(
        c.exact_sum("actual_amount").alias("_spent"), F.max("posting_date").alias("posting_date")
    )


def project_costs_from(budgets: DataFrame, totals: DataFrame) -> DataFrame:
    """``fact_project_costs`` from budgets and actual totals.

    The budget's own spent amount stands in where no actuals are posted.
    ``variance_amount`` is budget minus actual; the overrun in the actuals has the other sign.
    """
    budget = F.col("revised_amount")
    actual = F.coalesce("_spent", "actual_spent")
    left = c.settled(budget - actual)
    return _stamp(
        budgets.join(totals, ["project_id", "wbs_code", "cost_type"], "left").select(
            "budget_id",
            "project_id",
            F.col("wbs_code").alias("wbs_element"),
            "wbs_code",
            "cost_type",
            budget.alias("budget_amount"),
            F.col("original_amount").alias("original_budget"),
            "committed_amount",
            actual.alias("actual_amount"),
            left.alias("remaining_amount"),
            c.percent_or_zero(actual, budget).alias("utilization_pct"),
            left.alias("variance_amount"),
            c.percent_or_zero(left, budget).alias("variance_pct"),
            "budget_status",
            "period_start",
            "period_end",
            "posting_date",
        )
    )


def fact_project_costs(budgets: DataFrame, actuals: DataFrame) -> DataFrame:
    return project_costs_from(budgets, actual_totals(actuals))


def fact_project_actuals(actuals: DataFrame) -> DataFrame:
    """Posted transactions; ``overrun`` is actual minus budget."""
    return _stamp(
        actuals.select(
            "transaction_id",
            "po_id",
            "invoice_id",
            "wbs_code",
            "cost_type",
            "cost_category",
            "cost_status",
            "transaction_date",
            "posting_date",
            "actual_amount",
            "budget_amount",
            "variance",
            F.col("variance").alias("overrun"),
            "fiscal_period",
        )
    )


def fact_vendor_performance(performance: DataFrame) -> DataFrame:
    return _stamp(
        performance.select(
            "performance_id",
            "vendor_id",
            "project_id",
            "evaluation_date",
            "evaluation_period",
            "delivery_score",
            "quality_score",
            "commercial_score",
            "hse_score",
            "compliance_score",
            "overall_score",
            "recommendation",
            "evaluator_id",
            F.col("remarks").alias("notes"),
        )
    )


def fact_inventory(inventory: DataFrame) -> DataFrame:
    return _stamp(
        inventory.select(
            "movement_id",
            "material_id",
            "grn_id",
            "movement_type",
            "movement_date",
            "quantity",
            "unit_cost",
            "total_value",
            "from_location",
            "to_location",
            "batch_number",
            "unit_of_measure",
            "reason_code",
            "posted_by",
        )
    )


def item_totals(contract_items: DataFrame) -> DataFrame:
    """Contract items per contract."""
    return contract_items.groupBy("contract_id").agg(
        c.exact_sum("line_value").alias("items_total"), F.count("item_id").alias("item_count")
    )


def contracts_from(contracts: DataFrame, totals: DataFrame) -> DataFrame:
    """``fact_contracts`` from contracts and the item totals per contract."""
    items = F.coalesce("items_total", F.lit(0.0))
    return _stamp(
        contracts.join(totals, "contract_id", "left").select(
            "contract_id",
            "vendor_id",
            "project_id",
            "contract_type",
            "contract_status",
            "contract_value",
            "revised_value",
            "start_date",
            F.col("variation_orders").alias("change_order_count"),
            c.difference("revised_value", "contract_value").alias(
                "change_order_value"
            ),
            items.alias("items_total"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            c.percent_or_zero(items, "contract_value").alias("value_utilisation_pct"),
            "payment_terms",
            "retention_pct",
            F.col("liquidated_damages_pct").alias("penalty_clause"),
            F.col("performance_bond_pct").alias("performance_bond"),
            "currency",
        )
    )


def fact_contracts(contracts: DataFrame, contract_items: DataFrame) -> DataFrame:
    return contracts_from(contracts, item_totals(contract_items))


def fact_sales(sales_orders: DataFrame, materials: DataFrame) -> DataFrame:
    """Sales with the product's name and a hashed customer key."""
    products = materials.select("material_id", F.col("material_name").alias("product_name"))
    return sales_from(sales_orders, products)


def sales_from(sales_orders: DataFrame, products: DataFrame) -> DataFrame:
    """``fact_sales`` from sales orders and product names."""
    return sales_orders.join(products, "material_id", "left").select(
        "sales_order_id",
        "product_name",
        "customer_name",
        F.sha2("customer_name", 256).alias("customer_id"),
        "customer_type",
        "order_type",
        "order_status",
        "payment_status",
        "order_date",
        "delivery_date",
        "quantity",
        "unit_price",
        "revenue",
        "cogs",
        "gross_margin",
        "margin_pct",
        "tax_amount",
        "total_amount",
        "currency",
        "delivery_terms",
        F.col("_silver_timestamp").alias("load_timestamp"),
    )
