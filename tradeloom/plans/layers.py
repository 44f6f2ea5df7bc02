"""The three layers and the cubes as lazily built tables.

``Layers`` only composes DataFrames.  Reading one cube builds one logical plan, in which the
optimizer drops every column and table that the cube does not need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import cubes, dims, facts, silver

AsOf = dt.date | str | None


class Layers:
    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame] | Mapping[str, DataFrame],
        as_of: AsOf = None,
        calendar: tuple[str, str] = dims.CALENDAR,
    ):
        self.spark = spark
        self.as_of = as_of
        self.calendar = calendar
        self._raw = raw.__getitem__ if isinstance(raw, Mapping) else raw
        self._built: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        return self._once(f"raw.{table}", lambda: self._raw(table))

    def silver(self, table: str) -> DataFrame:
        return self._once(
            f"silver.{table}", lambda: silver.cleanse(table, self.raw(table), self.as_of)
        )

    def gold(self, table: str) -> DataFrame:
        return self._once(f"gold.{table}", lambda: GOLD[table](self))

    def cube(self, name: str) -> DataFrame:
        return self._once(f"cube.{name}", lambda: CUBES[name](self))

    def use(self, layer: str, table: str, df: DataFrame) -> None:
        """Put a stored table in the place of a computed one."""
        self._built[f"{layer}.{table}"] = df

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]


# Each gold table and the cleansed tables it reads.
GOLD: dict[str, Callable[[Layers], DataFrame]] = {
    "dim_date": lambda l: dims.dim_date(l.spark, l.calendar),
    "dim_vendor": lambda l: dims.dim_vendor(l.silver("vendors")),
    "dim_project": lambda l: dims.dim_project(l.silver("projects")),
    "dim_material": lambda l: dims.dim_material(l.silver("materials")),
    "dim_employee": lambda l: dims.dim_employee(l.silver("employees")),
    "dim_geography": lambda l: dims.dim_geography(l.silver("projects"), l.silver("vendors")),
    "dim_contract": lambda l: dims.dim_contract(l.silver("contracts")),
    "dim_cost_center": lambda l: dims.dim_cost_center(l.silver("employees")),
    "dim_sector": lambda l: dims.dim_sector(l.silver("vendors"), l.silver("projects")),
    "dim_currency": lambda l: dims.dim_currency(
        l.silver("purchase_orders"), l.silver("invoices"), l.silver("sales_orders")
    ),
    "fact_purchase_orders": lambda l: facts.fact_purchase_orders(
        l.silver("purchase_orders"), l.silver("po_line_items")
    ),
    "fact_invoices": lambda l: facts.fact_invoices(l.silver("invoices"), l.as_of),
    "fact_goods_receipts": lambda l: facts.fact_goods_receipts(
        l.silver("goods_receipts"), l.silver("po_line_items"), l.silver("purchase_orders")
    ),
    "fact_project_costs": lambda l: facts.fact_project_costs(
        l.silver("project_budgets"), l.silver("project_actuals")
    ),
    "fact_project_actuals": lambda l: facts.fact_project_actuals(l.silver("project_actuals")),
    "fact_vendor_performance": lambda l: facts.fact_vendor_performance(
        l.silver("vendor_performance")
    ),
    "fact_inventory": lambda l: facts.fact_inventory(l.silver("inventory")),
    "fact_contracts": lambda l: facts.fact_contracts(
        l.silver("contracts"), l.silver("contract_items")
    ),
    "fact_sales": lambda l: facts.fact_sales(l.silver("sales_orders"), l.silver("materials")),
}

CUBES: dict[str, Callable[[Layers], DataFrame]] = {
    "cube_procurement_spend": lambda l: cubes.cube_procurement_spend(
        l.gold("fact_purchase_orders"), l.gold("dim_vendor"), l.gold("dim_project")
    ),
    "cube_vendor_performance": lambda l: cubes.cube_vendor_performance(
        l.gold("fact_vendor_performance"), l.gold("dim_vendor")
    ),
    "cube_contract_status": lambda l: cubes.cube_contract_status(
        l.gold("fact_contracts"), l.gold("dim_contract"), l.gold("dim_vendor"),
        l.gold("dim_project"), l.as_of,
    ),
    "cube_invoice_aging": lambda l: cubes.cube_invoice_aging(
        l.gold("fact_invoices"), l.gold("dim_vendor"), l.gold("dim_project")
    ),
    "cube_project_costs": lambda l: cubes.cube_project_costs(
        l.gold("fact_project_costs"), l.gold("dim_project")
    ),
    "cube_goods_receipt_quality": lambda l: cubes.cube_goods_receipt_quality(
        l.gold("fact_goods_receipts"), l.gold("dim_vendor"), l.gold("dim_material")
    ),
    "cube_budget_vs_actual": lambda l: cubes.cube_budget_vs_actual(
        l.gold("fact_project_costs"), l.gold("dim_project")
    ),
    "cube_sales_analysis": lambda l: cubes.cube_sales_analysis(l.gold("fact_sales")),
    "cube_inventory_status": lambda l: cubes.cube_inventory_status(
        l.gold("fact_inventory"), l.gold("dim_material")
    ),
    "cube_spend_by_sector": lambda l: cubes.cube_spend_by_sector(
        l.gold("fact_purchase_orders"), l.gold("dim_vendor"), l.gold("dim_sector")
    ),
    "cube_delivery_performance": lambda l: cubes.cube_delivery_performance(
        l.gold("fact_purchase_orders"), l.gold("fact_goods_receipts"), l.gold("dim_vendor"),
    ),
    "cube_cost_variance": lambda l: cubes.cube_cost_variance(
        l.gold("fact_project_costs"), l.gold("dim_project")
    ),
    "cube_vendor_risk": lambda l: cubes.cube_vendor_risk(
        l.gold("dim_vendor"), l.gold("fact_vendor_performance"), l.gold("fact_invoices"),
        l.gold("fact_goods_receipts"),
    ),
    "cube_project_timeline": lambda l: cubes.cube_project_timeline(
        l.gold("dim_project"), l.gold("fact_project_costs"), l.gold("dim_contract"), l.as_of
    ),
    "cube_procurement_efficiency": lambda l: cubes.cube_procurement_efficiency(
        l.gold("fact_purchase_orders"), l.gold("fact_goods_receipts"), l.gold("fact_invoices"),
        l.gold("dim_vendor"),
    ),
}

# What the star schema owes its readers: per table the cleansed table it comes from, its key, and the
# columns that cubes read.
STAR_CONTRACT: dict[str, tuple[str, str, str]] = {
    "dim_vendor": ("vendors", "vendor_id", "vendor_name vendor_sector sector vendor_country vendor_city tier status _is_current"),
    "dim_project": (
        "projects", "project_id",
        "project_name sector status start_date end_date project_duration_days priority region _is_current",
    ),
    "dim_material": ("materials", "material_id", "material_name material_category _is_current"),
    "dim_employee": ("employees", "employee_id", "_is_current"),
    "dim_contract": (
        "contracts", "contract_id",
        "project_id contract_type status original_value revised_value start_date end_date contract_duration_days "
        "cost_growth_pct _is_current",
    ),
    "fact_purchase_orders": (
        "purchase_orders", "po_id",
        "vendor_id project_id po_date expected_delivery_date total_amount line_total total_quantity",
    ),
    "fact_invoices": (
        "invoices", "invoice_id",
        "vendor_id po_id project_id payment_status invoice_date payment_date net_amount tax_amount gross_amount "
        "days_outstanding aging_bucket",
    ),
    "fact_goods_receipts": (
        "goods_receipts", "grn_id",
        "po_id vendor_id material_id receipt_date quantity_received quantity_accepted quantity_rejected "
        "acceptance_rate receipt_value",
    ),
    "fact_project_costs": (
        "project_budgets", "budget_id",
        "project_id wbs_element cost_type budget_amount committed_amount actual_amount variance_amount variance_pct "
        "posting_date",
    ),
    "fact_project_actuals": ("project_actuals", "transaction_id", ""),
    "fact_vendor_performance": (
        "vendor_performance", "performance_id",
        "vendor_id evaluation_date evaluation_period delivery_score quality_score commercial_score hse_score "
        "overall_score recommendation",
    ),
    "fact_inventory": (
        "inventory", "movement_id", "material_id movement_type movement_date quantity unit_cost total_value"
    ),
    "fact_contracts": (
        "contracts", "contract_id", "vendor_id project_id items_total item_count value_utilisation_pct"
    ),
    "fact_sales": (
        "sales_orders", "sales_order_id",
        "product_name customer_name customer_type order_type order_date quantity unit_price revenue cogs gross_margin",
    ),
}

# References from facts into dimensions, by the name of the key on both sides.
_KEY_OF = {"vendor_id": "dim_vendor", "project_id": "dim_project", "material_id": "dim_material"}
STAR_REFERENCES: dict[str, dict[str, str]] = {
    t: {k: _KEY_OF[k] for k in keys.split()}
    for t, keys in {
        "fact_purchase_orders": "vendor_id project_id",
        "fact_invoices": "vendor_id project_id",
        "fact_goods_receipts": "vendor_id project_id material_id",
        "fact_project_costs": "project_id",
        "fact_vendor_performance": "vendor_id",
        "fact_inventory": "material_id",
        "fact_contracts": "vendor_id project_id",
    }.items()
}
