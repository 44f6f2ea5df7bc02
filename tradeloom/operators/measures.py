"""Named measures over the star schema, sliced by any dimension attribute.

``measure(tables, name, by, where)`` computes one measure.  Measures of the same table can be taken
together in one aggregate with ``measures_of``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


@dataclass(frozen=True)
class Measure:
    """A measure: the table it lives on, its aggregates, and how to combine them."""

    table: str
    parts: Mapping[str, Callable[[], Column]]
    combine: Callable[[], Column] | None = None


def _total(column: str) -> Callable[[], Column]:
    return lambda: c.exact_sum(column)


def _quantity(column: str) -> Callable[[], Column]:
    return lambda: c.exact_sum(column)


def _rows() -> Column:
    return F.count(F.lit(1))


def _is(column: str, label: str) -> Column:
    """Equality that ignores case."""
    return F.upper(F.col(column)) == label.upper()


def _mean(column: str) -> dict[str, Callable[[], Column]]:
    return {
        "_sum": lambda: c.exact_sum(column),
        "_n": lambda: F.count(column),
    }


def _quotient(a: str, b: str) -> Callable[[], Column]:
    return lambda: c.divide_or_zero(a, b)


def _mean_value() -> Column:
    return c.safe_div("_sum", "_n")


_BUDGET = {"_budget": _total("budget_amount"), "_actual": _total("actual_amount")}
_MARGIN = {"_revenue": _total("revenue"), "_cogs": _total("cogs")}

MEASURES: dict[str, Measure] = {
    "Total Spend": Measure("fact_purchase_orders", {"v": _total("total_value")}),
    "Total PO Count": Measure("fact_purchase_orders", {"v": _rows}),
    "Avg PO Value": Measure(
        "fact_purchase_orders", {"_sum": _total("total_value"), "_n": _rows},
        _quotient("_sum", "_n"),
    ),
    "Total Invoiced": Measure("fact_invoices", {"v": _total("gross_amount")}),
    "Total Paid": Measure("fact_invoices", {"v": _total("paid_amount")}),
    "Overdue Amount": Measure(
        "fact_invoices",
        {"v": lambda: c.exact_sum(F.when(_is("payment_status", "Overdue"), F.col("gross_amount")))},
    ),
    "Avg Days to Pay": Measure("fact_invoices", _mean("days_to_pay"), _mean_value),
    "Total Budget": Measure("fact_project_costs", {"v": _total("budget_amount")}),
    "Total Actual Cost": Measure("fact_project_costs", {"v": _total("actual_amount")}),
    "Budget Variance": Measure(
        "fact_project_costs", _BUDGET, lambda: c.difference("_budget", "_actual")
    ),
    "Budget Utilization %": Measure(
        "fact_project_costs", _BUDGET, _quotient("_actual", "_budget")
    ),
    "Avg Vendor Score": Measure("fact_vendor_performance", _mean("overall_score"), _mean_value),
    "Vendor Count": Measure("dim_vendor", {"v": lambda: F.count_distinct("vendor_id")}),
    "Total Received Qty": Measure("fact_goods_receipts", {"v": _quantity("quantity_received")}),
    "Avg Acceptance Rate": Measure("fact_goods_receipts", _mean("acceptance_rate"), _mean_value),
    "Total Contract Value": Measure("fact_contracts", {"v": _total("contract_value")}),
    "Active Contracts": Measure(
        "fact_contracts", {"v": lambda: F.count_if(_is("contract_status", "Active"))}
    ),
    "Total Revenue": Measure("fact_sales", {"v": _total("revenue")}),
    "Total COGS": Measure("fact_sales", {"v": _total("cogs")}),
    "Gross Margin": Measure(
        "fact_sales", _MARGIN, lambda: c.difference("_revenue", "_cogs")
    ),
    "Margin %": Measure(
        "fact_sales",
        _MARGIN,
        lambda: c.divide_or_zero(c.difference("_revenue", "_cogs"), "_revenue"),
    ),
    "Net Inventory Flow": Measure("fact_inventory", {"v": _quantity("quantity")}),
    "Inventory Value": Measure("fact_inventory", {"v": _total("total_value")}),
    "Project Count": Measure("dim_project", {"v": lambda: F.count_distinct("project_id")}),
    "Over Budget Projects": Measure(
        "cube_project_costs",
        {"v": lambda: F.count_distinct(F.when(F.col("is_over_budget"), F.col("project_id")))},
    ),
    "Spend by Sector": Measure("cube_procurement_spend", {"v": _total("total_spend")}),
    "Spend Cube Vendor Count": Measure(
        "cube_procurement_spend", {"v": lambda: F.count_distinct("vendor_id")}
    ),
    "YoY Growth": Measure("cube_procurement_spend", _mean("yoy_growth_pct"), _mean_value),
}

Tables = Callable[[str], DataFrame]


def column_name(measure: str) -> str:
    """``Budget Utilization %`` -> ``budget_utilization_pct``."""
    return measure.lower().replace("%", "pct").replace(" ", "_")


def measure(
    tables: Tables, name: str, by: Sequence[str] = (), where: Column | str | None = None
) -> DataFrame:
    """One measure, grouped and filtered by columns of its table."""
    return measures_of(tables, [name], by, where)


def measures_of(
    tables: Tables, names: Sequence[str], by: Sequence[str] = (), where: Column | str | None = None
) -> DataFrame:
    """Several measures of one table, from a single pass over it."""
    chosen = [MEASURES[n] for n in names]
    table = chosen[0].table
    if any(m.table != table for m in chosen):
        raise ValueError(f"measures {list(names)} do not live on one table")
    rows = tables(table)
    return _aggregate(rows if where is None else rows.filter(where), names, by)


def _aggregate(rows: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    grouped = rows.groupBy(*by)
    out: list[Column | str] = list(by)
    aggregates: list[Column] = []
    for i, name in enumerate(names):
        m = MEASURES[name]
        for part, build in m.parts.items():
            aggregates.append(build().alias(f"m{i}{part}"))
    wide = grouped.agg(*aggregates)
    for i, name in enumerate(names):
        m = MEASURES[name]
        alias = column_name(name)
        if m.combine is None:
            out.append(F.col(f"m{i}v").alias(alias))
        else:
            wide = wide.withColumns({p: F.col(f"m{i}{p}") for p in m.parts})
            wide = wide.withColumn(f"r{i}", m.combine())
            out.append(F.col(f"r{i}").alias(alias))
    return wide.select(*out)


def measure_by_dimension(
    tables: Tables,
    name: str,
    dimension: str,
    key: str,
    by: Sequence[str],
    where: Column | str | None = None,
) -> DataFrame:
    """A measure of a fact sliced by attributes of a dimension (many-to-one, fact to dimension).

    Additive parts are summed per key before the dimension is joined, then summed per attribute.
    """
    m = MEASURES[name]
    rows = tables(m.table)
    rows = rows if where is None else rows.filter(where)
    attributes = tables(dimension).select(key, *by)
    per_key = rows.groupBy(key).agg(*[build().alias(p) for p, build in m.parts.items()])
    joined = per_key.join(attributes, key)
    kinds = dict(per_key.dtypes)
    total = joined.groupBy(*by).agg(
        *[
            (F.sum(p) if kinds[p] == "bigint" else c.exact_sum(p)).alias(p)
            for p in m.parts
        ]
    )
    value = m.combine() if m.combine else F.col("v")
    return total.select(*by, value.alias(column_name(name)))
