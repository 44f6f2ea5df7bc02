"""Report building blocks over any cube: slice, roll up, top n, matrix, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


def report_slice(cube: DataFrame, **chosen: object) -> DataFrame:
    """Slicers: keep rows whose columns have one of the chosen values.  None means all."""
    out = cube
    for column, values in chosen.items():
        if values is None:
            continue
        listed = list(values) if isinstance(values, (list, tuple, set)) else [values]
        out = out.filter(F.col(column).isin(*listed))
    return out


def aggregate(kind: str, column: str) -> Column:
    """One report value: sum, mean, or count of a column."""
    if kind == "sum":
        return c.exact_sum(column)
    if kind == "avg":
        return c.try_mean(column)
    if kind == "count":
        return F.count(column)
    raise ValueError(f"unknown aggregate {kind!r}")


def report_rollup(
    cube: DataFrame, by: Sequence[str], values: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Aggregate a cube by some of its dimensions; ``values`` maps name -> (aggregate, column)."""
    return cube.groupBy(*by).agg(
        *[aggregate(kind, column).alias(name) for name, (kind, column) in values.items()]
    )


def report_topn(
    cube: DataFrame, by: Sequence[str], name: str, value: tuple[str, str], n: int = 10
) -> DataFrame:
    """The n largest groups.  Ties are broken by the group's own columns."""
    return report_rollup(cube, by, {name: value}).orderBy(F.desc(name), *by).limit(n)


def report_matrix(
    cube: DataFrame,
    rows: Sequence[str],
    column: str,
    value: tuple[str, str],
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Rows by columns.

    The columns are the values that occur.  With a list of labels no pass has to collect them; all
    other values then meet in a column ``OTHER``, so that no amount is lost.
    """
    kind, measured = value
    if labels is None:
        return cube.groupBy(*rows).pivot(column).agg(aggregate(kind, measured))
    listed = F.when(F.col(column).isin(*labels), F.col(column)).otherwise(F.lit("OTHER"))
    shown = cube.withColumn("_label", listed)
    return shown.groupBy(*rows).pivot("_label", [*labels, "OTHER"]).agg(aggregate(kind, measured))


# The colour bands of the cost index.
def cpi_band(cpi: str) -> Column:
    value = F.col(cpi)
    return (
        F.when(value < 0.9, "RED").when(value <= 1.0, "YELLOW").when(value > 1.0, "GREEN")
    )


def growth_band(growth: str) -> Column:
    value = F.col(growth)
    return F.when(value > 0, "GREEN").when(value < 0, "RED")


def report_band(report: DataFrame, name: str, label: Column) -> DataFrame:
    return report.withColumn(name, label)


# The visuals of the eleven report pages: cube, dimensions, values.
VISUALS: dict[str, tuple[str, tuple[str, ...], dict[str, tuple[str, str]]]] = {
    "spend_trend": (
        "cube_procurement_spend", ("year_month",), {"total_spend": ("sum", "total_spend")},
    ),
    "budget_by_variance_class": (
        "cube_budget_vs_actual", ("variance_class",), {"actual_amount": ("sum", "actual_amount")},
    ),
    "spend_by_sector": (
        "cube_spend_by_sector", ("sector_name",), {"total_spend": ("sum", "total_spend")},
    ),
    "spend_by_project_sector": (
        "cube_procurement_spend", ("project_name", "vendor_sector"),
        {"total_spend": ("sum", "total_spend")},
    ),
    "yoy_growth_by_vendor": (
        "cube_procurement_spend", ("vendor_name",),
        {
            "total_spend": ("sum", "total_spend"),
            "prev_year_spend": ("sum", "prev_year_spend"),
            "avg_yoy_growth_pct": ("avg", "yoy_growth_pct"),
        },
    ),
    "vendor_scorecard": (
        "cube_vendor_performance", ("vendor_name",),
        {
            f"avg_{s}_score": ("avg", f"avg_{s}_score")
            for s in ("delivery", "quality", "commercial", "hse", "overall")
        },
    ),
    "vendors_by_risk_tier": (
        "cube_vendor_risk", ("risk_tier",), {"vendor_count": ("count", "vendor_id")},
    ),
    "aging_by_month": (
        "cube_invoice_aging", ("year_month", "aging_bucket"),
        {"total_net_amount": ("sum", "total_net_amount")},
    ),
    "overdue_by_vendor": (
        "cube_invoice_aging", ("vendor_name",), {"overdue_amount": ("sum", "overdue_amount")},
    ),
    "days_outstanding_trend": (
        "cube_invoice_aging", ("year_month",),
        {"avg_days_outstanding": ("avg", "avg_days_outstanding")},
    ),
    "cpi_by_project": ("cube_project_costs", ("project_name",), {"avg_cpi": ("avg", "cpi")}),
    "on_time_trend": (
        "cube_delivery_performance", ("year_month",),
        {"avg_on_time_rate_pct": ("avg", "on_time_rate_pct")},
    ),
    "quality_tier_counts": (
        "cube_goods_receipt_quality", ("quality_tier",), {"vendor_rows": ("count", "vendor_id")},
    ),
    "defect_by_category": (
        "cube_goods_receipt_quality", ("material_category",),
        {"avg_defect_rate_pct": ("avg", "defect_rate_pct")},
    ),
    "contract_value_by_status": (
        "cube_contract_status", ("status",), {"revised_value": ("sum", "revised_value")},
    ),
    "cost_growth_by_contract": (
        "cube_contract_status", ("contract_id",), {"avg_cost_growth_pct": ("avg", "cost_growth_pct")},
    ),
    "revenue_by_product": (
        "cube_sales_analysis", ("product_name",), {"total_revenue": ("sum", "total_revenue")},
    ),
    "margin_by_customer_type": (
        "cube_sales_analysis", ("customer_type",), {"avg_margin_pct": ("avg", "margin_pct")},
    ),
    "revenue_trend": (
        "cube_sales_analysis", ("year_month",),
        {
            "total_revenue": ("sum", "total_revenue"),
            "avg_yoy_growth_pct": ("avg", "revenue_yoy_growth_pct"),
        },
    ),
    "net_flow_by_material": (
        "cube_inventory_status", ("material_name",),
        {"net_quantity_flow": ("sum", "net_quantity_flow")},
    ),
    "issue_ratio_trend": (
        "cube_inventory_status", ("year_month",),
        {"avg_issue_to_receipt_ratio": ("avg", "issue_to_receipt_ratio")},
    ),
    "movement_value_by_month": (
        "cube_inventory_status", ("year_month", "material_category"),
        {"total_movement_value": ("sum", "total_movement_value")},
    ),
    "p2p_trend": (
        "cube_procurement_efficiency", ("year_month",),
        {"avg_total_p2p_days": ("avg", "avg_total_p2p_days")},
    ),
    "cycle_by_vendor": (
        "cube_procurement_efficiency", ("vendor_name",),
        {
            "avg_order_to_receipt_days": ("avg", "avg_order_to_receipt_days"),
            "avg_receipt_to_invoice_days": ("avg", "avg_receipt_to_invoice_days"),
            "avg_invoice_to_payment_days": ("avg", "avg_invoice_to_payment_days"),
            "avg_total_p2p_days": ("avg", "avg_total_p2p_days"),
            "avg_median_p2p": ("avg", "median_total_p2p"),
            "total_spend": ("sum", "total_spend"),
        },
    ),
    "schedule_status_counts": (
        "cube_project_timeline", ("schedule_status",), {"project_count": ("count", "project_id")},
    ),
    "schedule_variance_by_project": (
        "cube_project_timeline", ("project_name",),
        {"schedule_variance_days": ("sum", "schedule_variance_days")},
    ),
    "vendor_risk_scatter": (
        "cube_vendor_risk", ("vendor_name",),
        {
            "avg_overall_score": ("avg", "avg_overall_score"),
            "composite_risk_score": ("avg", "composite_risk_score"),
            "total_invoiced": ("sum", "total_invoiced"),
        },
    ),
    "contract_risk_flags": (
        "cube_contract_status",
        ("contract_id", "vendor_name", "project_name", "cost_risk_flag", "schedule_risk_flag"),
        {"remaining_value": ("sum", "remaining_value")},
    ),
    "cost_vs_plan_scatter": (
        "cube_project_timeline", ("project_name",),
        {
            "planned_pct_complete": ("avg", "planned_pct_complete"),
            "cost_pct_complete": ("avg", "cost_pct_complete"),
            "total_budget": ("sum", "total_budget"),
        },
    ),
}


def visual(cube_of, name: str) -> DataFrame:
    """The data behind one visual; ``cube_of`` returns a cube by name."""
    cube, by, values = VISUALS[name]
    return report_rollup(cube_of(cube), by, values)
