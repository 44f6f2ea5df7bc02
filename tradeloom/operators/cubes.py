"""Semantic layer: fifteen aggregate cubes over the star schema.

Shape shared by the cubes: the fact is aggregated by its keys first (partial aggregation on the map
side, so a hot vendor or project is reduced before the shuffle) and the dimension attributes are
joined to the much smaller result.  Comparisons with an earlier period are made at a grain that is
unique per period and joined back.  Nothing is written: a cube is a lazy plan, so a view on it follows
its tables.  Where a reduced result is read more than once, its exchange is reused within the plan.
No join carries a broadcast hint: dimensions may grow, so the optimizer decides by measured size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ranking import with_rank
from .dims import current

AsOf = dt.date | str | None
Calendar = tuple[str, str]


def _pick(dim: DataFrame, *cols: str | Column) -> DataFrame:
    return current(dim).select(*cols)


def growth_pct(now: str, before: str) -> Column:
    """Growth in percent; NULL unless there is a positive earlier value."""
    return F.when(
        F.col(before) > 0, F.round((c.dbl(now) - c.dbl(before)) / c.dbl(before) * 100, 2)
    )


def with_previous_year(
    monthly: DataFrame, quarterly: DataFrame, keys: list[str], total: str, previous: str
) -> DataFrame:
    """Quarter total per key, and the same quarter's total in the last year that has one.

    ``quarterly`` has one row per key, year and quarter, summed from the fact by itself: few columns
    and few rows, so comparing costs less than keeping the monthly rows.  The order is free of ties
    and a window holds one row per year.
    """
    years = Window.partitionBy(*keys, "quarter").orderBy("year")
    compared = quarterly.withColumn(previous, F.lag(total).over(years))
    return null_safe_join(monthly, compared, [*keys, "year", "quarter"])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys where NULL matches NULL; keeps the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])


# ---- spend -------------------------------------------------------------------------------------


def cube_procurement_spend(
    purchase_orders: DataFrame,
    dim_vendor: DataFrame,
    dim_project: DataFrame,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Spend per vendor, project and month, with the vendor's quarter against a year before.

    Orders are counted once each; the average is over the rows that have an amount.
    """
    periods = ["year", "quarter", "year_month"]
    dated = c.with_calendar(purchase_orders, "po_date", calendar, periods)
    projects = _pick(dim_project, "project_id", "project_name")
    # Orders of unknown projects or vendors do not count, so they leave before the comparison.
    monthly = (
        dated.groupBy("vendor_id", "project_id", *periods)
        .agg(
            F.count_distinct("po_id").alias("po_count"),
            c.exact_sum("total_amount").alias("total_spend"),
            c.exact_mean("total_amount").alias("avg_po_value"),
            c.exact_sum("line_total").alias("total_line_value"),
            c.exact_sum("total_quantity").alias("total_quantity"),
        )
        .join(projects, "project_id")
    )
    quarterly = (
        dated.groupBy("vendor_id", "project_id", "year", "quarter")
        .agg(c.exact_sum("total_amount").alias("_spend"))
        .join(projects.select("project_id"), "project_id")
        .groupBy("vendor_id", "year", "quarter")
        .agg(c.exact_sum("_spend").alias("vendor_quarter_spend"))
    )
    compared = with_previous_year(
        monthly, quarterly, ["vendor_id"], "vendor_quarter_spend", "prev_year_spend"
    )
    vendors = _pick(dim_vendor, "vendor_id", "vendor_name", F.col("sector").alias("vendor_sector"))
    return compared.join(vendors, "vendor_id").select(
        "vendor_id",
        "vendor_name",
        "vendor_sector",
        "project_id",
        "project_name",
        *periods,
        "po_count",
        "total_spend",
        "total_line_value",
        "total_quantity",
        "avg_po_value",
        "vendor_quarter_spend",
        "prev_year_spend",
        growth_pct("vendor_quarter_spend", "prev_year_spend").alias("yoy_growth_pct"),
    )


def cube_spend_by_sector(
    purchase_orders: DataFrame,
    dim_vendor: DataFrame,
    dim_sector: DataFrame,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Spend per sector, vendor and quarter: share in the sector, ranks, change on the year.

    ``sector_spend_rank`` ranks sectors by their total in the quarter and
    ``vendor_spend_rank`` ranks the vendor rows.
    """
    periods = ["year", "quarter"]
    dated = c.with_calendar(purchase_orders, "po_date", calendar, periods)
    vendors = _pick(
        dim_vendor, "vendor_id", "vendor_name", "sector", F.col("vendor_country").alias("country")
    )
    sectors = _pick(dim_sector, F.col("sector_key").alias("sector"), "sector_key", "sector_name")
    spend = (
        dated.groupBy("vendor_id", *periods)
        .agg(
            F.count(F.lit(1)).alias("po_count"),
            c.exact_sum("total_amount").alias("total_spend"),
            c.exact_mean("total_amount").alias("avg_po_value"),
            c.exact_sum("total_quantity").alias("total_quantity"),
        )
        .join(vendors, "vendor_id")
        .join(sectors, "sector")
    )
    by_sector = spend.groupBy("sector_key", *periods).agg(
        c.exact_sum("total_spend").alias("sector_spend")
    )
    ranked_sectors = with_rank(
        by_sector, periods, "sector_spend", "sector_spend_rank", dense=True
    )
    ranked = with_rank(spend, periods, "total_spend", "vendor_spend_rank", dense=True)
    # A vendor has one sector, so a window per vendor and quarter holds one row per year.
    years = Window.partitionBy("vendor_id", "quarter").orderBy("year")
    compared = ranked.withColumn("prev_year_spend", F.lag("total_spend").over(years))
    return null_safe_join(compared, ranked_sectors, ["sector_key", *periods]).select(
        "sector_key",
        "sector_name",
        "vendor_id",
        "vendor_name",
        "country",
        *periods,
        "po_count",
        "total_spend",
        "total_quantity",
        "avg_po_value",
        c.ratio("total_spend", "sector_spend", 2, 100).alias("vendor_sector_share_pct"),
        "sector_spend_rank",
        "vendor_spend_rank",
        "prev_year_spend",
        growth_pct("total_spend", "prev_year_spend").alias("yoy_growth_pct"),
    )


# ---- vendors -----------------------------------------------------------------------------------


def cube_vendor_performance(performance: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Scores per vendor and evaluation period, ranked in the period, with the trend.

    The latest recommendation is the one of the last evaluation (highest id on equal dates).
    Periods are ordered as text, which sorts both ``yyyyMM`` and ``yyyy-Qn``.
    """
    names = ["delivery", "quality", "commercial", "hse", "overall"]
    last = F.struct("evaluation_date", "performance_id")
    vendors = _pick(
        dim_vendor,
        "vendor_id",
        "vendor_name",
        "sector",
        "tier",
        F.col("vendor_country").alias("country"),
    )
    scores = (
        performance.groupBy("vendor_id", "evaluation_period")
        .agg(
            *[c.exact_mean(f"{n}_score").alias(f"_{n}") for n in names],
            F.max_by("recommendation", last).alias("latest_recommendation"),
            F.count(F.lit(1)).alias("evaluation_count"),
        )
        .join(vendors, "vendor_id")
    )
    ranked = with_rank(scores, ["evaluation_period"], "_overall", "vendor_rank", dense=True)
    periods = Window.partitionBy("vendor_id").orderBy("evaluation_period")
    trend = F.col("_overall") - F.lag("_overall").over(periods)
    return ranked.withColumn("score_trend", F.round(trend, 2)).select(
        "vendor_id",
        "vendor_name",
        "sector",
        "tier",
        "country",
        "evaluation_period",
        *[F.round(f"_{n}", 2).alias(f"avg_{n}_score") for n in names],
        "latest_recommendation",
        "evaluation_count",
        "vendor_rank",
        "score_trend",
    )


def cube_vendor_risk(
    dim_vendor: DataFrame,
    performance: DataFrame,
    invoices: DataFrame,
    receipts: DataFrame,
) -> DataFrame:
    """Composite risk score per vendor from scores, payment delay and acceptance (in percent).

    Three per-vendor aggregates are joined to the vendors; a vendor without signals gets the
    defaults.  100 is best.  The rank covers all vendors without sorting them in one task.
    """
    names = ["overall", "delivery", "quality", "commercial", "hse"]
    scores = performance.groupBy("vendor_id").agg(
        *[c.exact_mean(f"{n}_score").alias(f"avg_{n}_score") for n in names],
        F.min("overall_score").alias("min_overall_score"),
        F.count(F.lit(1)).alias("evaluation_count"),
    )
    payments = invoices.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        F.count_if(F.col("payment_status") == "OVERDUE").alias("overdue_invoices"),
        c.mean_days("days_outstanding").alias("avg_days_outstanding"),
        c.exact_sum("gross_amount").alias("total_invoiced"),
    )
    quality = receipts.groupBy("vendor_id").agg(
        c.exact_mean("acceptance_rate").alias("avg_acceptance_rate"),
        c.exact_sum("quantity_rejected").alias("total_rejected"),
    )
    overdue = c.safe_div("overdue_invoices", "invoice_count") * 100
    best, zero = F.lit(100.0), F.lit(0.0)
    composite = (
        F.coalesce("avg_overall_score", F.lit(50.0)) * 0.35
        + F.coalesce("avg_acceptance_rate", F.lit(50.0)) * 0.25
        + F.greatest(zero, best - F.coalesce("avg_days_outstanding", zero)) * 0.20
        + F.greatest(zero, best - F.coalesce(overdue, zero)) * 0.20
    )
    joined = (
        current(dim_vendor)
        .join(scores, "vendor_id", "left")
        .join(payments, "vendor_id", "left")
        .join(quality, "vendor_id", "left")
        .withColumn("_composite", composite)
    )
    ranked = with_rank(joined, [], "_composite", "risk_rank", dense=True)
    return ranked.select(
        "vendor_id",
        "vendor_name",
        "vendor_sector",
        "vendor_country",
        "vendor_city",
        "tier",
        F.col("status").alias("vendor_status"),
        *[f"avg_{n}_score" for n in names],
        "min_overall_score",
        "evaluation_count",
        "invoice_count",
        "overdue_invoices",
        "avg_days_outstanding",
        "total_invoiced",
        F.round(overdue, 2).alias("overdue_rate_pct"),
        "avg_acceptance_rate",
        "total_rejected",
        F.round("_composite", 2).alias("composite_risk_score"),
        c.band(F.col("_composite"), [(80, "LOW_RISK"), (60, "MEDIUM_RISK")], "HIGH_RISK").alias(
            "risk_tier"
        ),
        "risk_rank",
    )


# ---- contracts and invoices --------------------------------------------------------------------


def cube_contract_status(
    contracts: DataFrame,
    dim_contract: DataFrame,
    dim_vendor: DataFrame,
    dim_project: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """One row per contract with cost and schedule risk."""
    today = c.as_of_date(as_of)
    active = F.col("status") == "ACTIVE"
    items = contracts.select(
        "contract_id", "vendor_id", "project_id", "items_total", "item_count",
        "value_utilisation_pct",
    )
    details = _pick(
        dim_contract,
        "contract_id", "contract_type", "status", "start_date", "end_date", "original_value",
        "revised_value", "contract_duration_days", "cost_growth_pct",
    )
    joined = (
        items.join(details, "contract_id")
        .join(_pick(dim_vendor, "vendor_id", "vendor_name"), "vendor_id")
        .join(_pick(dim_project, "project_id", "project_name"), "project_id")
    )
    cost_risk = (
        F.when(F.col("cost_growth_pct") > 20, "HIGH_COST_RISK")
        .when(F.col("cost_growth_pct") > 10, "MEDIUM_COST_RISK")
        .otherwise("LOW_COST_RISK")
    )
    schedule_risk = (
        F.when(active & (F.col("end_date") < today), "OVERDUE")
        .when(active & (F.datediff("end_date", today) < 30), "NEAR_EXPIRY")
        .otherwise("ON_TRACK")
    )
    remaining = F.col("revised_value") - F.coalesce("items_total", F.lit(0.0))
    return joined.select(
        "contract_id",
        "contract_type",
        "status",
        "vendor_id",
        "vendor_name",
        "project_id",
        "project_name",
        "start_date",
        "end_date",
        "original_value",
        "revised_value",
        "items_total",
        "item_count",
        "contract_duration_days",
        "cost_growth_pct",
        "value_utilisation_pct",
        cost_risk.alias("cost_risk_flag"),
        schedule_risk.alias("schedule_risk_flag"),
        c.settled(remaining).alias("remaining_value"),
    )


def cube_invoice_aging(
    invoices: DataFrame,
    dim_vendor: DataFrame,
    dim_project: DataFrame,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Invoices per vendor, project, month and aging bucket."""
    periods = ["year", "quarter", "year_month"]
    overdue = F.col("payment_status") == "OVERDUE"
    dated = c.with_calendar(invoices, "invoice_date", calendar, [])
    month = F.trunc("invoice_date", "month").alias("_month")
    totals = dated.groupBy("vendor_id", "project_id", month, "aging_bucket").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        c.exact_sum("net_amount").alias("total_net_amount"),
        c.exact_sum("gross_amount").alias("total_gross_amount"),
        c.exact_sum("tax_amount").alias("total_tax_amount"),
        c.mean_days("days_outstanding").alias("avg_days_outstanding"),
        F.max("days_outstanding").alias("max_days_outstanding"),
        c.sum_when(overdue, "gross_amount").alias("overdue_amount"),
        F.count_if(overdue).alias("overdue_count"),
    )
    # The vendor's and the project's texts come last, and the period travels as one day of the month.
    joined = (
        totals.join(_pick(dim_project, "project_id", "project_name"), "project_id")
        .join(_pick(dim_vendor, "vendor_id", "vendor_name", "vendor_sector"), "vendor_id")
    )
    return c.with_calendar(joined, "_month", None, periods).select(
        "project_id", "vendor_id", *periods, "aging_bucket",
        *[n for n in totals.columns if n not in ("project_id", "vendor_id", "_month", "aging_bucket")],
        "vendor_name", "vendor_sector", "project_name",
        c.ratio("overdue_amount", "total_gross_amount", 2, 100).alias("overdue_pct"),
    )


# ---- project cost ------------------------------------------------------------------------------


def _cost_lines(costs: DataFrame) -> DataFrame:
    """Costs per project, work package and cost type."""
    exposure = F.col("actual_amount") + F.col("committed_amount")
    return costs.groupBy("project_id", "wbs_element", "cost_type").agg(
        c.exact_sum("budget_amount").alias("budget_amount"),
        c.exact_sum("actual_amount").alias("actual_amount"),
        c.exact_sum("committed_amount").alias("committed_amount"),
        c.exact_sum(exposure).alias("total_exposure"),
        c.exact_sum("variance_amount").alias("variance_amount"),
        c.exact_sum("variance_pct").alias("_variance_pct_sum"),
        F.count("variance_pct").alias("_variance_pct_rows"),
    )


def cube_project_costs(costs: DataFrame, dim_project: DataFrame) -> DataFrame:
    """Cost performance per project.

    Distinct work packages and cost types are counted on the per-line totals, not on raw rows.
    """
    totals = _cost_lines(costs).groupBy("project_id").agg(
        c.exact_sum("budget_amount").alias("total_budget"),
        c.exact_sum("actual_amount").alias("total_actual"),
        c.exact_sum("committed_amount").alias("total_committed"),
        c.exact_sum("total_exposure").alias("total_exposure"),
        c.exact_sum("variance_amount").alias("total_variance"),
        c.exact_sum("_variance_pct_sum").alias("_pct_sum"),
        F.sum("_variance_pct_rows").alias("_pct_rows"),
        F.count_distinct("wbs_element").alias("wbs_count"),
        F.count_distinct("cost_type").alias("cost_type_count"),
    )
    projects = _pick(
        dim_project,
        "project_id", "project_name", F.col("status").alias("project_status"), "sector",
        "region", "priority", "project_duration_days",
    )
    over = F.coalesce(F.col("total_exposure") > F.col("total_budget"), F.lit(False))
    return projects.join(totals, "project_id").select(
        "project_id",
        "project_name",
        "project_status",
        "sector",
        "region",
        "priority",
        "project_duration_days",
        "total_budget",
        "total_actual",
        "total_committed",
        "total_exposure",
        "total_variance",
        c.safe_div("_pct_sum", "_pct_rows").alias("avg_variance_pct"),
        c.ratio("total_budget", "total_exposure", 4).alias("cpi"),
        over.alias("is_over_budget"),
        c.ratio("total_actual", "total_budget", 2, 100).alias("budget_utilisation_pct"),
        "wbs_count",
        "cost_type_count",
    )


def cube_budget_vs_actual(costs: DataFrame, dim_project: DataFrame) -> DataFrame:
    """Budget against actual per project, work package and cost type."""
    variance, budget = c.dbl("variance_amount"), c.dbl("budget_amount")
    kind = (
        F.when(variance > 0, "UNDER_BUDGET")
        .when(variance < -budget * 0.10, "CRITICAL_OVERRUN")
        .when(variance < 0, "OVER_BUDGET")
        .otherwise("ON_BUDGET")
    )
    projects = _pick(dim_project, "project_id", "project_name", "sector", "region")
    return _cost_lines(costs).join(projects, "project_id").select(
        "project_id",
        "project_name",
        "sector",
        "region",
        "wbs_element",
        "cost_type",
        "budget_amount",
        "actual_amount",
        "committed_amount",
        "total_exposure",
        "variance_amount",
        c.safe_div("_variance_pct_sum", "_variance_pct_rows").alias("avg_variance_pct"),
        kind.alias("variance_class"),
        c.ratio("budget_amount", "total_exposure", 4).alias("cpi"),
        c.ratio("actual_amount", "budget_amount", 2, 100).alias("budget_consumed_pct"),
    )


def cube_cost_variance(costs: DataFrame, dim_project: DataFrame) -> DataFrame:
    """Overruns per project, cost type and work package, ranked inside the project."""
    lines = _cost_lines(costs).withColumn(
        "_excess", c.difference("total_exposure", "budget_amount")
    )
    share = c.safe_div("_excess", "budget_amount")
    severity = (
        F.when(F.col("_excess") <= 0, "WITHIN_BUDGET")
        .when(share <= 0.05, "MINOR_OVERRUN")
        .when(share <= 0.15, "MODERATE_OVERRUN")
        .otherwise("SEVERE_OVERRUN")
    )
    projects = _pick(
        dim_project,
        "project_id", "project_name", F.col("status").alias("project_status"), "sector", "region",
    )
    # A project holds its work packages times its cost types, so one window per project is small.
    inside = Window.partitionBy("project_id").orderBy(F.desc_nulls_last("_excess"))
    ranked = lines.withColumn("overrun_rank", F.dense_rank().over(inside))
    return ranked.join(projects, "project_id").select(
        "project_id",
        "project_name",
        "project_status",
        "sector",
        "region",
        "cost_type",
        "wbs_element",
        "budget_amount",
        "actual_amount",
        "committed_amount",
        "variance_amount",
        F.greatest("_excess", F.lit(0.0)).alias("overrun_amount"),
        severity.alias("overrun_severity"),
        c.ratio("budget_amount", "total_exposure", 4).alias("cpi"),
        c.difference("budget_amount", "actual_amount").alias("remaining_budget"),
        c.ratio("actual_amount", "budget_amount", 2, 100).alias("burn_rate_pct"),
        "overrun_rank",
    )


def cube_project_timeline(
    dim_project: DataFrame,
    costs: DataFrame,
    dim_contract: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """Schedule status per project, with spend span and contract counts."""
    spend = (
        costs.groupBy("project_id", "wbs_element", "cost_type")
        .agg(
            F.min("posting_date").alias("_first"),
            F.max("posting_date").alias("_last"),
            c.exact_sum("actual_amount").alias("_actual"),
            c.exact_sum("budget_amount").alias("_budget"),
        )
        .groupBy("project_id")
        .agg(
            F.min("_first").alias("first_spend_date"),
            F.max("_last").alias("last_spend_date"),
            c.exact_sum("_actual").alias("total_actual"),
            c.exact_sum("_budget").alias("total_budget"),
            F.count_distinct("wbs_element").alias("active_wbs_count"),
        )
    )
    contracts = current(dim_contract).groupBy("project_id").agg(
        F.count(F.lit(1)).alias("contract_count"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_contracts"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_contracts"),
        c.exact_sum("revised_value").alias("total_contract_value"),
    )
    today, end, last = c.as_of_date(as_of), F.col("end_date"), F.col("last_spend_date")
    done = F.col("status").isin("COMPLETED", "CLOSED")
    status = (
        F.when(done & (last <= end), "ON_TIME")
        .when(done, "DELAYED")
        .when(end < today, "OVERDUE")
        .when(F.datediff(end, today) < 30, "AT_RISK")
        .otherwise("ON_TRACK")
    )
    elapsed = F.datediff(F.least(today, end), "start_date")
    return (
        current(dim_project)
        .join(spend, "project_id", "left")
        .join(contracts, "project_id", "left")
        .select(
            "project_id",
            "project_name",
            F.col("status").alias("project_status"),
            "sector",
            "region",
            "priority",
            "start_date",
            "end_date",
            F.col("project_duration_days").alias("planned_duration_days"),
            "first_spend_date",
            "last_spend_date",
            F.datediff("last_spend_date", "first_spend_date").alias("actual_active_days"),
            F.when(done, F.datediff(last, end))
            .otherwise(F.datediff(today, end))
            .alias("schedule_variance_days"),
            status.alias("schedule_status"),
            c.ratio(elapsed, "project_duration_days", 4).alias("planned_pct_complete"),
            c.ratio("total_actual", "total_budget", 4).alias("cost_pct_complete"),
            "total_actual",
            "total_budget",
            "active_wbs_count",
            "contract_count",
            "active_contracts",
            "completed_contracts",
            "total_contract_value",
        )
    )


# ---- receipts and delivery ---------------------------------------------------------------------


def cube_goods_receipt_quality(
    receipts: DataFrame, dim_vendor: DataFrame, dim_material: DataFrame
) -> DataFrame:
    """Acceptance and defects per vendor and material; rates are percentages throughout."""
    totals = receipts.groupBy("vendor_id", "material_id").agg(
        F.count(F.lit(1)).alias("receipt_count"),
        c.exact_sum("quantity_received").alias("total_qty_received"),
        c.exact_sum("quantity_accepted").alias("total_qty_accepted"),
        c.exact_sum("quantity_rejected").alias("total_qty_rejected"),
        c.exact_mean("acceptance_rate").alias("_acceptance"),
        F.min("acceptance_rate").alias("min_acceptance_rate"),
        c.exact_sum("receipt_value").alias("total_receipt_value"),
    )
    # The tier bounds in percent.
    tiers = [(98, "EXCELLENT"), (95, "GOOD"), (90, "ACCEPTABLE")]
    rejected_value = c.dbl("total_receipt_value") * c.dbl("total_qty_rejected")
    return (
        totals.join(_pick(dim_vendor, "vendor_id", "vendor_name", "vendor_sector"), "vendor_id")
        .join(_pick(dim_material, "material_id", "material_name", "material_category"),
              "material_id")
        .select(
            "vendor_id",
            "vendor_name",
            "vendor_sector",
            "material_id",
            "material_name",
            "material_category",
            "receipt_count",
            "total_qty_received",
            "total_qty_accepted",
            "total_qty_rejected",
            F.round("_acceptance", 4).alias("avg_acceptance_rate"),
            "min_acceptance_rate",
            "total_receipt_value",
            c.ratio("total_qty_rejected", "total_qty_received", 2, 100).alias("defect_rate_pct"),
            c.band(F.col("_acceptance"), tiers, "POOR").alias("quality_tier"),
            c.ratio(rejected_value, "total_qty_received", 2).alias("estimated_rejection_value"),
        )
    )


def with_previous_quarter(
    monthly: DataFrame, share: Column, total: str, previous: str, parts: list[str]
) -> DataFrame:
    """A ratio per vendor and quarter, and its value in the vendor's quarter before."""
    quarterly = monthly.groupBy("vendor_id", "year", "quarter").agg(
        *[F.sum(p).alias(p) for p in parts]
    )
    quarters = Window.partitionBy("vendor_id").orderBy("year", "quarter")
    compared = (
        quarterly.withColumn(total, share)
        .withColumn(previous, F.lag(total).over(quarters))
        .drop(*parts)
    )
    return null_safe_join(monthly, compared, ["vendor_id", "year", "quarter"])


def last_receipt_per_order(receipts: DataFrame) -> DataFrame:
    return receipts.groupBy("po_id").agg(F.max("receipt_date").alias("receipt_date"))


def cube_delivery_performance(
    purchase_orders: DataFrame,
    receipts: DataFrame,
    dim_vendor: DataFrame,
    calendar: Calendar | None = None,
    per_receipt: bool = False,
) -> DataFrame:
    """On-time delivery per vendor and month, with the vendor's previous quarter.

    An order counts once and is delivered with its last receipt.  ``per_receipt=True`` counts
    every receipt as a delivery of the whole order, which repeats the order's value.
    """
    periods = ["year", "quarter", "year_month"]
    dated = c.with_calendar(purchase_orders, "po_date", calendar, periods).select(
        "po_id", "vendor_id", "expected_delivery_date", "total_amount", *periods
    )
    delivered = (
        receipts.select("po_id", "receipt_date") if per_receipt
        else last_receipt_per_order(receipts)
    )
    late = F.col("_late")
    on_time = late <= 0
    classed = dated.join(delivered, "po_id").withColumn(
        "_late", F.datediff("receipt_date", "expected_delivery_date")
    )
    monthly = classed.groupBy("vendor_id", *periods).agg(
        F.count(F.lit(1)).alias("delivery_count"),
        F.sum(late.cast("long")).alias("_late_sum"),
        F.count(late).alias("_late_rows"),
        F.max(late).alias("max_variance_days"),
        F.min(late).alias("min_variance_days"),
        F.count_if(on_time).alias("on_time_count"),
        F.count_if((late > 0) & (late <= 7)).alias("late_1wk_count"),
        F.count_if((late > 7) & (late <= 30)).alias("late_1mo_count"),
        F.count_if((late > 30) | late.isNull()).alias("late_over_mo_count"),
        c.exact_sum("total_amount").alias("total_value_delivered"),
    )
    rate = c.ratio("on_time_count", "delivery_count", 2, 100)
    compared = with_previous_quarter(
        monthly, rate, "quarter_on_time_pct", "prev_quarter_on_time_pct",
        ["on_time_count", "delivery_count"],
    )
    vendors = _pick(dim_vendor, "vendor_id", "vendor_name", "vendor_sector")
    return compared.join(vendors, "vendor_id").select(
        "vendor_id",
        "vendor_name",
        "vendor_sector",
        *periods,
        "delivery_count",
        c.safe_div("_late_sum", "_late_rows").alias("avg_variance_days"),
        "max_variance_days",
        "min_variance_days",
        rate.alias("on_time_rate_pct"),
        "on_time_count",
        "late_1wk_count",
        "late_1mo_count",
        "late_over_mo_count",
        "total_value_delivered",
        "quarter_on_time_pct",
        "prev_quarter_on_time_pct",
    )


def cube_procurement_efficiency(
    purchase_orders: DataFrame,
    receipts: DataFrame,
    invoices: DataFrame,
    dim_vendor: DataFrame,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Procure-to-pay cycle times per vendor and month, with exact medians.

    Receipts and invoices are reduced to one row per order (the last receipt, the last invoice
    and the last payment) before the join.  Joining them raw would pair every receipt of an order
    with every invoice of it and count the order's value once per pair.
    Day counts have few distinct values, so the exact median keeps a small state per group.
    """
    periods = ["year", "quarter", "year_month"]
    dated = c.with_calendar(purchase_orders, "po_date", calendar, periods).select(
        "po_id", "vendor_id", "po_date", "total_amount", *periods
    )
    billed = invoices.groupBy("po_id").agg(
        F.max("invoice_date").alias("invoice_date"), F.max("payment_date").alias("payment_date")
    )
    cycle = (
        dated.join(last_receipt_per_order(receipts), "po_id", "left")
        .join(billed, "po_id", "left")
        .withColumns(
            {
                "order_to_receipt": F.datediff("receipt_date", "po_date"),
                "receipt_to_invoice": F.datediff("invoice_date", "receipt_date"),
                "invoice_to_payment": F.datediff("payment_date", "invoice_date"),
                "total_p2p": F.datediff("payment_date", "po_date"),
            }
        )
    )
    stages = ["order_to_receipt", "receipt_to_invoice", "invoice_to_payment", "total_p2p"]
    measures: list[Column] = []
    for stage in stages:
        measures.append(c.mean_days(stage).alias(f"avg_{stage}_days"))
        measures.append(F.percentile(stage, F.lit(0.5)).alias(f"median_{stage}"))
    monthly = cycle.groupBy("vendor_id", *periods).agg(
        F.count(F.lit(1)).alias("po_count"),
        *measures,
        F.min("total_p2p").alias("min_p2p_days"),
        F.max("total_p2p").alias("max_p2p_days"),
        c.exact_sum("total_amount").alias("total_spend"),
        F.sum(F.col("total_p2p").cast("long")).alias("_days"),
        F.count("total_p2p").alias("_complete"),
    )
    compared = with_previous_quarter(
        monthly, c.safe_div("_days", "_complete"), "quarter_avg_p2p_days",
        "prev_quarter_avg_p2p_days", ["_days", "_complete"],
    )
    vendors = _pick(dim_vendor, "vendor_id", "vendor_name", "vendor_sector")
    return (
        compared.join(vendors, "vendor_id")
        .withColumn("complete_p2p_pct", c.ratio("_complete", "po_count", 2, 100))
        .drop("_days", "_complete")
    )


# ---- sales and stock ---------------------------------------------------------------------------


def cube_sales_analysis(sales: DataFrame, calendar: Calendar | None = None) -> DataFrame:
    """Revenue and margin per product, customer, type and month, with the product's year before."""
    keys = ["product_name", "customer_name", "customer_type", "order_type"]
    periods = ["year", "quarter", "year_month"]
    dated = c.with_calendar(sales, "order_date", calendar, periods[:2])
    # The month travels as its first day; what it is called follows behind the exchange.
    monthly = dated.groupBy(*keys, F.trunc("order_date", "month").alias("_month")).agg(
        F.count(F.lit(1)).alias("sales_count"),
        c.exact_sum("quantity").alias("total_quantity"),
        c.exact_sum("revenue").alias("total_revenue"),
        c.exact_sum("cogs").alias("total_cogs"),
        c.exact_sum("gross_margin").alias("total_margin"),
        c.exact_mean("unit_price").alias("avg_unit_price"),
    )
    totals = [n for n in monthly.columns if n not in (*keys, "_month")]
    monthly = c.with_calendar(monthly, "_month", None, periods).select(*keys, *periods, *totals)
    quarterly = dated.groupBy("product_name", "year", "quarter").agg(
        c.exact_sum("revenue").alias("product_quarter_revenue")
    )
    compared = with_previous_year(
        monthly, quarterly, ["product_name"], "product_quarter_revenue", "prev_year_revenue"
    )
    change = c.dbl("product_quarter_revenue") - c.dbl("prev_year_revenue")
    return compared.withColumns(
        {
            "margin_pct": c.ratio("total_margin", "total_revenue", 2, 100),
            "revenue_yoy_growth_pct": c.ratio(change, "prev_year_revenue", 2, 100),
        }
    )


def cube_inventory_status(
    movements: DataFrame, dim_material: DataFrame, calendar: Calendar | None = None
) -> DataFrame:
    """Stock movements per material and month, by type.

    Issues are stored with a negative quantity, so the net flow is the sum of receipts, returns
    and issues, and the issue-to-receipt ratio uses the size of the issues.
    ``avg_unit_cost`` is the mean over the movement types of each type's mean (four digits).
    """
    periods = ["year", "quarter", "year_month"]
    dated = c.with_calendar(movements, "movement_date", calendar, periods)
    by_type = dated.groupBy("material_id", "movement_type", *periods).agg(
        F.count(F.lit(1)).alias("movement_count"),
        c.exact_sum("quantity").alias("total_quantity"),
        c.exact_sum("total_value").alias("total_value"),
        F.round(c.exact_mean("unit_cost"), 4).alias("avg_unit_cost"),
    )
    kind = F.col("movement_type")
    receipt, issue, back = kind == "RECEIPT", kind == "ISSUE", kind == "RETURN"

    def count_of(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("movement_count")).otherwise(F.lit(0)))

    monthly = by_type.groupBy("material_id", *periods).agg(
        count_of(receipt).alias("receipt_count"),
        count_of(issue).alias("issue_count"),
        count_of(back).alias("return_count"),
        F.sum("movement_count").alias("total_movement_count"),
        c.sum_when(receipt, "total_quantity").alias("qty_received"),
        c.sum_when(issue, "total_quantity").alias("qty_issued"),
        c.sum_when(back, "total_quantity").alias("qty_returned"),
        c.sum_when(receipt | issue | back, "total_quantity").alias(
            "net_quantity_flow"
        ),
        c.sum_when(receipt, "total_value").alias("receipt_value"),
        c.sum_when(issue, "total_value").alias("issue_value"),
        c.sum_when(back, "total_value").alias("return_value"),
        c.exact_sum("total_value").alias("total_movement_value"),
        c.exact_mean("avg_unit_cost").alias("avg_unit_cost"),
    )
    materials = _pick(dim_material, "material_id", "material_name", "material_category")
    return monthly.join(materials, "material_id").withColumn(
        "issue_to_receipt_ratio", c.ratio(F.abs(F.col("qty_issued")), "qty_received", 2)
    )
