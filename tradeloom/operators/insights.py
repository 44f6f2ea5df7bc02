"""Analyses on top of the star schema and the cubes: alerts, concentration, earned value, cash
flow, three-way match, stock alerts, burn rate, S-curve.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ranking import ordered_totals
from ..session import stored

AsOf = dt.date | str | None

# ---- KPI alerts --------------------------------------------------------------------------------

# Per KPI the direction that is good, the target and the alert threshold.
KPI_THRESHOLDS: dict[str, tuple[str, float, float]] = {
    "spend_vs_budget_pct": ("low", 100.0, 110.0),
    "yoy_spend_growth_pct": ("low", 15.0, 20.0),
    "invoice_days_outstanding": ("low", 30.0, 60.0),
    "overdue_invoice_pct": ("low", 5.0, 15.0),
    "cost_performance_index": ("high", 1.0, 0.9),
    "budget_variance_pct": ("high", 0.0, -10.0),
    "on_time_delivery_pct": ("high", 95.0, 85.0),
    "material_acceptance_pct": ("high", 98.0, 90.0),
    "defect_rate_pct": ("low", 2.0, 10.0),
    "vendor_overall_score": ("high", 80.0, 60.0),
    "procurement_cycle_days": ("low", 5.0, 15.0),
    "budget_utilisation_pct": ("low", 100.0, 100.0),  # and not below KPI_FLOORS
    "contract_cost_growth_pct": ("low", 5.0, 20.0),
    "schedule_variance_days": ("low", 0.0, 30.0),
    "contract_utilisation_pct": ("high", 80.0, 50.0),
}


# KPIs whose target is a range, with its lower end.
KPI_FLOORS: dict[str, float] = {"budget_utilisation_pct": 85.0}


def kpi_status(name: str, value: Column) -> Column:
    """OK at the target, ALERT beyond the threshold, WARN in between and below a range."""
    good, target, alert = KPI_THRESHOLDS[name]
    if good == "low":
        bad, fine = value > alert, value <= target
    else:
        bad, fine = value < alert, value >= target
    if name in KPI_FLOORS:
        fine = fine & (value >= KPI_FLOORS[name])
    label = F.when(value.isNull(), "NO DATA").when(bad, "ALERT").when(fine, "OK")
    return label.otherwise("WARN")


def _as_rows(one_row: DataFrame) -> DataFrame:
    """Turn a one-row aggregate into one row per column."""
    entries = [
        F.struct(F.lit(name).alias("name"), F.col(name).cast("double").alias("value"))
        for name in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def kpi_alerts(
    purchase_orders: DataFrame,
    invoices: DataFrame,
    costs: DataFrame,
    delivery: DataFrame,
    receipts: DataFrame,
    performance: DataFrame,
    contracts: DataFrame,
    timeline: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """Fifteen KPIs with value, target, alert threshold and status.

    Every source table is reduced to one row in a single pass; the few numbers are then brought
    into one row, from which all KPIs follow.  Year-on-year growth compares the last two full
    calendar years before ``as_of``.  The cycle time runs from the approval of an order to the
    order.
    """
    this_year = F.year(c.as_of_date(as_of))
    year, total = F.year("po_date"), F.col("total_amount")
    exposure = F.col("actual_amount") + F.col("committed_amount")
    sources = [
        purchase_orders.agg(
            c.exact_sum("total_amount").alias("spend"),
            c.sum_when(year == this_year - 1, total).alias("last_year"),
            c.sum_when(year == this_year - 2, total).alias("year_before"),
            c.mean_days(F.datediff("po_date", "approval_date")).alias("cycle"),
        ),
        invoices.agg(
            c.mean_days("days_outstanding").alias("outstanding"),
            c.sum_when(F.col("payment_status") == "OVERDUE", "gross_amount").alias("overdue"),
            c.exact_sum("gross_amount").alias("gross"),
        ),
        costs.agg(
            c.exact_sum("budget_amount").alias("budget"),
            c.exact_sum("actual_amount").alias("actual"),
            c.exact_sum(exposure).alias("exposure"),
        ),
        delivery.agg(
            F.sum("on_time_count").alias("on_time"), F.sum("delivery_count").alias("deliveries")
        ),
        receipts.agg(
            c.exact_sum("quantity_received").alias("received"),
            c.exact_sum("quantity_accepted").alias("accepted"),
            c.exact_sum("quantity_rejected").alias("rejected"),
        ),
        performance.agg(c.exact_mean("overall_score").alias("score")),
        contracts.agg(
            c.exact_sum("contract_value").alias("original"),
            c.exact_sum("revised_value").alias("revised"),
            c.exact_sum("items_total").alias("items"),
        ),
        timeline.agg(c.mean_days("schedule_variance_days").alias("late")),
    ]
    numbers = _as_rows(sources[0])
    for source in sources[1:]:
        numbers = numbers.unionByName(_as_rows(source))
    names = [name for source in sources for name in source.columns]
    one_row = numbers.agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    )

    def change(now: str, before: str) -> Column:
        return c.ratio(F.col(now) - F.col(before), before, 2, 100)

    kpis = {
        "spend_vs_budget_pct": c.ratio("spend", "budget", 2, 100),
        "yoy_spend_growth_pct": change("last_year", "year_before"),
        "invoice_days_outstanding": F.round("outstanding", 2),
        "overdue_invoice_pct": c.ratio("overdue", "gross", 2, 100),
        "cost_performance_index": c.ratio("budget", "exposure", 4),
        "budget_variance_pct": c.ratio(F.col("budget") - F.col("actual"), "budget", 2, 100),
        "on_time_delivery_pct": c.ratio("on_time", "deliveries", 2, 100),
        "material_acceptance_pct": c.ratio("accepted", "received", 2, 100),
        "defect_rate_pct": c.ratio("rejected", "received", 2, 100),
        "vendor_overall_score": F.round("score", 2),
        "procurement_cycle_days": F.round("cycle", 2),
        "budget_utilisation_pct": c.ratio("actual", "budget", 2, 100),
        "contract_cost_growth_pct": change("revised", "original"),
        "schedule_variance_days": F.round("late", 2),
        "contract_utilisation_pct": c.ratio("items", "original", 2, 100),
    }
    entries = [
        F.struct(
            F.lit(name).alias("kpi"),
            value.alias("value"),
            F.lit(KPI_THRESHOLDS[name][1]).alias("target"),
            F.lit(KPI_THRESHOLDS[name][2]).alias("alert_threshold"),
            kpi_status(name, value).alias("status"),
        )
        for name, value in kpis.items()
    ]
    return one_row.select(F.inline(F.array(*entries)))


# ---- concentration -----------------------------------------------------------------------------


def concentration_risk(purchase_orders: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Each vendor's share of all spend.  The grand total enters as a scalar subquery."""
    spend = stored(
        purchase_orders.groupBy("vendor_id").agg(c.exact_sum("total_amount").alias("spend")),
        "vendor_spend",
    )
    total = spend.agg(c.exact_sum("spend").alias("total")).scalar()
    vendors = dim_vendor.select("vendor_id", "vendor_name")
    return spend.join(vendors, "vendor_id").select(
        "vendor_id", "vendor_name", "spend", c.ratio("spend", total, 4, 100).alias("share_pct")
    )


def spend_concentration(
    po_line_items: DataFrame, dim_material: DataFrame, level: str = "category"
) -> DataFrame:
    """Pareto of spend per category (or material): share and cumulative share, largest first.

    Groups with equal spend get the same cumulative share.
    """
    per_material = po_line_items.groupBy("material_id").agg(
        c.exact_sum("line_value").alias("spend")
    )
    attributes = dim_material.select(*dict.fromkeys(["material_id", level]))
    spend = per_material.join(attributes, "material_id").groupBy(level).agg(
        c.exact_sum("spend").alias("spend")
    )
    spend = stored(spend, "level_spend")
    total = spend.agg(c.exact_sum("spend").alias("total")).scalar()
    points = ordered_totals(spend, [], "spend", measure="spend")
    reached = points.select(
        F.col("spend").alias("_spend"), F.col("_rank").alias("spend_rank"), "_running"
    )
    share = c.ratio("_running", total, 4, 100)
    return spend.join(reached, F.col("spend").eqNullSafe(F.col("_spend"))).select(
        level,
        "spend",
        F.col("spend_rank").cast("int").alias("spend_rank"),
        c.ratio("spend", total, 4, 100).alias("share_pct"),
        share.alias("cumulative_share_pct"),
        F.when(share <= 80, "A").when(share <= 95, "B").otherwise("C").alias("pareto_class"),
    )


# ---- project control ---------------------------------------------------------------------------


def evm_extended(project_costs: DataFrame, timeline: DataFrame) -> DataFrame:
    """Earned-value figures per project.

    EAC = budget / CPI, VAC = budget - EAC.  SPI compares cost progress with planned progress.
    TCPI is the planned work that is left over the money that is left.
    """
    plan = timeline.select("project_id", "planned_pct_complete", "cost_pct_complete")
    budget, actual = c.dbl("total_budget"), c.dbl("total_actual")
    eac = c.safe_div(budget, "cpi")
    work_left = budget * (1 - F.col("planned_pct_complete"))
    return project_costs.join(plan, "project_id").select(
        "project_id",
        "project_name",
        "total_budget",
        "total_actual",
        "cpi",
        F.round(eac, 2).alias("eac"),
        F.round(budget - eac, 2).alias("vac"),
        c.ratio("cost_pct_complete", "planned_pct_complete", 4).alias("spi"),
        c.ratio(work_left, budget - actual, 4).alias("tcpi"),
    )


def burn_rate_months(costs: DataFrame, actuals: DataFrame) -> DataFrame:
    """Months until a project's budget is used up at its mean monthly spend.

    Actuals are ``silver`` transactions; months without spend do not count as months.
    """
    monthly = actuals.groupBy("project_id", c.year_month("posting_date").alias("m")).agg(
        c.exact_sum("actual_amount").alias("spent")
    )
    pace = monthly.groupBy("project_id").agg(
        c.exact_sum("spent").alias("spent"), F.count("m").alias("spend_months")
    )
    budget = costs.groupBy("project_id").agg(c.exact_sum("budget_amount").alias("budget"))
    left = c.dbl("budget") - F.coalesce(c.dbl("spent"), F.lit(0.0))
    rate = c.safe_div("spent", "spend_months")
    return budget.join(pace, "project_id", "left").select(
        "project_id",
        "budget",
        "spent",
        "spend_months",
        F.round(rate, 2).alias("monthly_burn"),
        F.round(left, 2).alias("remaining"),
        F.when(left <= 0, F.lit(0.0))
        .otherwise(c.ratio(left, rate, 2))
        .alias("months_to_exhaustion"),
    )


def s_curve(projects: DataFrame, costs: DataFrame, actuals: DataFrame) -> DataFrame:
    """Cumulative planned and actual spend per project and month.

    Every month from the start, or the first actual, to the end, or the last actual, has a row; a
    month without actuals adds nothing.  The plan spreads the budget evenly over the days from start to end; the planned value of a
    month is what is due by the month's last day.  A project's window holds one row per month.
    """
    monthly = actuals.groupBy(
        "project_id", F.last_day("posting_date").alias("month_end")
    ).agg(c.exact_sum("actual_amount").alias("actual"))
    budget = costs.groupBy("project_id").agg(c.exact_sum("budget_amount").alias("budget"))
    span = projects.select("project_id", "start_date", "end_date")
    seen = monthly.groupBy("project_id").agg(
        F.min("month_end").alias("_first"), F.max("month_end").alias("_last")
    )
    month = F.explode(
        F.sequence(
            F.trunc(F.least("start_date", "_first"), "month"),
            F.trunc(F.greatest("end_date", "_last"), "month"),
            F.expr("interval 1 month"),
        )
    )
    spine = (
        span.join(budget, "project_id")
        .join(seen, "project_id", "left")
        .select("project_id", "start_date", "end_date", "budget", month.alias("_month"))
        .withColumn("month_end", F.last_day("_month"))
    )
    months = Window.partitionBy("project_id").orderBy("month_end").rowsBetween(
        Window.unboundedPreceding, 0
    )
    length = F.datediff("end_date", "start_date")
    done = F.least(F.greatest(F.datediff("month_end", "start_date"), F.lit(0)), length)
    return (
        spine.join(monthly, ["project_id", "month_end"], "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0.0)))
        .withColumn("cumulative_actual", c.from_units(F.sum(c.units("actual")).over(months)))
        .select(
            "project_id",
            "month_end",
            "actual",
            "cumulative_actual",
            F.round(c.dbl("budget") * c.safe_div(done, length), 2).alias("cumulative_planned"),
        )
    )


# ---- payables ----------------------------------------------------------------------------------


def cashflow_forecast(invoices: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Unpaid amounts per vendor: overdue, and due within 30, 60, 90 days and later."""
    ahead = F.datediff("due_date", c.as_of_date(as_of))
    unpaid = invoices.filter(F.col("payment_date").isNull() & F.col("due_date").isNotNull())
    amount = "gross_amount"
    return unpaid.groupBy("vendor_id").agg(
        c.sum_when(ahead < 0, amount).alias("overdue"),
        c.sum_when((ahead >= 0) & (ahead <= 30), amount).alias("due_30"),
        c.sum_when((ahead > 30) & (ahead <= 60), amount).alias("due_60"),
        c.sum_when((ahead > 60) & (ahead <= 90), amount).alias("due_90"),
        c.sum_when(ahead > 90, amount).alias("due_later"),
        c.exact_sum(amount).alias("total_unpaid"),
    )


def three_way_match(
    purchase_orders: DataFrame,
    receipts: DataFrame,
    invoices: DataFrame,
    tolerance_pct: float = 5.0,
) -> DataFrame:
    """Order, receipt and invoice totals per order, and whether they agree within a tolerance.

    Receipts and invoices are summed per order before the joins, so each order is one row.
    """
    received = receipts.groupBy("po_id").agg(
        c.exact_sum("receipt_value").alias("received_value"),
        c.exact_sum("quantity_accepted").alias("accepted_quantity"),
    )
    billed = invoices.groupBy("po_id").agg(
        c.exact_sum("gross_amount").alias("invoiced_amount"),
        F.count(F.lit(1)).alias("invoice_count"),
    )

    def apart(a: str, b: str) -> Column:
        return F.abs(c.dbl(a) - c.dbl(b)) > c.dbl(b) * (tolerance_pct / 100)

    status = (
        F.when(F.col("received_value").isNull(), "NO_RECEIPT")
        .when(F.col("invoiced_amount").isNull(), "NO_INVOICE")
        .when(apart("received_value", "line_total"), "RECEIPT_MISMATCH")
        .when(apart("invoiced_amount", "received_value"), "INVOICE_MISMATCH")
        .otherwise("MATCHED")
    )
    return (
        purchase_orders.select("po_id", "vendor_id", "line_total", "total_quantity")
        .join(received, "po_id", "left")
        .join(billed, "po_id", "left")
        .withColumn("match_status", status)
    )


# ---- stock -------------------------------------------------------------------------------------


def stock_alerts(
    movements: DataFrame, materials: DataFrame, as_of: AsOf = None, slow_days: int = 180
) -> DataFrame:
    """Stock per material against its reorder point, last issue, and days of inventory.

    Days of inventory = stock over the mean daily issue of the year before ``as_of``.
    """
    today = c.as_of_date(as_of)
    past = movements.filter(F.col("movement_date") <= today)
    issue = F.col("movement_type") == "ISSUE"
    recent = issue & (F.col("movement_date") > F.date_sub(today, 365))
    stock = past.groupBy("material_id").agg(
        c.exact_sum("quantity").alias("on_hand"),
        F.max(F.when(issue, F.col("movement_date"))).alias("last_issue"),
        F.abs(c.sum_when(recent, "quantity")).alias("issued_last_year"),
    )
    on_hand = F.coalesce("on_hand", F.lit(0.0))
    idle = F.datediff(today, "last_issue")
    return materials.select("material_id", "material_name", "reorder_point").join(
        stock, "material_id", "left"
    ).select(
        "material_id",
        "material_name",
        "reorder_point",
        on_hand.alias("on_hand"),
        "last_issue",
        (on_hand < F.col("reorder_point")).alias("reorder_alert"),
        F.coalesce(idle > slow_days, F.lit(True)).alias("slow_moving"),
        c.ratio(c.dbl(on_hand) * 365, "issued_last_year", 2).alias("days_of_inventory"),
    )
