"""Sales reports, commerce, measures, report blocks and insights on small inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tradeloom.operators import commerce, insights, measures, reports, sales_reports
from tradeloom.sources.schemas import SALES


@pytest.fixture(scope="module")
def sales(spark):
    day = dt.date(2024, 1, 7)  # a Sunday
    rows = [
        ("O1", "C1", "Ann", "Lee", "a@x", "Rome", "IT", "Saw", "Tools", 2, 300.0, day),
        ("O1", "C1", "Ann", "Lee", "a@x", "Rome", "IT", "Nail", "Parts", 100, 0.05, day),
        ("O2", "C2", "Bo", "Ek", "b@x", "Oslo", "NO", "Saw", "Tools", 4, 300.0, day),
        ("O3", "C2", "Bo", "Ek", "b@x", "Oslo", "NO", "Nail", "Parts", 10, 0.05,
         day + dt.timedelta(days=1)),
    ]
    return spark.createDataFrame(rows, SALES)


def test_customer_ranking(sales):
    rows = sales_reports.customer_ranking(sales).collect()
    assert [(r.full_name, r.customer_tier, r.spending_rank, r.total_spent) for r in rows] == [
        ("Bo Ek", "Gold", 1, 1200.5), ("Ann Lee", "Silver", 2, 605.0)
    ]
    assert (rows[0].total_orders, rows[0].avg_order_value) == (2, 600.25)


def test_places_products_and_time(sales):
    country = sales_reports.sales_by_country(sales).collect()[0]
    assert (country.country, country.order_count, country.total_items) == ("NO", 2, 14)
    assert sales_reports.sales_by_city(sales).collect()[0].city_rank_in_country == 1
    assert {r.category for r in sales_reports.top_category_by_country(sales).collect()} == {"Tools"}
    saw = sales_reports.product_performance(sales).collect()[0]
    assert (saw.product_name, saw.total_revenue, saw.revenue_rank) == ("Saw", 1800.0, 1)
    assert sales_reports.category_performance(sales).collect()[0].unique_customers == 2
    assert [r.orders_count for r in sales_reports.daily_sales(sales).collect()] == [2, 1]
    days = sales_reports.sales_by_weekday(sales).collect()
    assert [r.day_name for r in days] == ["Sunday", "Monday"]
    assert sales_reports.monthly_trend(sales).collect()[0].monthly_revenue == 1805.5


@pytest.fixture(scope="module")
def shop(spark):
    d = dt.date(2024, 7, 1)
    money = Decimal

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "product": frame([(1, "Saw", 10), (2, "Nail", 5)], "id int, name string, stock_quantity int"),
        "customer": frame([(1, "Ann"), (2, "Bo")], "id int, name string"),
        "sale": frame(
            [(1, d, 1, money("30"), "Completed", None),
             (2, d + dt.timedelta(days=20), 2, money("7"), "Pending", None)],
            "id int, date date, customer_id int, total decimal(18,2), status string, notes string",
        ),
        "sale_item": frame(
            [(1, 1, 1, 3, money("10")), (2, 2, 2, 7, money("1"))],
            "id int, sale_id int, product_id int, quantity int, unit_price decimal(18,2)",
        ),
        "purchase": frame([(1, d, money("8"))], "id int, date date, total decimal(18,2)"),
        "purchase_item": frame(
            [(1, 1, 1, 8, money("1"))],
            "id int, purchase_id int, product_id int, quantity int, unit_price decimal(18,2)",
        ),
        "payment": frame(
            [(1, d, money("5"), "Incoming"), (2, d, money("2"), "Outgoing")],
            "id int, date date, amount decimal(18,2), direction string",
        ),
    }


def test_commerce_summary_defaults_to_thirty_days(shop):
    args = shop["sale"], shop["purchase"], shop["payment"]
    recent = commerce.commerce_summary(*args, as_of="2024-08-10").collect()[0]
    assert (recent.total_sales, recent.sales_count) == (7, 1)
    assert (recent.total_purchases, recent.net_cash_flow) == (0, 0)
    july = commerce.commerce_summary(*args, start="2024-07-01", end="2024-07-31").collect()[0]
    assert (july.total_sales, july.total_purchases, july.net_cash_flow) == (37, 8, 3)


def test_commerce_lists(shop):
    top = commerce.top_products(
        shop["sale"], shop["sale_item"], shop["product"], "2024-07-01", "2024-07-31"
    ).collect()
    assert [(r.name, r.total, r.units) for r in top] == [("Saw", 30, 3), ("Nail", 7, 7)]
    days = commerce.daily_breakdown(shop["sale"], shop["purchase"], "2024-07-01", "2024-07-31")
    assert [(r.sales, r.purchases) for r in days.collect()] == [(30, 8), (7, 0)]
    page = commerce.sales_listing(
        shop["sale"], shop["sale_item"], shop["product"], shop["customer"], page=1, size=1
    ).collect()
    assert [(r.id, r.customer_name, r.line_total) for r in page] == [(2, "Bo", 7)]


def test_stock(shop):
    changes = commerce.stock_changes(
        shop["purchase"], shop["purchase_item"], shop["sale"], shop["sale_item"]
    )
    stock = {r.name: r.on_hand for r in commerce.stock_on_hand(shop["product"], changes).collect()}
    assert stock == {"Saw": 15, "Nail": -2}
    running = commerce.running_stock(shop["product"], changes).collect()
    assert sorted((r.product_id, r.on_hand) for r in running) == [(1, 15), (2, -2)]
    # Deleting a sale takes its effect back.
    without = commerce.stock_changes(
        shop["purchase"], shop["purchase_item"], shop["sale"].filter("id <> 2"),
        shop["sale_item"],
    )
    stock = {r.name: r.on_hand for r in commerce.stock_on_hand(shop["product"], without).collect()}
    assert stock["Nail"] == 5


def tables_of(layers):
    from tradeloom.plans.layers import CUBES

    return lambda name: layers.cube(name) if name in CUBES else layers.gold(name)


def test_every_measure_runs(layers):
    assert len(measures.MEASURES) == 28
    for name in measures.MEASURES:
        rows = measures.measure(tables_of(layers), name).collect()
        assert len(rows) == 1 and len(rows[0]) == 1


def test_measures(layers):
    def value(name, **options):
        return measures.measure(tables_of(layers), name, **options).collect()[0][0]

    assert value("Total Spend") == 787500
    assert value("Avg PO Value") == 393750
    assert value("Overdue Amount") == 500000
    assert value("Active Contracts") == 2
    assert value("Net Inventory Flow") == 60
    assert value("Budget Variance") == 2200000 - 85010
    assert value("Total Spend", where="po_status = 'APPROVED'") == 262500
    by_tier = measures.measure_by_dimension(
        tables_of(layers), "Total Spend", "dim_vendor", "vendor_id", ["tier"]
    )
    assert {r.tier: r.total_spend for r in by_tier.collect()} == {
        "STRATEGIC": 262500, "PREFERRED": 525000
    }
    with pytest.raises(ValueError, match="one table"):
        measures.measures_of(tables_of(layers), ["Total Spend", "Total Revenue"])


def test_report_blocks(spark):
    cube = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 5.0)], "k string, c string, v double"
    )
    top = reports.report_topn(cube, ["k"], "total", ("sum", "v"), 1).collect()
    assert [tuple(r) for r in top] == [("b", 5.0)]
    matrix = {r.k: (r.x, r.y) for r in reports.report_matrix(cube, ["k"], "c", ("sum", "v")).collect()}
    assert matrix == {"a": (1.0, 2.0), "b": (5.0, None)}
    listed = reports.report_matrix(cube, ["k"], "c", ("sum", "v"), ["x"]).collect()
    assert {r.k: (r.x, r.OTHER) for r in listed} == {"a": (1.0, 2.0), "b": (5.0, None)}
    assert reports.report_slice(cube, k="a", c=["x"]).count() == 1
    bands = spark.createDataFrame([(0.8,), (1.0,), (1.2,)], "cpi double")
    shown = reports.report_band(bands, "band", reports.cpi_band("cpi")).collect()
    assert [r.band for r in shown] == ["RED", "YELLOW", "GREEN"]


def test_kpis_and_insights(layers):
    l = layers
    alerts = {
        r.kpi: r.status
        for r in insights.kpi_alerts(
            l.gold("fact_purchase_orders"), l.gold("fact_invoices"), l.gold("fact_project_costs"),
            l.cube("cube_delivery_performance"), l.gold("fact_goods_receipts"),
            l.gold("fact_vendor_performance"), l.gold("fact_contracts"),
            l.cube("cube_project_timeline"), l.as_of,
        ).collect()
    }
    assert len(alerts) == 15
    assert alerts["overdue_invoice_pct"] == "ALERT"
    assert alerts["yoy_spend_growth_pct"] == "NO DATA"
    assert alerts["material_acceptance_pct"] == "WARN"
    shares = insights.concentration_risk(l.gold("fact_purchase_orders"), l.gold("dim_vendor"))
    assert sum(r.share_pct for r in shares.collect()) == pytest.approx(100, abs=0.001)
    due = insights.cashflow_forecast(l.gold("fact_invoices"), "2024-04-01").collect()[0]
    assert (due.due_30, due.total_unpaid) == (500000, 500000)
    match = {
        r.po_id: r.match_status
        for r in insights.three_way_match(
            l.gold("fact_purchase_orders"), l.gold("fact_goods_receipts"), l.gold("fact_invoices")
        ).collect()
    }
    assert match == {"PO001": "RECEIPT_MISMATCH", "PO002": "NO_RECEIPT"}
    pareto = insights.spend_concentration(l.silver("po_line_items"), l.gold("dim_material"))
    rows = sorted(pareto.collect(), key=lambda r: r.spend_rank)
    assert rows[-1].cumulative_share_pct == 100
    burn = {r.project_id: r for r in insights.burn_rate_months(
        l.gold("fact_project_costs"), l.silver("project_actuals")).collect()}
    assert burn["P001"].spend_months == 2
    curve = insights.s_curve(
        l.gold("dim_project"), l.gold("fact_project_costs"), l.silver("project_actuals")
    ).collect()
    assert max(r.cumulative_actual for r in curve) == 85000
    stock = insights.stock_alerts(l.gold("fact_inventory"), l.silver("materials"), l.as_of)
    assert {r.material_id: r.on_hand for r in stock.collect()} == {"M001": 60, "M002": 0}
    evm = insights.evm_extended(l.cube("cube_project_costs"), l.cube("cube_project_timeline"))
    assert evm.collect()[0].cpi > 1


def test_category_counts_do_not_multiply_rows(spark):
    from tradeloom.operators import sales_reports

    rows = [
        ("A", "p1", 1, 10, 2, 1.5), ("A", "p1", 1, 10, 1, 1.5), ("A", "p2", 2, None, 1, 2.0), (None, "p1", None, 11, 3, 1.0),
        (None, None, 3, 11, 1, None),
    ]
    sales = spark.createDataFrame(
        rows, "category string, product_name string, order_id long, customer_id long, quantity int, unit_price double"
    )
    report = sales_reports.category_performance(sales, ordered=False)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    got = {r.category: tuple(r)[1:] for r in report.collect()}
    assert got == {"A": (2, 2, 4, 6.5, 1, 2.17), None: (1, 1, 4, 3.0, 1, 3.0)}


def test_cubes_shuffle_a_month_as_one_value(layers):
    for name, key in (("cube_invoice_aging", "aging_bucket"), ("cube_sales_analysis", "customer_type")):
        plan = layers.cube(name)._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and key in line]
        assert exchanges and all("year_month#" not in e and "quarter#" not in e for e in exchanges)
