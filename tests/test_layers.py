"""Known answers on the fixture rows, from cleansing to the cubes."""

from __future__ import annotations

import datetime as dt

import pytest

from tradeloom.operators import dims, silver
from tradeloom.plans.layers import CUBES, GOLD
from tradeloom.sources.schemas import KEYS, SOURCES


def one(df, **key):
    name, value = next(iter(key.items()))
    rows = df.filter(f"{name} = '{value}'").collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("table", sorted(SOURCES))
def test_three_rows_in_two_rows_out(layers, table):
    rows = layers.silver(table).collect()
    assert len(rows) == 2
    assert all(r[KEYS[table]] is not None for r in rows)
    assert not {"_ingest_timestamp", "_source_file"} & set(rows[0].asDict())


def test_thirty_rules():
    rules = [r for listed in silver.RULES.values() for r in listed]
    assert len(rules) == 30
    assert sum(r.action == "drop" for r in rules) == 21


def test_vendor_cleansing(layers):
    v = one(layers.silver("vendors"), vendor_id="V002")
    assert (v.vendor_name, v.country, v.state, v.city) == ("Beta Industries", "GB", "LONDON", "London")
    assert v.payment_terms_days is None  # a bad number is no error
    assert v.performance_rating == 3.8


def test_project_cleansing(layers):
    p = one(layers.silver("projects"), project_id="P001")
    assert (p.planned_duration_days, p.budget_variance_pct) == (365, 11.11)
    assert one(layers.silver("projects"), project_id="P002").budget_variance_pct == 0.0


def test_rates_are_guarded(layers):
    lines = layers.silver("po_line_items")
    assert one(lines, line_id="LI001").fulfillment_rate == 95.0
    assert one(lines, line_id="LI001").acceptance_rate == 94.74
    assert one(lines, line_id="LI002").acceptance_rate == 0.0


def test_employee_name_is_null_propagating(layers):
    assert one(layers.silver("employees"), employee_id="E001").full_name == "Ann Lee"
    assert one(layers.silver("employees"), employee_id="E002").full_name is None


def test_invoice_days(layers):
    paid = one(layers.silver("invoices"), invoice_id="I1")
    late = one(layers.silver("invoices"), invoice_id="I2")
    assert (paid.days_to_pay, paid.days_overdue) == (24, 0)
    assert (late.days_to_pay, late.days_overdue) == (None, 107)


def test_boolean_and_scores(layers):
    assert one(layers.silver("materials"), material_id="M001").is_active is True
    assert one(layers.silver("materials"), material_id="M002").is_active is None
    vp = one(layers.silver("vendor_performance"), performance_id="VP1")
    assert (vp.compliance_score, vp.overall_score) == (4.125, 4.1)


def test_date_dimension(spark):
    days = dims.dim_date(spark)
    assert days.count() == 4018
    first = one(days, date_key="20240101")
    assert (first.quarter, first.day_of_week, first.day_name) == (1, 2, "Monday")
    assert (first.year_month, first.fiscal_period) == ("2024-01", "FY2024-H1")


def test_calendar_in_place_equals_join_with_the_dimension(spark, layers):
    from tradeloom.functions import columns as c

    orders = layers.gold("fact_purchase_orders")
    inline = c.with_calendar(orders, "po_date", layers.calendar, ["year", "quarter", "year_month"])
    joined = orders.join(layers.gold("dim_date"), orders.po_date == layers.gold("dim_date")["date"])
    columns = ["po_id", "year", "quarter", "year_month"]
    assert sorted(inline.select(*columns).collect()) == sorted(joined.select(*columns).collect())


def test_dimensions(layers):
    acme, beta = (one(layers.gold("dim_vendor"), vendor_id=v) for v in ("V001", "V002"))
    assert (acme.tier, acme.status, acme.sector) == ("STRATEGIC", "ACTIVE", "CONSTRUCTION")
    assert (beta.tier, beta.status, beta.sector) == ("PREFERRED", "PENDING", "OIL_GAS")
    regions = {r.project_id: r.region for r in layers.gold("dim_project").collect()}
    assert regions == {"P001": "NORTH AMERICA", "P002": "MIDDLE EAST"}
    places = layers.gold("dim_geography").collect()
    assert len(places) == 3 and all(len(p.geography_key) == 64 for p in places)
    assert {s.sector_key for s in layers.gold("dim_sector").collect()} == {"CONSTRUCTION", "OIL_GAS"}
    assert one(layers.gold("dim_contract"), contract_id="C001").cost_growth_pct == 5.0
    assert layers.gold("dim_cost_center").count() == 1
    assert {r.currency_key for r in layers.gold("dim_currency").collect()} == {"USD", "GBP"}


def test_facts(layers):
    po = one(layers.gold("fact_purchase_orders"), po_id="PO001")
    assert (po.line_total, po.total_quantity) == (162550, 600)
    assert one(layers.gold("fact_purchase_orders"), po_id="PO002").line_total == 0
    contract = one(layers.gold("fact_contracts"), contract_id="C001")
    assert (contract.items_total, contract.item_count) == (850000, 2)
    assert contract.value_utilisation_pct == 85.0
    gr = one(layers.gold("fact_goods_receipts"), grn_id="G1")
    assert (gr.rejection_rate, gr.acceptance_rate, gr.receipt_value) == (5.0, 95.0, 114047.5)
    assert one(layers.gold("fact_goods_receipts"), grn_id="G2").receipt_value == 0
    cost = one(layers.gold("fact_project_costs"), budget_id="B1")
    assert (cost.actual_amount, cost.variance_amount) == (85000, 2115000)
    assert cost.posting_date == dt.date(2024, 3, 31)
    unposted = one(layers.gold("fact_project_costs"), budget_id="B2")
    assert (unposted.actual_amount, unposted.variance_pct) == (10, 0.0)
    sale = one(layers.gold("fact_sales"), sales_order_id="S2")
    assert (sale.customer_name, sale.order_status, sale.product_name) == ("B", "SHIPPED", None)
    assert len(sale.customer_id) == 64


def test_gross_and_net_keep_their_meaning(layers):
    invoice = one(layers.gold("fact_invoices"), invoice_id="I1")
    assert (invoice.gross_amount, invoice.net_amount) == (120050, 114000)
    assert (invoice.payment_status, invoice.aging_bucket) == ("PAID", "CURRENT")
    late = one(layers.gold("fact_invoices"), invoice_id="I2")
    assert (late.payment_status, late.aging_bucket) == ("OVERDUE", "90+ DAYS")


@pytest.mark.parametrize("name", sorted(CUBES))
def test_every_cube_runs(layers, name):
    assert layers.cube(name).count() >= 1


def test_cube_values(layers):
    spend = one(layers.cube("cube_procurement_spend"), vendor_id="V001")
    assert (spend.total_spend, spend.po_count, spend.prev_year_spend) == (262500, 1, None)
    quality = one(layers.cube("cube_goods_receipt_quality"), vendor_id="V001")
    # Rates are percentages: (95 + 100) / 2 = 97.5 is GOOD.
    assert (quality.avg_acceptance_rate, quality.quality_tier) == (97.5, "GOOD")
    stock = one(layers.cube("cube_inventory_status"), material_id="M001")
    # Issues are negative already, so they reduce the flow once.
    assert (stock.net_quantity_flow, stock.issue_to_receipt_ratio) == (60, 0.4)
    # The recommendation is the last one, not the alphabetic maximum.
    score = one(layers.cube("cube_vendor_performance"), vendor_id="V001")
    assert (score.latest_recommendation, score.evaluation_count) == ("DROP", 2)
    status = {r.contract_id: r for r in layers.cube("cube_contract_status").collect()}
    assert status["C001"].schedule_risk_flag == "NEAR_EXPIRY"
    assert status["C002"].schedule_risk_flag == "OVERDUE"
    assert status["C002"].cost_risk_flag == "HIGH_COST_RISK"
    # Two receipts of one order are one delivery, at the last receipt.
    delivery = one(layers.cube("cube_delivery_performance"), vendor_id="V001")
    assert (delivery.delivery_count, delivery.late_1wk_count) == (1, 1)
    timeline = one(layers.cube("cube_project_timeline"), project_id="P001")
    assert timeline.schedule_status == "ON_TRACK"


def test_gold_has_nine_dimensions_and_nine_facts():
    names = [n for n in GOLD if n != "dim_currency"]
    assert sum(n.startswith("dim_") for n in names) == 9
    assert sum(n.startswith("fact_") for n in names) == 9
    assert len(CUBES) == 15
