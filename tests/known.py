"""Known rows of the feeds that several test modules share."""

from __future__ import annotations

AS_OF = "2024-07-31"
CALENDAR = ("2023-01-01", "2025-12-31")

# Three rows per feed, as text; the last row has no key and must not survive cleansing.
ROWS: dict[str, list[dict[str, str | None]]] = {
    "vendors": [
        dict(vendor_id="V001", vendor_name="Acme Corp", sector_specialization="CONSTRUCTION",
             country="US", state="TX", city="Houston", performance_rating="4.5",
             credit_limit_usd="500000", payment_terms_days="30",
             prequalification_status="APPROVED"),
        dict(vendor_id="V002", vendor_name=" Beta Industries ",
             sector_specialization=" oil_gas ", country="gb", state=" london ", city=" London",
             performance_rating="3.8", payment_terms_days="soon",
             prequalification_status="pending"),
        dict(vendor_name="Nobody", sector_specialization="MINING", performance_rating="7"),
    ],
    "projects": [
        dict(project_id="P001", project_name="Highway Bridge", sector="CONSTRUCTION",
             country="US", state="TX", city="Houston", contract_value_usd="5000000",
             approved_budget_usd="4500000", start_date="2024-01-01",
             planned_completion_date="2024-12-31", project_status="ACTIVE"),
        dict(project_id="P002", project_name=" Offshore ", sector=" oil_gas ", country="uae",
             city="Dubai", contract_value_usd="100", approved_budget_usd="0",
             start_date="2024-03-01", planned_completion_date="2024-06-30",
             project_status="COMPLETED"),
        dict(project_name="Nowhere"),
    ],
    "materials": [
        dict(material_id="M001", material_name="Steel Beam", category="structural",
             unit_price="1200.50", lead_time_days="14", active="true"),
        dict(material_id="M002", material_name=" Concrete ", category=" foundation ",
             unit_price="-1", lead_time_days="7", active="no idea"),
        dict(material_name="Nothing"),
    ],
    "employees": [
        dict(employee_id="E001", first_name="Ann", last_name="Lee", department=" procurement ",
             active="true", cost_center="CC-1"),
        dict(employee_id="E002", first_name=" Bo ", last_name=None, department="PROCUREMENT",
             active="false", cost_center="CC-1"),
        dict(first_name="No", last_name="Key"),
    ],
    "purchase_orders": [
        dict(po_id="PO001", vendor_id="V001", project_id="P001", po_date="2024-01-15",
             delivery_date="2024-02-15", approval_date="2024-01-10", po_value="250000",
             tax_amount="12500", total_value="262500", po_status="approved", currency="USD"),
        dict(po_id="PO002", vendor_id="V002", project_id="P002", po_date="2024-02-01",
             delivery_date="2024-03-15", po_value="500000", total_value="525000",
             po_status=" pending ", currency="gbp "),
        dict(po_id="PO003", vendor_id=None, project_id="P001", po_date="2024-03-01"),
    ],
    "po_line_items": [
        dict(line_id="LI001", po_id="PO001", material_id="M001", qty_ordered="100",
             qty_received="95", qty_accepted="90", unit_price="1200.50", line_value="120050"),
        dict(line_id="LI002", po_id="PO001", material_id="M002", qty_ordered="500",
             qty_received="0", qty_accepted="0", unit_price="85", line_value="42500"),
        dict(po_id="PO002", qty_ordered="200"),
    ],
    "contracts": [
        dict(contract_id="C001", vendor_id="V001", project_id="P001", contract_status="active",
             contract_type="fixed", original_value="1000000", revised_value="1050000",
             start_date="2024-01-01", end_date="2024-08-15"),
        dict(contract_id="C002", vendor_id="V002", project_id="P002",
             contract_status=" active ", original_value="100", revised_value="125",
             start_date="2024-03-01", end_date="2024-07-01"),
        dict(vendor_id="V001"),
    ],
    "contract_items": [
        dict(item_id="CI1", contract_id="C001", quantity="1", amount="500000"),
        dict(item_id="CI2", contract_id="C001", quantity="1", amount="350000"),
        dict(contract_id="C002", amount="2000000"),
    ],
    "invoices": [
        dict(invoice_id="I1", vendor_id="V001", po_id="PO001", project_id="P001",
             invoice_date="2024-02-01", due_date="2024-03-01", paid_date="2024-02-25",
             gross_amount="120050", net_amount="114000", paid_amount="120050"),
        dict(invoice_id="I2", vendor_id="V002", po_id="PO002", project_id="P002",
             invoice_date="2024-03-15", due_date="2024-04-15", gross_amount="500000",
             net_amount="475000", invoice_status=" overdue "),
        dict(vendor_id="V001", gross_amount="1"),
    ],
    "goods_receipts": [
        dict(grn_id="G1", po_id="PO001", line_item_id="LI001", vendor_id="V001",
             material_id="M001", receipt_date="2024-02-10", qty_delivered="100",
             qty_accepted="95", qty_rejected="5", grn_status="accepted"),
        dict(grn_id="G2", po_id="PO001", line_item_id="none", vendor_id="V001",
             material_id="M001", receipt_date="2024-02-20", qty_delivered="0",
             qty_accepted="0", qty_rejected="0", grn_status=" rejected "),
        dict(po_id="PO001"),
    ],
    "project_budgets": [
        dict(budget_id="B1", project_id="P001", wbs_code=" W1 ", cost_type="labor",
             original_amount="2000000", revised_amount="2200000", committed_amount="100",
             actual_spent="1800000", period_start="2024-01-01"),
        dict(budget_id="B2", project_id="P001", wbs_code="W2", cost_type="MATERIAL",
             original_amount="0", revised_amount="0", committed_amount="0", actual_spent="10"),
        dict(project_id="P002"),
    ],
    "project_actuals": [
        dict(transaction_id="A1", project_id="P001", wbs_code="W1", cost_type=" labor ",
             posting_date="2024-02-28", actual_amount="50000", budget_amount="60000",
             variance="-10000", cost_status="posted"),
        dict(transaction_id="A2", project_id="P001", wbs_code="W1 ", cost_type="LABOR",
             posting_date="2024-03-31", actual_amount="35000", budget_amount="40000"),
        dict(project_id="P001", actual_amount="9"),
    ],
    "sales_orders": [
        dict(sales_order_id="S1", material_id="M001", customer_name="A", customer_type="corp",
             order_date="2024-01-20", quantity="50", unit_price="1500", revenue="75000",
             cogs="60000", gross_margin="15000", total_amount="78750",
             order_status="delivered"),
        dict(sales_order_id="S2", material_id="gone", customer_name=" B ", customer_type=" sme ",
             order_date="2024-02-10", quantity="200", unit_price="90", revenue="18000",
             cogs="14400", gross_margin="3600", order_status=" shipped "),
        dict(revenue="0"),
    ],
    "inventory": [
        dict(movement_id="MV1", material_id="M001", movement_type="receipt", quantity="100",
             unit_cost="10", total_value="1000", movement_date="2024-02-15"),
        dict(movement_id="MV2", material_id="M001", movement_type=" issue ", quantity="-40",
             unit_cost="12", total_value="480", movement_date="2024-02-16"),
        dict(material_id="M001", quantity="1"),
    ],
    "vendor_performance": [
        dict(performance_id="VP1", vendor_id="V001", evaluation_date="2024-01-31",
             evaluation_period="2024-q1", delivery_score="4.0", quality_score="4.5",
             commercial_score="3.8", hse_score="4.2", composite_score="4.1",
             recommendation="RETAIN"),
        dict(performance_id="VP2", vendor_id="V001", evaluation_date="2024-02-28",
             evaluation_period="2024-Q1", delivery_score="3.0", quality_score="3.0",
             commercial_score="3.0", hse_score="3.0", composite_score="3.0",
             recommendation=" DROP "),
        dict(performance_id="VP3", vendor_id=None),
    ],
}
