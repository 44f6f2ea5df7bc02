"""SQL statements for the jobs beside the layers: quality, commerce, measures, reports, edits."""

from __future__ import annotations

from .oracle import (
    AS_OF,
    DECIMALS,
    FRAGMENTS,
    LINE,
    ORD,
    PRICE,
    SHIP,
    big,
    days,
    dbl,
    div,
    i32,
    imean,
    mon,
    msum,
    qmean,
    qsum,
    qty,
    rnd,
    statement,
    whole,
)

YEAR = "BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"
LAST30 = f"BETWEEN {AS_OF} - 30 AND {AS_OF}"

# ---- ingestion ---------------------------------------------------------------------------------

_RAW_ORDERS = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS po_id, po_type, '  ' || lower(po_status) || ' '
        AS po_status, priority, CAST(vendor_id AS VARCHAR) AS vendor_id,
      CAST(o_custkey AS VARCHAR) AS project_id, po_date, delivery_date, approval_date,
      o_totalprice AS po_value, floor(o_totalprice / 20) AS tax_amount,
      o_totalprice + floor(o_totalprice / 20) AS total_value, currency, payment_terms
    FROM all_purchase_orders JOIN orders ON po_id = o_orderkey"""

# Rows of each raw feed.
_RAW_COUNTS = {
    "vendors": "supplier", "projects": "customer", "materials": "part", "employees": "customer",
    "purchase_orders": "orders", "po_line_items": "lineitem", "contracts": "orders",
    "contract_items": "lineitem", "invoices": "lineitem", "goods_receipts": "lineitem",
    "project_budgets": "s_project_budgets", "project_actuals": "lineitem",
    "sales_orders": "lineitem", "inventory": "lineitem", "vendor_performance": "events",
}


# Columns of each fact that its digest covers: key, date, amounts.
BACKED_UP = {
    "fact_purchase_orders": "po_id vendor_id po_date po_status po_value tax_amount total_value",
    "fact_invoices": "invoice_id vendor_id invoice_date payment_status invoice_amount net_amount",
    "fact_goods_receipts": "grn_id project_id receipt_date quantity_received quantity_accepted",
    "fact_project_costs": "budget_id project_id period_start budget_amount actual_amount",
    "fact_project_actuals": "transaction_id po_id posting_date actual_amount budget_amount",
    "fact_vendor_performance": "performance_id vendor_id evaluation_date recommendation",
    "fact_inventory": "movement_id material_id movement_date quantity total_value",
    "fact_contracts": "contract_id vendor_id start_date contract_value items_total",
    "fact_sales": "sales_order_id order_date product_name revenue cogs",
}


def _digest(table: str) -> str:
    """Rows of a table and the sum of their hashes."""
    numbers = DECIMALS.get(table, "").split()

    def text(column: str) -> str:
        value = f"CAST({column} AS DECIMAL(38,6))" if column in numbers else column
        return f"'{column}=' || coalesce(CAST({value} AS VARCHAR), '\\N')"

    row = f"concat_ws('|', {', '.join(text(n) for n in BACKED_UP[table].split())})"
    total = f"SUM(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)::HUGEINT)"
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, "
        f"CAST(coalesce({total}, 0) AS VARCHAR) AS digest FROM {table}"
    )


def ingestion_statements() -> dict[str, str]:
    audit = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS record_count, "
        f"CAST(0 AS BIGINT) AS rejected_count, 'SUCCESS' AS status FROM {source}"
        for t, source in _RAW_COUNTS.items()
    )
    return {
        "ingest_csv": statement(_RAW_ORDERS),
        "ingest_all": statement(
            f"SELECT table_name, CASE table_name WHEN 'employees' THEN 0 ELSE record_count END "
            f"AS record_count, rejected_count, CASE table_name WHEN 'employees' THEN 'FAILED' "
            f"ELSE status END AS status FROM ({audit})"
        ),
        "write_layer": whole("fact_purchase_orders"),
        "backup_tables": statement(" UNION ALL ".join(_digest(t) for t in BACKED_UP)),
        "incremental_ingest": statement(f"SELECT *, 'batch-1' AS _batch_id FROM ({_RAW_ORDERS})"),
        "corrupt_row_gate": statement(
            "SELECT CASE po_status WHEN 'PENDING' THEN 'rejected' ELSE 'kept' END AS verdict, "
            "priority, COUNT(*) AS row_count FROM all_purchase_orders GROUP BY 1, 2"
        ),
        "load_audit": statement(audit),
        "create_cube_view": statement(
            f"SELECT region, COUNT(*) AS projects, {msum('total_budget')} AS total_budget "
            "FROM cube_project_costs GROUP BY 1"
        ),
    }


# ---- quality and integrity ---------------------------------------------------------------------

# (table, rule, condition, action, source of all rows before the drop rules)
_RULES = [
    ("vendors", "valid_vendor_id", "vendor_id IS NOT NULL", "drop"),
    ("vendors", "valid_vendor_name", "vendor_name IS NOT NULL", "drop"),
    ("vendors", "valid_rating", "performance_rating BETWEEN 0 AND 5", "warn"),
    ("projects", "valid_project_id", "project_id IS NOT NULL", "drop"),
    ("projects", "valid_budget", "approved_budget_usd > 0", "warn"),
    ("materials", "valid_material_id", "material_id IS NOT NULL", "drop"),
    ("materials", "valid_price", "unit_price >= 0", "warn"),
    ("employees", "valid_employee_id", "employee_id IS NOT NULL", "drop"),
    ("purchase_orders", "valid_po_id", "po_id IS NOT NULL", "drop"),
    ("purchase_orders", "valid_vendor_ref", "vendor_id IS NOT NULL", "drop"),
    ("purchase_orders", "valid_po_value", "po_value >= 0", "warn"),
    ("po_line_items", "valid_line_id", "line_id IS NOT NULL", "drop"),
    ("po_line_items", "valid_po_ref", "po_id IS NOT NULL", "drop"),
    ("contracts", "valid_contract_id", "contract_id IS NOT NULL", "drop"),
    ("contracts", "valid_value", "original_value > 0", "warn"),
    ("contract_items", "valid_item_id", "item_id IS NOT NULL", "drop"),
    ("contract_items", "valid_contract_ref", "contract_id IS NOT NULL", "drop"),
    ("invoices", "valid_invoice_id", "invoice_id IS NOT NULL", "drop"),
    ("invoices", "valid_amount", "gross_amount > 0", "warn"),
    ("goods_receipts", "valid_grn_id", "grn_id IS NOT NULL", "drop"),
    ("goods_receipts", "valid_po_ref", "po_id IS NOT NULL", "drop"),
    ("project_budgets", "valid_budget_id", "budget_id IS NOT NULL", "drop"),
    ("project_budgets", "valid_budget_amount", "revised_amount >= 0", "warn"),
    ("project_actuals", "valid_transaction_id", "transaction_id IS NOT NULL", "drop"),
    ("project_actuals", "valid_amount", "actual_amount > 0", "warn"),
    ("sales_orders", "valid_sales_order_id", "sales_order_id IS NOT NULL", "drop"),
    ("sales_orders", "valid_order_value", "revenue > 0", "warn"),
    ("inventory", "valid_movement_id", "movement_id IS NOT NULL", "drop"),
    ("vendor_performance", "valid_performance_id", "performance_id IS NOT NULL", "drop"),
    ("vendor_performance", "valid_vendor_ref", "vendor_id IS NOT NULL", "drop"),
]


_STAR = [
    ("dim_vendor", "vendors", "vendor_id"), ("dim_project", "projects", "project_id"),
    ("dim_material", "materials", "material_id"), ("dim_employee", "employees", "employee_id"),
    ("dim_contract", "contracts", "contract_id"), ("fact_purchase_orders", "purchase_orders", "po_id"),
    ("fact_invoices", "invoices", "invoice_id"), ("fact_goods_receipts", "goods_receipts", "grn_id"),
    ("fact_project_costs", "project_budgets", "budget_id"),
    ("fact_project_actuals", "project_actuals", "transaction_id"),
    ("fact_vendor_performance", "vendor_performance", "performance_id"),
    ("fact_inventory", "inventory", "movement_id"), ("fact_contracts", "contracts", "contract_id"),
    ("fact_sales", "sales_orders", "sales_order_id"),
]
_VENDOR, _PROJECT, _MATERIAL = {"vendor_id": "dim_vendor"}, {"project_id": "dim_project"}, {"material_id": "dim_material"}
_STAR_REFERENCES = {
    "fact_purchase_orders": _VENDOR | _PROJECT,
    "fact_invoices": _VENDOR | _PROJECT,
    "fact_goods_receipts": _VENDOR | _PROJECT | _MATERIAL,
    "fact_project_costs": _PROJECT,
    "fact_vendor_performance": _VENDOR,
    "fact_inventory": _MATERIAL,
    "fact_contracts": _VENDOR | _PROJECT,
}


def _unfiltered(table: str) -> str:
    name = f"all_{table}"
    return name if name in FRAGMENTS else f"s_{table}"


def _metrics(only: tuple[str, ...] = ()) -> str:
    parts = []
    for table, rule, condition, action in _RULES:
        if only and table not in only:
            continue
        bad = (
            f"COUNT(*) - COUNT(CASE WHEN {condition} THEN 1 END)" if action == "drop"
            else f"COUNT(CASE WHEN NOT ({condition}) THEN 1 END)"
        )
        parts.append(
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{condition}' AS condition, "
            f"'{action}' AS action, {bad} AS violations, COUNT(*) AS checked_rows "
            f"FROM {_unfiltered(table)}"
        )
    return " UNION ALL ".join(parts)


_BUSINESS = [
    ("blacklisted_low_rating", "vendors", "risk_category = 'BLACKLISTED'",
     "performance_rating < 2"),
    ("civil_project_sector", "projects",
     "project_type IN ('BUILDING', 'HIGHWAY', 'APARTMENT', 'BRIDGE')",
     "sector = 'CIVIL_CONSTRUCTION'"),
    ("oil_gas_project_sector", "projects",
     "project_type IN ('REFINERY', 'PIPELINE', 'DRILLING', 'LNG')", "sector = 'OIL_GAS'"),
    ("product_without_parent", "materials", "material_level = 'PRODUCT'",
     "parent_material_id IS NULL"),
    ("top_grade_unlimited", "employees", "grade = 'L6'", "approval_limit IS NULL"),
    ("emergency_is_critical", "purchase_orders", "po_type = 'EMERGENCY'",
     "priority = 'CRITICAL'"),
    ("discount_only_when_paid", "invoices", "early_payment_discount > 0",
     "invoice_status IN ('PAID', 'PARTIALLY_PAID')"),
    ("rejected_accepts_nothing", "goods_receipts", "grn_status = 'REJECTED'",
     "qty_accepted = 0"),
    ("accepted_within_delivered", "goods_receipts", "TRUE", "qty_accepted <= qty_delivered"),
    ("posted_has_invoice", "project_actuals", "cost_status = 'POSTED'",
     "invoice_id IS NOT NULL"),
    ("cancelled_is_unbilled", "sales_orders", "order_status = 'CANCELLED'",
     "payment_status = 'UNBILLED'"),
]


def quality_statements() -> dict[str, str]:
    business = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, "
        f"COUNT(CASE WHEN {a} THEN 1 END) AS concerned_rows, "
        f"COUNT(CASE WHEN {a} AND NOT coalesce({b}, FALSE) THEN 1 END) AS violations FROM s_{t}"
        for rule, t, a, b in _BUSINESS
    )
    keys = {t: c.split()[0] for t, _, c, a in _RULES[::-1] if a == "drop"}
    handover = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {source}) AS lower_rows, "
        f"COUNT(*) AS upper_rows, COUNT(*) - COUNT({keys[t]}) AS null_keys, "
        f"COUNT(*) <= (SELECT COUNT(*) FROM {source}) AS holds FROM s_{t}"
        for t, source in _RAW_COUNTS.items()
    )
    quarantine = (
        "SELECT 'purchase_orders' AS table_name, CAST(po_id AS VARCHAR) AS row_key, "
        "'valid_vendor_ref' AS failed_rules FROM all_purchase_orders WHERE vendor_id IS NULL "
        "UNION ALL SELECT 'vendor_performance', CAST(performance_id AS VARCHAR), "
        "'valid_vendor_ref' FROM all_vendor_performance WHERE vendor_id IS NULL"
    )
    balance = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {source}) AS lower_rows, COUNT(*) AS kept_rows, "
        f"(SELECT COUNT(*) FROM ({quarantine}) WHERE table_name = '{t}') AS rejected_rows FROM s_{t}"
        for t, source in _RAW_COUNTS.items()
    )
    star = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM s_{source}) AS lower_rows, COUNT(*) AS upper_rows, "
        f"COUNT(*) - COUNT({key}) AS null_keys, (SELECT COUNT(*) FROM (SELECT {key} FROM {t} WHERE {key} IS NOT NULL "
        f"GROUP BY 1 HAVING COUNT(*) > 1)) AS repeated_keys, '' AS missing_columns FROM {t}"
        for t, source, key in _STAR
    )
    references = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{column}' AS column_name, COUNT(*) - COUNT({column}) AS null_rows, "
        f"COUNT(DISTINCT CASE WHEN {column} NOT IN (SELECT {column} FROM {dim} WHERE {column} IS NOT NULL) THEN {column} END) "
        f"AS orphan_keys, COUNT(CASE WHEN {column} NOT IN (SELECT {column} FROM {dim} WHERE {column} IS NOT NULL) "
        f"THEN 1 END) AS orphan_rows FROM {t}"
        for t, columns in _STAR_REFERENCES.items()
        for column, dim in columns.items()
    )
    composite = (
        "delivery_score * 0.30::DOUBLE + quality_score * 0.30::DOUBLE "
        "+ commercial_score * 0.20::DOUBLE + hse_score * 0.20::DOUBLE"
    )
    band = (
        "CASE WHEN compliance_score >= 80 THEN 'PREFERRED' WHEN compliance_score >= 60 "
        "THEN 'APPROVED' WHEN compliance_score >= 40 THEN 'CONDITIONAL' ELSE 'DELIST' END"
    )
    return {
        "expect_warn": statement("SELECT vendor_id, performance_rating FROM s_vendors"),
        "expect_or_drop": statement(
            "SELECT performance_id, vendor_id, overall_score FROM all_vendor_performance "
            "WHERE performance_id IS NOT NULL AND vendor_id IS NOT NULL"
        ),
        "expect_or_fail": "SELECT l_suppkey AS vendor_id, COUNT(*) AS line_count FROM lineitem "
        "GROUP BY 1",
        "expectation_metrics": statement(_metrics()),
        "quarantine": statement(quarantine),
        "dq_metrics": statement(
            "SELECT 'run-1' AS run_id, table_name, rule, action, checked_rows - violations "
            f"AS passed, violations AS failed FROM ({_metrics()})"
        ),
        "silver_dedup": f"""
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {SHIP} AS ship_date
            FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
        "check_row_count": "SELECT COUNT(*) AS row_count, CAST(1 AS BIGINT) AS expected "
        "FROM lineitem HAVING COUNT(*) <> 1",
        "check_unique": "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem "
        "GROUP BY 1, 2 HAVING COUNT(*) > 1",
        "check_accepted_values": "SELECT o_orderkey, o_orderpriority FROM orders "
        "WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
        "check_foreign_key": "SELECT o_orderkey FROM orders WHERE NOT EXISTS "
        "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
        "check_cancelled_lines": statement(
            "SELECT line_id, po_id FROM s_po_line_items SEMI JOIN "
            "(SELECT po_id FROM s_purchase_orders WHERE po_status = 'CANCELLED') USING (po_id) "
            "WHERE qty_received <> 0"
        ),
        "check_conditional": statement(
            "SELECT po_id, po_type, priority FROM s_purchase_orders "
            "WHERE po_type = 'EMERGENCY' AND priority <> 'CRITICAL'"
        ),
        "check_business_rules": statement(business),
        "check_range": statement(
            f"SELECT contract_id, {dbl('original_value')} AS original_value FROM s_contracts "
            "WHERE NOT (original_value BETWEEN 50000 AND 400000)"
        ),
        "check_row_arithmetic": statement(
            f"SELECT performance_id, overall_score, {composite} AS expected_value "
            f"FROM s_vendor_performance WHERE abs(overall_score - ({composite})) > 0.01::DOUBLE"
        ),
        "check_sign": statement(
            "SELECT movement_type, COUNT(*) AS violations FROM s_inventory WHERE "
            "(movement_type IN ('RECEIPT', 'RETURN') AND quantity - 10 <= 0) OR "
            "(movement_type IN ('ISSUE', 'WRITEOFF') AND quantity - 10 >= 0) GROUP BY 1"
        ),
        "check_threshold_label": statement(
            f"SELECT performance_id, recommendation, {band} AS expected_label "
            f"FROM s_vendor_performance WHERE recommendation <> {band}"
        ),
        "check_share": statement(
            "SELECT COUNT(CASE WHEN milestone_flag THEN 1 END) AS matching, COUNT(*) AS total, "
            f"{div('COUNT(CASE WHEN milestone_flag THEN 1 END)', 'COUNT(*)')} AS share "
            "FROM s_contract_items"
        ),
        "layer_contract": statement(handover),
        "row_balance": statement(
            "SELECT *, lower_rows - kept_rows - rejected_rows AS lost_rows, "
            f"lower_rows = kept_rows + rejected_rows AS holds FROM ({balance})"
        ),
        "star_contract": statement(
            "SELECT *, upper_rows <= lower_rows AND null_keys = 0 AND repeated_keys = 0 AS holds "
            f"FROM ({star})"
        ),
        "star_references": statement(references),
    }


# ---- sales reports -----------------------------------------------------------------------------

FRAGMENTS["sales"] = f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, substr(c_name, 1, 8) AS first_name,
      substr(c_name, 10, 9) AS last_name, lower(c_name) || '@example.com' AS email,
      n_name AS city, r_name AS country, p_name AS product_name, p_type AS category,
      CAST(l_quantity AS INT) AS quantity,
      floor(l_extendedprice * 100 / l_quantity) / 100 AS unit_price, {ORD} AS order_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey"""

_AMOUNT = "SUM(CAST(quantity * unit_price AS DECIMAL(18,2)))"
_REVENUE = dbl(_AMOUNT)
_MEAN = rnd(f"{_REVENUE} / COUNT(*)")


def _per(count: str) -> str:
    return rnd(f"{_REVENUE} / {count}")


def sales_statements() -> dict[str, str]:
    customers, orders = "COUNT(DISTINCT customer_id)", "COUNT(DISTINCT order_id)"
    return {
        "customer_ranking": statement(f"""
            SELECT customer_id, full_name, email, city, country,
              CASE WHEN ts >= 1000 THEN 'Gold' WHEN ts >= 500 THEN 'Silver' ELSE 'Bronze' END
                AS customer_tier,
              {i32('RANK() OVER (ORDER BY ts DESC)')} AS spending_rank, total_orders,
              total_items_bought, {dbl('ts')} AS total_spent, avg_order_value, first_order_date,
              last_order_date
            FROM (
              SELECT customer_id, first_name || ' ' || last_name AS full_name, email, city,
                country, {orders} AS total_orders, {_AMOUNT} AS ts, {_MEAN} AS avg_order_value,
                MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
                {big('SUM(quantity)')} AS total_items_bought
              FROM sales GROUP BY 1, 2, 3, 4, 5)"""),
        "sales_by_country": statement(f"""
            SELECT country, {customers} AS customer_count, {orders} AS order_count,
              {big('SUM(quantity)')} AS total_items, {_REVENUE} AS total_revenue,
              {_MEAN} AS avg_order_value, {_per(customers)} AS lifetime_value_per_customer
            FROM sales GROUP BY country"""),
        "sales_by_city": statement(f"""
            SELECT city, country, {customers} AS customer_count, {orders} AS order_count,
              {_REVENUE} AS total_revenue,
              {i32(f'RANK() OVER (PARTITION BY country ORDER BY {_AMOUNT} DESC)')}
                AS city_rank_in_country
            FROM sales GROUP BY city, country"""),
        "top_category_by_country": statement(f"""
            SELECT * FROM (
              SELECT country, category, {_REVENUE} AS revenue,
                {i32(f'RANK() OVER (PARTITION BY country ORDER BY {_AMOUNT} DESC)')}
                  AS category_rank
              FROM sales GROUP BY country, category) WHERE category_rank = 1"""),
        "product_performance": statement(f"""
            SELECT product_name, category, COUNT(*) AS times_ordered,
              {big('SUM(quantity)')} AS total_quantity_sold, {_REVENUE} AS total_revenue,
              {rnd(qmean('unit_price'))} AS avg_unit_price, {customers} AS unique_customers,
              {_per(customers)} AS revenue_per_customer,
              {i32(f'RANK() OVER (ORDER BY {_AMOUNT} DESC)')} AS revenue_rank,
              {i32(f'RANK() OVER (PARTITION BY category ORDER BY {_AMOUNT} DESC)')}
                AS category_rank
            FROM sales GROUP BY product_name, category"""),
        "category_performance": statement(f"""
            SELECT category, COUNT(DISTINCT product_name) AS product_count,
              {orders} AS total_orders, {big('SUM(quantity)')} AS total_items_sold,
              {_REVENUE} AS total_revenue, {_MEAN} AS avg_order_value,
              {customers} AS unique_customers FROM sales GROUP BY category"""),
        "daily_sales": statement(f"""
            SELECT order_date, {orders} AS orders_count, {customers} AS unique_customers,
              {big('SUM(quantity)')} AS items_sold, {_REVENUE} AS daily_revenue,
              {_MEAN} AS avg_order_value FROM sales GROUP BY order_date"""),
        "sales_by_weekday": statement(f"""
            SELECT {i32('dayofweek(order_date) + 1')} AS day_of_week,
              dayname(order_date) AS day_name, {orders} AS orders_count,
              {_REVENUE} AS total_revenue FROM sales GROUP BY 1, 2"""),
        "monthly_trend": statement(f"""
            SELECT {i32('year(order_date)')} AS year, {i32('month(order_date)')} AS month,
              {orders} AS orders_count, {customers} AS unique_customers,
              {_REVENUE} AS monthly_revenue, {_per(customers)} AS revenue_per_customer
            FROM sales GROUP BY 1, 2"""),
    }


# ---- commerce ----------------------------------------------------------------------------------

_ITEM_AMOUNT = f"{mon(PRICE)} * CAST(l_quantity AS INT)"
FRAGMENTS |= {
    "c_purchase": f"""
        SELECT l_suppkey * 100000 + {big(f"datediff('day', DATE '1970-01-01', {SHIP})")} AS id,
          {SHIP} AS date, l_suppkey AS supplier_id, {mon(f'SUM({_ITEM_AMOUNT})')} AS total
        FROM lineitem GROUP BY ALL""",
    "c_stock": f"""
        SELECT product_id, date, {big('SUM(q)')} AS change FROM (
          SELECT l_partkey AS product_id, {SHIP} AS date, CAST(l_quantity AS INT) AS q
          FROM lineitem
          UNION ALL SELECT l_partkey, {ORD}, -CAST(l_quantity AS INT)
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL""",
    "c_offering": f"""
        SELECT o_orderkey AS id, n_regionkey AS class_id, r_name AS class_name,
          n_nationkey AS subject_id, n_name AS subject_name,
          {i32('ascii(c_mktsegment)')} AS section_id, c_mktsegment AS section_name,
          {i32(f'year({ORD})')} AS timeline_id, 'Year ' || year({ORD}) AS timeline_name,
          a AS start_date, z AS end_date,
          CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 20 AS VARCHAR) END
            AS instructor_id, s_name AS instructor_name
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        JOIN (SELECT year({ORD}) AS y, MIN({ORD}) AS a, MAX({ORD}) AS z FROM orders GROUP BY 1)
          ON y = year({ORD})
        LEFT JOIN supplier ON o_orderstatus <> 'P' AND s_suppkey = o_custkey % 20""",
}
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END"


def _summary(span: str) -> str:
    incoming = "CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END"
    outgoing = "CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END"
    return statement(f"""
        WITH s AS (SELECT coalesce({msum('o_totalprice')}, 0) AS total_sales,
                     COUNT(*) AS sales_count FROM orders WHERE {ORD} {span}),
        p AS (SELECT coalesce({msum('total')}, 0) AS total_purchases,
                COUNT(*) AS purchases_count FROM c_purchase WHERE date {span}),
        m AS (SELECT coalesce(SUM({mon(incoming)}), 0) AS a, coalesce(SUM({mon(outgoing)}), 0) AS b
              FROM lineitem WHERE {SHIP} {span})
        SELECT total_sales, sales_count, total_purchases, purchases_count,
          {dbl('a')} AS total_incoming_payments, {dbl('b')} AS total_outgoing_payments,
          {dbl('a - b')} AS net_cash_flow
        FROM s, p, m""")


def commerce_statements() -> dict[str, str]:
    top = (
        f"SELECT l_partkey AS product_id, {dbl(f'SUM({_ITEM_AMOUNT})')} AS total, "
        f"{big('SUM(CAST(l_quantity AS INT))')} AS units, p_name AS name FROM lineitem "
        "JOIN part ON l_partkey = p_partkey {where} GROUP BY ALL "
        "ORDER BY total DESC, product_id LIMIT 5"
    )
    recent = f">= {AS_OF} - 30"

    def last30(source: str, column: str, day: str) -> str:
        return statement(
            f"SELECT coalesce({msum(column)}, 0) AS total, COUNT(*) AS document_count, "
            f"coalesce({msum(column)} / NULLIF(COUNT(*), 0), 0) AS average "
            f"FROM {source} WHERE {day} {recent}"
        )

    incoming = msum("CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END")
    outgoing = msum("CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END")
    item = (
        f"{LINE} AS item_id, l_partkey AS product_id, p_name AS product_name, "
        f"CAST(l_quantity AS INT) AS quantity, {dbl(mon(PRICE))} AS unit_price, "
        f"{dbl(_ITEM_AMOUNT)} AS line_total"
    )
    offering = "SELECT * FROM c_offering"
    return {
        "commerce_summary": _summary(YEAR),
        "commerce_summary_default_range": _summary(LAST30),
        "top_products": top.format(
            where=f"JOIN orders ON l_orderkey = o_orderkey WHERE {ORD} {YEAR}"
        ),
        "top_products_alltime": top.format(where=""),
        "top_customers": f"""
            SELECT o_custkey AS customer_id, {msum('o_totalprice')} AS total,
              COUNT(*) AS sales_count, c_name AS name
            FROM orders JOIN customer ON o_custkey = c_custkey WHERE {ORD} {YEAR}
            GROUP BY ALL ORDER BY total DESC, customer_id LIMIT 5""",
        "daily_breakdown": statement(f"""
            SELECT coalesce(s.date, p.date) AS date, coalesce(s.t, 0) AS sales,
              coalesce(p.t, 0) AS purchases
            FROM (SELECT {ORD} AS date, {msum('o_totalprice')} AS t FROM orders
                  WHERE {ORD} {YEAR} GROUP BY 1) s
            FULL JOIN (SELECT date, {msum('total')} AS t FROM c_purchase WHERE date {YEAR}
                       GROUP BY 1) p ON s.date = p.date"""),
        "sales_last30": last30("orders", "o_totalprice", ORD),
        "purchases_last30": last30("c_purchase", "total", "date"),
        "payments_last30": f"""
            SELECT a AS incoming, b AS outgoing, {dbl(f"{mon('a')} - {mon('b')}")} AS net FROM (
              SELECT coalesce({incoming}, 0) AS a, coalesce({outgoing}, 0) AS b FROM lineitem
              WHERE {SHIP} {recent})""",
        "sales_listing": f"""
            WITH h AS (SELECT *, {ORD} AS d FROM orders WHERE {ORD} {YEAR}
                       ORDER BY d DESC, o_orderkey DESC LIMIT 20 OFFSET 20)
            SELECT o_orderkey AS id, d AS date, o_custkey AS customer_id,
              c_name AS customer_name, {dbl(mon('o_totalprice'))} AS total, {_STATUS} AS status,
              o_orderpriority AS notes, {item}
            FROM h JOIN customer ON o_custkey = c_custkey
            LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
        "purchases_listing": statement(f"""
            WITH h AS (SELECT * FROM c_purchase WHERE date {YEAR}
                       ORDER BY date DESC, id DESC LIMIT 20 OFFSET 20)
            SELECT id, date, supplier_id, s_name AS supplier_name, {dbl('total')} AS total,
              'Received' AS status, CAST(NULL AS VARCHAR) AS notes, {item}
            FROM h JOIN supplier ON supplier_id = s_suppkey
            LEFT JOIN lineitem ON l_suppkey = supplier_id AND {SHIP} = date
            LEFT JOIN part ON l_partkey = p_partkey"""),
        "sales_nested": f"""
            WITH h AS (SELECT *, {ORD} AS d FROM orders WHERE {ORD} {YEAR}
                       ORDER BY d DESC, o_orderkey DESC LIMIT 20 OFFSET 20)
            SELECT o_orderkey AS id, d AS date, {dbl(mon('o_totalprice'))} AS total, {_STATUS} AS status,
              COUNT(l_orderkey) AS item_count,
              coalesce(string_agg({LINE} || ':' || l_partkey, ',' ORDER BY {LINE}), '') AS items
            FROM h JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
            GROUP BY 1, 2, 3, 4""",
        "purchases_nested": statement(f"""
            WITH h AS (SELECT * FROM c_purchase WHERE date {YEAR}
                       ORDER BY date DESC, id DESC LIMIT 20 OFFSET 20)
            SELECT id, date, {dbl('total')} AS total, 'Received' AS status, COUNT(l_orderkey) AS item_count,
              coalesce(string_agg({LINE} || ':' || l_partkey, ',' ORDER BY {LINE}), '') AS items
            FROM h LEFT JOIN lineitem ON l_suppkey = supplier_id AND {SHIP} = date GROUP BY 1, 2, 3"""),
        "stock_ledger": f"""
            SELECT l_partkey AS product_id, {big("""SUM(q)""")} AS on_hand FROM (
              SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem
              UNION ALL
              SELECT l_partkey, -CAST(l_quantity AS BIGINT) - CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 7 <> 0) GROUP BY 1""",
        "payments_listing": f"""
            SELECT {LINE} AS id, {SHIP} AS date, {dbl(mon('l_extendedprice'))} AS amount,
              'Outgoing' AS direction, l_orderkey AS reference_id, 'Purchase' AS reference_type,
              CAST(NULL AS VARCHAR) AS notes
            FROM lineitem WHERE l_returnflag = 'R' AND {SHIP} {YEAR}
            ORDER BY date DESC, id DESC LIMIT 20 OFFSET 20""",
        "customer_search": """
            SELECT c_custkey AS id, c_name AS name, lower(c_mktsegment) || '@example.com' AS email,
              CAST(NULL AS VARCHAR) AS phone
            FROM customer WHERE contains(c_name, 'machinery')
              OR contains(lower(c_mktsegment) || '@example.com', 'machinery')
            ORDER BY c_name, c_custkey LIMIT 20 OFFSET 20""",
        "product_search": f"""
            SELECT p_partkey AS id, p_name AS name, p_brand AS sku, p_type AS description,
              {dbl(mon('p_retailprice'))} AS unit_price, p_size AS stock_quantity,
              p_size > 5 AS is_active
            FROM part WHERE contains(p_name, '1') OR contains(p_brand, '1')
            ORDER BY p_name, p_partkey LIMIT 20 OFFSET 20""",
        "supplier_search": """
            SELECT s_suppkey AS id, s_name AS name, lower(s_name) || '@example.com' AS email,
              CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS address,
              s_acctbal > 0 AS is_active
            FROM supplier WHERE contains(s_name, '0') ORDER BY s_name, s_suppkey LIMIT 20""",
        "active_users": """
            SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS full_name,
              lower(s_name) || '@example.com' AS email
            FROM supplier WHERE NOT s_acctbal < 0 ORDER BY full_name, id LIMIT 20""",
        "offering_listing": statement(
            f"{offering} WHERE start_date >= DATE '1996-01-01' AND end_date <= DATE '2000-12-31'"
        ),
        "offering_page": statement(
            f"{offering} WHERE class_id = 2 ORDER BY class_name, subject_name, id "
            "LIMIT 20 OFFSET 40"
        ),
        "stock_on_hand": statement(f"""
            SELECT p_partkey AS product_id, p_name AS name, {big('p_size')} AS opening_stock,
              coalesce(c, 0) AS net_change, p_size + coalesce(c, 0) AS on_hand
            FROM part LEFT JOIN (SELECT product_id, {big('SUM(change)')} AS c FROM c_stock
                                 GROUP BY 1) ON product_id = p_partkey"""),
        "running_stock": statement(f"""
            SELECT product_id, date, change, p_size + {big(
                'SUM(change) OVER (PARTITION BY product_id ORDER BY date)')} AS on_hand
            FROM c_stock JOIN part ON product_id = p_partkey"""),
        "order_total": f"SELECT l_orderkey AS sale_id, {dbl(f'SUM({_ITEM_AMOUNT})')} AS total "
        "FROM lineitem GROUP BY 1",
        "reference_list_class": "SELECT r_regionkey AS id, r_name AS name, "
        "CAST(NULL AS VARCHAR) AS description, TRUE AS is_active FROM region",
        "reference_list_subject": "SELECT n_nationkey AS id, n_name AS name, "
        "CAST(NULL AS VARCHAR) AS description, TRUE AS is_active FROM nation",
        "reference_list_section": f"SELECT {i32('ascii(c_mktsegment)')} AS id, "
        f"c_mktsegment AS name, {i32('COUNT(*)')} AS capacity, TRUE AS is_active "
        "FROM customer GROUP BY 1, 2",
        "reference_list_timeline": f"SELECT {i32(f'year({ORD})')} AS id, "
        f"'Year ' || year({ORD}) AS name, MIN({ORD}) AS start_date, MAX({ORD}) AS end_date, "
        "TRUE AS is_active FROM orders GROUP BY 1, 2",
    }


# ---- measures ----------------------------------------------------------------------------------


def measure_statements() -> dict[str, str]:
    def by(table: str, column: str, **values: str) -> str:
        listed = ", ".join(f"{sql} AS {name}" for name, sql in values.items())
        return statement(f"SELECT {column}, {listed} FROM {table} GROUP BY {column}")

    def quotient(a: str, b: str) -> str:
        return f"coalesce({div(a, b)}, 0)"

    return {
        "measures_fact_purchase_orders": by(
            "fact_purchase_orders", "po_status", total_spend=msum("total_value"),
            total_po_count="COUNT(*)", avg_po_value=quotient("SUM(total_value)", "COUNT(*)"),
        ),
        "measures_fact_invoices": by(
            "fact_invoices", "aging_bucket", total_invoiced=msum("gross_amount"),
            total_paid=msum("paid_amount"),
            overdue_amount=dbl(
                "SUM(CASE WHEN upper(payment_status) = 'OVERDUE' THEN gross_amount END)"
            ),
            avg_days_to_pay=imean("days_to_pay"),
        ),
        "measures_fact_project_costs": by(
            "fact_project_costs", "cost_type", total_budget=msum("budget_amount"),
            total_actual_cost=msum("actual_amount"),
            budget_variance=dbl("SUM(budget_amount) - SUM(actual_amount)"),
            budget_utilization_pct=quotient("SUM(actual_amount)", "SUM(budget_amount)"),
        ),
        "measures_fact_vendor_performance": by(
            "fact_vendor_performance", "recommendation", avg_vendor_score=qmean("overall_score")
        ),
        "measures_dim_vendor": by(
            "dim_vendor", "tier", vendor_count="COUNT(DISTINCT vendor_id)"
        ),
        "measures_fact_goods_receipts": by(
            "fact_goods_receipts", "grn_status", total_received_qty=qsum("quantity_received"),
            avg_acceptance_rate=qmean("acceptance_rate"),
        ),
        "measures_fact_contracts": by(
            "fact_contracts", "contract_type", total_contract_value=msum("contract_value"),
            active_contracts="COUNT(CASE WHEN upper(contract_status) = 'ACTIVE' THEN 1 END)",
        ),
        "measures_fact_sales": by(
            "fact_sales", "customer_type", total_revenue=msum("revenue"),
            total_cogs=msum("cogs"), gross_margin=dbl("SUM(revenue) - SUM(cogs)"),
            margin_pct=quotient("SUM(revenue) - SUM(cogs)", "SUM(revenue)"),
        ),
        "measures_fact_inventory": by(
            "fact_inventory", "movement_type", net_inventory_flow=qsum("quantity"),
            inventory_value=msum("total_value"),
        ),
        "measures_dim_project": by(
            "dim_project", "region", project_count="COUNT(DISTINCT project_id)"
        ),
        "measures_cube_project_costs": by(
            "cube_project_costs", "region",
            over_budget_projects="COUNT(DISTINCT CASE WHEN is_over_budget THEN project_id END)",
        ),
        "measures_cube_procurement_spend": by(
            "cube_procurement_spend", "vendor_sector", spend_by_sector=msum("total_spend"),
            spend_cube_vendor_count="COUNT(DISTINCT vendor_id)",
            yoy_growth=qmean("yoy_growth_pct"),
        ),
        "measure_grand_total": statement(
            f"SELECT {quotient('SUM(total_value)', 'COUNT(*)')} AS avg_po_value "
            "FROM fact_purchase_orders WHERE po_status = 'OPEN'"
        ),
        "measure_spend_by_tier": statement(
            f"SELECT tier, vendor_country, {quotient('SUM(total_value)', 'COUNT(*)')} "
            "AS avg_po_value FROM fact_purchase_orders f JOIN dim_vendor v "
            "ON f.vendor_id = v.vendor_id GROUP BY ALL"
        ),
    }


# ---- reports -----------------------------------------------------------------------------------


def _sum4(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def _mean8(x: str) -> str:
    return f"(CAST(SUM(CAST({rnd(x, 8)} AS DECIMAL(38,8))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def report_statements() -> dict[str, str]:
    def roll(cube: str, by: str, **values: str) -> str:
        listed = ", ".join(f"{sql} AS {name}" for name, sql in values.items())
        return statement(f"SELECT {by}, {listed} FROM {cube} GROUP BY ALL")

    spend, perf = "cube_procurement_spend", "cube_vendor_performance"
    sales, stock = "cube_sales_analysis", "cube_inventory_status"
    p2p, plan = "cube_procurement_efficiency", "cube_project_timeline"
    aging, quality = "cube_invoice_aging", "cube_goods_receipt_quality"
    scores = {f"avg_{s}_score": _mean8(f"avg_{s}_score")
              for s in ("delivery", "quality", "commercial", "hse", "overall")}
    cycles = {n: _mean8(n) for n in (
        "avg_order_to_receipt_days", "avg_receipt_to_invoice_days", "avg_invoice_to_payment_days",
        "avg_total_p2p_days")}
    pivot = ", ".join(
        f"CAST(SUM(CASE WHEN cost_type = '{t}' THEN CAST(overrun_amount AS DECIMAL(28,4)) END) "
        f'AS DOUBLE) AS "{t}"'
        for t in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    out = {
        "spend_trend": roll(spend, "year_month", total_spend=_sum4("total_spend")),
        "budget_by_variance_class": roll(
            "cube_budget_vs_actual", "variance_class", actual_amount=_sum4("actual_amount")),
        "spend_by_sector": roll(
            "cube_spend_by_sector", "sector_name", total_spend=_sum4("total_spend")),
        "spend_by_project_sector": roll(
            spend, "project_name, vendor_sector", total_spend=_sum4("total_spend")),
        "yoy_growth_by_vendor": roll(
            spend, "vendor_name", total_spend=_sum4("total_spend"),
            prev_year_spend=_sum4("prev_year_spend"),
            avg_yoy_growth_pct=_mean8("yoy_growth_pct")),
        "vendor_scorecard": roll(perf, "vendor_name", **scores),
        "vendors_by_risk_tier": roll(
            "cube_vendor_risk", "risk_tier", vendor_count="COUNT(vendor_id)"),
        "aging_by_month": roll(
            aging, "year_month, aging_bucket", total_net_amount=_sum4("total_net_amount")),
        "overdue_by_vendor": roll(
            aging, "vendor_name", overdue_amount=_sum4("overdue_amount")),
        "days_outstanding_trend": roll(
            aging, "year_month", avg_days_outstanding=_mean8("avg_days_outstanding")),
        "cpi_by_project": roll("cube_project_costs", "project_name", avg_cpi=_mean8("cpi")),
        "on_time_trend": roll(
            "cube_delivery_performance", "year_month",
            avg_on_time_rate_pct=_mean8("on_time_rate_pct")),
        "quality_tier_counts": roll(quality, "quality_tier", vendor_rows="COUNT(vendor_id)"),
        "defect_by_category": roll(
            quality, "material_category", avg_defect_rate_pct=_mean8("defect_rate_pct")),
        "contract_value_by_status": roll(
            "cube_contract_status", "status", revised_value=_sum4("revised_value")),
        "cost_growth_by_contract": roll(
            "cube_contract_status", "contract_id",
            avg_cost_growth_pct=_mean8("cost_growth_pct")),
        "revenue_by_product": roll(
            sales, "product_name", total_revenue=_sum4("total_revenue")),
        "margin_by_customer_type": roll(
            sales, "customer_type", avg_margin_pct=_mean8("margin_pct")),
        "revenue_trend": roll(
            sales, "year_month", total_revenue=_sum4("total_revenue"),
            avg_yoy_growth_pct=_mean8("revenue_yoy_growth_pct")),
        "net_flow_by_material": roll(
            stock, "material_name", net_quantity_flow=_sum4("net_quantity_flow")),
        "issue_ratio_trend": roll(
            stock, "year_month", avg_issue_to_receipt_ratio=_mean8("issue_to_receipt_ratio")),
        "movement_value_by_month": roll(
            stock, "year_month, material_category",
            total_movement_value=_sum4("total_movement_value")),
        "p2p_trend": roll(p2p, "year_month", avg_total_p2p_days=_mean8("avg_total_p2p_days")),
        "cycle_by_vendor": roll(
            p2p, "vendor_name", **cycles, avg_median_p2p=_mean8("median_total_p2p"),
            total_spend=_sum4("total_spend")),
        "schedule_status_counts": roll(
            plan, "schedule_status", project_count="COUNT(project_id)"),
        "schedule_variance_by_project": roll(
            plan, "project_name", schedule_variance_days=_sum4("schedule_variance_days")),
        "vendor_risk_scatter": roll(
            "cube_vendor_risk", "vendor_name", avg_overall_score=_mean8("avg_overall_score"),
            composite_risk_score=_mean8("composite_risk_score"),
            total_invoiced=_sum4("total_invoiced")),
        "contract_risk_flags": roll(
            "cube_contract_status",
            "contract_id, vendor_name, project_name, cost_risk_flag, schedule_risk_flag",
            remaining_value=_sum4("remaining_value")),
        "cost_vs_plan_scatter": roll(
            plan, "project_name", planned_pct_complete=_mean8("planned_pct_complete"),
            cost_pct_complete=_mean8("cost_pct_complete"), total_budget=_sum4("total_budget")),
        "topn": statement(
            f"SELECT vendor_name, {_sum4('total_spend')} AS total_spend FROM {spend} "
            "GROUP BY 1 ORDER BY total_spend DESC, vendor_name LIMIT 10"),
        "slice": statement(
            f"SELECT vendor_name, {_sum4('total_spend')} AS total_spend FROM {spend} "
            "WHERE year IN (1996, 1997) AND quarter = 2 GROUP BY 1"),
        "matrix": statement(
            f"SELECT project_name, {pivot} FROM cube_cost_variance GROUP BY 1"),
        "band": statement(
            "SELECT project_id, cpi, CASE WHEN cpi < 0.9::DOUBLE THEN 'RED' WHEN cpi <= 1 "
            "THEN 'YELLOW' WHEN cpi > 1 THEN 'GREEN' END AS cpi_band FROM cube_project_costs"),
        "growth_band": statement(
            "SELECT vendor_id, year, quarter, yoy_growth_pct, CASE WHEN yoy_growth_pct > 0 "
            "THEN 'GREEN' WHEN yoy_growth_pct < 0 THEN 'RED' END AS growth_band "
            "FROM cube_spend_by_sector"),
    }
    return {f"report_{name}": sql for name, sql in out.items()}


# ---- insights ----------------------------------------------------------------------------------


def _kpis() -> str:
    def one(
        name: str, value: str, source: str, target: float, alert: float, low: bool, ok: str = ""
    ) -> str:
        bad, fine = ("> ", "<= ") if low else ("< ", ">= ")
        return (
            f"SELECT '{name}' AS kpi, {value} AS value, {dbl(str(target))} AS target, "
            f"{dbl(str(alert))} AS alert_threshold, CASE WHEN {value} IS NULL THEN 'NO DATA' "
            f"WHEN {value} {bad}{alert} THEN 'ALERT' WHEN {value} {ok or f'{fine}{target}'} THEN 'OK' "
            f"ELSE 'WARN' END AS status FROM {source}"
        )

    def pct(a: str, b: str) -> str:
        return rnd(div(a, b) + " * 100")

    def in_year(y: int) -> str:
        return f"SUM(CASE WHEN year(po_date) = {y} THEN total_amount ELSE 0 END)"

    po, iv, pc = "fact_purchase_orders", "fact_invoices", "fact_project_costs"
    budget = "(SELECT SUM(budget_amount) FROM fact_project_costs)"
    parts = [
        one("spend_vs_budget_pct", pct("SUM(total_amount)", budget), po, 100, 110, True),
        one("yoy_spend_growth_pct",
            rnd(f"({dbl(in_year(1997))} - {dbl(in_year(1996))}) / {dbl(in_year(1996))} * 100"),
            po, 15, 20, True),
        one("procurement_cycle_days", rnd(imean(days("po_date", "approval_date"))), po, 5, 15,
            True),
        one("invoice_days_outstanding", rnd(imean("days_outstanding")), iv, 30, 60, True),
        one("overdue_invoice_pct",
            pct("SUM(CASE WHEN payment_status = 'OVERDUE' THEN gross_amount ELSE 0 END)",
                "SUM(gross_amount)"), iv, 5, 15, True),
        one("cost_performance_index",
            rnd(div("SUM(budget_amount)", "SUM(actual_amount + committed_amount)"), 4), pc, 1, 0.9,
            False),
        one("budget_variance_pct",
            rnd(f"({dbl('SUM(budget_amount)')} - {dbl('SUM(actual_amount)')})"
                f" / {dbl('SUM(budget_amount)')} * 100"), pc, 0, -10, False),
        one("budget_utilisation_pct", pct("SUM(actual_amount)", "SUM(budget_amount)"), pc, 100,
            100, True, "BETWEEN 85 AND 100"),
        one("on_time_delivery_pct", pct("SUM(on_time_count)", "SUM(delivery_count)"),
            "cube_delivery_performance", 95, 85, False),
        one("material_acceptance_pct", pct("SUM(quantity_accepted)", "SUM(quantity_received)"),
            "fact_goods_receipts", 98, 90, False),
        one("defect_rate_pct", pct("SUM(quantity_rejected)", "SUM(quantity_received)"),
            "fact_goods_receipts", 2, 10, True),
        one("vendor_overall_score", rnd(qmean("overall_score")), "fact_vendor_performance", 80,
            60, False),
        one("contract_cost_growth_pct",
            rnd(f"({dbl('SUM(revised_value)')} - {dbl('SUM(contract_value)')})"
                f" / {dbl('SUM(contract_value)')} * 100"), "fact_contracts", 5, 20, True),
        one("contract_utilisation_pct", pct("SUM(items_total)", "SUM(contract_value)"),
            "fact_contracts", 80, 50, False),
        one("schedule_variance_days", rnd(imean("schedule_variance_days")),
            "cube_project_timeline", 0, 30, True),
    ]
    return statement(" UNION ALL ".join(parts))


def _pareto(level: str, source: str) -> str:
    share = rnd(div("r", "t") + " * 100", 4)
    return statement(f"""
        WITH g AS (SELECT {level}, {mon('SUM(line_value)')} AS s FROM {source} GROUP BY 1),
        w AS (SELECT *, SUM(s) OVER (ORDER BY s DESC RANGE UNBOUNDED PRECEDING) AS r,
                SUM(s) OVER () AS t, RANK() OVER (ORDER BY s DESC) AS k FROM g)
        SELECT {level}, {dbl('s')} AS spend, {i32('k')} AS spend_rank,
          {rnd(div('s', 't') + ' * 100', 4)} AS share_pct, {share} AS cumulative_share_pct,
          CASE WHEN {share} <= 80 THEN 'A' WHEN {share} <= 95 THEN 'B' ELSE 'C' END
            AS pareto_class
        FROM w""")


def insight_statements() -> dict[str, str]:
    eac = div("total_budget", "cpi")
    ahead = f"datediff('day', {AS_OF}, due_date)"

    def due(cond: str) -> str:
        return msum(f"CASE WHEN {cond} THEN gross_amount ELSE 0 END")

    return {
        "kpi_alerts": _kpis(),
        "concentration_risk": statement(f"""
            SELECT f.vendor_id, vendor_name, {msum('total_amount')} AS spend,
              {rnd(div('SUM(total_amount)', '(SELECT SUM(total_amount) FROM fact_purchase_orders)')
                   + ' * 100', 4)} AS share_pct
            FROM fact_purchase_orders f JOIN dim_vendor v ON f.vendor_id = v.vendor_id
            GROUP BY ALL"""),
        "evm_extended": statement(f"""
            SELECT c.project_id, c.project_name, c.total_budget, c.total_actual, cpi,
              {rnd(eac.replace('total_budget', 'c.total_budget'))} AS eac,
              {rnd('c.total_budget - ' + eac.replace('total_budget', 'c.total_budget'))} AS vac,
              {rnd(div('cost_pct_complete', 'planned_pct_complete'), 4)} AS spi,
              {rnd(div('c.total_budget * (1 - planned_pct_complete)',
                       'c.total_budget - c.total_actual'), 4)} AS tcpi
            FROM cube_project_costs c JOIN cube_project_timeline t
              ON c.project_id = t.project_id"""),
        "cashflow_forecast": statement(f"""
            SELECT vendor_id, {due(f'{ahead} < 0')} AS overdue,
              {due(f'{ahead} BETWEEN 0 AND 30')} AS due_30,
              {due(f'{ahead} BETWEEN 31 AND 60')} AS due_60,
              {due(f'{ahead} BETWEEN 61 AND 90')} AS due_90,
              {due(f'{ahead} > 90')} AS due_later, {msum('gross_amount')} AS total_unpaid
            FROM fact_invoices WHERE payment_date IS NULL AND due_date IS NOT NULL GROUP BY 1"""),
        "three_way_match": statement(f"""
            WITH r AS (SELECT po_id, {msum('receipt_value')} AS rv,
                         {qsum('quantity_accepted')} AS aq FROM fact_goods_receipts GROUP BY 1),
            i AS (SELECT po_id, {msum('gross_amount')} AS ia, COUNT(*) AS n
                  FROM fact_invoices GROUP BY 1)
            SELECT po_id, vendor_id, {dbl('line_total')} AS line_total,
              {dbl('total_quantity')} AS total_quantity, rv AS received_value,
              aq AS accepted_quantity, ia AS invoiced_amount, n AS invoice_count,
              CASE WHEN rv IS NULL THEN 'NO_RECEIPT' WHEN ia IS NULL THEN 'NO_INVOICE'
                WHEN abs(rv - line_total) > line_total * 0.05::DOUBLE THEN 'RECEIPT_MISMATCH'
                WHEN abs(ia - rv) > rv * 0.05::DOUBLE THEN 'INVOICE_MISMATCH' ELSE 'MATCHED' END
                AS match_status
            FROM fact_purchase_orders LEFT JOIN r USING (po_id) LEFT JOIN i USING (po_id)"""),
        "stock_alerts": statement(f"""
            WITH s AS (
              SELECT material_id, {qsum('quantity')} AS oh,
                MAX(CASE WHEN movement_type = 'ISSUE' THEN movement_date END) AS li,
                abs({qsum(f"CASE WHEN movement_type = 'ISSUE' AND movement_date > {AS_OF} - 365 "
                          "THEN quantity ELSE 0 END")}) AS iss
              FROM fact_inventory WHERE movement_date <= {AS_OF} GROUP BY 1)
            SELECT material_id, material_name, reorder_point, coalesce(oh, 0) AS on_hand,
              li AS last_issue, coalesce(oh, 0) < reorder_point AS reorder_alert,
              coalesce(datediff('day', li, {AS_OF}) > 180, TRUE) AS slow_moving,
              {rnd(div('coalesce(oh, 0) * 365', 'iss'))} AS days_of_inventory
            FROM s_materials LEFT JOIN s USING (material_id)"""),
        "burn_rate_months": statement(f"""
            WITH m AS (SELECT project_id, {msum('actual_amount')} AS sp,
                         COUNT(DISTINCT strftime(posting_date, '%Y-%m')) AS n
                       FROM s_project_actuals GROUP BY 1),
            b AS (SELECT project_id, {msum('budget_amount')} AS bu FROM fact_project_costs
                  GROUP BY 1),
            x AS (SELECT *, bu - coalesce(sp, 0) AS lft, {div('sp', 'n')} AS rate
                  FROM b LEFT JOIN m USING (project_id))
            SELECT project_id, bu AS budget, sp AS spent, n AS spend_months,
              {rnd('rate')} AS monthly_burn, {rnd('lft')} AS remaining,
              CASE WHEN lft <= 0 THEN 0 ELSE {rnd(div('lft', 'rate'))} END AS months_to_exhaustion
            FROM x"""),
        "s_curve": statement(f"""
            WITH m AS (SELECT project_id, last_day(posting_date) AS month_end,
                         {mon('SUM(actual_amount)')} AS a FROM s_project_actuals GROUP BY ALL),
            b AS (SELECT project_id, {msum('budget_amount')} AS bu FROM fact_project_costs
                  GROUP BY 1),
            e AS (SELECT project_id, MIN(month_end) AS f, MAX(month_end) AS l FROM m GROUP BY 1),
            s AS (SELECT project_id, start_date, end_date, bu, last_day(unnest(generate_series(
                    date_trunc('month', least(start_date, f)),
                    date_trunc('month', greatest(end_date, l)), INTERVAL 1 MONTH))::DATE)
                    AS month_end
                  FROM dim_project JOIN b USING (project_id) LEFT JOIN e USING (project_id))
            SELECT s.project_id, s.month_end, {dbl('coalesce(a, 0)')} AS actual,
              {dbl('SUM(coalesce(a, 0)) OVER (PARTITION BY s.project_id ORDER BY s.month_end)')}
                AS cumulative_actual,
              {rnd('bu * ' + div("least(greatest(datediff('day', start_date, s.month_end), 0), "
                                 "datediff('day', start_date, end_date))",
                                 "datediff('day', start_date, end_date)"))}
                AS cumulative_planned
            FROM s LEFT JOIN m ON s.project_id = m.project_id AND s.month_end = m.month_end"""),
        "spend_concentration": _pareto(
            "category", "s_po_line_items JOIN dim_material USING (material_id)"
        ),
        "spend_concentration_material": _pareto("material_id", "s_po_line_items"),
    }


# ---- edits and history -------------------------------------------------------------------------

_KEYS = {
    "fact_purchase_orders": "po_id", "fact_invoices": "invoice_id",
    "fact_contracts": "contract_id", "fact_project_costs": "budget_id",
    "fact_goods_receipts": "grn_id", "fact_sales": "sales_order_id",
    "fact_vendor_performance": "performance_id", "dim_vendor": "vendor_id",
    "dim_project": "project_id", "dim_material": "material_id",
}


def _times(column: str, factor: str) -> str:
    return f"round({mon(column)} * {factor}, 2)"


_EDITS = {
    "A01": ("fact_purchase_orders", 5, "po_value", _times("po_value", "1.30"),
            "po_status = 'APPROVED'"),
    "A02": ("fact_purchase_orders", 5, "total_amount", _times("total_amount", "1.20"), "TRUE"),
    "A03": ("fact_purchase_orders", 3, "po_status", "'CANCELLED'", "po_status = 'OPEN'"),
    "A04": ("fact_purchase_orders", 5, "priority", "'HIGH'", "priority = 'NORMAL'"),
    "A05": ("fact_purchase_orders", 5, "payment_terms", "'90'",
            "CAST(payment_terms AS INT) < 90"),
    "A06": ("fact_purchase_orders", 3, "po_type", "'EMERGENCY'", "po_type = 'STANDARD'"),
    "A07": ("fact_invoices", 5, "invoice_amount", _times("invoice_amount", "1.25"),
            "payment_status IN ('UNPAID', 'PENDING')"),
    "A08": ("fact_invoices", 5, "days_overdue", "95", "days_overdue > 0"),
    "A09": ("fact_invoices", 3, "aging_bucket", "'90+ DAYS'", "aging_bucket != '90+ DAYS'"),
    "A10": ("fact_invoices", 3, "payment_status", "'DISPUTED'", "payment_status = 'PENDING'"),
    "A11": ("fact_invoices", 5, "net_amount", _times("net_amount", "1.20"), "TRUE"),
    "A12": ("fact_invoices", 5, "gross_amount", _times("gross_amount", "1.15"), "TRUE"),
    "A13": ("fact_contracts", 3, "contract_value", _times("contract_value", "1.25"),
            "contract_status = 'ACTIVE'"),
    "A14": ("fact_contracts", 3, "revised_value", _times("revised_value", "1.30"), "TRUE"),
    "A15": ("fact_contracts", 3, "value_utilisation_pct", "97.0", "value_utilisation_pct < 90"),
    "A16": ("fact_contracts", 3, "change_order_count", "change_order_count + 5", "TRUE"),
    "A17": ("fact_contracts", 2, "contract_status", "'AT_RISK'", "contract_status = 'ACTIVE'"),
    "A18": ("fact_project_costs", 5, "actual_amount", _times("actual_amount", "1.40"), "TRUE"),
    "A19": ("fact_project_costs", 5, "variance_amount", "variance_amount - 75000", "TRUE"),
    "A20": ("fact_project_costs", 3, "budget_status", "'OVERSPENT'",
            "budget_status != 'OVERSPENT'"),
    "A21": ("fact_project_costs", 3, "utilization_pct", "115.0", "utilization_pct < 100"),
    "A22": ("fact_project_costs", 5, "remaining_amount", _times("remaining_amount", "0.50"),
            "remaining_amount > 0"),
    "A23": ("fact_goods_receipts", 5, "rejection_rate", "40.0", "rejection_rate < 20"),
    "A24": ("fact_goods_receipts", 5, "quantity_rejected", "quantity_rejected + 50", "TRUE"),
    "A25": ("fact_goods_receipts", 3, "grn_status", "'REJECTED'", "grn_status = 'RECEIVED'"),
    "A26": ("fact_goods_receipts", 5, "acceptance_rate", "60.0", "acceptance_rate > 80"),
    "A27": ("fact_goods_receipts", 5, "receipt_value", _times("receipt_value", "1.25"), "TRUE"),
    "A28": ("fact_sales", 5, "revenue", _times("revenue", "1.50"), "order_status = 'COMPLETED'"),
    "A29": ("fact_sales", 5, "margin_pct", "margin_pct - 15", "TRUE"),
    "A30": ("fact_sales", 3, "order_status", "'CANCELLED'", "order_status = 'PENDING'"),
    "A31": ("fact_sales", 5, "unit_price", f"round({qty('unit_price')} * 1.30, 2)", "TRUE"),
    "A32": ("fact_vendor_performance", 3, "overall_score", "35.0", "overall_score > 60"),
    "A33": ("fact_vendor_performance", 3, "recommendation", "'REVIEW'",
            "recommendation = 'APPROVED'"),
    "A34": ("fact_vendor_performance", 3, "quality_score", "30.0", "quality_score > 60"),
    "A35": ("dim_vendor", 3, "performance_rating", "1.5",
            "performance_rating >= 4 AND status = 'ACTIVE'"),
    "A36": ("dim_vendor", 3, "risk_category", "'HIGH'", "risk_category = 'LOW'"),
    "A37": ("dim_vendor", 5, "tier", "'STANDARD'", "tier IN ('STRATEGIC', 'PREFERRED')"),
    "A38": ("dim_vendor", 2, "status", "'SUSPENDED'", "status = 'ACTIVE'"),
    "A39": ("dim_project", 3, "project_status", "'ON_HOLD'", "project_status = 'ACTIVE'"),
    "A40": ("dim_project", 3, "risk_level", "'CRITICAL'", "risk_level = 'LOW'"),
    "A41": ("dim_project", 3, "approved_budget_usd", _times("approved_budget_usd", "1.35"),
            "TRUE"),
    "A42": ("dim_material", 5, "unit_price", _times("unit_price", "1.45"), "is_active"),
    "A43": ("dim_material", 5, "lead_time_days", "60", "lead_time_days < 30"),
    "A44": ("dim_material", 3, "is_active", "FALSE", "is_active"),
}
_TEXT = {
    "po_status", "priority", "payment_terms", "po_type", "aging_bucket", "payment_status",
    "contract_status", "budget_status", "grn_status", "order_status", "recommendation",
    "risk_category", "tier", "status", "project_status", "risk_level",
}
_INTEGER = {"days_overdue", "change_order_count", "lead_time_days"}


def edit_statements() -> dict[str, str]:
    out = {}
    for name, (table, n, column, value, condition) in _EDITS.items():
        if column in _TEXT:
            cast = str
        elif column in _INTEGER:
            cast = i32
        elif column == "is_active":
            cast = str
        else:
            cast = dbl
        key = _KEYS[table]
        out[f"update_{name}"] = statement(
            f"SELECT {key}, {cast(column)} AS old_{column}, {cast(value)} AS new_{column} "
            f"FROM {table} WHERE {key} IN (SELECT {key} FROM {table} WHERE {condition} "
            f"ORDER BY {key} LIMIT {n})"
        )
    first5 = (
        "(SELECT po_id FROM fact_purchase_orders WHERE po_status = 'APPROVED' "
        "ORDER BY po_id LIMIT 5)"
    )
    now = "SELECT vendor_id, vendor_name, tier, status FROM dim_vendor"
    later = (
        "SELECT vendor_id, vendor_name, CASE WHEN performance_rating + 1 >= 4 THEN 'STRATEGIC' "
        "WHEN performance_rating + 1 >= 3 THEN 'PREFERRED' ELSE 'STANDARD' END AS tier, status "
        "FROM dim_vendor WHERE status <> 'INACTIVE'"
    )
    out |= {
        "update_first_n": statement(
            f"SELECT po_id, po_status, {dbl('CASE WHEN po_id IN ' + first5 + ' THEN ' + _times('po_value', '1.30') + ' ELSE po_value END')} "
            "AS po_value FROM fact_purchase_orders"
        ),
        "revert_update": statement(
            f"SELECT po_id, po_status, {dbl('po_value')} AS po_value FROM fact_purchase_orders"
        ),
        "upsert_merge": statement(
            f"WITH l AS ({later}), a AS (SELECT * FROM l UNION ALL SELECT vendor_id + 1000000, "
            "vendor_name, tier, status FROM l WHERE status = 'PENDING') "
            f"SELECT * FROM a UNION ALL ({now} WHERE vendor_id NOT IN (SELECT vendor_id FROM a))"
        ),
        "scd2_snapshots": statement(f"""
            WITH o AS ({now}), l AS ({later}),
            j AS (SELECT o.*, l.tier AS t2, l.vendor_id IS NOT NULL AS here
                  FROM o LEFT JOIN l ON o.vendor_id = l.vendor_id)
            SELECT vendor_id, vendor_name, tier, status, DATE '1997-01-01' AS valid_from,
              CASE WHEN NOT here OR tier <> t2 THEN DATE '1997-12-31' ELSE DATE '9999-12-31' END
                AS valid_to,
              here AND tier = t2 AS is_current FROM j
            UNION ALL SELECT vendor_id, vendor_name, t2, status, DATE '1998-01-01',
              DATE '9999-12-31', TRUE FROM j WHERE here AND tier <> t2"""),
        "scd2_dimension": f"""
            WITH d AS (SELECT o_custkey, {ORD} AS day, arg_max(o_orderstatus, o_orderkey) AS s
                       FROM orders GROUP BY 1, 2),
            c AS (SELECT * FROM (SELECT *, LAG(s) OVER (PARTITION BY o_custkey ORDER BY day) AS p
                  FROM d) WHERE p IS NULL OR p <> s)
            SELECT o_custkey, s AS order_status, day AS valid_from,
              coalesce(LEAD(day) OVER w - 1, DATE '9999-12-31') AS valid_to,
              LEAD(day) OVER w IS NULL AS is_current
            FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""",
        "scd2_late_changes": f"""
            WITH d AS (SELECT o_custkey, {ORD} AS day,
                         CASE WHEN max(o_orderkey) % 11 <> 0 THEN arg_max(o_orderstatus, o_orderkey) END AS s
                       FROM orders GROUP BY 1, 2),
            c AS (SELECT * FROM (SELECT *, row_number() OVER w AS i, LAG(s) OVER w AS p FROM d
                                 WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
                  WHERE i = 1 OR p IS DISTINCT FROM s),
            n AS (SELECT *, LEAD(day) OVER (PARTITION BY o_custkey ORDER BY day) AS later FROM c)
            SELECT o_custkey, s AS order_status, day AS valid_from,
              coalesce(later - 1, DATE '9999-12-31') AS valid_to, later IS NULL AS is_current
            FROM n WHERE s IS NOT NULL""",
        "edit_stored": statement(
            f"SELECT po_id, po_status, {dbl('CASE WHEN po_id IN ' + first5 + ' THEN ' + _times('po_value', '1.30') + ' ELSE po_value END')} "
            "AS po_value, priority FROM fact_purchase_orders"
        ),
        "undo_stored": statement(
            f"SELECT po_id, po_status, {dbl('po_value')} AS po_value, CASE WHEN po_id IN (SELECT po_id FROM "
            "fact_purchase_orders WHERE priority = 'NORMAL' ORDER BY po_id LIMIT 5) THEN 'HIGH' ELSE priority END AS priority "
            "FROM fact_purchase_orders"
        ),
        "merge_stored": statement(
            "SELECT po_id, CASE WHEN po_id % 50 = 0 THEN po_date + 31 ELSE po_date END AS po_date, CASE WHEN po_id % 50 = 0 "
            f"THEN 'MOVED' ELSE po_status END AS po_status, {dbl('po_value')} AS po_value FROM fact_purchase_orders"
        ),
        "read_period": statement(
            f"SELECT po_id, po_date, po_status, {dbl('po_value')} AS po_value FROM fact_purchase_orders "
            "WHERE po_date BETWEEN DATE '1997-02-10' AND DATE '1997-04-20'"
        ),
        "join_period": statement(
            f"SELECT {i32('dayofweek(po_date) + 1')} AS weekday, COUNT(*) AS orders, {msum('po_value')} AS spend "
            "FROM fact_purchase_orders WHERE po_date BETWEEN DATE '1997-04-01' AND DATE '1997-06-30' GROUP BY 1"
        ),
        "hierarchy_materials": statement(
            "SELECT m.material_id, CASE WHEN p.material_id IS NOT NULL THEN m.parent_material_id ELSE m.material_id END AS root, "
            "CASE WHEN p.material_id IS NOT NULL THEN 1::BIGINT ELSE 0::BIGINT END AS level, "
            "CASE WHEN m.parent_material_id IS NULL THEN 'ROOT' WHEN p.material_id IS NULL THEN 'ORPHAN' ELSE 'CHILD' END AS status "
            "FROM s_materials m LEFT JOIN s_materials p ON p.material_id = m.parent_material_id"
        ),
        "hierarchy_chains": """
            WITH RECURSIVE n AS (
              SELECT p_partkey AS id, CASE WHEN p_partkey % 97 = 0 THEN p_partkey + 1000000000 WHEN p_partkey % 101 = 5 THEN p_partkey + 1
                WHEN p_partkey % 101 = 6 THEN p_partkey - 1 WHEN p_partkey >= 3 THEN p_partkey // 3 END AS up FROM part
            ), tops AS (SELECT id, up IS NOT NULL AS lost FROM n WHERE up IS NULL OR up NOT IN (SELECT id FROM n)),
            down AS (
              SELECT id, id AS root, 0::BIGINT AS level, lost FROM tops
              UNION ALL SELECT n.id, root, level + 1, lost FROM down JOIN n ON n.up = down.id
            ), walk AS (
              SELECT id AS origin, up AS here, 1 AS step FROM n WHERE id NOT IN (SELECT id FROM down)
              UNION ALL SELECT origin, n.up, step + 1 FROM walk JOIN n ON n.id = walk.here WHERE step < 2
            )
            SELECT id::BIGINT AS part_id, root::BIGINT AS root, level, CASE WHEN NOT lost THEN CASE WHEN level = 0 THEN 'ROOT' ELSE 'CHILD' END
              WHEN level = 0 THEN 'ORPHAN' ELSE 'BELOW_ORPHAN' END AS status FROM down
            UNION ALL
            SELECT origin, NULL, NULL, CASE WHEN bool_or(here = origin) THEN 'CYCLE' ELSE 'BELOW_CYCLE' END FROM walk GROUP BY 1""",
    }
    return out


# ---- streams -----------------------------------------------------------------------------------


def stream_statements() -> dict[str, str]:
    names = (
        "dim_vendor dim_project dim_material fact_purchase_orders fact_invoices "
        "fact_goods_receipts fact_project_costs fact_vendor_performance fact_contracts fact_sales"
    ).split()
    out = {f"stream_{n}": whole(n) for n in names}
    late = ("fact_purchase_orders", "fact_goods_receipts")
    out |= {f"stream_late_{n}": whole(n) for n in late}
    out["stream_merge"] = statement(
        "SELECT vendor_id, vendor_name, CASE WHEN vendor_id % 2 = 0 THEN 'MOVED' ELSE tier END AS tier "
        "FROM dim_vendor WHERE vendor_id % 5 <> 0"
    )
    day = "DATE '1998-03-15'"
    age = f"CASE WHEN payment_date IS NULL AND due_date IS NOT NULL THEN {days(day, 'due_date')} ELSE 0 END"
    out["aging_at_read"] = statement(
        f"SELECT invoice_id, CASE WHEN payment_date IS NOT NULL THEN 'PAID' WHEN due_date < {day} THEN 'OVERDUE' "
        f"ELSE 'PENDING' END AS payment_status, {i32(age)} AS days_overdue, CASE WHEN {age} <= 0 THEN 'CURRENT' "
        f"WHEN {age} <= 30 THEN '1-30 DAYS' WHEN {age} <= 60 THEN '31-60 DAYS' WHEN {age} <= 90 THEN '61-90 DAYS' "
        f"ELSE '90+ DAYS' END AS aging_bucket FROM fact_invoices"
    )
    out["stream_dq"] = statement(
        "SELECT CASE WHEN vendor_id IS NULL THEN 'valid_vendor_ref' ELSE 'kept' END AS outcome, "
        "evaluation_period, COUNT(*) AS row_count FROM all_vendor_performance GROUP BY 1, 2"
    )
    out["stream_dq_metrics"] = statement(_metrics(("vendor_performance", "contracts", "sales_orders")))
    return out


def job_statements() -> dict[str, str]:
    return (
        ingestion_statements()
        | quality_statements()
        | sales_statements()
        | commerce_statements()
        | measure_statements()
        | report_statements()
        | insight_statements()
        | edit_statements()
        | stream_statements()
    )
