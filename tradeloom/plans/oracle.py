"""Independent SQL statements for the registered queries, over the same parquet tables.

Every statement is written from the definition of the result, without the pre-aggregation and
bucketing that the jobs use.  Named fragments may refer to each other; ``statement`` puts the
needed ones in front as common table expressions.
"""

from __future__ import annotations

import re

from ..sources.star import NATION_COUNTRIES

AS_OF = "DATE '1998-09-30'"


def rnd(x: str, digits: int = 2) -> str:
    """Round half up on the decimal text of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def i32(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def mon(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def qty(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def qsum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def mmean(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def qmean(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def imean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


def pct0(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {rnd(f'{dbl(a)} / {dbl(b)} * 100')} ELSE 0.0 END"


def days(later: str, earlier: str) -> str:
    return i32(f"datediff('day', {earlier}, {later})")


# The countries of each region.
REGIONS = {
    "NORTH AMERICA": ["US", "CA", "MX", "USA"],
    "EUROPE": ["GB", "DE", "FR", "IT", "ES", "NL", "NO", "SE", "UK"],
    "MIDDLE EAST": ["AE", "SA", "QA", "KW", "OM", "BH", "UAE", "SAUDI ARABIA"],
    "ASIA PACIFIC": ["AU", "NZ", "SG", "MY", "IN", "JP", "KR", "CN", "SOUTH KOREA"],
}


def region(x: str) -> str:
    whens = ""
    for label, countries in REGIONS.items():
        listed = ", ".join(f"'{c}'" for c in countries)
        whens += f" WHEN {x} IN ({listed}) THEN '{label}'"
    return f"CASE{whens} ELSE 'OTHER' END"


LINE = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
SHIP = "CAST(l_shipdate AS DATE)"
ORD = "CAST(o_orderdate AS DATE)"
PRICE = "CAST(floor(l_extendedprice / l_quantity) AS DOUBLE)"
TAX = "floor(l_extendedprice * l_tax)"
REJ = "CASE WHEN l_returnflag = 'R' THEN floor(l_quantity * l_discount) ELSE 0.0 END"
LO = "lineitem JOIN orders ON l_orderkey = o_orderkey"
COUNTRY = f"[{', '.join(repr(c) for c in NATION_COUNTRIES)}][n_nationkey + 1]"


def ym(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def period(x: str) -> str:
    return f"{i32(f'year({x})')} AS year, {i32(f'quarter({x})')} AS quarter, {ym(x)} AS year_month"


FRAGMENTS: dict[str, str] = {
    "order_vendor": "SELECT l_orderkey AS k, MIN(l_suppkey) AS vendor_id FROM lineitem GROUP BY 1",
    # ---- cleansed tables -------------------------------------------------------------------
    "s_vendors": f"""
        SELECT s_suppkey AS vendor_id, s_name AS vendor_code, s_name AS vendor_name,
          CASE s_suppkey % 3 WHEN 0 THEN 'MANUFACTURER' WHEN 1 THEN 'SUPPLIER'
            ELSE 'CONSULTANT' END AS vendor_type,
          '  ' || lower(r_name) || ' ' AS sector_specialization,
          upper({COUNTRY}) AS country, r_name AS state, n_name AS city,
          {i32('s_suppkey % 3 * 15 + 30')} AS payment_terms_days,
          {mon('abs(s_acctbal) * 10')} AS credit_limit_usd,
          s_acctbal / 2000 AS performance_rating,
          CASE WHEN s_acctbal < 1000 THEN 'BLACKLISTED' WHEN s_acctbal < 4000 THEN 'HIGH'
            WHEN s_acctbal < 7000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
          CASE s_suppkey % 4 WHEN 0 THEN 'expired' WHEN 1 THEN 'pending' WHEN 2 THEN 'approved'
            ELSE 'Approved' END AS prequalification_status,
          DATE '2001-12-31' AS prequalification_expiry_date,
          s_suppkey % 2 = 0 AS iso_certified, {dbl('4')} AS hse_rating,
          s_suppkey % 5 = 0 AS minority_owned, s_suppkey % 7 = 0 AS small_business,
          s_name AS contact_name, lower(s_name) || '@example.com' AS contact_email,
          CAST(NULL AS VARCHAR) AS contact_phone,
          {mon('s_acctbal * 1000')} AS annual_turnover_usd,
          {i32('s_suppkey % 40')} AS years_in_business
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "s_projects": f"""
        WITH p AS (
          SELECT c_custkey AS project_id, c_name AS project_code, c_name AS project_name,
            CASE c_custkey % 4 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'HIGHWAY' WHEN 2 THEN 'REFINERY'
              ELSE 'PIPELINE' END AS project_type,
            '  ' || lower(c_mktsegment) || ' ' AS sector, c_name AS client_name,
            'EMP-' || c_custkey AS project_manager, upper({COUNTRY}) AS country,
            upper(r_name) AS state, n_name AS city,
            {mon('abs(c_acctbal) * 110')} AS contract_value_usd,
            {mon('c_acctbal * 100')} AS approved_budget_usd,
            CASE c_custkey % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'COMPLETED' WHEN 2 THEN 'PLANNING'
              WHEN 3 THEN 'CLOSED' ELSE 'ACTIVE' END AS project_status,
            MIN({ORD}) AS start_date, MAX({ORD}) AS planned_completion_date,
            CASE c_custkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
            CASE c_custkey % 4 WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
          FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey LEFT JOIN orders ON o_custkey = c_custkey
          GROUP BY c_custkey, c_name, c_mktsegment, c_acctbal, n_nationkey, r_name, n_name)
        SELECT *, CASE WHEN project_id % 5 = 1 THEN planned_completion_date + 10 END
            AS actual_completion_date,
          {days('planned_completion_date', 'start_date')} AS planned_duration_days,
          {pct0('(contract_value_usd - approved_budget_usd)', 'approved_budget_usd')}
            AS budget_variance_pct
        FROM p""",
    "s_materials": f"""
        SELECT p_partkey AS material_id, 'MAT-' || p_partkey AS material_code,
          p_name AS material_name,
          CASE p_partkey % 3 WHEN 0 THEN 'PRODUCT' ELSE 'ITEM' END AS material_level,
          CASE WHEN p_partkey % 3 <> 0 THEN p_partkey - p_partkey % 3 END AS parent_material_id,
          p_type AS category, p_brand AS sub_category, {mon('p_retailprice')} AS unit_price,
          p_size AS lead_time_days, {dbl('p_size')} * {dbl('1.5')} AS weight_kg,
          {i32('p_size * 5')} AS reorder_point, {i32('p_size * 20')} AS max_stock_level,
          p_size > 5 AS is_active
        FROM part""",
    "s_employees": f"""
        SELECT c_custkey AS employee_id, 'EMP-' || c_custkey AS employee_code,
          ' ' || substr(c_name, 1, 8) || ' ' AS first_name,
          ' ' || substr(c_name, 10, 9) AS last_name,
          substr(c_name, 1, 8) || ' ' || substr(c_name, 10, 9) AS full_name,
          upper(c_mktsegment) AS department,
          CASE c_custkey % 3 WHEN 0 THEN 'Manager' WHEN 1 THEN 'Engineer' ELSE 'Analyst' END
            AS job_title,
          'L' || (c_custkey % 6 + 1) AS grade,
          CASE WHEN c_custkey % 6 <> 5 THEN {mon('abs(c_acctbal) * 10')} END AS approval_limit,
          DATE '1990-01-01' + {i32('c_custkey % 3000')} AS hire_date,
          c_custkey % 4 <> 0 AS is_active, 'Houston' AS location,
          'CC-' || substr(c_mktsegment, 1, 4) AS cost_center
        FROM customer""",
    "all_purchase_orders": f"""
        SELECT o_orderkey AS po_id, vendor_id, o_custkey AS project_id, {ORD} AS po_date,
          {ORD} + 30 AS delivery_date, {ORD} - {i32('o_orderkey % 20')} AS approval_date,
          {mon('o_totalprice')} AS po_value, {mon('floor(o_totalprice / 20)')} AS tax_amount,
          {mon('o_totalprice + floor(o_totalprice / 20)')} AS total_value,
          CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END
            AS po_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'EMERGENCY' WHEN '5-LOW' THEN 'BLANKET'
            ELSE 'STANDARD' END AS po_type,
          CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' THEN 'CRITICAL'
            WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH' ELSE 'NORMAL' END
            AS priority,
          'USD' AS currency,
          CASE o_orderstatus WHEN 'F' THEN '30' WHEN 'O' THEN '60' ELSE '90' END AS payment_terms,
          {ORD} AS order_date
        FROM orders LEFT JOIN order_vendor ON o_orderkey = k""",
    "s_purchase_orders": "SELECT * FROM all_purchase_orders WHERE vendor_id IS NOT NULL",
    "s_po_line_items": f"""
        WITH r AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_quantity
                             ELSE floor(l_quantity * 0.5::DOUBLE) END AS got FROM lineitem),
        l AS (
          SELECT {LINE} AS line_id, l_orderkey AS po_id, l_linenumber AS line_number,
            l_partkey AS material_id, l_suppkey AS vendor_id, {qty('l_quantity')} AS qty_ordered,
            {qty('got')} AS qty_received,
            {qty('floor(got * (1 - l_discount))')} AS qty_accepted, {qty(PRICE)} AS unit_price,
            {mon('l_extendedprice')} AS line_value, {SHIP} AS delivery_date,
            CASE WHEN l_linestatus = 'F' THEN {SHIP} + 3 END AS actual_delivery_date
          FROM r)
        SELECT *, {pct0('qty_received', 'qty_ordered')} AS fulfillment_rate,
          {pct0('qty_accepted', 'qty_received')} AS acceptance_rate
        FROM l""",
    "s_contracts": f"""
        SELECT o_orderkey AS contract_id,
          CASE o_orderstatus WHEN 'F' THEN 'FIXED_PRICE' WHEN 'O' THEN 'COST_PLUS'
            ELSE 'TIME_MATERIALS' END AS contract_type,
          CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'ACTIVE' ELSE 'PENDING' END
            AS contract_status,
          vendor_id, o_custkey AS project_id, 'EMP-' || (o_orderkey % 100) AS contract_manager_id,
          {mon('o_totalprice')} AS contract_value, {mon('o_totalprice')} AS original_value,
          {mon('o_totalprice + (o_orderkey % 5) * 10000')} AS revised_value,
          {i32('o_orderkey % 5')} AS variation_orders, 'USD' AS currency, {ORD} AS start_date,
          {ORD} + 365 AS end_date, {dbl('10')} AS retention_pct,
          {dbl('5')} AS performance_bond_pct, {dbl('2')} AS liquidated_damages_pct,
          'NET30' AS payment_terms, 365 AS contract_duration_days
        FROM orders LEFT JOIN order_vendor ON o_orderkey = k""",
    "s_contract_items": f"""
        SELECT {LINE} AS item_id, l_orderkey AS contract_id, l_linenumber AS line_number,
          l_partkey AS material_id, {qty('l_quantity')} AS quantity, {PRICE} AS unit_rate,
          l_extendedprice AS amount, l_returnflag = 'R' AS milestone_flag,
          {qty(PRICE)} AS unit_price, {mon('l_extendedprice')} AS line_value
        FROM lineitem""",
    "s_invoices": f"""
        SELECT *, {days('payment_date', 'invoice_date')} AS days_to_pay,
          CASE WHEN payment_date IS NULL AND due_date IS NOT NULL
            THEN {days(AS_OF, 'due_date')} ELSE 0 END AS days_overdue
        FROM (
          SELECT {LINE} AS invoice_id, l_suppkey AS vendor_id, l_orderkey AS po_id,
            l_orderkey AS contract_id, o_custkey AS project_id,
            CASE l_returnflag WHEN 'N' THEN 'standard' WHEN 'A' THEN 'milestone' ELSE 'credit' END
              AS invoice_type,
            CASE l_linestatus WHEN 'F' THEN 'PAID' ELSE 'APPROVED' END AS invoice_status,
            {SHIP} AS invoice_date, {SHIP} + 30 AS due_date,
            {mon('l_extendedprice')} AS gross_amount, l_tax AS tax_rate, {mon(TAX)} AS tax_amount,
            {mon('0')} AS retention_amount,
            {mon(f'l_extendedprice - {TAX}')} AS net_amount, 'USD' AS currency,
            CASE WHEN l_discount > 0.05::DOUBLE THEN floor(l_extendedprice * l_discount)
              ELSE 0.0::DOUBLE END AS early_payment_discount,
            CASE WHEN l_linestatus = 'F' THEN {SHIP} + CAST(l_quantity AS INT) END AS paid_date,
            CASE WHEN l_linestatus = 'F' THEN {SHIP} + CAST(l_quantity AS INT) END AS payment_date,
            {mon("CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END")} AS paid_amount,
            'EMP-1' AS approved_by, {LINE} AS invoice_ref, CAST(NULL AS VARCHAR) AS description,
            {mon('l_extendedprice')} AS invoice_amount,
            {mon(f'l_extendedprice - {TAX}')} AS total_amount
          FROM {LO})""",
    "s_goods_receipts": f"""
        SELECT *, {pct0('qty_rejected', 'qty_delivered')} AS rejection_rate FROM (
          SELECT {LINE} AS grn_id, l_orderkey AS po_id, {LINE} AS line_item_id,
            l_suppkey AS vendor_id, CAST(NULL AS BIGINT) AS project_id, l_partkey AS material_id,
            {SHIP} AS receipt_date, {qty('l_quantity')} AS qty_delivered,
            {qty(f'l_quantity - ({REJ})')} AS qty_accepted, {qty(REJ)} AS qty_rejected,
            CASE l_returnflag WHEN 'N' THEN 'RECEIVED' WHEN 'A' THEN 'ACCEPTED' ELSE 'REJECTED'
              END AS grn_status,
            'WH-1' AS storage_location, 'inspector' AS received_by,
            {qty('l_quantity')} AS qty_received
          FROM lineitem)""",
    "s_project_budgets": f"""
        SELECT o_custkey || '-' || o_orderstatus || '-' || o_orderpriority AS budget_id,
          o_custkey AS project_id, o_orderstatus AS wbs_code, o_orderpriority AS cost_type,
          CASE o_orderstatus WHEN 'F' THEN 'ORIGINAL' WHEN 'O' THEN 'REVISED' ELSE 'FORECAST' END
            AS budget_version,
          CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'DRAFT' ELSE 'SUBMITTED' END
            AS budget_status,
          {mon('t')} AS original_amount, {mon('t')} AS revised_amount,
          CASE o_orderstatus WHEN 'P' THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END AS contingency_pct,
          {mon('floor(t / 10)')} AS committed_amount, {mon('floor(t / 2)')} AS actual_spent,
          a AS period_start, z AS period_end, {mon('t')} AS budget_amount,
          {mon('t')} AS original_budget, {mon('floor(t / 2)')} AS spent_amount,
          {mon('t')} - {mon('floor(t / 2)')} AS remaining_amount,
          {pct0(mon('floor(t / 2)'), mon('t'))} AS utilization_pct
        FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, {msum('o_totalprice')} AS t,
                MIN({ORD}) AS a, MAX({ORD}) AS z FROM orders GROUP BY 1, 2, 3)""",
    "s_project_actuals": f"""
        SELECT {LINE} AS transaction_id, o_custkey AS project_id, l_suppkey AS vendor_id,
          l_orderkey AS po_id, l_orderkey AS contract_id,
          CASE WHEN l_returnflag <> 'A' THEN {LINE} END AS invoice_id,
          o_orderstatus AS wbs_code, o_orderpriority AS cost_type,
          CASE l_linestatus WHEN 'F' THEN 'POSTED' ELSE 'DRAFT' END AS cost_status,
          {SHIP} AS transaction_date, {SHIP} AS posting_date,
          {mon('l_extendedprice')} AS actual_amount,
          {mon('floor(l_extendedprice * (1 - l_discount))')} AS budget_amount,
          {mon('l_extendedprice - floor(l_extendedprice * (1 - l_discount))')} AS variance,
          strftime({SHIP}, '%Y%m') AS fiscal_period, {mon('l_extendedprice')} AS amount,
          o_orderpriority AS cost_category
        FROM {LO}""",
    "s_sales_orders": f"""
        WITH b AS (SELECT *, floor(l_extendedprice * (1 - l_discount) * 0.5::DOUBLE) AS cost
                   FROM {LO} JOIN customer ON o_custkey = c_custkey)
        SELECT {LINE} AS sales_order_id, o_custkey AS project_id, l_partkey AS material_id,
          CASE l_returnflag WHEN 'N' THEN 'STANDARD' WHEN 'A' THEN 'URGENT' ELSE 'BLANKET' END
            AS order_type,
          CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'CANCELLED'
            END AS order_status,
          CASE l_linestatus WHEN 'F' THEN 'PAID' ELSE 'UNBILLED' END AS payment_status,
          c_name AS customer_name, c_mktsegment AS customer_type, {ORD} AS order_date,
          {SHIP} AS delivery_date, {qty('l_quantity')} AS quantity, {qty(PRICE)} AS unit_price,
          {mon('l_extendedprice')} AS revenue, {mon('cost')} AS cogs,
          {mon('l_extendedprice - cost')} AS gross_margin,
          floor((l_extendedprice - cost) / l_extendedprice * 100) AS margin_pct,
          {mon(TAX)} AS tax_amount, {mon(f'l_extendedprice + {TAX}')} AS total_amount,
          'USD' AS currency, 'EXW' AS delivery_terms, {mon('l_extendedprice')} AS order_value,
          {mon(f'l_extendedprice + {TAX}')} AS total_value
        FROM b""",
    "s_inventory": f"""
        SELECT {LINE} AS movement_id, l_partkey AS material_id, {LINE} AS grn_id,
          CASE l_returnflag WHEN 'N' THEN 'RECEIPT' WHEN 'A' THEN 'ISSUE' ELSE 'RETURN' END
            AS movement_type,
          {qty("CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END")} AS quantity,
          {qty(PRICE)} AS unit_cost, {mon('l_extendedprice')} AS total_value,
          'SUPPLIER' AS from_location, 'WH-1' AS to_location, 'B-1' AS batch_number,
          'EACH' AS unit_of_measure, 'GRN' AS reason_code, {SHIP} AS movement_date,
          'EMP-1' AS posted_by, {mon('l_extendedprice')} AS total_cost
        FROM lineitem""",
    "all_vendor_performance": """
        WITH e AS (
          SELECT *, least(value, 100.0::DOUBLE) AS d, greatest(0.0::DOUBLE, 100.0::DOUBLE
              - least(value, 100.0::DOUBLE)) AS q,
            least(100.0::DOUBLE, least(value, 100.0::DOUBLE) + CASE event_type
              WHEN 'purchase' THEN 20.0::DOUBLE WHEN 'signup' THEN 10.0::DOUBLE
              ELSE 0.0::DOUBLE END) AS c,
            CASE WHEN event_type = 'error' THEN 30.0::DOUBLE ELSE 90.0::DOUBLE END AS h
          FROM events),
        f AS (SELECT *, floor(d * 0.3::DOUBLE + q * 0.3::DOUBLE + c * 0.2::DOUBLE
                + h * 0.2::DOUBLE) AS comp FROM e)
        SELECT event_id AS performance_id,
          CASE WHEN event_type = 'error' AND value > 150 THEN NULL ELSE user_id % 10 END
            AS vendor_id,
          user_id AS project_id, strftime(ts, '%Y%m%d') || '-D' AS evaluation_period,
          CAST(ts AS DATE) AS evaluation_date, d AS delivery_score, q AS quality_score,
          c AS commercial_score, h AS hse_score, event_type AS evaluator_id, props AS remarks,
          CASE WHEN comp >= 80 THEN 'PREFERRED' WHEN comp >= 60 THEN 'APPROVED'
            WHEN comp >= 40 THEN 'CONDITIONAL' ELSE 'DELIST' END AS recommendation,
          comp AS overall_score, (d + q + c + h) / 4 AS compliance_score
        FROM f""",
    "s_vendor_performance":
        "SELECT * FROM all_vendor_performance WHERE vendor_id IS NOT NULL",
    # ---- star schema -----------------------------------------------------------------------
    "dim_date": f"""
        SELECT {i32("strftime(d, '%Y%m%d')")} AS date_key, d AS date, {i32('year(d)')} AS year,
          {i32('quarter(d)')} AS quarter, {i32('month(d)')} AS month, {i32('day(d)')} AS day,
          {i32('dayofweek(d) + 1')} AS day_of_week, dayname(d) AS day_name,
          monthname(d) AS month_name, {ym('d')} AS year_month,
          'FY' || year(d) || CASE WHEN month(d) <= 6 THEN '-H1' ELSE '-H2' END AS fiscal_period,
          {i32('year(d)')} AS fiscal_year, {i32('quarter(d)')} AS fiscal_quarter
        FROM (SELECT CAST(unnest(generate_series(MIN({ORD}), MAX({ORD}), INTERVAL 1 DAY)) AS DATE)
              AS d FROM orders)""",
    "dim_vendor": """
        SELECT vendor_id, vendor_code, vendor_name, vendor_type,
          sector_specialization AS vendor_sector, upper(trim(sector_specialization)) AS sector,
          country AS vendor_country, state AS vendor_state, city AS vendor_city,
          payment_terms_days, credit_limit_usd, performance_rating, risk_category,
          prequalification_status, prequalification_expiry_date AS prequalification_expiry,
          iso_certified, hse_rating, minority_owned, small_business,
          contact_name AS primary_contact, contact_email, contact_phone, annual_turnover_usd,
          years_in_business,
          CASE WHEN performance_rating >= 4 THEN 'STRATEGIC' WHEN performance_rating >= 3
            THEN 'PREFERRED' ELSE 'STANDARD' END AS tier,
          CASE upper(prequalification_status) WHEN 'APPROVED' THEN 'ACTIVE'
            WHEN 'PENDING' THEN 'PENDING' ELSE 'INACTIVE' END AS status, TRUE AS _is_current
        FROM s_vendors""",
    "dim_project": f"""
        SELECT project_id, project_code, project_name, project_type, client_name, sector, state,
          project_manager, contract_value_usd, approved_budget_usd, budget_variance_pct,
          project_status, project_status AS status, start_date,
          planned_completion_date AS end_date, actual_completion_date,
          planned_duration_days AS project_duration_days, priority, risk_level,
          {region('country')} AS region, TRUE AS _is_current
        FROM s_projects""",
    "dim_material": """
        SELECT material_id, material_code, material_name, category,
          category AS material_category, sub_category, unit_price, weight_kg, lead_time_days,
          is_active, TRUE AS _is_current FROM s_materials""",
    "dim_employee": """
        SELECT employee_id, employee_code, full_name, department, job_title, grade,
          approval_limit, location, is_active, cost_center, hire_date, TRUE AS _is_current
        FROM s_employees""",
    "dim_geography": f"""
        SELECT sha256(coalesce(country, '') || '|' || coalesce(state, '') || '|'
            || coalesce(city, '')) AS geography_key,
          country, state, city, {region('country')} AS region, TRUE AS _is_current
        FROM (SELECT country, state, city FROM s_projects
              UNION SELECT country, state, city FROM s_vendors)""",
    "dim_contract": f"""
        SELECT contract_id, vendor_id, project_id, contract_type, contract_status,
          contract_status AS status, contract_value, contract_value AS original_value,
          revised_value, start_date, end_date, contract_duration_days, payment_terms,
          retention_pct, performance_bond_pct AS performance_bond,
          variation_orders AS change_order_count,
          revised_value - contract_value AS change_order_value,
          {pct0('(revised_value - contract_value)', 'contract_value')} AS cost_growth_pct,
          contract_manager_id AS approved_by, TRUE AS _is_current FROM s_contracts""",
    "dim_cost_center": """
        SELECT DISTINCT cost_center AS cost_center_key, cost_center AS cost_center_code,
          department AS cost_center_category, TRUE AS _is_current FROM s_employees""",
    "dim_sector": """
        SELECT s AS sector_key, s AS sector_name, TRUE AS _is_current FROM (
          SELECT upper(trim(sector_specialization)) AS s FROM s_vendors
          UNION SELECT upper(trim(sector)) FROM s_projects)""",
    "dim_currency": """
        SELECT DISTINCT currency AS currency_key, currency AS currency_code, TRUE AS _is_current
        FROM (SELECT currency FROM s_purchase_orders UNION ALL SELECT currency FROM s_invoices
              UNION ALL SELECT currency FROM s_sales_orders)""",
    "fact_purchase_orders": f"""
        SELECT po_id, p.vendor_id, project_id, po_date, p.delivery_date,
          p.delivery_date AS expected_delivery_date, approval_date, po_value, tax_amount,
          total_value, total_value AS total_amount, po_status, po_type, priority, currency,
          payment_terms, coalesce(lt, 0) AS line_total, coalesce(tq, 0) AS total_quantity
        FROM s_purchase_orders p LEFT JOIN (
          SELECT po_id AS k, {msum('line_value')} AS lt, {qsum('qty_ordered')} AS tq
          FROM s_po_line_items GROUP BY 1) ON po_id = k""",
    "fact_invoices": f"""
        SELECT invoice_id, vendor_id, po_id, project_id, contract_id,
          invoice_ref AS invoice_number, invoice_type,
          CASE WHEN payment_date IS NOT NULL THEN 'PAID' WHEN due_date < {AS_OF} THEN 'OVERDUE'
            ELSE 'PENDING' END AS payment_status,
          invoice_date, due_date, payment_date, invoice_amount, total_amount AS net_amount,
          tax_rate, tax_amount, total_amount, invoice_amount AS gross_amount, paid_amount,
          retention_amount, days_to_pay, days_overdue, days_overdue AS days_outstanding,
          CASE WHEN days_overdue <= 0 THEN 'CURRENT' WHEN days_overdue <= 30 THEN '1-30 DAYS'
            WHEN days_overdue <= 60 THEN '31-60 DAYS' WHEN days_overdue <= 90 THEN '61-90 DAYS'
            ELSE '90+ DAYS' END AS aging_bucket, currency, approved_by, description AS notes
        FROM s_invoices""",
    "fact_goods_receipts": f"""
        SELECT grn_id, g.po_id, line_item_id, g.vendor_id, g.material_id,
          coalesce(g.project_id, p.project_id) AS project_id, receipt_date, g.qty_received AS quantity_received, g.qty_accepted AS quantity_accepted,
          qty_rejected AS quantity_rejected, rejection_rate,
          {dbl('100')} - rejection_rate AS acceptance_rate,
          {mon('g.qty_accepted * coalesce(l.unit_price, 0)')} AS receipt_value, grn_status,
          storage_location, received_by AS inspector
        FROM s_goods_receipts g LEFT JOIN s_purchase_orders p ON g.po_id = p.po_id
        LEFT JOIN (SELECT line_id, MAX(unit_price) AS unit_price FROM s_po_line_items GROUP BY 1) l
          ON line_item_id = line_id""",
    "fact_project_costs": f"""
        SELECT budget_id, b.project_id, b.wbs_code AS wbs_element, b.wbs_code, b.cost_type,
          revised_amount AS budget_amount, original_amount AS original_budget, committed_amount,
          coalesce(spent, actual_spent) AS actual_amount,
          revised_amount - coalesce(spent, actual_spent) AS remaining_amount,
          {pct0('coalesce(spent, actual_spent)', 'revised_amount')} AS utilization_pct,
          revised_amount - coalesce(spent, actual_spent) AS variance_amount,
          {pct0('(revised_amount - coalesce(spent, actual_spent))', 'revised_amount')}
            AS variance_pct,
          budget_status, period_start, period_end, last_day AS posting_date
        FROM s_project_budgets b LEFT JOIN (
          SELECT project_id, wbs_code, cost_type, {mon('SUM(actual_amount)')} AS spent,
            MAX(posting_date) AS last_day FROM s_project_actuals GROUP BY 1, 2, 3) a
        ON b.project_id = a.project_id AND b.wbs_code = a.wbs_code
          AND upper(b.cost_type) = a.cost_type""",
    "fact_project_actuals": """
        SELECT transaction_id, po_id, invoice_id, wbs_code, cost_type, cost_category, cost_status,
          transaction_date, posting_date, actual_amount, budget_amount, variance,
          variance AS overrun, fiscal_period FROM s_project_actuals""",
    "fact_vendor_performance": """
        SELECT performance_id, vendor_id, project_id, evaluation_date, evaluation_period,
          delivery_score, quality_score, commercial_score, hse_score, compliance_score,
          overall_score, recommendation, evaluator_id, remarks AS notes
        FROM s_vendor_performance""",
    "fact_inventory": """
        SELECT movement_id, material_id, grn_id, movement_type, movement_date, quantity,
          unit_cost, total_value, from_location, to_location, batch_number, unit_of_measure,
          reason_code, posted_by FROM s_inventory""",
    "fact_contracts": f"""
        SELECT c.contract_id, vendor_id, project_id, contract_type, contract_status,
          contract_value, revised_value, start_date, variation_orders AS change_order_count,
          revised_value - contract_value AS change_order_value,
          {mon('coalesce(it, 0)')} AS items_total, coalesce(n, 0) AS item_count,
          {pct0('coalesce(it, 0)', 'contract_value')} AS value_utilisation_pct, payment_terms,
          retention_pct, liquidated_damages_pct AS penalty_clause,
          performance_bond_pct AS performance_bond, currency
        FROM s_contracts c LEFT JOIN (
          SELECT contract_id, SUM(line_value) AS it, COUNT(item_id) AS n
          FROM s_contract_items GROUP BY 1) i ON c.contract_id = i.contract_id""",
    "fact_sales": """
        SELECT sales_order_id, material_name AS product_name, customer_name,
          sha256(customer_name) AS customer_id, customer_type, order_type, order_status,
          payment_status, order_date, delivery_date, quantity, s.unit_price, revenue, cogs,
          gross_margin, margin_pct, tax_amount, total_amount, currency, delivery_terms
        FROM s_sales_orders s LEFT JOIN s_materials m ON s.material_id = m.material_id""",
    # ---- cubes -----------------------------------------------------------------------------
    "po_dated": f"SELECT *, {period('po_date')} FROM fact_purchase_orders",
    "spend_quarters": f"""
        SELECT vendor_id, year, quarter, {mon('SUM(total_amount)')} AS q FROM po_dated
        JOIN dim_project USING (project_id) GROUP BY ALL""",
    "cube_procurement_spend": f"""
        WITH prev AS (SELECT *, LAG(q) OVER (PARTITION BY vendor_id, quarter ORDER BY year) AS p
                      FROM spend_quarters),
        g AS (
          SELECT v.vendor_id, v.vendor_name, v.sector AS vendor_sector, project_id, project_name,
            year, quarter, year_month, COUNT(DISTINCT po_id) AS po_count,
            {msum('total_amount')} AS total_spend, {msum('line_total')} AS total_line_value,
            {qsum('total_quantity')} AS total_quantity,
            {mmean('total_amount')} AS avg_po_value
          FROM po_dated f JOIN dim_vendor v ON f.vendor_id = v.vendor_id
          JOIN dim_project USING (project_id) GROUP BY ALL)
        SELECT g.*, q AS vendor_quarter_spend, p AS prev_year_spend,
          CASE WHEN p > 0 THEN {rnd(f"({dbl('q')} - {dbl('p')}) / {dbl('p')} * 100")} END
            AS yoy_growth_pct
        FROM g JOIN prev USING (vendor_id, year, quarter)""",
    "cube_vendor_performance": f"""
        WITH g AS (
          SELECT v.vendor_id, vendor_name, sector, tier, vendor_country AS country,
            evaluation_period, {qmean('delivery_score')} AS a, {qmean('quality_score')} AS b,
            {qmean('commercial_score')} AS c, {qmean('hse_score')} AS d,
            {qmean('overall_score')} AS e, COUNT(*) AS evaluation_count
          FROM fact_vendor_performance p JOIN dim_vendor v ON p.vendor_id = v.vendor_id
          GROUP BY ALL),
        r AS (
          SELECT vendor_id, evaluation_period, recommendation FROM fact_vendor_performance
          QUALIFY row_number() OVER (PARTITION BY vendor_id, evaluation_period
            ORDER BY evaluation_date DESC, performance_id DESC) = 1)
        SELECT vendor_id, vendor_name, sector, tier, country, evaluation_period,
          {rnd('a')} AS avg_delivery_score, {rnd('b')} AS avg_quality_score,
          {rnd('c')} AS avg_commercial_score, {rnd('d')} AS avg_hse_score,
          {rnd('e')} AS avg_overall_score, recommendation AS latest_recommendation,
          evaluation_count,
          {i32('DENSE_RANK() OVER (PARTITION BY evaluation_period ORDER BY e DESC)')}
            AS vendor_rank,
          {rnd('e - LAG(e) OVER (PARTITION BY vendor_id ORDER BY evaluation_period)')}
            AS score_trend
        FROM g JOIN r USING (vendor_id, evaluation_period)""",
    "cube_contract_status": f"""
        SELECT d.contract_id, d.contract_type, d.status, v.vendor_id, vendor_name, p.project_id,
          project_name, d.start_date, d.end_date, d.original_value, d.revised_value, items_total,
          item_count, contract_duration_days, cost_growth_pct, value_utilisation_pct,
          CASE WHEN cost_growth_pct > 20 THEN 'HIGH_COST_RISK' WHEN cost_growth_pct > 10
            THEN 'MEDIUM_COST_RISK' ELSE 'LOW_COST_RISK' END AS cost_risk_flag,
          CASE WHEN d.status = 'ACTIVE' AND d.end_date < {AS_OF} THEN 'OVERDUE'
            WHEN d.status = 'ACTIVE' AND datediff('day', {AS_OF}, d.end_date) < 30
            THEN 'NEAR_EXPIRY' ELSE 'ON_TRACK' END AS schedule_risk_flag,
          d.revised_value - coalesce(items_total, 0) AS remaining_value
        FROM fact_contracts f JOIN dim_contract d ON f.contract_id = d.contract_id
        JOIN dim_vendor v ON f.vendor_id = v.vendor_id
        JOIN dim_project p ON f.project_id = p.project_id""",
    "cube_invoice_aging": f"""
        SELECT f.vendor_id, vendor_name, vendor_sector, f.project_id, project_name,
          {period('invoice_date')}, aging_bucket, COUNT(*) AS invoice_count,
          {msum('net_amount')} AS total_net_amount, {msum('gross_amount')} AS total_gross_amount,
          {msum('tax_amount')} AS total_tax_amount,
          {imean('days_outstanding')} AS avg_days_outstanding,
          MAX(days_outstanding) AS max_days_outstanding,
          {msum("CASE WHEN payment_status = 'OVERDUE' THEN gross_amount ELSE 0 END")}
            AS overdue_amount,
          COUNT(CASE WHEN payment_status = 'OVERDUE' THEN 1 END) AS overdue_count,
          {rnd(div("SUM(CASE WHEN payment_status = 'OVERDUE' THEN gross_amount ELSE 0 END)",
                   'SUM(gross_amount)') + ' * 100')} AS overdue_pct
        FROM fact_invoices f JOIN dim_vendor v ON f.vendor_id = v.vendor_id
        JOIN dim_project p ON f.project_id = p.project_id
        GROUP BY ALL""",
    "cube_project_costs": f"""
        SELECT p.project_id, project_name, status AS project_status, sector, region, priority,
          project_duration_days, {msum('budget_amount')} AS total_budget,
          {msum('actual_amount')} AS total_actual, {msum('committed_amount')} AS total_committed,
          {msum('actual_amount + committed_amount')} AS total_exposure,
          {msum('variance_amount')} AS total_variance, {mmean('variance_pct')} AS avg_variance_pct,
          {rnd(div('SUM(budget_amount)', 'SUM(actual_amount + committed_amount)'), 4)} AS cpi,
          SUM(actual_amount + committed_amount) > SUM(budget_amount) AS is_over_budget,
          {rnd(div('SUM(actual_amount)', 'SUM(budget_amount)') + ' * 100')}
            AS budget_utilisation_pct,
          COUNT(DISTINCT wbs_element) AS wbs_count, COUNT(DISTINCT cost_type) AS cost_type_count
        FROM fact_project_costs f JOIN dim_project p ON f.project_id = p.project_id
        GROUP BY p.project_id, project_name, status, sector, region, priority,
          project_duration_days""",
    "cube_goods_receipt_quality": f"""
        SELECT v.vendor_id, vendor_name, vendor_sector, m.material_id, material_name,
          category AS material_category, COUNT(*) AS receipt_count,
          {qsum('quantity_received')} AS total_qty_received,
          {qsum('quantity_accepted')} AS total_qty_accepted,
          {qsum('quantity_rejected')} AS total_qty_rejected,
          {rnd(mmean('acceptance_rate'), 4)} AS avg_acceptance_rate,
          MIN(acceptance_rate) AS min_acceptance_rate,
          {msum('receipt_value')} AS total_receipt_value,
          {rnd(div('SUM(quantity_rejected)', 'SUM(quantity_received)') + ' * 100')}
            AS defect_rate_pct,
          CASE WHEN {mmean('acceptance_rate')} >= 98 THEN 'EXCELLENT'
            WHEN {mmean('acceptance_rate')} >= 95 THEN 'GOOD'
            WHEN {mmean('acceptance_rate')} >= 90 THEN 'ACCEPTABLE' ELSE 'POOR' END
            AS quality_tier,
          {rnd(f"{dbl('SUM(receipt_value)')} * {dbl('SUM(quantity_rejected)')}"
               f" / NULLIF({dbl('SUM(quantity_received)')}, 0)")} AS estimated_rejection_value
        FROM fact_goods_receipts f JOIN dim_vendor v ON f.vendor_id = v.vendor_id
        JOIN dim_material m ON f.material_id = m.material_id
        GROUP BY v.vendor_id, vendor_name, vendor_sector, m.material_id, material_name, category""",
    "cube_budget_vs_actual": f"""
        SELECT p.project_id, project_name, sector, region, wbs_element, cost_type,
          {msum('budget_amount')} AS budget_amount, {msum('actual_amount')} AS actual_amount,
          {msum('committed_amount')} AS committed_amount,
          {msum('actual_amount + committed_amount')} AS total_exposure,
          {msum('variance_amount')} AS variance_amount,
          {mmean('variance_pct')} AS avg_variance_pct,
          CASE WHEN SUM(variance_amount) > 0 THEN 'UNDER_BUDGET'
            WHEN {dbl('SUM(variance_amount)')} < -{dbl('SUM(budget_amount)')} * 0.10::DOUBLE
            THEN 'CRITICAL_OVERRUN'
            WHEN SUM(variance_amount) < 0 THEN 'OVER_BUDGET' ELSE 'ON_BUDGET' END
            AS variance_class,
          {rnd(div('SUM(budget_amount)', 'SUM(actual_amount + committed_amount)'), 4)} AS cpi,
          {rnd(div('SUM(actual_amount)', 'SUM(budget_amount)') + ' * 100')}
            AS budget_consumed_pct
        FROM fact_project_costs f JOIN dim_project p ON f.project_id = p.project_id
        GROUP BY p.project_id, project_name, sector, region, wbs_element, cost_type""",
    "cube_sales_analysis": f"""
        WITH s AS (SELECT *, {period('order_date')} FROM fact_sales),
        prev AS (
          SELECT *, LAG(q) OVER (PARTITION BY product_name, quarter ORDER BY year) AS p FROM (
            SELECT product_name, year, quarter, {mon('SUM(revenue)')} AS q FROM s GROUP BY ALL)),
        g AS (
          SELECT product_name, customer_name, customer_type, order_type, year, quarter,
            year_month, COUNT(*) AS sales_count, {qsum('quantity')} AS total_quantity,
            {msum('revenue')} AS total_revenue, {msum('cogs')} AS total_cogs,
            {msum('gross_margin')} AS total_margin, {qmean('unit_price')} AS avg_unit_price,
            {rnd(div('SUM(gross_margin)', 'SUM(revenue)') + ' * 100')} AS margin_pct
          FROM s GROUP BY ALL)
        SELECT g.*, q AS product_quarter_revenue, p AS prev_year_revenue,
          {rnd(f"({dbl('q')} - {dbl('p')}) / NULLIF({dbl('p')}, 0) * 100")}
            AS revenue_yoy_growth_pct
        FROM g JOIN prev USING (product_name, year, quarter)""",
    "cube_inventory_status": f"""
        WITH t AS (
          SELECT material_id, movement_type AS k, {period('movement_date')},
            COUNT(*) AS n, SUM(quantity) AS q, SUM(total_value) AS v,
            {rnd(qmean('unit_cost'), 4)} AS u
          FROM fact_inventory GROUP BY ALL)
        SELECT m.material_id, material_name, category AS material_category, year, quarter,
          year_month, {big("SUM(CASE WHEN k = 'RECEIPT' THEN n ELSE 0 END)")} AS receipt_count,
          {big("SUM(CASE WHEN k = 'ISSUE' THEN n ELSE 0 END)")} AS issue_count,
          {big("SUM(CASE WHEN k = 'RETURN' THEN n ELSE 0 END)")} AS return_count,
          {big('SUM(n)')} AS total_movement_count,
          {dbl("SUM(CASE WHEN k = 'RECEIPT' THEN q ELSE 0 END)")} AS qty_received,
          {dbl("SUM(CASE WHEN k = 'ISSUE' THEN q ELSE 0 END)")} AS qty_issued,
          {dbl("SUM(CASE WHEN k = 'RETURN' THEN q ELSE 0 END)")} AS qty_returned,
          {dbl("SUM(CASE WHEN k IN ('RECEIPT', 'RETURN', 'ISSUE') THEN q ELSE 0 END)")}
            AS net_quantity_flow,
          {dbl("SUM(CASE WHEN k = 'RECEIPT' THEN v ELSE 0 END)")} AS receipt_value,
          {dbl("SUM(CASE WHEN k = 'ISSUE' THEN v ELSE 0 END)")} AS issue_value,
          {dbl("SUM(CASE WHEN k = 'RETURN' THEN v ELSE 0 END)")} AS return_value,
          {dbl('SUM(v)')} AS total_movement_value, {qmean('u')} AS avg_unit_cost,
          {rnd(div("abs(SUM(CASE WHEN k = 'ISSUE' THEN q ELSE 0 END))",
                   "SUM(CASE WHEN k = 'RECEIPT' THEN q ELSE 0 END)"))} AS issue_to_receipt_ratio
        FROM t JOIN dim_material m ON t.material_id = m.material_id
        GROUP BY m.material_id, material_name, category, year, quarter, year_month""",
    "cube_spend_by_sector": f"""
        WITH g AS (
          SELECT sector_key, sector_name, v.vendor_id, vendor_name, vendor_country AS country,
            year, quarter, COUNT(*) AS po_count, {mon('SUM(total_amount)')} AS total_spend,
            {qsum('total_quantity')} AS total_quantity, {mmean('total_amount')} AS avg_po_value
          FROM po_dated f JOIN dim_vendor v ON f.vendor_id = v.vendor_id
          JOIN dim_sector ON sector = sector_key GROUP BY ALL),
        s AS (
          SELECT *, DENSE_RANK() OVER (PARTITION BY year, quarter ORDER BY ss DESC) AS rk FROM (
            SELECT sector_key, year, quarter, SUM(total_spend) AS ss FROM g GROUP BY ALL)),
        w AS (
          SELECT *, DENSE_RANK() OVER (PARTITION BY year, quarter ORDER BY total_spend DESC) AS vr,
            LAG(total_spend) OVER (PARTITION BY sector_key, vendor_id, quarter ORDER BY year) AS p
          FROM g)
        SELECT sector_key, sector_name, vendor_id, vendor_name, country, year, quarter, po_count,
          total_spend, total_quantity, avg_po_value,
          {rnd(div('total_spend', 'ss') + ' * 100')} AS vendor_sector_share_pct,
          {i32('rk')} AS sector_spend_rank, {i32('vr')} AS vendor_spend_rank,
          p AS prev_year_spend,
          CASE WHEN p > 0 THEN {rnd(f"({dbl('total_spend')} - {dbl('p')}) / {dbl('p')} * 100")}
            END AS yoy_growth_pct
        FROM w JOIN s USING (sector_key, year, quarter)""",
    "po_last_receipt":
        "SELECT po_id, MAX(receipt_date) AS receipt_date FROM s_goods_receipts GROUP BY 1",
    "cube_project_timeline": f"""
        WITH ps AS (
          SELECT project_id, MIN(posting_date) AS a, MAX(posting_date) AS z,
            {msum('actual_amount')} AS ta, {msum('budget_amount')} AS tb,
            COUNT(DISTINCT wbs_element) AS w FROM fact_project_costs GROUP BY 1),
        pc AS (
          SELECT project_id, COUNT(*) AS n, {big("SUM(CASE WHEN status = 'ACTIVE' THEN 1 ELSE 0 END)")}
            AS na, {big("SUM(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END)")} AS nc,
            {msum('revised_value')} AS tv FROM dim_contract GROUP BY 1)
        SELECT project_id, project_name, status AS project_status, sector, region, priority,
          start_date, end_date, project_duration_days AS planned_duration_days,
          a AS first_spend_date, z AS last_spend_date, {days('z', 'a')} AS actual_active_days,
          CASE WHEN status IN ('COMPLETED', 'CLOSED') THEN {days('z', 'end_date')}
            ELSE {days(AS_OF, 'end_date')} END AS schedule_variance_days,
          CASE WHEN status IN ('COMPLETED', 'CLOSED') AND z <= end_date THEN 'ON_TIME'
            WHEN status IN ('COMPLETED', 'CLOSED') THEN 'DELAYED'
            WHEN end_date < {AS_OF} THEN 'OVERDUE'
            WHEN datediff('day', {AS_OF}, end_date) < 30 THEN 'AT_RISK' ELSE 'ON_TRACK' END
            AS schedule_status,
          {rnd(div(days(f'least({AS_OF}, end_date)', 'start_date'), 'project_duration_days'), 4)}
            AS planned_pct_complete,
          {rnd(div('ta', 'tb'), 4)} AS cost_pct_complete, ta AS total_actual, tb AS total_budget,
          w AS active_wbs_count, n AS contract_count, na AS active_contracts,
          nc AS completed_contracts, tv AS total_contract_value
        FROM dim_project LEFT JOIN ps USING (project_id) LEFT JOIN pc USING (project_id)""",
    "cube_cost_variance": f"""
        WITH g AS (
          SELECT p.project_id, project_name, status AS project_status, sector, region, cost_type,
            wbs_element, {mon('SUM(budget_amount)')} AS b, {mon('SUM(actual_amount)')} AS a,
            {mon('SUM(committed_amount)')} AS c, {mon('SUM(variance_amount)')} AS v
          FROM fact_project_costs f JOIN dim_project p ON f.project_id = p.project_id
          GROUP BY ALL)
        SELECT project_id, project_name, project_status, sector, region, cost_type, wbs_element,
          b AS budget_amount, a AS actual_amount, c AS committed_amount, v AS variance_amount,
          greatest(a + c - b, 0) AS overrun_amount,
          CASE WHEN a + c <= b THEN 'WITHIN_BUDGET'
            WHEN {div('a + c - b', 'b')} <= 0.05::DOUBLE THEN 'MINOR_OVERRUN'
            WHEN {div('a + c - b', 'b')} <= 0.15::DOUBLE THEN 'MODERATE_OVERRUN'
            ELSE 'SEVERE_OVERRUN' END AS overrun_severity,
          {rnd(div('b', 'a + c'), 4)} AS cpi, b - a AS remaining_budget,
          {rnd(div('a', 'b') + ' * 100')} AS burn_rate_pct,
          {i32('DENSE_RANK() OVER (PARTITION BY project_id ORDER BY a + c - b DESC)')}
            AS overrun_rank
        FROM g""",
    "cube_vendor_risk": f"""
        WITH pa AS (
          SELECT vendor_id, {qmean('overall_score')} AS o, {qmean('delivery_score')} AS d,
            {qmean('quality_score')} AS q, {qmean('commercial_score')} AS c,
            {qmean('hse_score')} AS h, MIN(overall_score) AS mo, COUNT(*) AS n
          FROM fact_vendor_performance GROUP BY 1),
        ia AS (
          SELECT vendor_id, COUNT(*) AS ni,
            {big("SUM(CASE WHEN payment_status = 'OVERDUE' THEN 1 ELSE 0 END)")} AS no,
            {imean('days_outstanding')} AS ad, {msum('gross_amount')} AS ti
          FROM fact_invoices GROUP BY 1),
        qa AS (
          SELECT vendor_id, {mmean('acceptance_rate')} AS ar, {qsum('quantity_rejected')} AS tr
          FROM fact_goods_receipts GROUP BY 1),
        j AS (
          SELECT *, coalesce(o, 50) * 0.35::DOUBLE + coalesce(ar, 50) * 0.25::DOUBLE
            + greatest(0, 100 - coalesce(ad, 0)) * 0.20::DOUBLE
            + greatest(0, 100 - coalesce({div('no', 'ni')} * 100, 0)) * 0.20::DOUBLE AS comp
          FROM dim_vendor LEFT JOIN pa USING (vendor_id) LEFT JOIN ia USING (vendor_id)
          LEFT JOIN qa USING (vendor_id))
        SELECT vendor_id, vendor_name, vendor_sector, vendor_country, vendor_city, tier,
          status AS vendor_status, o AS avg_overall_score, d AS avg_delivery_score,
          q AS avg_quality_score, c AS avg_commercial_score, h AS avg_hse_score,
          mo AS min_overall_score, n AS evaluation_count, ni AS invoice_count,
          no AS overdue_invoices, ad AS avg_days_outstanding, ti AS total_invoiced,
          {rnd(div('no', 'ni') + ' * 100')} AS overdue_rate_pct, ar AS avg_acceptance_rate,
          tr AS total_rejected, {rnd('comp')} AS composite_risk_score,
          CASE WHEN comp >= 80 THEN 'LOW_RISK' WHEN comp >= 60 THEN 'MEDIUM_RISK'
            ELSE 'HIGH_RISK' END AS risk_tier,
          {i32('DENSE_RANK() OVER (ORDER BY comp DESC)')} AS risk_rank
        FROM j""",
    "cube_procurement_efficiency": f"""
        WITH iv AS (SELECT po_id, MAX(invoice_date) AS iv, MAX(payment_date) AS pd
                    FROM fact_invoices GROUP BY 1),
        p AS (
          SELECT f.*, {days('receipt_date', 'po_date')} AS a, {days('iv', 'receipt_date')} AS b,
            {days('pd', 'iv')} AS c, {days('pd', 'po_date')} AS d
          FROM po_dated f LEFT JOIN po_last_receipt USING (po_id) LEFT JOIN iv USING (po_id)),
        qv AS (
          SELECT *, LAG(m) OVER (PARTITION BY vendor_id ORDER BY year, quarter) AS pm FROM (
            SELECT vendor_id, year, quarter, {imean('d')} AS m FROM p GROUP BY ALL)),
        g AS (
          SELECT p.vendor_id, vendor_name, vendor_sector, year, quarter, year_month,
            COUNT(*) AS po_count, {imean('a')} AS avg_order_to_receipt_days,
            quantile_cont(a, 0.5) AS median_order_to_receipt,
            {imean('b')} AS avg_receipt_to_invoice_days,
            quantile_cont(b, 0.5) AS median_receipt_to_invoice,
            {imean('c')} AS avg_invoice_to_payment_days,
            quantile_cont(c, 0.5) AS median_invoice_to_payment,
            {imean('d')} AS avg_total_p2p_days, quantile_cont(d, 0.5) AS median_total_p2p,
            MIN(d) AS min_p2p_days, MAX(d) AS max_p2p_days,
            {msum('total_amount')} AS total_spend,
            {rnd(div('COUNT(d)', 'COUNT(*)') + ' * 100')} AS complete_p2p_pct
          FROM p JOIN dim_vendor v ON p.vendor_id = v.vendor_id GROUP BY ALL)
        SELECT g.*, m AS quarter_avg_p2p_days, pm AS prev_quarter_avg_p2p_days
        FROM g JOIN qv USING (vendor_id, year, quarter)""",
}


def delivery_cube(receipts: str) -> str:
    """Delivery performance over one or many receipt rows per order."""
    return f"""
        WITH p AS (
          SELECT f.vendor_id, year, quarter, year_month, total_amount,
            {days('r.receipt_date', 'expected_delivery_date')} AS d
          FROM po_dated f JOIN {receipts} r ON f.po_id = r.po_id),
        qv AS (
          SELECT *, LAG(m) OVER (PARTITION BY vendor_id ORDER BY year, quarter) AS pm FROM (
            SELECT vendor_id, year, quarter,
              {rnd(div('COUNT(CASE WHEN d <= 0 THEN 1 END)', 'COUNT(*)') + ' * 100')} AS m
            FROM p GROUP BY ALL)),
        g AS (
          SELECT p.vendor_id, vendor_name, vendor_sector, year, quarter, year_month,
            COUNT(*) AS delivery_count, {imean('d')} AS avg_variance_days,
            MAX(d) AS max_variance_days, MIN(d) AS min_variance_days,
            {rnd(div('COUNT(CASE WHEN d <= 0 THEN 1 END)', 'COUNT(*)') + ' * 100')}
              AS on_time_rate_pct,
            COUNT(CASE WHEN d <= 0 THEN 1 END) AS on_time_count,
            COUNT(CASE WHEN d > 0 AND d <= 7 THEN 1 END) AS late_1wk_count,
            COUNT(CASE WHEN d > 7 AND d <= 30 THEN 1 END) AS late_1mo_count,
            COUNT(CASE WHEN d > 30 THEN 1 END) AS late_over_mo_count,
            {msum('total_amount')} AS total_value_delivered
          FROM p JOIN dim_vendor v ON p.vendor_id = v.vendor_id GROUP BY ALL)
        SELECT g.*, m AS quarter_on_time_pct, pm AS prev_quarter_on_time_pct
        FROM g JOIN qv USING (vendor_id, year, quarter)"""


FRAGMENTS["cube_delivery_performance"] = delivery_cube("po_last_receipt")
FRAGMENTS["cube_delivery_per_receipt"] = delivery_cube("fact_goods_receipts")

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Fragments a statement uses, each after the ones it depends on."""
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in FRAGMENTS and word not in seen:
            _needed(FRAGMENTS[word], seen)
            seen.append(word)
    return seen


def statement(sql: str) -> str:
    """A complete statement: the needed fragments in front of the query."""
    parts = [f"{name} AS ({FRAGMENTS[name]})" for name in _needed(sql, [])]
    if not parts:
        return sql
    query = f"SELECT * FROM ({sql})" if sql.lstrip().startswith("WITH") else sql
    return f"WITH {', '.join(parts)} {query}"


# Decimal columns of each result, which leave as doubles.
DECIMALS: dict[str, str] = {
    "s_vendors": "credit_limit_usd annual_turnover_usd",
    "s_projects": "contract_value_usd approved_budget_usd",
    "s_materials": "unit_price",
    "s_employees": "approval_limit",
    "s_purchase_orders": "po_value tax_amount total_value",
    "s_po_line_items": "qty_ordered qty_received qty_accepted unit_price line_value",
    "s_contracts": "contract_value original_value revised_value",
    "s_contract_items": "quantity unit_price line_value",
    "s_invoices": "gross_amount tax_amount retention_amount net_amount paid_amount invoice_amount "
    "total_amount",
    "s_goods_receipts": "qty_delivered qty_accepted qty_rejected qty_received",
    "s_project_budgets": "original_amount revised_amount committed_amount actual_spent "
    "budget_amount original_budget spent_amount remaining_amount",
    "s_project_actuals": "actual_amount budget_amount variance amount",
    "s_sales_orders": "quantity unit_price revenue cogs gross_margin tax_amount total_amount "
    "order_value total_value",
    "s_inventory": "quantity unit_cost total_value total_cost",
    "dim_vendor": "credit_limit_usd annual_turnover_usd",
    "dim_project": "contract_value_usd approved_budget_usd",
    "dim_material": "unit_price",
    "dim_employee": "approval_limit",
    "dim_contract": "contract_value original_value revised_value change_order_value",
    "fact_purchase_orders": "po_value tax_amount total_value total_amount",
    "fact_invoices": "invoice_amount net_amount tax_amount total_amount gross_amount paid_amount "
    "retention_amount",
    "fact_goods_receipts": "quantity_received quantity_accepted quantity_rejected receipt_value",
    "fact_project_costs": "budget_amount original_budget committed_amount actual_amount "
    "remaining_amount variance_amount",
    "fact_project_actuals": "actual_amount budget_amount variance overrun",
    "fact_inventory": "quantity unit_cost total_value",
    "fact_contracts": "contract_value revised_value change_order_value items_total",
    "fact_sales": "quantity unit_price revenue cogs gross_margin tax_amount total_amount",
    "cube_procurement_spend": "vendor_quarter_spend prev_year_spend",
    "cube_contract_status": "original_value revised_value items_total remaining_value",
    "cube_sales_analysis": "product_quarter_revenue prev_year_revenue",
    "cube_spend_by_sector": "total_spend prev_year_spend",
    "cube_cost_variance": "budget_amount actual_amount committed_amount variance_amount "
    "overrun_amount remaining_budget",
}


def whole(fragment: str) -> str:
    """All rows of a fragment, with its decimals as doubles."""
    casts = ", ".join(f"{dbl(c)} AS {c}" for c in DECIMALS.get(fragment, "").split())
    return statement(f"SELECT *{f' REPLACE ({casts})' if casts else ''} FROM {fragment}")


def layer_statements() -> dict[str, str]:
    out = {}
    for name in FRAGMENTS:
        if name.startswith("s_"):
            out["silver_" + name[2:]] = whole(name)
        elif name.startswith(("dim_", "fact_", "cube_")):
            out[name] = whole(name)
    return out
