"""Adapter: the order/line/part/supplier star schema as the fifteen source feeds.

Each function derives one raw feed, with the raw feed's column names and some of its dirt (padded
and lower-case codes, missing vendors), so the whole chain raw -> cleansed -> star -> cube can run
on these tables.  Keys keep their native integer type; the jobs do not depend on the key type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c

# One country per nation key 0..24, as a mix of codes, names and unmapped places.
NATION_COUNTRIES = (
    "us", "ca", "mx", "gb", "de", "fr", "it", "es", "nl", "ae", "sa", "qa", "kw", "au", "in",
    "jp", "uae", "saudi arabia", "usa", "uk", "south korea", "br", "za", "ng", "eg",
)


class Star:
    """Lazy access to the parquet tables of one folder; each is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def lines(self) -> DataFrame:
        return self.table("lineitem")

    def orders(self) -> DataFrame:
        return self.table("orders")

    def lines_with_orders(self) -> DataFrame:
        return self.lines().join(self.orders(), F.col("l_orderkey") == F.col("o_orderkey"))

    def places(self) -> DataFrame:
        """Nation with region; at most a few hundred rows."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "n_regionkey", "r_name", country_of("n_nationkey")
        )


def country_of(nationkey: str) -> Column:
    names = F.array(*[F.lit(c) for c in NATION_COUNTRIES])
    return F.element_at(names, F.col(nationkey) + 1).alias("country_text")


def line_key() -> Column:
    """Order, line number, part and supplier: the line number alone is not unique in an order."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def padded(c: Column) -> Column:
    return F.concat(F.lit("  "), c, F.lit(" "))


def choose(key: Column, *labels: str | None) -> Column:
    """Spread labels over the remainders of an integer key."""
    out = F.lit(labels[-1])
    for i in range(len(labels) - 2, -1, -1):
        out = F.when(key % len(labels) == i, F.lit(labels[i])).otherwise(out)
    return out


def relabel(c: Column, **labels: str) -> Column:
    out = F.lit(None).cast("string")
    for value, label in labels.items():
        out = F.when(c == value, F.lit(label)).otherwise(out)
    return out


def shipped() -> Column:
    return F.col("l_shipdate").cast("date")


def ordered() -> Column:
    return F.col("o_orderdate").cast("date")


def line_unit_price() -> Column:
    return F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double")


def line_tax() -> Column:
    return F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("double")


def rejected_quantity() -> Column:
    return F.when(
        F.col("l_returnflag") == "R", F.floor(F.col("l_quantity") * F.col("l_discount"))
    ).otherwise(F.lit(0)).cast("double")


# ---- master data -------------------------------------------------------------------------------


def vendors(star: Star) -> DataFrame:
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    joined = star.table("supplier").join(
        star.places(), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        key.alias("vendor_id"),
        F.col("s_name").alias("vendor_code"),
        padded(F.col("s_name")).alias("vendor_name"),
        choose(key, "MANUFACTURER", "SUPPLIER", "CONSULTANT").alias("vendor_type"),
        padded(F.lower("r_name")).alias("sector_specialization"),
        padded(F.col("country_text")).alias("country"),
        F.lower("r_name").alias("state"),
        padded(F.col("n_name")).alias("city"),
        ((key % 3) * 15 + 30).cast("int").alias("payment_terms_days"),
        (F.abs(balance) * 10).alias("credit_limit_usd"),
        (balance / 2000).alias("performance_rating"),
        F.when(balance < 1000, "BLACKLISTED")
        .when(balance < 4000, "HIGH")
        .when(balance < 7000, "MEDIUM")
        .otherwise("LOW")
        .alias("risk_category"),
        choose(key, "expired", "pending", "approved", "Approved").alias("prequalification_status"),
        F.lit("2001-12-31").cast("date").alias("prequalification_expiry_date"),
        (key % 2 == 0).alias("iso_certified"),
        F.lit(4.0).alias("hse_rating"),
        (key % 5 == 0).alias("minority_owned"),
        (key % 7 == 0).alias("small_business"),
        F.col("s_name").alias("contact_name"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("contact_email"),
        F.lit(None).cast("string").alias("contact_phone"),
        (balance * 1000).alias("annual_turnover_usd"),
        (key % 40).cast("int").alias("years_in_business"),
    )


def projects(star: Star) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    span = star.orders().groupBy("o_custkey").agg(
        F.min(ordered()).alias("start_date"), F.max(ordered()).alias("last_date")
    )
    joined = (
        star.table("customer")
        .join(star.places(), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(span, key == F.col("o_custkey"), "left")
    )
    return joined.select(
        key.alias("project_id"),
        F.col("c_name").alias("project_code"),
        padded(F.col("c_name")).alias("project_name"),
        choose(key, "BUILDING", "HIGHWAY", "REFINERY", "PIPELINE").alias("project_type"),
        padded(F.lower("c_mktsegment")).alias("sector"),
        F.col("c_name").alias("client_name"),
        F.concat(F.lit("EMP-"), key.cast("string")).alias("project_manager"),
        padded(F.col("country_text")).alias("country"),
        F.upper("r_name").alias("state"),
        F.col("n_name").alias("city"),
        (F.abs(balance) * 110).alias("contract_value_usd"),
        (balance * 100).alias("approved_budget_usd"),
        choose(key, "ACTIVE", "COMPLETED", "PLANNING", "CLOSED", "ACTIVE").alias("project_status"),
        "start_date",
        F.col("last_date").alias("planned_completion_date"),
        F.when(key % 5 == 1, F.date_add("last_date", 10)).alias("actual_completion_date"),
        choose(key, "HIGH", "MEDIUM", "LOW").alias("priority"),
        choose(key, "LOW", "HIGH", "MEDIUM", "LOW").alias("risk_level"),
    )


def materials(star: Star) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return star.table("part").select(
        key.alias("material_id"),
        F.concat(F.lit("MAT-"), key.cast("string")).alias("material_code"),
        padded(F.col("p_name")).alias("material_name"),
        choose(key, "PRODUCT", "ITEM", "ITEM").alias("material_level"),
        F.when(key % 3 != 0, key - key % 3).alias("parent_material_id"),
        padded(F.lower("p_type")).alias("category"),
        padded(F.col("p_brand")).alias("sub_category"),
        F.col("p_retailprice").alias("unit_price"),
        size.alias("lead_time_days"),
        (size * 1.5).alias("weight_kg"),
        (size * 5).alias("reorder_point"),
        (size * 20).alias("max_stock_level"),
        F.when(size > 5, F.lit("true")).otherwise(F.lit("FALSE")).alias("active"),
    )


def employees(star: Star) -> DataFrame:
    key = F.col("c_custkey")
    return star.table("customer").select(
        key.alias("employee_id"),
        F.concat(F.lit("EMP-"), key.cast("string")).alias("employee_code"),
        F.concat(F.lit(" "), F.substring("c_name", 1, 8), F.lit(" ")).alias("first_name"),
        F.concat(F.lit(" "), F.substring("c_name", 10, 9)).alias("last_name"),
        padded(F.lower("c_mktsegment")).alias("department"),
        choose(key, "Manager", "Engineer", "Analyst").alias("job_title"),
        F.concat(F.lit("L"), (key % 6 + 1).cast("string")).alias("grade"),
        F.when(key % 6 != 5, F.abs(F.col("c_acctbal")) * 10).alias("approval_limit"),
        F.date_add(F.lit("1990-01-01").cast("date"), (key % 3000).cast("int")).alias("hire_date"),
        F.when(key % 4 == 0, F.lit("false")).otherwise(F.lit("TRUE")).alias("active"),
        F.lit("Houston").alias("location"),
        F.concat(F.lit("CC-"), F.substring("c_mktsegment", 1, 4)).alias("cost_center"),
    )


# ---- purchasing --------------------------------------------------------------------------------


def order_vendor(star: Star) -> DataFrame:
    """The vendor of an order: the smallest supplier key on its lines."""
    return star.lines().groupBy("l_orderkey").agg(F.min("l_suppkey").alias("vendor_id"))


def purchase_orders(star: Star) -> DataFrame:
    total, status, rank = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    joined = star.orders().join(
        order_vendor(star), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    tax = F.floor(total / 20).cast("double")
    return joined.select(
        F.col("o_orderkey").alias("po_id"),
        "vendor_id",
        F.col("o_custkey").alias("project_id"),
        ordered().alias("po_date"),
        F.date_add(ordered(), 30).alias("delivery_date"),
        F.date_sub(ordered(), (F.col("o_orderkey") % 20).cast("int")).alias("approval_date"),
        total.alias("po_value"),
        tax.alias("tax_amount"),
        c.settled(total + tax).alias("total_value"),
        padded(relabel(status, F="approved", O="open", P="pending")).alias("po_status"),
        F.when(rank == "1-URGENT", "EMERGENCY")
        .when(rank == "5-LOW", "BLANKET")
        .otherwise("STANDARD")
        .alias("po_type"),
        F.when((rank == "1-URGENT") & (status != "P"), "CRITICAL")
        .when(rank.isin("1-URGENT", "2-HIGH"), "HIGH")
        .otherwise("NORMAL")
        .alias("priority"),
        F.lit("USD").alias("currency"),
        relabel(status, F="30", O="60", P="90").alias("payment_terms"),
    )


def po_line_items(star: Star) -> DataFrame:
    qty = F.col("l_quantity")
    received = F.when(F.col("l_linestatus") == "F", qty).otherwise(F.floor(qty * 0.5)).cast("double")
    return star.lines().select(
        line_key().alias("line_id"),
        F.col("l_orderkey").alias("po_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("material_id"),
        F.col("l_suppkey").alias("vendor_id"),
        qty.alias("qty_ordered"),
        received.alias("qty_received"),
        F.floor(received * (1 - F.col("l_discount"))).cast("double").alias("qty_accepted"),
        line_unit_price().alias("unit_price"),
        F.col("l_extendedprice").alias("line_value"),
        shipped().alias("delivery_date"),
        F.when(F.col("l_linestatus") == "F", F.date_add(shipped(), 3)).alias(
            "actual_delivery_date"
        ),
    )


def contracts(star: Star) -> DataFrame:
    key, total, status = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    joined = star.orders().join(order_vendor(star), key == F.col("l_orderkey"), "left")
    return joined.select(
        key.alias("contract_id"),
        padded(relabel(status, F="fixed_price", O="cost_plus", P="time_materials")).alias(
            "contract_type"
        ),
        padded(relabel(status, F="completed", O="active", P="pending")).alias("contract_status"),
        "vendor_id",
        F.col("o_custkey").alias("project_id"),
        F.concat(F.lit("EMP-"), (key % 100).cast("string")).alias("contract_manager_id"),
        total.alias("original_value"),
        c.settled(total + (key % 5) * 10000).alias("revised_value"),
        (key % 5).cast("int").alias("variation_orders"),
        F.lit("USD").alias("currency"),
        ordered().alias("start_date"),
        F.date_add(ordered(), 365).alias("end_date"),
        F.lit(10.0).alias("retention_pct"),
        F.lit(5.0).alias("performance_bond_pct"),
        F.lit(2.0).alias("liquidated_damages_pct"),
        F.lit("NET30").alias("payment_terms"),
    )


def contract_items(star: Star) -> DataFrame:
    return star.lines().select(
        line_key().alias("item_id"),
        F.col("l_orderkey").alias("contract_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("material_id"),
        F.col("l_quantity").alias("quantity"),
        line_unit_price().alias("unit_rate"),
        F.col("l_extendedprice").alias("amount"),
        (F.col("l_returnflag") == "R").alias("milestone_flag"),
    )


def goods_receipts(star: Star) -> DataFrame:
    """Receipts carry no project of their own; the fact takes it from the order."""
    return star.lines().select(
        line_key().alias("grn_id"),
        F.col("l_orderkey").alias("po_id"),
        line_key().alias("line_item_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.lit(None).cast("long").alias("project_id"),
        F.col("l_partkey").alias("material_id"),
        shipped().alias("receipt_date"),
        F.col("l_quantity").alias("qty_delivered"),
        (F.col("l_quantity") - rejected_quantity()).alias("qty_accepted"),
        rejected_quantity().alias("qty_rejected"),
        padded(relabel(F.col("l_returnflag"), N="received", A="accepted", R="rejected")).alias(
            "grn_status"
        ),
        padded(F.lit("WH-1")).alias("storage_location"),
        F.lit("inspector").alias("received_by"),
    )


def invoices(star: Star) -> DataFrame:
    gross = F.col("l_extendedprice")
    paid = F.col("l_linestatus") == "F"
    return star.lines_with_orders().select(
        line_key().alias("invoice_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_orderkey").alias("po_id"),
        F.col("l_orderkey").alias("contract_id"),
        F.col("o_custkey").alias("project_id"),
        relabel(F.col("l_returnflag"), N="standard", A="milestone", R="credit").alias(
            "invoice_type"
        ),
        padded(relabel(F.col("l_linestatus"), F="paid", O="approved")).alias("invoice_status"),
        shipped().alias("invoice_date"),
        F.date_add(shipped(), 30).alias("due_date"),
        gross.alias("gross_amount"),
        F.col("l_tax").alias("tax_rate"),
        line_tax().alias("tax_amount"),
        F.lit(0.0).alias("retention_amount"),
        c.settled(gross - line_tax()).alias("net_amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("l_discount") > 0.05, F.floor(gross * F.col("l_discount")))
        .otherwise(F.lit(0))
        .cast("double")
        .alias("early_payment_discount"),
        F.when(paid, F.date_add(shipped(), F.col("l_quantity").cast("int"))).alias("paid_date"),
        F.when(paid, gross).otherwise(F.lit(0.0)).alias("paid_amount"),
        F.lit("EMP-1").alias("approved_by"),
        line_key().alias("invoice_ref"),
        F.lit(None).cast("string").alias("description"),
    )


# ---- project control ---------------------------------------------------------------------------


def project_budgets(star: Star) -> DataFrame:
    total = F.sum(F.rint(F.col("o_totalprice") * 100).cast("long")) / 100
    lots = star.orders().groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(
        total.alias("total"), F.min(ordered()).alias("first"), F.max(ordered()).alias("last")
    )
    return lots.select(
        F.concat_ws("-", "o_custkey", "o_orderstatus", "o_orderpriority").alias("budget_id"),
        F.col("o_custkey").alias("project_id"),
        padded(F.col("o_orderstatus")).alias("wbs_code"),
        padded(F.lower("o_orderpriority")).alias("cost_type"),
        relabel(F.col("o_orderstatus"), F="ORIGINAL", O="REVISED", P="FORECAST").alias(
            "budget_version"
        ),
        padded(relabel(F.col("o_orderstatus"), F="approved", O="draft", P="submitted")).alias(
            "budget_status"
        ),
        F.col("total").alias("original_amount"),
        F.col("total").alias("revised_amount"),
        F.when(F.col("o_orderstatus") == "P", 0.2).otherwise(0.1).alias("contingency_pct"),
        F.floor(F.col("total") / 10).cast("double").alias("committed_amount"),
        F.floor(F.col("total") / 2).cast("double").alias("actual_spent"),
        F.col("first").cast("string").alias("period_start"),
        F.col("last").cast("string").alias("period_end"),
    )


def project_actuals(star: Star) -> DataFrame:
    amount = F.col("l_extendedprice")
    budget = F.floor(amount * (1 - F.col("l_discount"))).cast("double")
    return star.lines_with_orders().select(
        line_key().alias("transaction_id"),
        F.col("o_custkey").alias("project_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_orderkey").alias("po_id"),
        F.col("l_orderkey").alias("contract_id"),
        F.when(F.col("l_returnflag") != "A", line_key()).alias("invoice_id"),
        padded(F.col("o_orderstatus")).alias("wbs_code"),
        padded(F.lower("o_orderpriority")).alias("cost_type"),
        padded(relabel(F.col("l_linestatus"), F="posted", O="draft")).alias("cost_status"),
        shipped().alias("transaction_date"),
        shipped().alias("posting_date"),
        amount.alias("actual_amount"),
        budget.alias("budget_amount"),
        c.settled(amount - budget).alias("variance"),
        F.concat(F.lit(" "), F.date_format(shipped(), "yyyyMM")).alias("fiscal_period"),
    )


# ---- sales, stock, scores ----------------------------------------------------------------------


def sales_orders(star: Star) -> DataFrame:
    revenue, kind = F.col("l_extendedprice"), F.col("l_returnflag")
    cogs = F.floor(revenue * (1 - F.col("l_discount")) * 0.5).cast("double")
    joined = star.lines_with_orders().join(
        star.table("customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        line_key().alias("sales_order_id"),
        F.col("o_custkey").alias("project_id"),
        F.col("l_partkey").alias("material_id"),
        padded(relabel(kind, N="standard", A="urgent", R="blanket")).alias("order_type"),
        padded(relabel(F.col("o_orderstatus"), F="completed", O="pending", P="cancelled")).alias(
            "order_status"
        ),
        padded(relabel(F.col("l_linestatus"), F="paid", O="unbilled")).alias("payment_status"),
        padded(F.col("c_name")).alias("customer_name"),
        padded(F.lower("c_mktsegment")).alias("customer_type"),
        ordered().alias("order_date"),
        shipped().alias("delivery_date"),
        F.col("l_quantity").alias("quantity"),
        line_unit_price().alias("unit_price"),
        revenue.alias("revenue"),
        cogs.alias("cogs"),
        c.settled(revenue - cogs).alias("gross_margin"),
        F.floor((revenue - cogs) / revenue * 100).cast("double").alias("margin_pct"),
        line_tax().alias("tax_amount"),
        c.settled(revenue + line_tax()).alias("total_amount"),
        F.lit("USD").alias("currency"),
        F.lit("EXW").alias("delivery_terms"),
    )


def inventory(star: Star) -> DataFrame:
    kind, qty = F.col("l_returnflag"), F.col("l_quantity")
    return star.lines().select(
        line_key().alias("movement_id"),
        F.col("l_partkey").alias("material_id"),
        line_key().alias("grn_id"),
        padded(relabel(kind, N="receipt", A="issue", R="return")).alias("movement_type"),
        F.when(kind == "A", -qty).otherwise(qty).alias("quantity"),
        line_unit_price().alias("unit_cost"),
        F.col("l_extendedprice").alias("total_value"),
        padded(F.lit("SUPPLIER")).alias("from_location"),
        padded(F.lit("WH-1")).alias("to_location"),
        F.lit("B-1").alias("batch_number"),
        padded(F.lit("each")).alias("unit_of_measure"),
        padded(F.lit("grn")).alias("reason_code"),
        shipped().alias("movement_date"),
        F.lit("EMP-1").alias("posted_by"),
    )


def vendor_performance(star: Star) -> DataFrame:
    """One evaluation per event; errors above 150 have lost their vendor."""
    kind = F.col("event_type")
    base = F.least(F.col("value"), F.lit(100.0))
    boost = F.when(kind == "purchase", 20.0).when(kind == "signup", 10.0).otherwise(0.0)
    delivery = base
    quality = F.greatest(F.lit(0.0), 100.0 - base)
    commercial = F.least(F.lit(100.0), base + boost)
    hse = F.when(kind == "error", 30.0).otherwise(90.0)
    composite = F.floor(delivery * 0.3 + quality * 0.3 + commercial * 0.2 + hse * 0.2)
    score = F.col("composite_score")
    return star.table("events").select(
        F.col("event_id").alias("performance_id"),
        F.when((kind == "error") & (F.col("value") > 150), F.lit(None))
        .otherwise(F.col("user_id") % 10)
        .alias("vendor_id"),
        F.col("user_id").alias("project_id"),
        F.concat(F.lit(" "), F.date_format("ts", "yyyyMMdd"), F.lit("-d")).alias(
            "evaluation_period"
        ),
        F.col("ts").cast("date").alias("evaluation_date"),
        delivery.alias("delivery_score"),
        quality.alias("quality_score"),
        commercial.alias("commercial_score"),
        hse.alias("hse_score"),
        composite.cast("double").alias("composite_score"),
        kind.alias("evaluator_id"),
        F.col("props").alias("remarks"),
    ).withColumn(
        "recommendation",
        F.when(score >= 80, " PREFERRED")
        .when(score >= 60, "APPROVED ")
        .when(score >= 40, "CONDITIONAL")
        .otherwise("DELIST"),
    )


FEEDS: dict[str, Callable[[Star], DataFrame]] = {
    "vendors": vendors,
    "projects": projects,
    "materials": materials,
    "employees": employees,
    "purchase_orders": purchase_orders,
    "po_line_items": po_line_items,
    "contracts": contracts,
    "contract_items": contract_items,
    "invoices": invoices,
    "goods_receipts": goods_receipts,
    "project_budgets": project_budgets,
    "project_actuals": project_actuals,
    "sales_orders": sales_orders,
    "inventory": inventory,
    "vendor_performance": vendor_performance,
}


# ---- sample sales table ------------------------------------------------------------------------


def sales(star: Star) -> DataFrame:
    """The flat sales table of the sample reports: city = nation, country = region."""
    price = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100
    joined = (
        star.lines_with_orders()
        .join(star.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(star.places(), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("c_name", 1, 8).alias("first_name"),
        F.substring("c_name", 10, 9).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        ordered().alias("order_date"),
    )


# ---- commerce tables ---------------------------------------------------------------------------


def commerce(star: Star) -> dict[str, DataFrame]:
    """Products, sales, purchases, payments and course offerings derived from the star."""
    lines, orders = star.lines(), star.orders()
    customer, supplier = star.table("customer"), star.table("supplier")
    purchase_id = F.col("l_suppkey") * 100000 + F.unix_date(shipped())
    item = [
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        line_unit_price().cast("decimal(18,2)").alias("unit_price"),
    ]
    return {
        "product": star.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_brand").alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
            F.col("p_size").alias("stock_quantity"),
            (F.col("p_size") > 5).alias("is_active"),
        ),
        "customer": customer.select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
        ),
        "supplier": supplier.select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.lit(None).cast("string").alias("address"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        ),
        "sale": orders.select(
            F.col("o_orderkey").alias("id"),
            ordered().alias("date"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
            relabel(F.col("o_orderstatus"), F="Completed", O="Pending", P="Cancelled").alias(
                "status"
            ),
            F.col("o_orderpriority").alias("notes"),
        ),
        "sale_item": lines.select(
            line_key().alias("id"), F.col("l_orderkey").alias("sale_id"), *item
        ),
        # A purchase is what one supplier delivers on one day.
        "purchase": lines.groupBy("l_suppkey", shipped().alias("date")).agg(
            F.sum(line_unit_price().cast("decimal(18,2)") * F.col("l_quantity").cast("int"))
            .cast("decimal(18,2)")
            .alias("total")
        ).select(
            (F.col("l_suppkey") * 100000 + F.unix_date("date")).alias("id"),
            "date",
            F.col("l_suppkey").alias("supplier_id"),
            "total",
            F.lit("Received").alias("status"),
            F.lit(None).cast("string").alias("notes"),
        ),
        "purchase_item": lines.select(
            line_key().alias("id"), purchase_id.alias("purchase_id"), *item
        ),
        "payment": lines.select(
            line_key().alias("id"),
            shipped().alias("date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.when(F.col("l_returnflag") == "R", "Outgoing").otherwise("Incoming").alias(
                "direction"
            ),
            F.col("l_orderkey").alias("reference_id"),
            F.when(F.col("l_returnflag") == "R", "Purchase").otherwise("Sale").alias(
                "reference_type"
            ),
            F.lit(None).cast("string").alias("notes"),
        ),
        "class": star.table("region").select(
            F.col("r_regionkey").alias("id"),
            F.col("r_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
            F.lit(True).alias("is_active"),
        ),
        "subject": star.table("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
            F.lit(True).alias("is_active"),
        ),
        "section": customer.groupBy(F.col("c_mktsegment").alias("name"))
        .agg(F.count(F.lit(1)).cast("int").alias("capacity"))
        .select(
            F.ascii(F.substring("name", 1, 1)).alias("id"),
            "name",
            "capacity",
            F.lit(True).alias("is_active"),
        ),
        "timeline": orders.groupBy(F.year(ordered()).alias("id")).agg(
            F.min(ordered()).alias("start_date"), F.max(ordered()).alias("end_date")
        ).select(
            "id",
            F.concat(F.lit("Year "), F.col("id").cast("string")).alias("name"),
            "start_date",
            "end_date",
            F.lit(True).alias("is_active"),
        ),
        "class_offering": orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(star.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("n_regionkey").alias("class_id"),
            F.col("n_nationkey").alias("subject_id"),
            F.ascii(F.substring("c_mktsegment", 1, 1)).alias("section_id"),
            F.year(ordered()).alias("timeline_id"),
            F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") % 20).cast("string")).alias(
                "instructor_id"
            ),
        ),
        "app_user": supplier.select(
            F.col("s_suppkey").cast("string").alias("id"),
            F.col("s_name").alias("full_name"),
            F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"),
            (F.col("s_acctbal") < 0).alias("is_deleted"),
        ),
    }
