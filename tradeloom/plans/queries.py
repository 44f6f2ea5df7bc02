"""Registry: one query per job, over the star schema's parquet folder.

Each entry takes the session and the folder.  Results carry no load time, and decimals leave as
doubles, so that they compare with other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c
from ..operators import (
    commerce,
    cubes,
    digest,
    dims,
    edits,
    hierarchy,
    history,
    insights,
    integrity,
    ledger,
    measures,
    quality,
    reports,
    sales_reports,
    silver,
)
from ..session import fresh_path, tidy
from ..sources import ingest, rewrite, star as star_schema, tables
from ..sources.schemas import KEYS, SOURCES
from ..sources.star import FEEDS, Star
from ..streaming import jobs as streams, merge, observed, propagate, versions
from .layers import CUBES, GOLD, STAR_CONTRACT, STAR_REFERENCES, Layers
from .oracle_jobs import BACKED_UP

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "1998-09-30"
CALENDAR = ("1992-01-01", "2004-12-31")


def presentable(df: DataFrame) -> DataFrame:
    """Drop load times and turn decimals into doubles."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            continue
        column = F.col(f"`{field.name}`")
        decimal = isinstance(field.dataType, T.DecimalType)
        out.append(column.cast("double").alias(field.name) if decimal else column)
    return df.select(*out)


def layers(spark: SparkSession, folder: str) -> Layers:
    star = Star(spark, folder)
    return Layers(spark, lambda table: FEEDS[table](star), as_of=AS_OF, calendar=CALENDAR)


def on_layers(job: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: presentable(job(layers(spark, folder)))


def on_star(job: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: presentable(job(Star(spark, folder)))


def table_of(l: Layers) -> Callable[[str], DataFrame]:
    """Star schema tables and cubes by one name."""
    return lambda name: l.cube(name) if name in CUBES else l.gold(name)


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---- layers ------------------------------------------------------------------------------------


def layer_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for table in silver.JOBS:
        out[f"silver_{table}"] = on_layers(lambda l, t=table: l.silver(t))
    for table in GOLD:
        out[table] = on_layers(lambda l, t=table: l.gold(t))
    out["dim_date"] = on_star(lambda s: dims.dim_date_covering(s.orders(), "o_orderdate"))
    for name in CUBES:
        out[name] = on_layers(lambda l, n=name: l.cube(n))
    out["cube_delivery_per_receipt"] = on_layers(
        lambda l: cubes.cube_delivery_performance(
            l.gold("fact_purchase_orders"), l.gold("fact_goods_receipts"), l.gold("dim_vendor"),
            per_receipt=True,
        )
    )
    return out


# ---- ingestion ---------------------------------------------------------------------------------

_CSV_COLUMNS = (
    "po_id po_type po_status priority vendor_id project_id po_date delivery_date approval_date "
    "po_value tax_amount total_value currency payment_terms"
).split()


def _orders_csv(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "purchase_orders_csv")
    ingest.write_csv(star_schema.purchase_orders(Star(spark, folder)), path, "purchase_orders")
    return path


def _ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_csv(spark, folder)
    return presentable(ingest.ingest_csv(spark, path, "purchase_orders").select(*_CSV_COLUMNS))


def _incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_csv(spark, folder)
    raw = streams.incremental_ingest(
        spark, path, "purchase_orders", fresh_path(spark, "raw"), fresh_path(spark, "state"),
        "batch-1",
    )
    return presentable(raw.select(*_CSV_COLUMNS, "_batch_id"))


def _corrupt_row_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Pending orders are written with a date that is no date."""
    rows = star_schema.purchase_orders(Star(spark, folder))
    damaged = rows.withColumn(
        "po_date",
        F.when(F.trim("po_status") == "pending", F.lit("soon")).otherwise(
            F.col("po_date").cast("string")
        ),
    )
    path = fresh_path(spark, "damaged_csv")
    ingest.write_csv(damaged, path, "purchase_orders")
    good, bad = ingest.corrupt_row_gate(spark, path, "purchase_orders")
    reasons = bad.select(
        F.lit("rejected").alias("verdict"),
        F.split(ingest.CORRUPT, ",").getItem(3).alias("priority"),
    )
    kept = good.select(F.lit("kept").alias("verdict"), "priority")
    return kept.unionByName(reasons).groupBy("verdict", "priority").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _ingest_all(spark: SparkSession, folder: str) -> DataFrame:
    """Audit of a load of all feeds from files, one of them with two header names swapped."""
    star, root = Star(spark, folder), fresh_path(spark, "landing")
    for feed in SOURCES:
        rows = FEEDS[feed](star)
        if "active" in rows.columns:
            rows = rows.withColumn("active", F.lower("active"))
        path = f"{root}/{feed}.csv"
        if feed == "employees":
            first, second, *others = SOURCES[feed].fieldNames()
            columns = [
                F.col(n).cast("string") if n in rows.columns else F.lit(None).cast("string")
                for n in (first, second, *others)
            ]
            ingest.write_files(rows.select(*columns).toDF(second, first, *others), path)
        else:
            ingest.write_csv(rows, path, feed)
    loaded = ingest.ingest_all(spark, root)
    verdict = F.split("status", ":").getItem(0).alias("status")
    audit = ingest.load_audit(spark, loaded)
    return audit.select("table_name", "record_count", "rejected_count", verdict)


def _new_database(spark: SparkSession, label: str) -> str:
    """A database of its own below the shared folder."""
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _write_layer(spark: SparkSession, folder: str) -> DataFrame:
    """A fact written as a table partitioned by month, and read by the next layer."""
    gold = _new_database(spark, "gold")
    orders = layers(spark, folder).gold("fact_purchase_orders")
    tables.write_layer(orders, gold, "fact_purchase_orders", "Purchase order facts", "gold")
    return presentable(tables.read_upper_layer(spark, gold, "fact_purchase_orders"))


def _backup_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All facts are copied; the result is the number of rows and the digest of every copy."""
    gold, backup = _new_database(spark, "gold"), _new_database(spark, "backup")
    star = layers(spark, folder)
    for table in BACKED_UP:
        tables.write_layer(star.gold(table), gold, table, "Facts", "gold")
    tables.backup_tables(spark, gold, BACKED_UP, backup)
    return union(
        [
            digest.table_digest(tables.read_upper_layer(spark, backup, t), columns.split()).select(
                F.lit(t).alias("table_name"), "row_count", "digest"
            )
            for t, columns in BACKED_UP.items()
        ]
    )


def _load_audit(l: Layers) -> DataFrame:
    frames = {t: l.raw(t) for t in SOURCES}
    return ingest.load_audit(l.spark, ingest.Loaded(frames, {}))


def _create_cube_view(spark: SparkSession, folder: str) -> DataFrame:
    tables.create_cube_view(layers(spark, folder).cube("cube_project_costs"), "project_costs_view")
    return presentable(
        spark.sql(
            "SELECT region, COUNT(*) AS projects, "
            "SUM(CAST(total_budget AS DECIMAL(18,2))) AS total_budget "
            "FROM project_costs_view GROUP BY region"
        )
    )


def ingestion_queries() -> dict[str, Query]:
    return {
        "ingest_csv": _ingest_csv,
        "ingest_all": _ingest_all,
        "write_layer": _write_layer,
        "backup_tables": _backup_tables,
        "incremental_ingest": _incremental_ingest,
        "corrupt_row_gate": _corrupt_row_gate,
        "load_audit": on_layers(_load_audit),
        "create_cube_view": _create_cube_view,
    }


# ---- quality and integrity ---------------------------------------------------------------------


def _all_metrics(l: Layers) -> DataFrame:
    return union(
        [
            quality.expectation_metrics(
                silver.JOBS[t](l.raw(t), l.as_of), silver.RULES[t], t
            )
            for t in silver.JOBS
        ]
    )


def _quarantined(l: Layers) -> DataFrame:
    parts = []
    for table in silver.JOBS:
        rows = silver.cleanse_checked(table, l.raw(table), l.as_of).quarantined
        parts.append(
            rows.select(
                F.lit(table).alias("table_name"),
                F.col(KEYS[table]).cast("string").alias("row_key"),
                F.array_join("failed_rules", ",").alias("failed_rules"),
            )
        )
    return union(parts)


def _dedup(s: Star) -> DataFrame:
    return quality.deduplicate(
        s.lines().select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            star_schema.shipped().alias("ship_date"),
        ),
        ["l_orderkey", "l_linenumber"],
        ["ship_date", "l_partkey", "l_suppkey"],
    )


def _expect_warn(l: Layers) -> DataFrame:
    rows = silver.JOBS["vendors"](l.raw("vendors"), l.as_of)
    kept, _ = quality.expect_warn(rows, silver.RULES["vendors"])
    return kept.select("vendor_id", "performance_rating")


def _expect_or_drop(l: Layers) -> DataFrame:
    rows = silver.JOBS["vendor_performance"](l.raw("vendor_performance"), l.as_of)
    kept = quality.expect_or_drop(rows, silver.RULES["vendor_performance"])
    return kept.select("performance_id", "vendor_id", "overall_score")


def _expect_or_fail(l: Layers) -> DataFrame:
    rule = quality.Rule("quantity_positive", "qty_ordered > 0", quality.FAIL)
    return quality.expect_or_fail(l.silver("po_line_items"), [rule]).groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("line_count")
    )


def _dq_metrics(l: Layers) -> DataFrame:
    return quality.dq_metrics(_all_metrics(l), "run-1").drop("checked_at")


def _layer_contract(l: Layers) -> DataFrame:
    return union(
        [integrity.layer_contract(l.raw(t), l.silver(t), KEYS[t], t) for t in SOURCES]
    )


def _row_balance(l: Layers) -> DataFrame:
    checked = {t: silver.cleanse_checked(t, l.raw(t), l.as_of) for t in SOURCES}
    return union(
        [integrity.row_balance(l.raw(t), rows.good, rows.quarantined, t) for t, rows in checked.items()]
    )


def _star_contract(l: Layers) -> DataFrame:
    return union(
        [
            integrity.star_contract(l.silver(source), l.gold(t), key, columns.split(), t)
            for t, (source, key, columns) in STAR_CONTRACT.items()
        ]
    )


def _star_references(l: Layers) -> DataFrame:
    return union(
        [
            integrity.reference_counts(l.gold(t), column, l.gold(dim), column, t)
            for t, columns in STAR_REFERENCES.items()
            for column, dim in columns.items()
        ]
    )


def _composite_check(l: Layers) -> DataFrame:
    expected = integrity.composite_score(
        "delivery_score", "quality_score", "commercial_score", "hse_score"
    )
    rows = l.silver("vendor_performance")
    return integrity.check_row_arithmetic(rows, "overall_score", expected, 0.01).select(
        "performance_id", "overall_score", c.dbl("expected_value").alias("expected_value")
    )


def _sign_check(l: Layers) -> DataFrame:
    shifted = l.silver("inventory").withColumn("quantity", F.col("quantity") - 10)
    return integrity.check_sign(shifted, "movement_type", "quantity").groupBy(
        "movement_type"
    ).agg(F.count(F.lit(1)).alias("violations"))


def quality_queries() -> dict[str, Query]:
    return {
        "expect_warn": on_layers(_expect_warn),
        "expect_or_drop": on_layers(_expect_or_drop),
        "expect_or_fail": on_layers(_expect_or_fail),
        "expectation_metrics": on_layers(_all_metrics),
        "quarantine": on_layers(_quarantined),
        "dq_metrics": on_layers(_dq_metrics),
        "silver_dedup": on_star(_dedup),
        "check_row_count": on_star(lambda s: integrity.check_row_count(s.lines(), 1)),
        "check_unique": on_star(
            lambda s: integrity.check_unique(s.lines(), "l_orderkey", "l_linenumber")
        ),
        "check_accepted_values": on_star(
            lambda s: integrity.check_accepted_values(
                s.orders(), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
            ).select("o_orderkey", "o_orderpriority")
        ),
        "check_foreign_key": on_star(
            lambda s: integrity.check_foreign_key(
                s.orders(), "o_orderkey", s.lines(), "l_orderkey"
            ).select("o_orderkey")
        ),
        "check_cancelled_lines": on_layers(
            lambda l: integrity.check_cancelled_lines(
                l.silver("po_line_items"), l.silver("purchase_orders")
            ).select("line_id", "po_id")
        ),
        "check_conditional": on_layers(
            lambda l: integrity.check_conditional(
                l.silver("purchase_orders"), "po_type = 'EMERGENCY'", "priority = 'CRITICAL'"
            ).select("po_id", "po_type", "priority")
        ),
        "check_business_rules": on_layers(lambda l: integrity.check_business_rules(l.silver)),
        "check_range": on_layers(
            lambda l: integrity.check_range(
                l.silver("contracts"), "original_value", 50_000, 400_000
            ).select("contract_id", "original_value")
        ),
        "check_row_arithmetic": on_layers(_composite_check),
        "check_sign": on_layers(_sign_check),
        "check_threshold_label": on_layers(
            lambda l: integrity.check_threshold_label(
                l.silver("vendor_performance"), "compliance_score", "recommendation"
            ).select("performance_id", "recommendation", "expected_label")
        ),
        "check_share": on_layers(
            lambda l: integrity.check_share(
                l.silver("contract_items"), "milestone_flag", 0.10, 0.20
            )
        ),
        "layer_contract": on_layers(_layer_contract),
        "row_balance": on_layers(_row_balance),
        "star_contract": on_layers(_star_contract),
        "star_references": on_layers(_star_references),
    }


# ---- sales and commerce ------------------------------------------------------------------------

_SALES_REPORTS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        sales_reports.customer_ranking,
        sales_reports.sales_by_country,
        sales_reports.sales_by_city,
        sales_reports.top_category_by_country,
        sales_reports.product_performance,
        sales_reports.category_performance,
        sales_reports.daily_sales,
        sales_reports.sales_by_weekday,
        sales_reports.monthly_trend,
    )
}
YEAR = ("1997-01-01", "1997-12-31")


def on_commerce(job: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return on_star(lambda s: job(star_schema.commerce(s)))


def _stock_changes(t: dict[str, DataFrame]) -> DataFrame:
    return commerce.stock_changes(t["purchase"], t["purchase_item"], t["sale"], t["sale_item"])


def _with_items_as_text(listing: DataFrame) -> DataFrame:
    """Items as text, so that the result compares with other engines."""
    items = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["item_id"], x["product_id"])), ",")
    return commerce.nested(listing).select(
        "id", "date", "total", "status", F.size("items").cast("long").alias("item_count"), items.alias("items")
    )


def _stock_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Balances after sales were entered, edited, deleted and sent again, from an append-only ledger."""
    t = star_schema.commerce(Star(spark, folder))

    def side(kind: str, sign: int, version: int, chosen: str, deleted: bool, more: int) -> DataFrame:
        rows = t[kind].where(chosen)
        headers = rows.select("id", F.lit(version).alias("version"), "date", F.lit(deleted).alias("deleted"))
        items = t[f"{kind}_item"].select(
            F.col(f"{kind}_id").alias("id"), F.lit(version).alias("version"), "product_id",
            (F.col("quantity") + more).alias("quantity"),
        ).where(chosen)
        return ledger.versions_of(items, headers, kind, sign)

    entered = side("sale", -1, 1, "true", False, 0).unionByName(side("purchase", 1, 1, "true", False, 0))
    edited = side("sale", -1, 2, "id % 5 = 0", False, 1)
    deleted = side("sale", -1, 3, "id % 7 = 0", True, 0)
    again = side("sale", -1, 1, "id % 3 = 0", False, 0)
    path = fresh_path(spark, "ledger")
    spark.createDataFrame([], ledger.MOVEMENT).write.parquet(path)
    for n, batch in enumerate((edited, entered, deleted.unionByName(again))):
        if n == 1:  # what was edited before it was entered is not entered again
            batch = batch.unionByName(edited)
        held = spark.read.schema(ledger.MOVEMENT).parquet(path)
        ledger.new_movements(held, batch).write.mode("append").parquet(path)
    return ledger.balance(spark.read.schema(ledger.MOVEMENT).parquet(path))


def commerce_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        name: on_star(lambda s, f=report: f(star_schema.sales(s)))
        for name, report in _SALES_REPORTS.items()
    }
    out |= {
        "commerce_summary": on_commerce(
            lambda t: commerce.commerce_summary(t["sale"], t["purchase"], t["payment"], *YEAR)
        ),
        "commerce_summary_default_range": on_commerce(
            lambda t: commerce.commerce_summary(
                t["sale"], t["purchase"], t["payment"], as_of=AS_OF
            )
        ),
        "top_products": on_commerce(
            lambda t: commerce.top_products(t["sale"], t["sale_item"], t["product"], *YEAR)
        ),
        "top_customers": on_commerce(
            lambda t: commerce.top_customers(t["sale"], t["customer"], *YEAR)
        ),
        "daily_breakdown": on_commerce(
            lambda t: commerce.daily_breakdown(t["sale"], t["purchase"], *YEAR)
        ),
        "sales_last30": on_commerce(lambda t: commerce.last30_totals(t["sale"], AS_OF)),
        "purchases_last30": on_commerce(lambda t: commerce.last30_totals(t["purchase"], AS_OF)),
        "payments_last30": on_commerce(lambda t: commerce.payments_last30(t["payment"], AS_OF)),
        "top_products_alltime": on_commerce(
            lambda t: commerce.top_products_alltime(t["sale_item"], t["product"])
        ),
        "sales_listing": on_commerce(
            lambda t: commerce.sales_listing(
                t["sale"], t["sale_item"], t["product"], t["customer"], *YEAR, page=2
            )
        ),
        "purchases_listing": on_commerce(
            lambda t: commerce.purchases_listing(
                t["purchase"], t["purchase_item"], t["product"], t["supplier"], *YEAR, page=2
            )
        ),
        "payments_listing": on_commerce(
            lambda t: commerce.payments_listing(t["payment"], "Outgoing", *YEAR, page=2)
        ),
        "customer_search": on_commerce(
            lambda t: commerce.customer_search(t["customer"], "machinery", page=2)
        ),
        "product_search": on_commerce(lambda t: commerce.product_search(t["product"], "1", 2)),
        "supplier_search": on_commerce(lambda t: commerce.supplier_search(t["supplier"], "0")),
        "active_users": on_commerce(lambda t: commerce.active_users(t["app_user"])),
        "offering_listing": on_commerce(
            lambda t: commerce.offering_listing(
                t["class_offering"], t["class"], t["subject"], t["section"], t["timeline"],
                t["app_user"], start="1996-01-01", end="2000-12-31", page=None,
            )
        ),
        "offering_page": on_commerce(
            lambda t: commerce.offering_listing(
                t["class_offering"], t["class"], t["subject"], t["section"], t["timeline"],
                t["app_user"], class_id=2, page=3,
            )
        ),
        "sales_nested": on_commerce(
            lambda t: _with_items_as_text(
                commerce.sales_listing(
                    t["sale"], t["sale_item"], t["product"], t["customer"], *YEAR, page=2
                )
            )
        ),
        "purchases_nested": on_commerce(
            lambda t: _with_items_as_text(
                commerce.purchases_listing(
                    t["purchase"], t["purchase_item"], t["product"], t["supplier"], *YEAR, page=2
                )
            )
        ),
        "stock_ledger": _stock_ledger,
        "stock_on_hand": on_commerce(
            lambda t: commerce.stock_on_hand(t["product"], _stock_changes(t))
        ),
        "running_stock": on_commerce(
            lambda t: commerce.running_stock(t["product"], _stock_changes(t))
        ),
        "order_total": on_commerce(lambda t: commerce.order_total(t["sale_item"], "sale_id")),
    }
    for kind in ("class", "subject", "section", "timeline"):
        out[f"reference_list_{kind}"] = on_commerce(
            lambda t, k=kind: commerce.reference_list(k, t[k])
        )
    return out


# ---- measures, reports, insights ---------------------------------------------------------------

# The column by which each table's measures are listed.
MEASURE_GROUPS: dict[str, str] = {
    "fact_purchase_orders": "po_status",
    "fact_invoices": "aging_bucket",
    "fact_project_costs": "cost_type",
    "fact_vendor_performance": "recommendation",
    "dim_vendor": "tier",
    "fact_goods_receipts": "grn_status",
    "fact_contracts": "contract_type",
    "fact_sales": "customer_type",
    "fact_inventory": "movement_type",
    "dim_project": "region",
    "cube_project_costs": "region",
    "cube_procurement_spend": "vendor_sector",
}


def _measures(l: Layers, table: str) -> DataFrame:
    names = [n for n, m in measures.MEASURES.items() if m.table == table]
    return measures.measures_of(table_of(l), names, [MEASURE_GROUPS[table]])


def measure_queries() -> dict[str, Query]:
    out = {
        f"measures_{table}": on_layers(lambda l, t=table: _measures(l, t))
        for table in MEASURE_GROUPS
    }
    out["measure_grand_total"] = on_layers(
        lambda l: measures.measure(table_of(l), "Avg PO Value", where="po_status = 'OPEN'")
    )
    out["measure_spend_by_tier"] = on_layers(
        lambda l: measures.measure_by_dimension(
            table_of(l), "Avg PO Value", "dim_vendor", "vendor_id", ["tier", "vendor_country"]
        )
    )
    return out


def report_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        f"report_{name}": on_layers(lambda l, n=name: reports.visual(l.cube, n))
        for name in reports.VISUALS
    }
    out |= {
        "report_topn": on_layers(
            lambda l: reports.report_topn(
                l.cube("cube_procurement_spend"), ["vendor_name"], "total_spend",
                ("sum", "total_spend"), 10,
            )
        ),
        "report_slice": on_layers(
            lambda l: reports.report_rollup(
                reports.report_slice(
                    l.cube("cube_procurement_spend"), year=[1996, 1997], quarter=2
                ),
                ["vendor_name"],
                {"total_spend": ("sum", "total_spend")},
            )
        ),
        "report_matrix": on_layers(
            lambda l: reports.report_matrix(
                l.cube("cube_cost_variance"), ["project_name"], "cost_type",
                ("sum", "overrun_amount"),
            )
        ),
        "report_band": on_layers(
            lambda l: reports.report_band(
                l.cube("cube_project_costs").select("project_id", "cpi"),
                "cpi_band", reports.cpi_band("cpi"),
            )
        ),
        "report_growth_band": on_layers(
            lambda l: reports.report_band(
                l.cube("cube_spend_by_sector").select(
                    "vendor_id", "year", "quarter", "yoy_growth_pct"
                ),
                "growth_band", reports.growth_band("yoy_growth_pct"),
            )
        ),
    }
    return out


def insight_queries() -> dict[str, Query]:
    return {
        "kpi_alerts": on_layers(
            lambda l: insights.kpi_alerts(
                l.gold("fact_purchase_orders"), l.gold("fact_invoices"),
                l.gold("fact_project_costs"), l.cube("cube_delivery_performance"),
                l.gold("fact_goods_receipts"), l.gold("fact_vendor_performance"),
                l.gold("fact_contracts"), l.cube("cube_project_timeline"), l.as_of,
            )
        ),
        "concentration_risk": on_layers(
            lambda l: insights.concentration_risk(
                l.gold("fact_purchase_orders"), l.gold("dim_vendor")
            )
        ),
        "evm_extended": on_layers(
            lambda l: insights.evm_extended(
                l.cube("cube_project_costs"), l.cube("cube_project_timeline")
            )
        ),
        "cashflow_forecast": on_layers(
            lambda l: insights.cashflow_forecast(l.gold("fact_invoices"), l.as_of)
        ),
        "three_way_match": on_layers(
            lambda l: insights.three_way_match(
                l.gold("fact_purchase_orders"), l.gold("fact_goods_receipts"),
                l.gold("fact_invoices"),
            )
        ),
        "stock_alerts": on_layers(
            lambda l: insights.stock_alerts(
                l.gold("fact_inventory"), l.silver("materials"), l.as_of
            )
        ),
        "burn_rate_months": on_layers(
            lambda l: insights.burn_rate_months(
                l.gold("fact_project_costs"), l.silver("project_actuals")
            )
        ),
        "s_curve": on_layers(
            lambda l: insights.s_curve(
                l.gold("dim_project"), l.gold("fact_project_costs"), l.silver("project_actuals")
            )
        ),
        "spend_concentration": on_layers(
            lambda l: insights.spend_concentration(
                l.silver("po_line_items"), l.gold("dim_material")
            )
        ),
        "spend_concentration_material": on_layers(
            lambda l: insights.spend_concentration(
                l.silver("po_line_items"), l.gold("dim_material"), "material_id"
            )
        ),
    }


# ---- edits and history -------------------------------------------------------------------------


def _verify_edit(l: Layers, name: str) -> DataFrame:
    edit = edits.EDITS[name]
    before = l.gold(edit.table)
    after = edits.update_first_n(before, edit)
    return edits.verify_after_update(after, edit, edits.pre_image(before, edit))


def _revert(l: Layers) -> DataFrame:
    edit = edits.EDITS["A01"]
    before = l.gold(edit.table)
    saved = edits.pre_image(before, edit)
    return edits.revert_update(edits.update_first_n(before, edit), edit, saved)


def _vendor_versions(l: Layers) -> tuple[DataFrame, DataFrame]:
    """Vendors now, and a later snapshot with better ratings and without the inactive ones."""
    now = l.gold("dim_vendor").select("vendor_id", "vendor_name", "tier", "status")
    rating = F.col("performance_rating") + 1
    tier = c.band(rating, [(4, "STRATEGIC"), (3, "PREFERRED")], "STANDARD")
    later = l.gold("dim_vendor").filter("status <> 'INACTIVE'").select(
        "vendor_id", "vendor_name", tier.alias("tier"), "status"
    )
    return now, later


def _scd2_snapshots(l: Layers) -> DataFrame:
    now, later = _vendor_versions(l)
    tracked = ["vendor_name", "tier", "status"]
    opened = history.start_history(now, "vendor_id", tracked, "1997-01-01")
    return history.apply_snapshot(
        opened, later, "vendor_id", tracked, "1998-01-01", close_missing=True
    ).drop("row_hash")


def _scd2_log(s: Star) -> DataFrame:
    """History of a customer's order status, from the last order of each day."""
    day = star_schema.ordered().alias("order_date")
    changes = s.orders().groupBy("o_custkey", day).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("order_status")
    )
    return history.scd2_dimension(changes, "o_custkey", ["order_status"], "order_date").drop(
        "row_hash"
    )


def _merge(l: Layers) -> DataFrame:
    now, later = _vendor_versions(l)
    arrivals = later.filter("status = 'PENDING'").withColumn(
        "vendor_id", F.col("vendor_id") + 1_000_000
    )
    return edits.upsert_merge(now, later.unionByName(arrivals), "vendor_id")


def _stored_orders(spark: SparkSession, folder: str) -> str:
    gold = _new_database(spark, "gold")
    orders = layers(spark, folder).gold("fact_purchase_orders").drop("_gold_timestamp")
    tables.write_layer(orders, gold, "fact_purchase_orders", "Purchase order facts", "gold")
    return gold


def _edit_stored(undone: bool) -> Query:
    """An edit of a stored fact, which rewrites the months of its keys, and its undoing."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        gold = _stored_orders(spark, folder)
        done = tables.edit_table(spark, gold, edits.EDITS["A01"])
        if undone:
            tables.edit_table(spark, gold, edits.EDITS["A04"])
            tables.undo_edit(spark, gold, edits.EDITS["A01"], done)
        stored_rows = tables.read_upper_layer(spark, gold, "fact_purchase_orders")
        return presentable(stored_rows.select("po_id", "po_status", "po_value", "priority"))

    return query


def _merge_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that move by a month, merged into the stored fact; of two changes the later counts."""
    gold = _stored_orders(spark, folder)
    rows = tables.read_upper_layer(spark, gold, "fact_purchase_orders").where("po_id % 50 = 0")
    moved = rows.withColumns({"po_date": F.date_add("po_date", 31), "po_status": F.lit("MOVED")})
    first = rows.withColumn("po_status", F.lit("LOST")).withColumn("_at", F.lit(1))
    changes = first.unionByName(moved.withColumn("_at", F.lit(2)))
    tables.merge_table(spark, gold, "fact_purchase_orders", changes, "po_id", "_at")
    stored_rows = tables.read_upper_layer(spark, gold, "fact_purchase_orders")
    return presentable(stored_rows.select("po_id", "po_date", "po_status", "po_value"))


def _read_period(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of a stored fact; only the folders of its months are read."""
    gold = _stored_orders(spark, folder)
    rows = tables.between(spark, gold, "fact_purchase_orders", "1997-02-10", "1997-04-20")
    return presentable(rows.select("po_id", "po_date", "po_status", "po_value"))


def _join_period(spark: SparkSession, folder: str) -> DataFrame:
    """Spend per weekday of one quarter: the calendar's filter prunes the months of the fact."""
    gold = _stored_orders(spark, folder)
    fact = spark.read.table(tables.full_name(gold, "fact_purchase_orders"))
    quarter = layers(spark, folder).gold("dim_date").where("year = 1997 AND quarter = 2")
    rows = tables.join_on_month(fact, quarter, "po_date")
    return presentable(
        rows.groupBy(F.dayofweek("po_date").alias("weekday")).agg(
            F.count(F.lit(1)).alias("orders"), c.exact_sum("po_value").alias("spend")
        )
    )


def _late_history(spark: SparkSession, folder: str) -> DataFrame:
    """A customer's order status by day, from three batches in mixed order with repeats and deletions."""
    star = Star(spark, folder)
    events = star.orders().select(
        "o_custkey", F.col("o_orderstatus").alias("order_status"),
        star_schema.ordered().alias("valid_from"), F.col("o_orderkey").cast("long").alias("_sequence"),
        (F.col("o_orderkey") % 11 == 0).alias("_deleted"),
    )
    root = fresh_path(spark, "history")
    held = versions.MaintainedHistory(spark, "o_custkey", ["order_status"], root, events.schema)
    part = F.pmod(F.xxhash64("_sequence"), F.lit(4))
    for k, chosen in enumerate((part.isin(2, 3), part.isin(0, 2), part.isin(1, 0))):
        held.apply(events.where(chosen), f"{root}-batches/{k}")
    return presentable(held.versions().drop("row_hash"))


def _hierarchy_chains(s: Star) -> DataFrame:
    """Parts under the part of a third of their number, with some lost parents and some cycles."""
    key = F.col("p_partkey").cast("long")
    parent = (
        F.when(key % 97 == 0, key + 1_000_000_000)
        .when(key % 101 == 5, key + 1)
        .when(key % 101 == 6, key - 1)
        .when(key >= 3, F.floor(key / 3).cast("long"))
    )
    rows = s.table("part").select(key.alias("part_id"), parent.alias("parent_id"))
    return hierarchy.closure(rows, "part_id", "parent_id")


def edit_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        f"update_{name}": on_layers(lambda l, n=name: _verify_edit(l, n)) for name in edits.EDITS
    }
    out |= {
        "update_first_n": on_layers(
            lambda l: edits.update_first_n(
                l.gold("fact_purchase_orders"), edits.EDITS["A01"]
            ).select("po_id", "po_status", "po_value")
        ),
        "revert_update": on_layers(lambda l: _revert(l).select("po_id", "po_status", "po_value")),
        "upsert_merge": on_layers(_merge),
        "scd2_snapshots": on_layers(_scd2_snapshots),
        "scd2_dimension": on_star(_scd2_log),
        "scd2_late_changes": _late_history,
        "edit_stored": _edit_stored(False),
        "undo_stored": _edit_stored(True),
        "merge_stored": _merge_stored,
        "read_period": _read_period,
        "join_period": _join_period,
        "hierarchy_materials": on_layers(
            lambda l: hierarchy.closure(l.silver("materials"), "material_id", "parent_material_id")
        ),
        "hierarchy_chains": on_star(_hierarchy_chains),
    }
    return out


# ---- streaming ---------------------------------------------------------------------------------


def _as_stream(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """A feed written to files and read back as a stream."""
    path = fresh_path(spark, "feed")
    with tidy(spark):
        raw.write.option("compression", "zstd").parquet(path)
    return streams.stream_parquet(spark, path, raw)


def _drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = fresh_path(spark, "out")
    streams.run_available(stream, target, fresh_path(spark, "state"))
    return spark.read.parquet(target)


def _stream_dim(feed: str, table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        l = layers(spark, folder)
        cleansed = streams.stream_silver(_as_stream(spark, l.raw(feed)), feed, AS_OF)
        return presentable(_drain(spark, streams.stream_dims(table, cleansed)))

    return query


def _stream_fact(feed: str, table: str, *lookups: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        l = layers(spark, folder)
        cleansed = streams.stream_silver(_as_stream(spark, l.raw(feed)), feed, AS_OF)
        static = {t: l.silver(t) for t in lookups}
        return presentable(_drain(spark, streams.stream_facts(table, cleansed, AS_OF, **static)))

    return query


def _fed(spark: SparkSession, raw: DataFrame, parts: int) -> tuple[str, int]:
    """Folder of a feed, and the number of files of which about ``parts`` batches take all.

    Every task writes its own file, so files do not grow with the input.  Only a feed of fewer files
    than batches is dealt out again.
    """
    for deal in (False, True):
        feed = fresh_path(spark, "feed")
        rows = raw.repartition(parts) if deal else raw
        rows.write.option("compression", "zstd").parquet(feed)
        files = len(spark.read.schema(raw.schema).parquet(feed).inputFiles())
        if files >= parts:
            break
        raw = spark.read.schema(raw.schema).parquet(feed)
    return feed, max(1, -(-files // parts))


def _checked_stream(spark: SparkSession, l: Layers, table: str, parts: int) -> tuple[str, str]:
    """Folders of the rows and counts of a feed that arrived in some batches."""
    rows, counts, state = (fresh_path(spark, n) for n in ("rows", "counts", "state"))
    raw = l.raw(table)
    feed, files = _fed(spark, raw, parts)
    arriving = silver.JOBS[table](streams.stream_parquet(spark, feed, raw, max_files=files), AS_OF)
    observed.stream_dq(arriving, silver.RULES[table], table, rows, counts, state)
    return rows, counts


def _stream_dq(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per outcome after the expectations of the evaluations ran on a stream."""
    rows, _ = _checked_stream(spark, layers(spark, folder), "vendor_performance", 1)
    kept = observed.good_rows(spark, rows).select(
        F.lit("kept").alias("outcome"), "evaluation_period"
    )
    rejected = observed.quarantined_rows(spark, rows).select(
        F.array_join("failed_rules", ",").alias("outcome"), "evaluation_period"
    )
    return kept.unionByName(rejected).groupBy("outcome", "evaluation_period").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _stream_dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per rule that were observed on three streams of three batches each."""
    l = layers(spark, folder)
    parts = []
    for table in ("vendor_performance", "contracts", "sales_orders"):
        _, counts = _checked_stream(spark, l, table, 3)
        parts.append(observed.totals(spark, counts))
    return union(parts)


def _late_fact(table: str) -> Query:
    """A fact from three batches: stale and missing children first, repeats, corrections last."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        l = layers(spark, folder)
        if table == "fact_goods_receipts":
            view = propagate.receipts_view(l.silver("purchase_orders"))
        else:
            view = propagate.VIEWS[table]
        parents = l.silver(view.parent).withColumn("_sequence", F.lit(1).cast("long"))
        children = l.silver(view.child).withColumn("_sequence", F.lit(2).cast("long"))
        stale = children.withColumn("_sequence", F.lit(1).cast("long"))
        for name in {*view.sums.values(), *view.maxima.values()}:
            wrong = F.date_add(name, 100) if dict(children.dtypes)[name] == "date" else F.col(name) * 2 + 1
            stale = stale.withColumn(name, wrong)
        third, half = F.pmod(F.xxhash64(view.child_key), F.lit(3)), F.pmod(F.xxhash64(view.parent_key), F.lit(2))
        batches = [
            (parents.where(half == 0), stale.where(third == 0).unionByName(children.where(third == 1))),
            (parents, children.where(third == 2)),
            (parents.where(half == 1), children.where(third == 0).unionByName(stale.where(third == 0))),
        ]
        root, state, feeds = (fresh_path(spark, n) for n in ("fact", "state", "feeds"))
        for own, lines in batches:
            own.write.mode("append").option("compression", "zstd").parquet(f"{feeds}/parents")
            lines.write.mode("append").option("compression", "zstd").parquet(f"{feeds}/children")
            arriving = (
                streams.stream_parquet(spark, f"{feeds}/{name}", like, max_files=100_000)
                for name, like in (("parents", parents), ("children", children))
            )
            propagate.maintain(spark, view, *arriving, root, state)
        held = propagate.MaintainedFact(spark, view, root, parents.schema, children.schema)
        return presentable(held.fact())

    return query


def _stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Vendors merged from three batches: later changes first, repeats, deletions last."""
    vendors = layers(spark, folder).gold("dim_vendor").select("vendor_id", "vendor_name", "tier")

    def change(sequence: int, deleted: bool) -> DataFrame:
        marks = {"_sequence": F.lit(sequence).cast("long"), "_deleted": F.lit(deleted)}
        return vendors.withColumns(marks | {rewrite.BUCKET: rewrite.bucket_of(["vendor_id"], 8)})

    new = change(1, False)
    moved = change(2, False).where("vendor_id % 2 = 0").withColumn("tier", F.lit("MOVED"))
    gone = change(3, True).where("vendor_id % 5 = 0")
    feed, path, state = (fresh_path(spark, n) for n in ("changes", "vendors", "state"))
    for batch in (moved.unionByName(new.where("vendor_id % 3 = 0")), new.unionByName(moved), gone.unionByName(new)):
        batch.write.mode("append").parquet(feed)
        arriving = streams.stream_parquet(spark, feed, new, max_files=100_000)
        merge.stream_merge(arriving, path, ["vendor_id"], rewrite.BUCKET, state)
    return merge.live(rewrite.read_rows(spark, path, new.schema)).drop(rewrite.BUCKET)


def stream_queries() -> dict[str, Query]:
    return {
        "stream_merge": _stream_merge,
        "stream_late_fact_purchase_orders": _late_fact("fact_purchase_orders"),
        "stream_late_fact_goods_receipts": _late_fact("fact_goods_receipts"),
        "aging_at_read": on_layers(
            lambda l: streams.aging_at_read(l.gold("fact_invoices"), "1998-03-15").select(
                "invoice_id", "payment_status", "days_overdue", "aging_bucket"
            )
        ),
        "stream_dim_vendor": _stream_dim("vendors", "dim_vendor"),
        "stream_dim_project": _stream_dim("projects", "dim_project"),
        "stream_dim_material": _stream_dim("materials", "dim_material"),
        "stream_fact_purchase_orders": _stream_fact(
            "purchase_orders", "fact_purchase_orders", "po_line_items"
        ),
        "stream_fact_invoices": _stream_fact("invoices", "fact_invoices"),
        "stream_fact_goods_receipts": _stream_fact(
            "goods_receipts", "fact_goods_receipts", "po_line_items", "purchase_orders"
        ),
        "stream_fact_project_costs": _stream_fact(
            "project_budgets", "fact_project_costs", "project_actuals"
        ),
        "stream_fact_vendor_performance": _stream_fact(
            "vendor_performance", "fact_vendor_performance"
        ),
        "stream_fact_contracts": _stream_fact("contracts", "fact_contracts", "contract_items"),
        "stream_fact_sales": _stream_fact("sales_orders", "fact_sales", "materials"),
        "stream_dq": _stream_dq,
        "stream_dq_metrics": _stream_dq_metrics,
    }


def queries() -> dict[str, Query]:
    return (
        layer_queries()
        | ingestion_queries()
        | quality_queries()
        | commerce_queries()
        | measure_queries()
        | report_queries()
        | insight_queries()
        | edit_queries()
        | stream_queries()
    )
