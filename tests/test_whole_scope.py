"""Nothing is dropped, frozen or accepted in silence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import commerce, cubes, edits, insights, reports
from tradeloom.sources import ingest, tables
from tradeloom.streaming import jobs as streams

ORDERS = "po_id string, vendor_id string, project_id string, po_date date, total_amount double, line_total double, total_quantity double"


def spend(spark, rows):
    import datetime as dt

    orders = spark.createDataFrame(
        [(p, "V1", "P1", None if d is None else dt.date.fromisoformat(d), a, a, 1.0) for p, d, a in rows], ORDERS
    )
    vendors = spark.createDataFrame([("V1", "Acme", "S", True)], "vendor_id string, vendor_name string, sector string, is_current boolean")
    projects = spark.createDataFrame([("P1", "Bridge", True)], "project_id string, project_name string, is_current boolean")
    return cubes.cube_procurement_spend(orders, vendors, projects)


def test_orders_outside_any_calendar_and_without_date_count(spark):
    got = spend(spark, [("A", "2019-12-31", 1.0), ("B", "2041-01-01", 2.0), ("C", None, 4.0)]).collect()
    assert {r.year: (r.po_count, r.total_spend, r.vendor_quarter_spend) for r in got} == {
        2019: (1, 1.0, 1.0), 2041: (1, 2.0, 2.0), None: (1, 4.0, 4.0)
    }


def test_orders_count_once_and_missing_amounts_do_not_pull_the_mean(spark):
    (row,) = spend(spark, [("A", "2024-01-05", 100.0), ("A", "2024-01-05", 100.0), ("B", "2024-01-06", None)]).collect()
    assert (row.po_count, row.avg_po_value, row.total_spend) == (2, 100.0, 200.0)


def test_a_view_follows_its_table(spark, tmp_path):
    first = [("A", "V1", "P1", 100.0)]
    schema = "po_id string, vendor_id string, project_id string, total_amount double"

    def append(rows):
        df = spark.createDataFrame(rows, schema).withColumns(
            {"po_date": F.lit("2024-01-05").cast("date"), "line_total": F.col("total_amount"), "total_quantity": F.lit(1.0)}
        )
        df.write.mode("append").option("path", str(tmp_path / "orders")).saveAsTable("live_orders")

    spark.sql("DROP TABLE IF EXISTS live_orders")
    append(first)
    vendors = spark.createDataFrame([("V1", "Acme", "S", True)], "vendor_id string, vendor_name string, sector string, is_current boolean")
    projects = spark.createDataFrame([("P1", "Bridge", True)], "project_id string, project_name string, is_current boolean")
    tables.create_cube_view(cubes.cube_procurement_spend(spark.table("live_orders"), vendors, projects), "live_spend")
    assert spark.table("live_spend").first().po_count == 1
    append([("B", "V1", "P1", 50.0)])
    assert [r.po_count for r in spark.table("live_spend").collect()] == [2]
    spark.sql("DROP TABLE live_orders")


def test_utilisation_has_a_target_range(spark):
    values = spark.createDataFrame([(40.0,), (85.0,), (100.0,), (100.5,), (None,)], "v double")
    got = values.select(insights.kpi_status("budget_utilisation_pct", F.col("v")).alias("s")).collect()
    assert [r.s for r in got] == ["WARN", "OK", "OK", "ALERT", "NO DATA"]


def test_merge_guards_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k int, v string, at int")
    with pytest.raises(Exception, match="several changes of k 1"):
        edits.upsert_merge(old, new, "k").collect()
    got = edits.upsert_merge(old, new, "k", latest="at").collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "y"), (2, "b"), (3, "z")]
    assert edits.upsert_merge(old, new.where("v <> 'x'"), "k").count() == 3


def swapped(folder, table):
    from test_sources import write_files

    write_files(folder, [table])
    path = folder / f"{table}.csv"
    header, *rows = path.read_text().splitlines()
    first, second, *others = header.split(",")
    path.write_text("\n".join([",".join([second, first, *others]), *rows]) + "\n")


def test_swapped_header_fails_one_table(spark, tmp_path):
    from test_sources import write_files

    write_files(tmp_path, ["projects"])
    swapped(tmp_path, "vendors")
    audit = ingest.load_audit(spark, ingest.ingest_all(spark, str(tmp_path), ["vendors", "projects"]))
    got = {r.table_name: (r.status.split(":")[0], r.record_count) for r in audit.collect()}
    assert got == {"vendors": ("FAILED", 0), "projects": ("SUCCESS", 3)}


def test_swapped_header_stops_the_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    swapped(landing, "vendors")
    with pytest.raises(Exception, match="(?i)header|schema"):
        streams.incremental_ingest(spark, str(landing), "vendors", str(tmp_path / "raw"), str(tmp_path / "state"), "b1")


def test_malformed_rows_do_not_enter_the_raw_table(spark, tmp_path):
    from test_sources import write_files

    landing = tmp_path / "landing"
    landing.mkdir()
    write_files(landing, ["purchase_orders"])
    with open(landing / "purchase_orders.csv", "a") as out:
        out.write("PO9,T,S,P,V,J,not-a-date\n")
    target = str(tmp_path / "raw")
    rows = streams.incremental_ingest(spark, str(landing), "purchase_orders", target, str(tmp_path / "state"), "b1")
    assert rows.count() == 3 and ingest.CORRUPT not in rows.columns
    assert [r._batch_id for r in streams.rejected_rows(spark, target).collect()] == ["b1"]


def test_s_curve_has_every_month(spark):
    import datetime as dt

    projects = spark.createDataFrame([("P", dt.date(2024, 2, 1), dt.date(2024, 5, 31))], "project_id string, start_date date, end_date date")
    costs = spark.createDataFrame([("P", 120.0)], "project_id string, budget_amount double")
    actuals = spark.createDataFrame([("P", dt.date(2024, 1, 9), 5.0), ("P", dt.date(2024, 4, 2), 7.0)], "project_id string, posting_date date, actual_amount double")
    got = insights.s_curve(projects, costs, actuals).orderBy("month_end").collect()
    assert [(r.month_end.month, r.actual, r.cumulative_actual) for r in got] == [(1, 5.0, 5.0), (2, 0.0, 5.0), (3, 0.0, 5.0), (4, 7.0, 12.0), (5, 0.0, 12.0)]
    assert got[0].cumulative_planned == 0.0 and got[-1].cumulative_planned == 120.0


def test_pareto_keeps_groups_without_spend(spark):
    lines = spark.createDataFrame([("M1", 5.0), ("M2", None)], "material_id string, line_value double")
    materials = spark.createDataFrame([("M1", "A"), ("M2", "B")], "material_id string, category string")
    assert {r.category: r.spend for r in insights.spend_concentration(lines, materials).collect()} == {"A": 5.0, "B": None}


def test_matrix_keeps_every_label(spark):
    cube = spark.createDataFrame([("a", "x", 1.0), ("a", "Z", 5.0)], "k string, c string, v double")
    (row,) = reports.report_matrix(cube, ["k"], "c", ("sum", "v")).collect()
    assert (row.x, row.Z) == (1.0, 5.0)


def test_listing_is_newest_first(spark, tiny):
    from tradeloom.plans.queries import queries

    rows = queries()["sales_listing"](spark, tiny).collect()
    assert [(r.date, r.id) for r in rows] == sorted([(r.date, r.id) for r in rows], reverse=True)
    assert commerce.PAGE_SIZE


def test_digits_below_a_cent_and_large_groups_add_up(spark):
    from tradeloom.functions import columns as c

    small = spark.range(1000).select(c.money(F.lit("0.004")).alias("v"))
    assert small.agg(c.exact_sum("v").alias("s")).first().s == 4.0
    large = spark.range(100).select(F.lit(1.1e15).alias("v"))
    total = reports.report_rollup(large.withColumn("k", F.lit(1)), ["k"], {"s": ("sum", "v")}).first().s
    assert total == 1.1e17
    assert spark.range(1).select(c.difference(F.lit(1e9 + 0.37), F.lit(1e9)).alias("d")).first().d == 0.37


def test_pages_by_key_follow_pages_by_number(spark):
    import datetime as dt

    rows = [(i, dt.date(2024, 1, 1 + i % 5), 1.0, "IN", None, None, None) for i in range(40)]
    payments = spark.createDataFrame(
        rows, "id int, date date, amount double, direction string, reference_id int, reference_type string, notes string"
    )
    after = None
    for page in (1, 2, 3):
        by_number = [r.id for r in commerce.payments_listing(payments, page=page, size=7).collect()]
        by_key = commerce.payments_listing(payments, size=7, after=after).collect()
        assert [r.id for r in by_key] == by_number
        after = (by_key[-1].date, by_key[-1].id)
