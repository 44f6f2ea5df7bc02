"""Edits, merges, history, and streams that must equal their batch runs."""

from __future__ import annotations

import datetime as dt

import pytest

from known import AS_OF
from tradeloom.operators import edits, facts, history
from tradeloom.operators.edits import Edit, scale, set_to, subtract_floored
from tradeloom.session import fresh_path
from tradeloom.streaming import jobs as streams


def test_update_verify_revert(spark):
    df = spark.createDataFrame(
        [("b", "OPEN", 10.0), ("a", "OPEN", 20.05), ("c", "OPEN", 30.0), ("d", "DONE", 40.0)],
        "id string, status string, v double",
    )
    edit = Edit("t", "id", 2, {"v": scale("v", "1.30"), "status": set_to("HELD")}, "status = 'OPEN'")
    saved = edits.pre_image(df, edit)
    after = edits.update_first_n(df, edit)
    assert sorted(after.collect()) == [
        ("a", "HELD", 26.07), ("b", "HELD", 13.0), ("c", "OPEN", 30.0), ("d", "DONE", 40.0)
    ]
    shown = edits.verify_after_update(after, edit, saved)
    assert sorted(r.old_v for r in shown.collect()) == [10.0, 20.05]
    # A second edit of other rows does not disturb the restore.
    later = edits.update_first_n(after, Edit("t", "id", 1, {"v": set_to(0.0)}, "status = 'DONE'"))
    back = edits.revert_update(later, edit, saved)
    assert sorted(back.collect()) == [
        ("a", "OPEN", 20.05), ("b", "OPEN", 10.0), ("c", "OPEN", 30.0), ("d", "DONE", 0.0)
    ]


def test_floor_and_all_edits_fit_their_tables(spark, layers):
    df = spark.createDataFrame([("a", 3.0)], "id string, v double")
    edit = Edit("t", "id", 1, {"v": subtract_floored("v", 5)})
    assert edits.update_first_n(df, edit).collect()[0].v == 0.0
    assert len(edits.EDITS) == 44
    for one in edits.EDITS.values():
        table = layers.gold(one.table)
        assert edits.update_first_n(table, one).schema.simpleString() == table.schema.simpleString()


def test_upsert(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    assert sorted(edits.upsert_merge(now, new, "id").collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_type_two_history(spark):
    def snapshot(*rows):
        return spark.createDataFrame(rows, "id int, tier string")

    def lines(df):
        rows = [
            (r.id, r.tier, str(r.valid_from), str(r.valid_to), r.is_current) for r in df.collect()
        ]
        return sorted(rows, key=str)

    opened = history.start_history(snapshot((1, "A"), (2, "B"), (3, None)), "id", ["tier"], "2024-01-01")
    second = history.apply_snapshot(
        opened, snapshot((1, "A"), (2, "C"), (3, ""), (4, "N")), "id", ["tier"], "2024-02-01"
    )
    end = "9999-12-31"
    assert lines(second) == sorted([
        (1, "A", "2024-01-01", end, True),
        (2, "B", "2024-01-01", "2024-01-31", False),
        (2, "C", "2024-02-01", end, True),
        (3, None, "2024-01-01", "2024-01-31", False),
        (3, "", "2024-02-01", end, True),
        (4, "N", "2024-02-01", end, True),
    ], key=str)
    third = history.apply_snapshot(
        second, snapshot((1, "A"), (2, "C")), "id", ["tier"], "2024-03-01", close_missing=True
    )
    open_now = {r.id for r in third.filter("is_current").collect()}
    assert open_now == {1, 2}
    assert third.filter("id = 4").collect()[0].valid_to == dt.date(2024, 2, 29)
    # Every key has at most one open version, and the periods of a key do not overlap.
    assert third.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0


def test_history_from_a_log(spark):
    log = spark.createDataFrame(
        [(1, "A", "2024-01-01"), (1, "A", "2024-01-05"), (1, "B", "2024-01-09")],
        "id int, tier string, day string",
    ).selectExpr("id", "tier", "CAST(day AS DATE) AS day")
    got = sorted(
        (r.tier, str(r.valid_from), str(r.valid_to), r.is_current)
        for r in history.scd2_dimension(log, "id", ["tier"], "day").collect()
    )
    assert got == [
        ("A", "2024-01-01", "2024-01-08", False), ("B", "2024-01-09", "9999-12-31", True)
    ]


def plain(df):
    columns = sorted(c for c in df.columns if not c.endswith("_timestamp"))
    return sorted(map(str, df.select(*columns).collect()))


@pytest.fixture
def feed(spark, raw):
    """A raw feed written as two files, streamed with one file per batch."""

    def build(table):
        path = fresh_path(spark, f"feed_{table}")
        raw[table].repartition(2).write.parquet(path)
        return streams.stream_parquet(spark, path, raw[table], max_files=1)

    return build


def drained(spark, stream):
    path = fresh_path(spark, "out")
    streams.run_available(stream, path, fresh_path(spark, "state"))
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "table,source,lookups",
    [
        ("fact_purchase_orders", "purchase_orders", ["po_line_items"]),
        ("fact_invoices", "invoices", []),
        ("fact_goods_receipts", "goods_receipts", ["po_line_items", "purchase_orders"]),
        ("fact_project_costs", "project_budgets", ["project_actuals"]),
        ("fact_vendor_performance", "vendor_performance", []),
        ("fact_contracts", "contracts", ["contract_items"]),
        ("fact_sales", "sales_orders", ["materials"]),
    ],
)
def test_streamed_fact_equals_batch(spark, layers, feed, table, source, lookups):
    cleansed = streams.stream_silver(feed(source), source, AS_OF)
    static = {t: layers.silver(t) for t in lookups}
    streamed = drained(spark, streams.stream_facts(table, cleansed, AS_OF, **static))
    assert plain(streamed.drop("load_timestamp")) == plain(layers.gold(table).drop("load_timestamp"))


@pytest.mark.parametrize(
    "table,source", [("dim_vendor", "vendors"), ("dim_project", "projects"), ("dim_material", "materials")]
)
def test_streamed_dimension_equals_batch(spark, layers, feed, table, source):
    cleansed = streams.stream_silver(feed(source), source)
    assert plain(drained(spark, streams.stream_dims(table, cleansed))) == plain(layers.gold(table))


def test_batch_only_tables_do_not_stream(layers):
    with pytest.raises(ValueError, match="rebuilt in batch"):
        streams.stream_facts("fact_inventory", layers.silver("inventory"))


def test_ages_are_taken_when_read(layers):
    aged = streams.aging_at_read(layers.gold("fact_invoices"), "2024-04-20")
    buckets = {r.invoice_id: (r.aging_bucket, r.payment_status) for r in aged.collect()}
    assert buckets == {"I1": ("CURRENT", "PAID"), "I2": ("1-30 DAYS", "OVERDUE")}
    assert facts.AGING_BUCKETS[1] == "1-30 DAYS"


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    from test_sources import write_files

    landing = tmp_path / "landing"
    landing.mkdir()
    write_files(landing, ["contracts"])
    target, state = str(tmp_path / "raw"), str(tmp_path / "state")

    def run(batch):
        return streams.incremental_ingest(spark, str(landing), "contracts", target, state, batch)

    assert run("b1").count() == 3
    assert run("b2").count() == 3
    (landing / "more.csv").write_text((landing / "contracts.csv").read_text())
    rows = run("b3")
    assert rows.groupBy("_batch_id").count().collect()
    assert {(r._batch_id, r["count"]) for r in rows.groupBy("_batch_id").count().collect()} == {
        ("b1", 3), ("b3", 3)
    }


def test_streams_write_zstd(spark):
    source = fresh_path(spark, "numbers")
    spark.range(30).write.parquet(source)
    out = drained(spark, streams.stream_parquet(spark, source, spark.range(1)))
    files = out.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert sorted(r.id for r in out.collect()) == list(range(30))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
