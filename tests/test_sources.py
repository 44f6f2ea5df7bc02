"""CSV ingestion, the corrupt-row gate, the audit, tables, and the whole pipeline on files."""

from __future__ import annotations

import csv
import pathlib
import time
import uuid

import pytest
from pyspark.sql import DataFrameWriter

from known import AS_OF, CALENDAR, ROWS
from tradeloom.operators import edits
from tradeloom.plans import pipeline
from tradeloom.sources import ingest, tables
from tradeloom.sources.schemas import KEYS, SOURCES


def write_files(root, names=tuple(ROWS)):
    for table in names:
        columns = SOURCES[table].fieldNames()
        with open(root / f"{table}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(columns)
            for row in ROWS[table]:
                # Only values that fit the declared types; bad ones have a test of their own.
                values = dict(row)
                for name, bad in (("payment_terms_days", "soon"), ("active", "no idea")):
                    if values.get(name) == bad:
                        values[name] = None
                writer.writerow([values.get(c) for c in columns])


def test_schemas_cover_fifteen_feeds():
    assert len(SOURCES) == 15
    assert all(KEYS[t] in schema.fieldNames() for t, schema in SOURCES.items())


def test_ingest_stamps_and_types(spark, tmp_path):
    write_files(tmp_path, ["purchase_orders"])
    df = ingest.ingest_csv(spark, str(tmp_path / "purchase_orders.csv"), "purchase_orders")
    assert df.count() == 3
    row = df.filter("po_id = 'PO001'").collect()[0]
    assert (str(row.po_date), row.total_value) == ("2024-01-15", 262500.0)
    assert row._source_file == "purchase_orders.csv"
    assert row._ingest_timestamp is not None


def test_corrupt_rows_are_split_off(spark, tmp_path):
    write_files(tmp_path, ["purchase_orders"])
    with open(tmp_path / "purchase_orders.csv", "a") as out:
        out.write("PO9,T,S,P,V,J,not-a-date\n")
    good, bad = ingest.corrupt_row_gate(
        spark, str(tmp_path / "purchase_orders.csv"), "purchase_orders"
    )
    assert (good.count(), bad.count()) == (3, 1)
    assert "not-a-date" in bad.collect()[0][ingest.CORRUPT]


def test_missing_file_fails_alone(spark, tmp_path):
    write_files(tmp_path, ["vendors", "projects"])
    loaded = ingest.ingest_all(spark, str(tmp_path), ["vendors", "projects", "materials"])
    audit = {r.table_name: r for r in ingest.load_audit(spark, loaded).collect()}
    assert audit["vendors"].status == "SUCCESS" and audit["vendors"].record_count == 3
    assert audit["materials"].status.startswith("FAILED: ") and audit["materials"].record_count == 0


def test_write_csv_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "materials.csv")
    ingest.write_csv(raw["materials"].drop("active"), path, "materials")
    names = {r.material_name for r in ingest.ingest_csv(spark, path, "materials").collect()}
    assert names == {"Steel Beam", " Concrete ", "Nothing"}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The pipeline run over files, in databases of its own."""
    root = tmp_path_factory.mktemp("raw")
    write_files(root)
    with open(root / "vendors.csv", "a") as out:
        out.write("V9,code,name,legal\n")
    tag = uuid.uuid4().hex[:8]
    names = {layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold")}
    warehouse = tmp_path_factory.mktemp("warehouse")
    for name in names.values():
        spark.sql(f"CREATE DATABASE {name} LOCATION '{warehouse}/{name}'")
    audit = pipeline.run_bronze(spark, str(root), names["bronze"]).collect()
    history = pipeline.run_silver(
        spark, "run-1", AS_OF, names["bronze"], names["silver"]
    ).collect()
    pipeline.run_gold(spark, AS_OF, CALENDAR, names["silver"], names["gold"])
    cubes = pipeline.run_cubes(spark, AS_OF, CALENDAR, names["gold"])
    return names, audit, history, cubes


def test_pipeline_audit_and_history(built):
    _, audit, history, _ = built
    counts = {r.table_name: (r.record_count, r.rejected_count, r.status) for r in audit}
    assert counts["vendors"] == (3, 1, "SUCCESS")
    assert len(counts) == 15 and all(c[2] == "SUCCESS" for c in counts.values())
    assert len(history) == 30
    failed = {(r.table_name, r.rule): r.failed for r in history}
    assert failed[("purchase_orders", "valid_vendor_ref")] == 1
    assert failed[("vendors", "valid_rating")] == 1


def test_pipeline_tables_equal_the_lazy_layers(spark, built, layers):
    names, _, _, cubes = built
    stored = tables.read_upper_layer(spark, names["gold"], "fact_purchase_orders")
    columns = [c for c in stored.columns if not c.startswith("_")]
    lazy = layers.gold("fact_purchase_orders")
    assert sorted(stored.select(*columns).collect()) == sorted(lazy.select(*columns).collect())
    assert spark.table("cube_vendor_risk").count() == 2
    for name, cube in cubes.items():
        assert cube.count() == layers.cube(name).count(), name


def test_facts_are_partitioned_by_month(spark, built):
    names = built[0]
    parts = spark.sql(f"SHOW PARTITIONS {names['gold']}.fact_purchase_orders").collect()
    assert {p.partition for p in parts} == {"_year_month=2024-01", "_year_month=2024-02"}


def test_edit_is_swapped_in_and_backed_up(spark, built):
    names = built[0]
    gold = names["gold"]
    tables.backup_tables(spark, gold, ["fact_invoices"], f"{gold}_backup")
    edit = edits.EDITS["A12"]
    before = spark.table(f"{gold}.fact_invoices")
    saved = edits.pre_image(before, edit).collect()
    tables.replace_table(spark, gold, "fact_invoices", edits.update_first_n(before, edit))
    after = {r.invoice_id: r.gross_amount for r in spark.table(f"{gold}.fact_invoices").collect()}
    assert after == {"I1": 138057.5, "I2": 575000.0}
    old = spark.createDataFrame(saved)
    restored = edits.revert_update(spark.table(f"{gold}.fact_invoices"), edit, old)
    tables.replace_table(spark, gold, "fact_invoices", restored)
    backup = spark.table(f"{gold}_backup.fact_invoices").select("invoice_id", "gross_amount")
    now = spark.table(f"{gold}.fact_invoices").select("invoice_id", "gross_amount")
    assert sorted(now.collect()) == sorted(backup.collect())


def test_written_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "FILE_ROWS", 40)
    path = tmp_path / "vendors.csv"
    rows = spark.range(100, numPartitions=1).selectExpr(
        "cast(id as string) AS vendor_id", "concat('  name, ', id, ' ') AS vendor_name"
    )
    ingest.write_csv(rows, str(path), "vendors")
    names = sorted(p.name for p in path.iterdir() if p.name.startswith("part-"))
    assert len(names) == 3 and all(n.endswith(".csv.gz") for n in names)
    good, bad = ingest.corrupt_row_gate(spark, str(path), "vendors")
    got = {(r.vendor_id, r.vendor_name) for r in good.collect()}
    assert got == {(str(i), f"  name, {i} ") for i in range(100)} and bad.isEmpty()


def test_tables_and_backups_are_written_in_zstd(spark, tmp_path):
    gold, backup = "zstd_gold", "zstd_backup"
    for name in (gold, backup):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    dated = spark.range(20).selectExpr("id AS sales_order_id", "date_add(DATE'2024-01-20', int(id)) AS order_date")
    tables.write_layer(dated, gold, "fact_sales")
    tables.write_layer(dated.drop("order_date"), gold, "fact_contracts")
    tables.backup_tables(spark, gold, ["fact_sales", "fact_contracts"], backup)
    for layer in (gold, backup):
        for name in ("fact_sales", "fact_contracts"):
            stored = tables.read_upper_layer(spark, layer, name)
            files = stored.inputFiles()
            assert files and all(f.endswith(".zstd.parquet") for f in files)
            assert sorted(r.sales_order_id for r in stored.collect()) == list(range(20))


def _held(folder) -> int:
    return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*") if p.is_file())


def test_shuffles_of_written_tables_go_at_once(spark, tmp_path, monkeypatch):
    # The driver's garbage collector may come first, so the setting of each write is looked at as well.
    name, seen, save = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda *a: (seen.append(spark.conf.get(name, "false")), save(*a))[1])
    for layer in ("tidy_gold", "tidy_backup"):
        spark.sql(f"CREATE DATABASE {layer} LOCATION '{tmp_path}/{layer}'")
    rows = spark.range(200_000).selectExpr(
        "concat(id, '-', hash(id)) AS sales_order_id", "date_add(DATE'2024-01-01', int(id % 300)) AS order_date"
    )
    blocks = pathlib.Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = _held(blocks)
    tables.write_layer(rows, "tidy_gold", "fact_sales")
    tables.backup_tables(spark, "tidy_gold", ["fact_sales"], "tidy_backup")
    until = time.time() + 20
    while _held(blocks) > before and time.time() < until:
        time.sleep(0.2)
    assert _held(blocks) <= before
    assert seen == ["true", "true"] and spark.conf.get(name, "false") == "false"
    stored = spark.table("tidy_backup.fact_sales")
    assert sorted(r.sales_order_id for r in stored.collect()) == sorted(r.sales_order_id for r in rows.collect())


def test_rows_of_a_written_file_are_ordered_by_key(spark, tmp_path):
    spark.sql(f"CREATE DATABASE ordered_gold LOCATION '{tmp_path}/ordered_gold'")
    rows = spark.range(300).selectExpr("id * 7919 % 300 AS sales_order_id", "DATE'2024-01-20' AS order_date")
    tables.write_layer(rows, "ordered_gold", "fact_sales")
    files = tables.read_upper_layer(spark, "ordered_gold", "fact_sales").inputFiles()
    for file in files:
        keys = [r.sales_order_id for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_landing_and_parsed_rows_are_written_without_leaving_shuffles(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    for kind in ("csv", "parquet"):
        save = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda *a, k=kind, s=save: (seen.append((k, spark.conf.get(name, "false"))), s(*a))[1])
    rows = spark.range(50).selectExpr("cast(id as string) AS vendor_id", "concat('n', id % 7) AS vendor_name").repartition(2)
    ingest.write_csv(rows, str(tmp_path / "vendors.csv"), "vendors")
    good, bad = ingest.corrupt_row_gate(spark, str(tmp_path / "vendors.csv"), "vendors")
    assert seen == [("csv", "true"), ("parquet", "true")] and spark.conf.get(name, "false") == "false"
    assert {(r.vendor_id, r.vendor_name) for r in good.collect()} == {(str(i), f"n{i % 7}") for i in range(50)} and bad.isEmpty()
