"""Stock ledger, table digests, nested listings, history of quality runs."""

from __future__ import annotations

import datetime as dt
import random
import uuid

from pyspark.sql import functions as F

from tradeloom.operators import commerce, digest, ledger, quality
from tradeloom.plans import pipeline
from tradeloom.session import fresh_path

VERSION = "kind string, document_id long, version long, product_id long, date date, quantity long, deleted boolean"


def apply(spark, path, rows):
    held = spark.read.schema(ledger.MOVEMENT).parquet(path)
    ledger.new_movements(held, spark.createDataFrame(rows, VERSION)).write.mode("append").parquet(path)


def test_any_order_of_versions_gives_the_balance_of_a_rebuild(spark):
    rng = random.Random(6)
    versions = {}
    for document in range(12):
        for version in range(1, rng.randrange(2, 5)):
            deleted = rng.random() < 0.25
            day = dt.date(2024, 1, 1 + rng.randrange(20))
            items = {p: rng.randrange(1, 9) for p in rng.sample(range(5), rng.randrange(1, 4))}
            versions[document, version] = [("sale", document, version, p, day, -q, deleted) for p, q in items.items()]
    last = {d: max(v for x, v in versions if x == d) for d, _ in versions}
    want = {}
    for d, v in last.items():
        for _, _, _, product, day, quantity, deleted in versions[d, v]:
            if not deleted:
                want[product, day] = want.get((product, day), 0) + quantity
    order = sorted(versions)
    rng.shuffle(order)
    path = fresh_path(spark, "ledger")
    spark.createDataFrame([], ledger.MOVEMENT).write.parquet(path)
    third = len(order) // 3 + 1
    for k in range(3):
        part = order[k * third : (k + 1) * third] + order[:2]
        apply(spark, path, [row for key in dict.fromkeys(part) for row in versions[key]])
    rows = spark.read.schema(ledger.MOVEMENT).parquet(path)
    totals = {}
    for (product, _), quantity in want.items():
        totals[product] = totals.get(product, 0) + quantity
    got = {r.product_id: r.on_hand for r in ledger.balance(rows).collect()}
    assert {p: q for p, q in got.items() if q} == {p: q for p, q in totals.items() if q}
    for day in (dt.date(2024, 1, 5), dt.date(2024, 1, 12)):
        until = {r.product_id: r.on_hand for r in ledger.balance(rows, until=str(day)).collect()}
        some = {}
        for (product, at), quantity in want.items():
            if at <= day:
                some[product] = some.get(product, 0) + quantity
        assert {p: q for p, q in until.items() if q} == {p: q for p, q in some.items() if q}
    running = {(r.product_id, r.date): r.on_hand for r in ledger.running_balance(rows).collect()}
    for (product, day), on_hand in running.items():
        assert on_hand == sum(q for (p, at), q in want.items() if p == product and at <= day)


def test_deletion_writes_the_reversal(spark):
    path = fresh_path(spark, "ledger")
    spark.createDataFrame([], ledger.MOVEMENT).write.parquet(path)
    day = dt.date(2024, 1, 1)
    apply(spark, path, [("sale", 1, 1, 7, day, -3, False)])
    apply(spark, path, [("sale", 1, 2, 7, day, 0, True)])
    rows = spark.read.schema(ledger.MOVEMENT).parquet(path).where("product_id IS NOT NULL")
    assert sorted((r.version, r.quantity, r.reversal) for r in rows.collect()) == [(1, -3, False), (2, 3, True)]
    assert ledger.balance(rows, known_at=1).first().on_hand == -3


def test_digest_is_free_of_order_and_sees_swapped_columns(spark):
    rows = [(i, f"n{i % 7}", i / 4, None if i % 5 else dt.date(2024, 1, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, name string, v double, d date")
    mixed = spark.createDataFrame(rows[::-1], df.schema).repartition(7)
    assert digest.table_digest(df).first() == digest.table_digest(mixed.select("d", "v", "id", "name")).first()
    two = spark.createDataFrame([(i, i * 3 % 11) for i in range(50)], "a long, b long")
    swapped = two.select(F.col("b").alias("a"), F.col("a").alias("b"))
    assert digest.table_digest(two).first() != digest.table_digest(swapped).first()
    assert digest.table_digest(df.union(df.limit(1))).first() != digest.table_digest(df).first()
    changed = df.withColumn("v", F.when(F.col("id") == 3, 0.0).otherwise(F.col("v")))
    got = {r.table_name: r.same for r in digest.differences({"a": (df, mixed), "b": (df, changed), "c": (df, df.drop("d"))}).collect()}
    assert got == {"a": True, "b": False, "c": False}
    assert tuple(digest.table_digest(df.limit(0)).first()) == (0, "0")


def test_nested_listing_has_one_row_per_document(spark):
    sale = spark.sql("SELECT id, DATE'2024-01-01' AS date, 1L AS customer_id, 5.0D AS total, 's' AS status, 'n' AS notes FROM range(30)")
    item = spark.sql("SELECT id, id % 20 AS sale_id, 1L AS product_id, 2 AS quantity, 1.5D AS unit_price FROM range(90)")
    product, customer = spark.sql("SELECT 1L AS id, 'p' AS name"), spark.sql("SELECT 1L AS id, 'c' AS name")
    flat = commerce.sales_listing(sale, item, product, customer, size=15)
    rows = commerce.nested(flat).collect()
    assert [r.id for r in rows] == list(range(29, 14, -1))
    assert [len(r["items"]) for r in rows] == [0] * 10 + [4] * 5
    assert [x.item_id for x in rows[-1]["items"]] == [15, 35, 55, 75]


def test_repeated_run_replaces_its_metrics(spark):
    database = f"q_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_path(spark, database)}'")
    table = f"{database}.dq_metrics"

    def run(name, failed, day):
        rows = spark.createDataFrame([("t", "r", "c", "warn", failed, 100)], "table_name string, rule string, condition string, action string, violations long, checked_rows long")
        return pipeline.record_metrics(quality.dq_metrics(rows, name, F.lit(day).cast("timestamp")), name, table)

    run("it's 1", 5, "2024-01-01")
    run("run 2", 50, "2024-01-02")
    history = run("run 2", 9, "2024-01-02")
    assert sorted((r.run_id, r.failed) for r in history.collect()) == [("it's 1", 5), ("run 2", 9)]
    assert [(r.before_share, r.failed_share, r.verdict) for r in quality.drift(history, "run 2").collect()] == [(0.05, 0.09, "WORSE")]
    assert quality.drift(history, "it's 1").first().verdict == "NEW"


def test_a_batch_of_movements_costs_one_exchange_by_document(spark):
    held = spark.createDataFrame([("sale", 1, 1, 7, dt.date(2024, 1, 1), 5, False)], ledger.MOVEMENT)
    rows = [("sale", 1, 2, 7, dt.date(2024, 1, 1), 5, False), ("sale", None, 1, 7, None, 1, False), ("sale", 2, 1, None, None, 0, True)]
    moves = ledger.new_movements(held, spark.createDataFrame(rows, VERSION))
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4
    assert sorted(map(tuple, moves.collect()), key=str) == sorted([
        ("sale", 1, 2, None, None, 0, False), ("sale", 2, 1, None, None, 0, False), ("sale", None, 1, None, None, 0, False),
    ], key=str)
