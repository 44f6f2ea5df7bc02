"""Changes of stored tables: which partitions are rewritten, repetition, undoing, late and repeated changes."""

from __future__ import annotations

import pathlib
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import edits, facts
from tradeloom.operators.edits import Edit, set_to
from tradeloom.session import fresh_path
from tradeloom.sources import rewrite, tables
from tradeloom.streaming import merge, propagate

SCHEMA = "id int, day date, status string, v double"


def files(path):
    root = pathlib.Path(path.removeprefix("file:"))
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


@pytest.fixture
def orders(spark):
    """A stored fact with twelve months, one of them without a date."""
    rows = spark.range(600).selectExpr(
        "cast(id as int) AS po_id", "CASE WHEN id < 590 THEN date_add(DATE'2024-01-01', cast(id % 330 as int)) END AS po_date",
        "CASE WHEN id % 50 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS po_status", "cast(id as double) AS po_value",
    )
    gold = f"gold_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {gold} LOCATION '{fresh_path(spark, gold)}'")
    tables.write_layer(rows, gold, "fact_purchase_orders")
    return gold, rows


def now(spark, gold):
    return sorted(map(tuple, tables.read_upper_layer(spark, gold, "fact_purchase_orders").collect()), key=str)


def test_edit_rewrites_only_months_of_its_keys(spark, orders):
    gold, rows = orders
    edit = Edit("fact_purchase_orders", "po_id", 3, {"po_value": set_to(-1.0)}, "po_status = 'OPEN'")
    path = tables.location(spark, gold, "fact_purchase_orders")
    before, first = files(path), now(spark, gold)
    done = tables.edit_table(spark, gold, edit)
    after = files(path)
    assert done.partitions == ("2024-01", "2024-02", "2024-04") and done.rows == 3 and done.files == 3
    kept = {f for f in before if before[f] == after.get(f)}
    assert {f.split("/")[0] for f in set(before) - kept} == {f"_year_month={m}" for m in done.partitions}
    assert len(kept) == len(before) - 3
    assert now(spark, gold) == sorted(map(tuple, edits.update_first_n(rows, edit).collect()), key=str)
    # A later edit of other rows survives the undoing of the first one.
    later = Edit("fact_purchase_orders", "po_id", 1, {"po_status": set_to("HELD")}, "po_status = 'CLOSED'")
    tables.edit_table(spark, gold, later)
    tables.undo_change(spark, gold, "fact_purchase_orders", done)
    assert now(spark, gold) == sorted(map(tuple, edits.update_first_n(rows, later).collect()), key=str)
    assert first != now(spark, gold)
    # So does a later edit of another column of the same rows.
    done = tables.edit_table(spark, gold, edit)
    other = Edit("fact_purchase_orders", "po_id", 2, {"po_status": set_to("OPEN?")}, "po_status = 'OPEN'")
    tables.edit_table(spark, gold, other)
    tables.undo_edit(spark, gold, edit, done)
    want = edits.update_first_n(edits.update_first_n(rows, later), other)
    assert now(spark, gold) == sorted(map(tuple, want.collect()), key=str)


def test_merge_moves_rows_between_months(spark, orders):
    gold, rows = orders
    changes = spark.createDataFrame(
        [(0, "2025-03-01", "MOVED", 1.0, 1), (0, "2025-02-01", "MOVED", 2.0, 2), (595, "2024-01-09", "DATED", 3.0, 1), (900, None, "NEW", 4.0, 1)],
        "po_id int, po_date string, po_status string, po_value double, seq int",
    ).withColumn("po_date", F.col("po_date").cast("date"))
    done = tables.merge_table(spark, gold, "fact_purchase_orders", changes, "po_id", "seq")
    assert set(done.partitions) == {"2024-01", "2025-02", None}
    want = edits.upsert_merge(rows, changes.drop("seq").where("po_value <> 1.0"), "po_id")
    assert now(spark, gold) == sorted(map(tuple, want.collect()), key=str)


def test_a_month_that_loses_its_last_row_goes(spark):
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    rewrite.create(rows, path, "p")
    new = spark.createDataFrame([(1, "b"), (3, "b")], "id int, p string")
    done = rewrite.replace_rows(new, path, rows.schema, ["id"], "p", removed=spark.createDataFrame([(2,)], "id int"))
    got = rewrite.read_rows(spark, path, rows.schema)
    assert sorted(got.collect()) == [(1, "b"), (3, "b")] and done.rows == 3
    rewrite.undo(spark, done)
    assert sorted(map(tuple, rewrite.read_rows(spark, path, rows.schema).collect())) == [(1, "a"), (2, "b"), (3, None)]


def test_a_change_that_broke_off_is_published_from_its_folder(spark, monkeypatch):
    path, folder = fresh_path(spark, "t"), fresh_path(spark, "change")
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, p string, v int")
    rewrite.create(rows, path, "p")

    def fail(*args):
        raise RuntimeError("executor lost")

    new = spark.createDataFrame([(1, "a", 2)], rows.schema)
    with monkeypatch.context() as patched:
        patched.setattr(rewrite, "publish", fail)
        with pytest.raises(RuntimeError):
            rewrite.replace_rows(new, path, rows.schema, ["id"], "p", folder=folder)
    # The second attempt gets other rows, but the recorded ones count.
    other = spark.createDataFrame([(1, "a", 3)], rows.schema)
    rewrite.replace_rows(other, path, rows.schema, ["id"], "p", folder=folder)
    got = rewrite.read_rows(spark, path, rows.schema).select(*rows.columns)
    assert sorted(got.collect()) == [(1, "a", 2), (2, "b", 1)]


CHANGES = "id int, v string, _sequence long, _deleted boolean, p string"


def test_merge_in_any_order_with_repeats(spark):
    rng = random.Random(4)
    changes = [(rng.randrange(30), f"v{s}", s, rng.random() < 0.2) for s in range(120)]
    last = {}
    for change in changes:
        last[change[0]] = change
    want = sorted((k, c[1]) for k, c in last.items() if not c[3])
    rows = [(*c, str(c[0] % 4)) for c in changes]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        path = fresh_path(spark, "merged")
        schema = spark.createDataFrame([], CHANGES).schema
        merge.create_empty(spark, path, schema, "p")
        for k in range(4):
            part = spark.createDataFrame(rows[k * 30 : (k + 1) * 30] + rows[:3], CHANGES)
            merge.merge_batch(part, path, schema, ["id"], "p", f"{path}-batches/{k}")
        done = merge.merge_batch(part, path, schema, ["id"], "p", f"{path}-batches/9")
        assert done.partitions == () and done.rows == 0
        got = merge.live(rewrite.read_rows(spark, path, schema)).drop("p")
        assert sorted(map(tuple, got.collect())) == want


def test_repeated_batch_changes_nothing(spark):
    path = fresh_path(spark, "merged")
    one = spark.createDataFrame([(1, "a", 1, False, "x")], CHANGES)
    merge.create_empty(spark, path, one.schema, "p")
    merge.merge_batch(one, path, one.schema, ["id"], "p", f"{path}-batches/0")
    before = files(path)
    merge.merge_batch(one, path, one.schema, ["id"], "p", f"{path}-batches/0")
    assert files(path) == before


def test_stream_of_changes(spark):
    source, path, state = (fresh_path(spark, n) for n in ("source", "merged", "state"))
    batches = [[(1, "a", 1, False, "x"), (2, "b", 1, False, "y")], [(1, "c", 3, False, "x")], [(1, "late", 2, False, "x"), (2, "b", 2, True, "y")]]
    for rows in batches:
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(source)
    schema = spark.createDataFrame([], CHANGES).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    merge.stream_merge(stream, path, ["id"], "p", state)
    merge.stream_merge(stream, path, ["id"], "p", state)
    assert merge.live(rewrite.read_rows(spark, path, schema)).collect() == [(1, "c", "x")]


# ---- propagation -------------------------------------------------------------------------------

ORDER = "po_id int, _sequence long, po_date date"
LINE = "line_id string, po_id int, line_value double, qty_ordered double, _sequence long, _deleted boolean"


def maintained(spark, view, parents, children):
    root = fresh_path(spark, "fact")
    return propagate.MaintainedFact(spark, view, root, parents, children), root


def small_view():
    def assemble(parents, totals):
        return parents.join(totals, "po_id", "left").select("po_id", "po_date", "line_total", "largest", "n")

    return propagate.FactView(
        "o", "po_id", "po_date", "po_date", "l", "line_id", {"po_id": "po_id"}, assemble,
        sums={"line_total": "line_value"}, counts={"n": "line_value"}, maxima={"largest": "qty_ordered"},
    )


def test_late_changed_and_deleted_lines_correct_the_fact(spark):
    rng = random.Random(8)
    orders = spark.createDataFrame([(i, 1, None) for i in range(12)], ORDER).withColumn("po_date", F.expr("date_add(DATE'2024-01-10', po_id * 31)"))
    log, state = [], {}
    for s in range(160):
        line, value = f"l{rng.randrange(40)}", rng.choice([None, *range(100)])
        change = (line, rng.randrange(12), None if value is None else value / 4, float(rng.randrange(9)), s, rng.random() < 0.15)
        log.append(change)
        state[line] = change
    view = small_view()
    tables_, root = maintained(spark, view, orders.schema, spark.createDataFrame([], LINE).schema)
    rng.shuffle(log)
    for k in range(4):
        lines = spark.createDataFrame(log[k * 40 : (k + 1) * 40], LINE)
        part = orders.where(F.col("po_id") % 4 == (k + 2) % 4)
        for _ in range(2 if k == 1 else 1):  # one batch twice
            tables_.apply(part, lines, f"{root}-batches/{k}")
    want = []
    for i in range(12):
        own = [x for x in state.values() if x[1] == i and not x[5]]
        sums = [x[2] for x in own if x[2] is not None]
        want.append((i, sum(sums) if sums else None, max((x[3] for x in own), default=None), len(sums) if own else None))
    got = tables_.fact().select("po_id", "line_total", "largest", "n")
    assert sorted(map(tuple, got.collect())) == want


def test_only_months_of_the_parents_are_rewritten(spark):
    orders = spark.createDataFrame([(i, 1, None) for i in range(12)], ORDER).withColumn("po_date", F.expr("date_add(DATE'2024-01-10', po_id * 31)"))
    none = spark.createDataFrame([], LINE)
    tables_, root = maintained(spark, small_view(), orders.schema, none.schema)
    first = tables_.apply(orders, none, f"{root}-batches/0")
    assert len(first.partitions) == 12
    before = files(f"{root}/fact")
    late = spark.createDataFrame([("a", 3, 5.0, 1.0, 1, False), ("b", 3, 5.0, 1.0, 1, False), ("c", 7, 1.0, 1.0, 1, False)], LINE)
    done = tables_.apply(orders.limit(0), late, f"{root}-batches/1")
    assert done.partitions == ("2024-04", "2024-08") and done.rows == 2
    after = files(f"{root}/fact")
    assert {f.split("/")[0] for f in after if before.get(f) != after[f]} == {f"_year_month={m}" for m in done.partitions}


def test_broken_off_batch_continues(spark, monkeypatch):
    orders = spark.createDataFrame([(1, 1, None)], ORDER).withColumn("po_date", F.expr("DATE'2024-01-10'"))
    lines = spark.createDataFrame([("a", 1, 5.0, 1.0, 1, False)], LINE)
    more = spark.createDataFrame([("a", 1, 7.0, 1.0, 2, False), ("b", 1, 1.0, 1.0, 2, False)], LINE)
    tables_, root = maintained(spark, small_view(), orders.schema, lines.schema)
    tables_.apply(orders, lines, f"{root}-batches/0")
    whole = rewrite.replace_rows
    for step in ("totals", "fact"):

        def fail(*args, folder=None, **kwargs):
            if folder.endswith(step):
                raise RuntimeError(step)
            return whole(*args, folder=folder, **kwargs)

        with monkeypatch.context() as patched:
            patched.setattr(propagate.rewrite, "replace_rows", fail)
            with pytest.raises(RuntimeError):
                tables_.apply(orders.limit(0), more, f"{root}-batches/1")
    tables_.apply(orders.limit(0), more, f"{root}-batches/1")
    assert tables_.fact().select("line_total", "n").collect() == [(8.0, 2)]


@pytest.mark.parametrize("table", ["fact_project_costs", "fact_contracts", "fact_sales"])  # the others are registered queries
def test_maintained_facts_equal_batch(spark, layers, table):
    view = propagate.receipts_view(layers.silver("purchase_orders")) if table == "fact_goods_receipts" else propagate.VIEWS[table]
    parents = layers.silver(view.parent).withColumn("_sequence", F.lit(1).cast("long"))
    children = layers.silver(view.child).withColumn("_sequence", F.lit(2).cast("long"))
    stale = children.withColumn("_sequence", F.lit(1).cast("long"))
    for column in [*view.sums.values(), *view.maxima.values()]:
        if dict(stale.dtypes)[column] == "double":
            stale = stale.withColumn(column, F.col(column) * 3 + 1)
    tables_, root = maintained(spark, view, parents.schema, children.schema)
    tables_.apply(parents, stale, f"{root}-batches/0")
    tables_.apply(parents.limit(0), children, f"{root}-batches/1")
    names = sorted(n for n in layers.gold(table).columns if not n.endswith("_timestamp"))
    rows = [sorted(map(str, df.select(*names).collect())) for df in (tables_.fact(), layers.gold(table))]
    assert rows[0] == rows[1] and facts.AGING_BUCKETS


def test_a_dated_read_prunes_months(spark, orders):
    gold, rows = orders
    period = tables.between(spark, gold, "fact_purchase_orders", "2024-02-20", "2024-03-05")
    plan = period._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_year_month" in filters and "2024-02" in filters and "2024-03" in filters
    read = {f.split("_year_month=")[1][:7] for f in (r[0] for r in period.select("_metadata.file_path").distinct().collect())}
    assert read == {"2024-02", "2024-03"}
    want = rows.where("po_date BETWEEN '2024-02-20' AND '2024-03-05'")
    assert sorted(period.collect()) == sorted(want.collect())


def test_a_filtered_calendar_prunes_months(spark, orders):
    gold, rows = orders
    fact = spark.read.table(tables.full_name(gold, "fact_purchase_orders"))
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS date").where("month(date) = 5")
    joined = tables.join_on_month(fact, days, "po_date")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    assert joined.count() == rows.where("month(po_date) = 5").count()


def test_stored_rows_are_not_copied_and_children_keep_what_a_view_reads(spark):
    path, at = fresh_path(spark, "t"), fresh_path(spark, "rows")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "b")], "id int, p string")
    rewrite.create(rows, path, "p")
    spark.createDataFrame([(1, "b")], rows.schema).write.parquet(at)
    done = rewrite.replace_rows(rows, path, rows.schema, ["id"], "p", rows_at=at)
    assert not rewrite.exists(spark, f"{done.folder}/rows") and done.rows == 1
    assert [tuple(r) for r in rewrite.before(spark, done).collect()] == [(1, "a")]
    rewrite.undo(spark, done)
    assert sorted(map(tuple, rewrite.read_rows(spark, path, rows.schema).collect()), key=str) == [(1, "a"), (2, "b"), (None, "b")]
    parents = "po_id int, vendor_id int, project_id int, po_date date, delivery_date date, approval_date date, po_value double, "
    parents += "tax_amount double, total_value double, po_status string, po_type string, priority string, currency string, "
    parents = spark.createDataFrame([], parents + "payment_terms string, _sequence long")
    children = spark.createDataFrame([], "line_id string, po_id int, line_value double, qty_ordered double, note string, _sequence long")
    view = propagate.VIEWS["fact_purchase_orders"]
    held = propagate.MaintainedFact(spark, view, fresh_path(spark, "fact"), parents.schema, children.schema)
    assert held.table("children").columns == ["line_id", "po_id", "line_value", "qty_ordered", "_sequence", rewrite.BUCKET]


def test_covered_rows_are_written_once_where_they_are_staged(spark):
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1), (4, "c", 1), (None, "b", 1)], "id int, p string, v int")
    rewrite.create(rows, path, "p")
    # 1 moves, 2 changes, 3 and 4 go, 5 is new, 6 was never there.
    new = spark.createDataFrame([(1, None, 2), (2, "b", 2), (5, "d", 2)], rows.schema)
    removed = spark.createDataFrame([(i,) for i in range(1, 7)], "id int")
    done = rewrite.replace_rows(new, path, rows.schema, ["id"], "p", removed=removed, covered=True)
    assert not rewrite.exists(spark, f"{done.folder}/rows") and done.rows == 4
    assert set(done.partitions) == {"a", "b", "c", "d", None} and set(done.emptied) == {"a", "c"}
    now = [tuple(r) for r in rewrite.read_rows(spark, path, rows.schema).select("id", "p", "v").collect()]
    assert sorted(now, key=str) == sorted([(1, None, 2), (2, "b", 2), (5, "d", 2), (None, "b", 1)], key=str)
    rewrite.undo(spark, done)
    now = [tuple(r) for r in rewrite.read_rows(spark, path, rows.schema).select("id", "p", "v").collect()]
    assert sorted(now, key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_a_partition_that_follows_from_the_key_is_not_looked_up(spark):
    path = fresh_path(spark, "t")
    rows = spark.range(40).selectExpr("cast(id as int) AS id", "1 AS v").withColumn(rewrite.BUCKET, rewrite.bucket_of(["id"], 4))
    rewrite.create(rows, path, rewrite.BUCKET)
    new = rows.where("id < 10").withColumn("v", F.lit(2)).unionByName(rows.where("id < 3").withColumn("id", F.col("id") + 100))
    new = new.withColumn(rewrite.BUCKET, rewrite.bucket_of(["id"], 4))
    done = rewrite.replace_rows(new, path, rows.schema, ["id"], rewrite.BUCKET, by_key=True)
    got = rewrite.read_rows(spark, path, rows.schema)
    assert done.rows == 10 and rewrite.before(spark, done).count() == 10
    want = [(i, 2 if i < 10 else 1) for i in range(40)] + [(100 + i, 1) for i in range(3)]
    assert sorted(map(tuple, got.select("id", "v").collect())) == sorted((i, v) for i, v in want)


def test_changes_meet_held_rows_before_they_are_reduced(spark):
    held = spark.createDataFrame([(1, "a", 3), (2, "b", 1), (None, "c", 9)], "id int, v string, _sequence long")
    changes = [(1, "old", 2), (1, "same", 3), (2, "x", 2), (2, "y", 4), (3, "n", 1), (None, "m", 1), (None, "k", 2)]
    changes = spark.createDataFrame(changes, held.schema)
    found = merge.newer(changes, held, ["id"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(2, "y", 4), (3, "n", 1), (None, "k", 2)], key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join")


def test_totals_without_maxima_are_stored_once(spark):
    orders = "po_id int, vendor_id int, project_id int, po_date date, delivery_date date, approval_date date, po_value double, "
    orders += "tax_amount double, total_value double, po_status string, po_type string, priority string, currency string, "
    orders += "payment_terms string, _sequence long"
    columns = ", ".join(f"cast(null as {n.split()[1]}) AS {n.split()[0]}" for n in orders.split(", ")[1:-1])
    parents = spark.range(3).selectExpr("cast(id as int) AS po_id", *columns.split(", "), "1L AS _sequence")
    lines = spark.createDataFrame([("a", 1, 5.0, 2.0, 1), ("b", 1, 7.0, 1.0, 1), ("c", 2, None, 1.0, 1)], "line_id string, po_id int, line_value double, qty_ordered double, _sequence long")
    held, root = maintained(spark, propagate.VIEWS["fact_purchase_orders"], parents.schema, lines.schema)
    held.apply(parents, lines, f"{root}-batches/0")
    assert not rewrite.exists(spark, f"{root}-batches/0/moved")
    got = held.fact().select("po_id", "line_total", "total_quantity").collect()
    assert sorted(map(tuple, got)) == [(0, 0.0, 0.0), (1, 12.0, 3.0), (2, 0.0, 1.0)]


def test_a_batch_keeps_one_copy_of_its_fact_rows(spark):
    orders = spark.createDataFrame([(i, 1, None) for i in (1, 2, 3, None)], ORDER).withColumn("po_date", F.expr("DATE'2024-01-10'"))
    lines = spark.createDataFrame([("a", 1, 5.0, 1.0, 1, False)], LINE)
    more = spark.createDataFrame([("b", 2, 7.0, 1.0, 2, False)], LINE)
    tables_, root = maintained(spark, small_view(), orders.schema, lines.schema)
    tables_.apply(orders, lines, f"{root}-batches/0")
    tables_.apply(orders.limit(0), more, f"{root}-batches/1")
    assert not rewrite.exists(spark, f"{root}-batches/0/fact/rows")
    keys = spark.read.parquet(f"{root}-batches/1/fact/removed").collect()
    assert [r.po_id for r in keys] == [2]
    got = tables_.fact().select("po_id", "line_total", "n").collect()
    assert sorted(map(tuple, got)) == [(1, 5.0, 1), (2, 7.0, 1), (3, None, None)]
