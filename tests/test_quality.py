"""Expectations, quarantine, de-duplication and the integrity checks with planted violations."""

from __future__ import annotations

import pytest

from tradeloom.operators import integrity, quality, silver
from tradeloom.operators.quality import FAIL, Rule
from tradeloom.plans.layers import CUBES, STAR_CONTRACT


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, 5.0), (2, -1.0), (3, None), (None, 4.0)], "id int, score double"
    )


RULES = [Rule("has_id", "id IS NOT NULL"), Rule("positive", "score > 0", quality.WARN)]


def test_drop_removes_unknown_and_warn_does_not_count_it(rows):
    checked = quality.check(rows, RULES, "t")
    assert {r.id for r in checked.good.collect()} == {1, 2, 3}
    assert [(r.id, r.failed_rules) for r in checked.quarantined.collect()] == [(None, ["has_id"])]
    metrics = {r.rule: (r.action, r.violations, r.checked_rows) for r in checked.metrics.collect()}
    assert metrics == {"has_id": ("drop", 1, 4), "positive": ("warn", 1, 4)}


def test_drop_on_unknown_condition(rows):
    kept = quality.expect_or_drop(rows, [Rule("positive", "score > 0")])
    assert sorted(r.score for r in kept.collect()) == [4.0, 5.0]


def test_warn_observes_while_rows_flow(rows):
    watched, seen = quality.expect_warn(rows, RULES)
    assert watched.count() == 4
    assert quality.observed_metrics(seen, RULES) == [
        ("has_id", "id IS NOT NULL", "drop", 1, 4),
        ("positive", "score > 0", "warn", 1, 4),
    ]


def test_fail_aborts_and_passes(rows):
    assert quality.expect_or_fail(rows, [Rule("any", "1 = 1", FAIL)]).count() == 4
    with pytest.raises(Exception, match="expectation failed: rule='positive'"):
        quality.expect_or_fail(rows, [Rule("positive", "score > 0", FAIL)]).collect()


def test_dq_history(rows):
    metrics = quality.expectation_metrics(rows, RULES, "t")
    history = {r.rule: (r.run_id, r.passed, r.failed)
               for r in quality.dq_metrics(metrics, "r1").collect()}
    assert history == {"has_id": ("r1", 3, 1), "positive": ("r1", 3, 1)}


def test_deduplicate_keeps_the_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only")],
        "k string, loaded int, v string",
    )
    assert {(r.k, r.v) for r in quality.deduplicate(df, ["k"], ["loaded"]).collect()} == {
        ("a", "new"), ("b", "only")
    }


def test_quarantine_of_every_feed(layers):
    for table in silver.JOBS:
        checked = silver.cleanse_checked(table, layers.raw(table), layers.as_of)
        assert checked.good.count() == 2
        assert checked.quarantined.count() == 1


def test_unique_and_row_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert [(r.id, r.copies) for r in integrity.check_unique(df, "id").collect()] == [(1, 2)]
    assert integrity.check_row_count(df, 3).count() == 0
    assert integrity.check_row_count(df, 4).collect()[0].row_count == 3


def test_row_balance(spark):
    """Lost, multiplied and set-aside rows; equal counts on both sides hold, also of empty tables."""
    rows = spark.range(10)
    want = [
        (rows.limit(7), rows.limit(3), (10, 7, 3, 0, True)),
        (rows.limit(7), rows.limit(2), (10, 7, 2, 1, False)),
        (rows.union(rows), rows.limit(0), (10, 20, 0, -10, False)),
    ]
    for kept, rejected, numbers in want:
        assert [tuple(r) for r in integrity.row_balance(rows, kept, rejected, "t").collect()] == [("t", *numbers)]
    none = rows.limit(0)
    assert [tuple(r) for r in integrity.row_balance(none, none, none, "t").collect()] == [("t", 0, 0, 0, 0, True)]


def test_value_checks(spark):
    df = spark.createDataFrame(
        [("A", 10.0, 10.0), ("B", 20.0, 20.5), (None, None, 1.0)], "k string, v double, w double"
    )
    assert integrity.check_accepted_values(df, "k", ["A"]).count() == 2
    assert integrity.check_range(df, "v", 5, 15).count() == 2
    assert integrity.check_conditional(df, "k = 'A'", "v > 10").count() == 1
    assert integrity.check_row_arithmetic(df, "v", "w", 0.1).count() == 1
    assert integrity.check_share(df, "k = 'A'", 0.1, 0.2).count() == 1
    assert integrity.check_share(df, "k = 'A'", 0.1, 0.5).count() == 0


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 7), (2, 8)], "id int, parent int")
    parent = spark.createDataFrame([(7,)], "pid int")
    assert [r.id for r in integrity.check_foreign_key(child, "parent", parent, "pid").collect()] == [2]


def test_sign_label_and_business_rules(spark, layers):
    moves = spark.createDataFrame(
        [("RECEIPT", 1.0), ("RECEIPT", -1.0), ("ISSUE", 1.0), ("ADJUST", -1.0)],
        "kind string, q double",
    )
    assert integrity.check_sign(moves, "kind", "q").count() == 2
    scores = spark.createDataFrame([(80.0, "PREFERRED"), (79.9, "PREFERRED")], "s double, l string")
    assert integrity.check_threshold_label(scores, "s", "l").count() == 1
    found = {r.rule: r.violations
             for r in integrity.check_business_rules(layers.silver).collect()}
    assert len(found) == 11 and found["posted_has_invoice"] == 1


def test_cancelled_lines(spark):
    orders = spark.createDataFrame([(1, "CANCELLED"), (2, "OPEN")], "po_id int, po_status string")
    lines = spark.createDataFrame([(1, 0.0), (1, 3.0), (2, 3.0)], "po_id int, qty_received double")
    assert integrity.check_cancelled_lines(lines, orders).count() == 1


def test_layer_contract(layers):
    row = integrity.layer_contract(
        layers.raw("vendors"), layers.silver("vendors"), "vendor_id", "vendors"
    ).collect()[0]
    assert (row.lower_rows, row.upper_rows, row.null_keys, row.holds) == (3, 2, 0, True)
    assert integrity.missing_columns(layers.raw("vendors"), layers.silver("vendors")) == []


def test_star_contract(spark, layers):
    for table, (source, key, columns) in STAR_CONTRACT.items():
        row = integrity.star_contract(layers.silver(source), layers.gold(table), key, columns.split(), table).collect()[0]
        assert row.holds and row.missing_columns == "" and row.upper_rows == row.lower_rows, table
    lower = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    upper = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    row = integrity.star_contract(lower, upper, "k", ["v", "w", "a"], "t").collect()[0]
    assert tuple(row) == ("t", 3, 4, 2, 1, "a w", False)
    row = integrity.star_contract(lower, upper.select("v"), "k", [], "t").collect()[0]
    assert (row.null_keys, row.repeated_keys, row.missing_columns, row.holds) == (4, 0, "k", False)
    row = integrity.star_contract(lower, upper.limit(0), "k", ["v"], "t").collect()[0]
    assert tuple(row) == ("t", 3, 0, 0, 0, "", True)


def test_cubes_read_only_what_the_star_promises(spark, layers):
    """Every cube resolves on tables cut down to the columns of their contract."""

    class Narrow:
        as_of = layers.as_of

        def gold(self, table):
            if table not in STAR_CONTRACT:
                return layers.gold(table)
            _, key, columns = STAR_CONTRACT[table]
            return layers.gold(table).select(key, *columns.split())

    for name, cube in CUBES.items():
        assert cube(Narrow()).columns == layers.cube(name).columns, name


def test_reference_counts(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (8,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    got = integrity.reference_counts(child, "k", parent, "k", "t").collect()
    assert [tuple(r) for r in got] == [("t", "k", 1, 2, 3)]
    got = integrity.reference_counts(child.limit(0), "k", parent, "k", "t").collect()
    assert [tuple(r) for r in got] == [("t", "k", 0, 0, 0)]
