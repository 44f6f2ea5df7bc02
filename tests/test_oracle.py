"""A selection of registered queries against their SQL statements; tools/check_oracle.py runs all."""

from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import check_oracle  # noqa: E402

SELECTED = (
    "cube_procurement_spend cube_spend_by_sector cube_vendor_performance cube_vendor_risk "
    "cube_cost_variance cube_inventory_status cube_procurement_efficiency customer_ranking "
    "product_performance running_stock quarantine update_A01 scd2_dimension "
    "spend_concentration_material stream_fact_contracts"
).split()


@pytest.fixture(scope="module")
def duck(tiny):
    return check_oracle.connect(tiny)


def test_every_query_has_a_statement():
    """Document operators that SQL cannot express are tested against brute force instead."""
    registered = {q for q in entry_points.queries() if q != "pipeline" and not q.startswith("op")}
    assert registered <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", SELECTED)
def test_query_equals_sql(spark, tiny, duck, name):
    df = entry_points.queries()[name](spark, tiny)
    assert check_oracle.compare(df, duck, entry_points.oracle_sql()[name]) == []


def test_entry(spark, tiny):
    assert entry_points.entry(spark).count() > 0
