"""The same results when one order, one vendor and one customer hold a third of all rows."""

from __future__ import annotations

import pathlib
import shutil
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import check_oracle  # noqa: E402

SELECTED = (
    "cube_spend_by_sector cube_procurement_efficiency cube_vendor_risk cube_sales_analysis "
    "three_way_match customer_ranking silver_dedup stock_on_hand"
).split()


@pytest.fixture(scope="module")
def skewed(spark, tiny, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in pathlib.Path(tiny).glob("*.parquet"):
        if table.stem not in ("lineitem", "orders"):
            shutil.copy(table, folder / table.name)

    def hot(df, *columns):
        third = F.abs(F.xxhash64(*df.columns)) % 3 == 0
        return df.withColumns({c: F.when(third, F.lit(1)).otherwise(F.col(c)).cast("long")
                               for c in columns})

    lines = hot(spark.read.parquet(f"{tiny}/lineitem.parquet"), "l_orderkey", "l_suppkey")
    lines.write.parquet(str(folder / "lineitem.parquet"))
    orders = hot(spark.read.parquet(f"{tiny}/orders.parquet"), "o_custkey")
    orders.write.parquet(str(folder / "orders.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    import duckdb

    con = duckdb.connect()
    for t in check_oracle.TABLES:
        path = pathlib.Path(skewed) / f"{t}.parquet"
        pattern = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{pattern}')")
    return con


@pytest.mark.parametrize("name", SELECTED)
def test_hot_keys(spark, skewed, duck, name):
    df = entry_points.queries()[name](spark, skewed)
    assert check_oracle.compare(df, duck, entry_points.oracle_sql()[name]) == []
