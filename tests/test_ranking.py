"""The bucketed ranks against the definition, including ties, negatives and NULL."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.functions.ranking import order_bucket, ordered_totals, with_rank

MONEY = st.one_of(
    st.none(),
    st.integers(-50, 50).map(lambda n: n / 100),
    st.integers(-(10**14), 10**14).map(lambda n: n / 100),
)


def expected(rows, dense):
    out = []
    for group, value in rows:
        peers = [v for g, v in rows if g == group]
        if value is None:
            better = [v for v in peers if v is not None]
        else:
            better = [v for v in peers if v is not None and v > value]
        out.append((group, value, (len(set(better)) if dense else len(better)) + 1))
    return sorted(out, key=str)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), MONEY), min_size=1, max_size=30))
def test_rank_equals_definition(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    for dense in (False, True):
        got = with_rank(df, ["g"], "v", "r", dense=dense).collect()
        assert sorted([tuple(r) for r in got], key=str) == expected(rows, dense)


def test_global_rank_with_a_hot_value(spark):
    rng = random.Random(7)
    rows = [("x", 50.0)] * 300 + [("x", rng.randint(-10**6, 10**6) / 100) for _ in range(600)]
    df = spark.createDataFrame(rows, "g string, v double")
    order = Window.orderBy(F.desc("v"))
    plain = df.withColumn("r", F.rank().over(order)).collect()
    assert sorted(with_rank(df, [], "v", "r").collect()) == sorted(plain)


def test_bucket_is_monotone(spark):
    values = sorted({s * m * 10.0**e for s in (-1, 1) for m in (1, 1.004, 3.7) for e in range(-9, 16)} | {0.0})
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [r.b for r in rows.select("v", order_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_running_total(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (2.0,), (9.5,)], "v double")
    got = {r.v: (r._rank, r._running) for r in ordered_totals(df, [], "v", measure="v").collect()}
    assert got == {9.5: (1, 9.5), 5.0: (2, 19.5), 2.0: (4, 21.5)}
