"""Expectations observed on streams: batch = stream, lost progress, repeats, fail rules."""

from __future__ import annotations

import pytest

from known import AS_OF
from tradeloom.operators import quality, silver
from tradeloom.operators.quality import Rule
from tradeloom.plans import queries
from tradeloom.session import fresh_path
from tradeloom.streaming import jobs as streams
from tradeloom.streaming import observed

RULES = [Rule("has_id", "id IS NOT NULL"), Rule("small", "v < 90"), Rule("even", "v % 2 = 0", quality.WARN)]


def folders(spark):
    return tuple(fresh_path(spark, n) for n in ("feed", "rows", "counts", "state"))


def arrive(spark, feed, rows, files=1):
    df = spark.createDataFrame(rows, "id long, v int")
    df.repartition(files).write.mode("append").parquet(feed)
    return streams.stream_parquet(spark, feed, df, max_files=1)


def sample(n):
    return [(None if i % 7 == 0 else i, None if i % 11 == 0 else i) for i in range(n)]


def expected(spark, rows, rules=RULES):
    df = spark.createDataFrame(rows, "id long, v int")
    return sorted(tuple(r) for r in quality.expectation_metrics(df, rules, "t").collect())


def counted(spark, counts):
    return sorted(tuple(r) for r in observed.totals(spark, counts).collect())


def test_stream_quality(spark, raw):
    table = "vendor_performance"
    feed, rows, counts, state = folders(spark)
    raw[table].repartition(2).write.parquet(feed)
    stream = silver.JOBS[table](streams.stream_parquet(spark, feed, raw[table], max_files=1), AS_OF)
    observed.stream_dq(stream, silver.RULES[table], table, rows, counts, state)
    assert observed.good_rows(spark, rows).count() == 2
    rejected = observed.quarantined_rows(spark, rows).collect()
    assert [r.failed_rules for r in rejected] == [["valid_vendor_ref"]]
    seen = {r.rule: (r.checked_rows, r.violations) for r in observed.totals(spark, counts).collect()}
    assert seen == {"valid_performance_id": (3, 0), "valid_vendor_ref": (3, 1)}


def test_counts_equal_batch_and_a_second_run_adds_only_new_files(spark):
    feed, rows, counts, state = folders(spark)
    stream = arrive(spark, feed, sample(100), files=3)
    observed.stream_dq(stream, RULES, "t", rows, counts, state)
    assert counted(spark, counts) == expected(spark, sample(100))
    before = {(r.batch, r.rule, r.violations) for r in observed.metrics(spark, counts).collect()}
    assert len({b for b, *_ in before}) == 3
    # Nothing new: nothing changes.  New rows: new batches only.
    observed.stream_dq(stream, RULES, "t", rows, counts, state)
    assert counted(spark, counts) == expected(spark, sample(100))
    stream = arrive(spark, feed, sample(40))
    observed.stream_dq(stream, RULES, "t", rows, counts, state)
    assert counted(spark, counts) == expected(spark, sample(100) + sample(40))
    assert before < {(r.batch, r.rule, r.violations) for r in observed.metrics(spark, counts).collect()}
    good = observed.good_rows(spark, rows)
    assert "PartitionFilters: [isnotnull(quarantined" in good._jdf.queryExecution().toString()
    assert good.columns == ["id", "v"]
    kept = [r for r in sample(100) + sample(40) if r[0] is not None and r[1] is not None and r[1] < 90]
    assert sorted(tuple(r) for r in good.collect()) == sorted(kept)
    assert good.count() + observed.quarantined_rows(spark, rows).count() == 140


def test_lost_progress_is_counted_again(spark):
    feed, rows, counts, state = folders(spark)
    stream = arrive(spark, feed, sample(60), files=4)
    query = observed.stream_dq(stream, RULES, "t", rows, counts, state)
    seen = observed.progress_metrics(query, RULES, "t")
    want, schema = counted(spark, counts), observed.observed(stream, RULES).schema
    # A driver that ended after two of the batches, or that forgot the earlier ones.
    for kept in ([x for x in seen if x[0] < 2], [x for x in seen if x[0] == 3], []):
        other = fresh_path(spark, "counts")
        observed.record(spark, kept, RULES, "t", rows, other, schema)
        assert counted(spark, other) == want
        assert sorted(map(tuple, observed.metrics(spark, other).collect())) == sorted(seen)
        observed.record(spark, seen, RULES, "t", rows, other, schema)
        assert counted(spark, other) == want


def test_one_job_per_batch(spark):
    feed, rows, counts, state = folders(spark)
    stream = arrive(spark, feed, sample(50), files=2)
    plan = observed.observed(stream, RULES)
    assert plan.isStreaming
    tracker, started = spark.sparkContext.statusTracker(), []

    def write(batch, batch_id):
        spark.sparkContext.setJobGroup(f"observed-{batch_id}", "")
        batch.write.mode("overwrite").partitionBy("quarantined").parquet(f"{rows}/batch={batch_id}")
        started.append(len(tracker.getJobIdsForGroup(f"observed-{batch_id}")))

    query = plan.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    assert started == [1, 1]
    assert len(observed.progress_metrics(query, RULES, "t")) == 2 * len(RULES)


def test_fail_rule_ends_the_query_unless_the_row_is_dropped(spark):
    rules = [Rule("has_id", "id IS NOT NULL"), Rule("below", "v < 50", quality.FAIL)]
    feed, rows, counts, state = folders(spark)
    observed.stream_dq(arrive(spark, feed, [(1, 10), (None, 60)]), rules, "t", rows, counts, state)
    assert [r[4] for r in counted(spark, counts)] == [1, 1]
    with pytest.raises(Exception, match="below"):
        observed.stream_dq(arrive(spark, feed, [(2, 70)]), rules, "t", rows, counts, state)
    assert observed.good_rows(spark, rows).count() == 1


def test_a_stream_without_files(spark):
    feed, rows, counts, state = folders(spark)
    stream = arrive(spark, feed, [])
    observed.stream_dq(stream, RULES, "t", rows, counts, state)
    assert sum(r[5] for r in counted(spark, counts)) == 0
    assert observed.good_rows(spark, rows, observed.observed(stream, RULES).schema).count() == 0


def test_a_feed_is_written_by_as_many_tasks_as_it_has(spark):
    feed, files = queries._fed(spark, spark.range(0, 7000, 1, 7), 3)
    names = spark.read.parquet(feed).inputFiles()
    assert len(names) == 7 and files == 3 and spark.read.parquet(feed).count() == 7000
    # A small feed still arrives in as many batches as asked for.
    feed, files = queries._fed(spark, spark.range(0, 90, 1, 1), 3)
    assert len(spark.read.parquet(feed).inputFiles()) == 3 and files == 1
    assert spark.read.parquet(feed).distinct().count() == 90
