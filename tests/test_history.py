"""Histories from late events, and closures of hierarchies, against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tradeloom.operators import hierarchy, history
from tradeloom.session import fresh_path
from tradeloom.streaming.versions import MaintainedHistory, stream_history

CHANGES = "id int, tier string, valid_from date, _sequence long, _deleted boolean"
END = dt.date(9999, 12, 31)


def versions_of(events):
    """Versions per key from the last event of each day."""
    last = {}
    for e in sorted(events, key=lambda e: e[3]):
        last[e[0], e[2]] = e
    out = []
    for key in {e[0] for e in events}:
        own = [last[k] for k in sorted(k for k in last if k[0] == key)]
        runs = [e for i, e in enumerate(own) if i == 0 or (e[4], None if e[4] else e[1]) != (own[i - 1][4], None if own[i - 1][4] else own[i - 1][1])]
        for e, after in zip(runs, [*runs[1:], None], strict=True):
            if not e[4]:
                to = END if after is None else after[2] - dt.timedelta(1)
                out.append((key, e[1], e[2], to, after is None))
    return sorted(out, key=lambda v: (v[0], v[2]))


def shown(df):
    rows = df.select("id", "tier", "valid_from", "valid_to", "is_current").collect()
    return sorted(map(tuple, rows), key=lambda v: (v[0], v[2]))


def events_of(rng, n):
    day = dt.date(2022, 11, 1)
    return [(rng.randrange(6), rng.choice(["A", "B", None, ""]), day + dt.timedelta(rng.randrange(1200)), s, rng.random() < 0.15) for s in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_same_history(spark, seed):
    rng = random.Random(seed)
    events = events_of(rng, 150) + [(9, "A", dt.date(2024, 1, d), 900 + d, False) for d in (1, 5, 9)]
    order = list(events)
    rng.shuffle(order)
    root = fresh_path(spark, "dimension")
    held = MaintainedHistory(spark, "id", ["tier"], root, spark.createDataFrame([], CHANGES).schema)
    for k in range(3):
        part = order[k * 51 : (k + 1) * 51] + order[:5]
        held.apply(spark.createDataFrame(part, CHANGES), f"{root}-batches/{k}")
    assert shown(held.versions()) == versions_of(events)
    last = {(e[0], e[2]): e for e in events}
    whole = history.history_of(spark.createDataFrame(list(last.values()), CHANGES), "id", ["tier"])
    assert shown(whole) == versions_of(events)


def test_a_change_between_two_versions_splits_one(spark):
    def change(tier, day, sequence, gone=False):
        return spark.createDataFrame([(1, tier, dt.date(2024, 1, day), sequence, gone)], CHANGES)

    root = fresh_path(spark, "dimension")
    held = MaintainedHistory(spark, "id", ["tier"], root, change("A", 1, 1).schema)
    held.apply(change("A", 1, 1).union(change("A", 20, 2)), f"{root}-batches/0")
    assert shown(held.versions()) == [(1, "A", dt.date(2024, 1, 1), END, True)]
    held.apply(change("B", 10, 3), f"{root}-batches/1")
    first, second, third = shown(held.versions())
    assert first[3] == dt.date(2024, 1, 9) and second[2:4] == (dt.date(2024, 1, 10), dt.date(2024, 1, 19))
    assert third[1:3] == ("A", dt.date(2024, 1, 20))
    held.apply(change("B", 10, 4, True), f"{root}-batches/2")
    assert [v[2:4] for v in shown(held.versions())] == [(dt.date(2024, 1, 1), dt.date(2024, 1, 9)), (dt.date(2024, 1, 20), END)]
    held.apply(change("B", 10, 3), f"{root}-batches/3")  # an older change of the same day
    assert len(shown(held.versions())) == 2


def test_history_of_a_stream(spark):
    events = events_of(random.Random(7), 60)
    source, root, state = (fresh_path(spark, n) for n in ("events", "dimension", "state"))
    for k in range(2):
        spark.createDataFrame(events[k::2], CHANGES).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(spark.createDataFrame([], CHANGES).schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_history(stream, "id", ["tier"], root, state)
    schema = spark.createDataFrame([], CHANGES).schema
    assert shown(MaintainedHistory(spark, "id", ["tier"], root, schema).versions()) == versions_of(events)


def brute_closure(parents):
    out = []
    for key in parents:
        seen, at, level = [], key, 0
        while at in parents and parents[at] is not None and at not in seen:
            seen.append(at)
            if parents[at] not in parents:
                break
            at, level = parents[at], level + 1
        if at in seen and parents[at] in parents:
            member = key in seen[seen.index(at) :]
            out.append((key, None, None, "CYCLE" if member else "BELOW_CYCLE"))
        elif parents[at] is None:
            out.append((key, at, level, "ROOT" if key == at else "CHILD"))
        else:
            out.append((key, at, level, "ORPHAN" if key == at else "BELOW_ORPHAN"))
    return sorted(out)


def test_closure_of_chains_cycles_and_orphans(spark):
    rng = random.Random(3)
    parents = {i: (i - 1 if i else None) for i in range(40)}  # one long chain
    parents |= {100 + i: 100 + (i + 1) % 7 for i in range(7)} | {120: 120, 121: 120, 122: 121}
    parents |= {200: 999, 201: 200, 202: 201, 300: None, 301: None}
    parents |= {1000 + i: rng.choice([*range(40), *range(100, 107), 200, 202, 300, 1000 + rng.randrange(i + 1)]) for i in range(60)}
    df = spark.createDataFrame([*parents.items(), (None, 3)], "id long, parent long")
    assert sorted(map(tuple, hierarchy.closure(df, "id", "parent").collect())) == brute_closure(parents)
    rows = {r.status: r.row_count for r in hierarchy.report(df, "id", "parent").collect()}
    assert sum(rows.values()) == len(parents) and rows["ORPHAN"] == 1


def test_closure_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, parent long")
    assert hierarchy.closure(df, "id", "parent").count() == 0
