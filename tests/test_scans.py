"""Running aggregates and run fragments against brute force, and the shape of their plans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow.operators.ingest import activity_sessions
from tripflow.operators.late import mark_late, window_closings
from tripflow.operators.scans import running


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def windows(plan):
    """The partition columns of the plan's windows."""
    return [line.split("], [")[1].split("]")[0] for line in plan.splitlines() if "Window [" in line]


@pytest.mark.parametrize("name", ["min", "max", "sum", "bit_xor"])
@pytest.mark.parametrize("falling", [False, True])
def test_running(spark, name, falling):
    rng = random.Random(name)
    numbers = sorted(rng.sample(range(-2000, 2000), 150)) + [2**20]
    rows = [(k, n, rng.choice([None, *range(50)])) for k in "ab" for n in numbers if rng.random() < 0.7]
    fold = {"min": min, "max": max, "sum": lambda a, b: a + b, "bit_xor": lambda a, b: a ^ b}[name]
    want = set()
    for key in "ab":
        so_far = None
        for k, n, v in sorted(rows, reverse=falling):
            if k == key:
                so_far = v if so_far is None else so_far if v is None else fold(so_far, v)
                want.add((k, n, so_far))
    table = spark.createDataFrame(rows, "key STRING, no LONG, v LONG")
    found = running(table, ["key"], "no", "v", getattr(F, name), falling, bits=4, levels=6)
    assert {tuple(r) for r in found.collect()} == want


def test_runs_cross_stretches(spark):
    """One tenant's runs over many cells, with silences of just the gap and a moment more."""
    rng, at, times = random.Random(3), datetime(1969, 12, 31, 20), []
    for _ in range(900):
        at += timedelta(microseconds=rng.choice([1, 30_000_000, 59_999_999, 60_000_000, 60_000_001, 200_000_000]))
        times.append(at)
    rows = spark.createDataFrame([("t", t, "ok") for t in times], "tenant STRING, ingest_ts TIMESTAMP, disposition STRING")
    want, run = [], [times[0]]
    for t in times[1:]:
        if t - run[-1] > timedelta(seconds=60):
            want.append((run[0], run[-1], len(run)))
            run = []
        run.append(t)
    want.append((run[0], run[-1], len(run)))
    found = activity_sessions(rows)
    assert sorted((r.start, r.last_msg, r.rows) for r in found.collect()) == want and len(want) > 100
    partitions = windows(plan_of(found))
    assert partitions and all("_stretch" in p for p in partitions)


def test_scattered_years_close_windows(spark):
    """Event times over thousands of years: each window's closing arrival, and no window without partition."""
    rng = random.Random(5)
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), rng.choice([
        datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(900)), datetime(rng.randrange(1900, 2025), 3, 1),
    ])) for i in range(400)]
    df = spark.createDataFrame(rows, "seq LONG, ingest_ts TIMESTAMP, event_time TIMESTAMP")
    seen, want = None, {}
    for i, _, event in rows:
        ms = round((event - datetime(1970, 1, 1)).total_seconds() * 1000)
        want[i] = seen is not None and ms // 60_000 * 60_000 + 60_000 - 1 + 20_000 <= seen - 60_000 - 1
        seen = ms if seen is None else max(seen, ms)
    assert {r.seq: r.late for r in mark_late(df).collect()} == want and sum(want.values()) > 50
    closings = window_closings(
        df.withColumns({"_event_ms": F.unix_millis("event_time"), "_arrival": F.col("seq").cast("DECIMAL(38,0)")}), 60_000, 80_000
    )
    assert all("_stretch" in p for p in windows(plan_of(closings)))
