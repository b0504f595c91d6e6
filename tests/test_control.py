"""Live status, runs and warnings against their replay over the same arrivals."""

import random
from collections import Counter
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripflow.operators.ingest import activity_actions, activity_sessions, ingest_status
from tripflow.operators.monitor import ANY_LIMITS, breaches, recommend_actions, status_warnings, with_limits
from tripflow.schemas import LIMITS
from tripflow.session import ROCKS_DB
from tripflow.streaming.control import CONTROL, _Runs, run_actions, status_reports, tenant_control, watch
from tripflow.streaming.sinks import start

T0 = datetime(2024, 5, 1, 12)
ROWS = "tenant STRING, ingest_ts TIMESTAMP, disposition STRING"


def arrivals(seed, n):
    """Bursts and silences of three tenants; one goes silent for good, one starts late."""
    rng, rows, at = random.Random(seed), [], T0
    for i in range(n):
        at += timedelta(microseconds=rng.choice([1, 1_000, 400_000, 9_999_999, 61_000_000 if i % 9 == 0 else 5]))
        tenant = "a" if i < n // 3 else rng.choice(["b", "c"]) if i > n // 2 else "b"
        rows.append((tenant, at, rng.choice(["ok", "discarded", "errored", None])))
    return rows


@pytest.mark.parametrize("seed", [2])
def test_control_equals_replay(spark, tmp_path, seed):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    rows, cuts = arrivals(seed, 240), [0, 41, 150, 240]
    base = str(tmp_path)
    first_seen = {}
    for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = rows[a:b]
        random.Random(seed).shuffle(part)  # within a batch rows come in any order
        spark.createDataFrame(part, ROWS).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(ROWS).parquet(f"{base}/in")
        start(tenant_control(source, delay="0 seconds"), f"{base}/ck", f"{base}/out").awaitTermination()
        for r in run_actions(spark.read.schema(CONTROL).parquet(f"{base}/out")).collect():
            first_seen.setdefault((r.tenant, r.at, r.action), number)
    table = spark.createDataFrame(rows, ROWS)
    end = F.lit(rows[-1][1].replace(microsecond=rows[-1][1].microsecond // 1000 * 1000))
    out = spark.read.schema(CONTROL).parquet(f"{base}/out")
    status = status_reports(out)
    replay = ingest_status(table)
    assert status.join(replay, ["tenant_id", "interval_no"], "left_semi").exceptAll(replay).count() == 0
    # Missing are only intervals that have not ended; further ones are silent tenants' zero reports.
    open_ones = replay.exceptAll(status)
    assert open_ones.filter(F.to_timestamp("timestamp") <= end).count() == 0
    zero = status.join(replay, ["tenant_id", "interval_no"], "left_anti")
    assert zero.filter("tenant_id = 'a'").count() > 30 and zero.filter("rows_processed > 0").count() == 0
    per = status.groupBy("tenant_id").agg(F.count("*").alias("n"), F.max("interval_no").alias("last")).collect()
    assert all(r.n == r.last + 1 for r in per) and len(per) == 3
    want = activity_actions(activity_sessions(table))
    got = run_actions(out).select("tenant", "at", "action")
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).filter((F.col("action") == "start") | (F.col("at") <= end)).count() == 0
    # A start comes in the batch of the run's first message.
    batch_of = {(t, at): next(k for k in range(3) if cuts[k] <= i < cuts[k + 1]) for i, (t, at, _) in enumerate(rows)}
    starts = {k: v for k, v in first_seen.items() if k[2] == "start"}
    assert starts and all(v == batch_of[k[0], k[1]] for k, v in starts.items())

    stored = spark.readStream.schema(CONTROL).parquet(f"{base}/out")
    limits = spark.createDataFrame([("a", 1e9, 0, 2.0), ("b", 0.0, 3, None)], LIMITS)
    for _ in range(2):  # nothing new the second time
        watch(status_reports(stored), lambda: limits, f"{base}/w").awaitTermination()
    told = spark.read.parquet(f"{base}/w/breaches/batch_id=*").select("tenant", "interval_no", "warning", "action")
    assert told.exceptAll(breaches(status, limits).select(told.columns)).count() == 0
    assert breaches(status, limits).select(told.columns).exceptAll(told).count() == 0 and told.count() > 3


class _State:
    """The state of one key, with a count of the accesses to it."""

    def __init__(self):
        self.held, self.accesses = {}, 0

    def __getattr__(self, name):
        def access(*args):
            self.accesses += 1
            key = args[0] if name.endswith(("Value", "Key")) else None
            if name in ("update", "updateValue"):
                self.held[key] = args[-1]
            elif name == "removeKey":
                del self.held[key]
            elif name == "iterator":
                return iter(list(self.held.items()))
            return key in self.held if name in ("exists", "containsKey") else self.held.get(key)

        return access


def test_control_reads_its_state_a_chunk_at_a_time():
    """Many open intervals cost few accesses; rows in any order, in several frames, some without a time."""
    run, kept = _State(), _State()
    control = _Runs(10, 60)
    control.init(SimpleNamespace(
        getValueState=lambda *_: run, getMapState=lambda *_: kept, registerTimer=lambda _: None
    ))
    rng = np.random.default_rng(4)
    width, out, want, first, next_no, times = 10_000_000, [], Counter(), None, 0, []
    for begin, clock in ((7, 1_500), (200_000, 350_000), (349_000, 349_500), (420_000, 500_000)):
        at = rng.integers(begin * 1_000_000, (begin + 150_000) * 1_000_000, 20_000)
        bad = rng.integers(0, 2, len(at))
        first = int(at.min()) if first is None else first
        for t, d in zip(at.tolist(), bad.tolist(), strict=True):
            want[max((t - first) // width, next_no), "n"] += 2
            want[max((t - first) // width, next_no), "d"] += d
        frame = pd.DataFrame({"arrived_us": at, "n": 2, "discarded": bad})
        empty = pd.DataFrame({"arrived_us": [None, float(at[0])], "n": 0, "discarded": 0})
        out += control.handleInputRows(("a",), iter([frame[:9_000], empty, frame[9_000:]]), None)
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda clock=clock: clock * 1000)
        out += control.handleExpiredTimer(("a",), now, None)
        next_no = max(next_no, (clock * 1_000_000 - first) // width)
    out = pd.concat(out)
    status = out[out["kind"] == "status"]
    assert status["interval_no"].tolist() == list(range(next_no))
    assert status["rows_processed"].tolist() == [want[k, "n"] for k in range(next_no)]
    assert status["discarded_rows"].tolist() == [want[k, "d"] for k in range(next_no)]
    assert len(status) > 40_000 and sum(status["rows_processed"]) < 160_000  # the last ones are open
    assert kept.accesses < 100 and run.accesses < 20


def test_breaches(spark):
    limits = spark.createDataFrame([("a", 0.0, 2, 0.4), ("b", 480.0, 0, 1.0), ("b2", None, None, None)], LIMITS)
    counts = {"a": [(5, 0), (1, 0), (1, 0), (2, 2), (1, 1), (3, 0), (1, 0)], "b": [(1, 0), (200, 0), (1, 0)],
              "b2": [(0, 0), (4, 4)], "nobody": [(1, 0), (0, 0), (0, 0)]}
    status = spark.createDataFrame(
        [(t, i, n, n / 10.0, d) for t, c in counts.items() for i, (n, d) in enumerate(c)],
        "tenant_id STRING, interval_no LONG, rows_processed LONG, rows_per_second DOUBLE, discarded_rows LONG",
    )
    got = sorted((r.tenant, r.interval_no, r.warning, r.action) for r in breaches(status, limits).collect())
    few, bad, slow = "minRowsProcessed", "maxDiscardedRowsRelation", "minimumIngestionSpeed"
    assert got == [
        ("a", 1, few, "restart"), ("a", 3, bad, "stop"), ("a", 6, few, "restart"),
        ("b", 0, slow, "restart"), ("b", 2, slow, "restart"), ("b2", 0, bad, "stop"), ("nobody", 1, bad, "stop"),
    ]
    warned = status_warnings(status, limits, {**ANY_LIMITS, "maxDiscardedRowsRelation": 2.0})
    assert {r.tenant for r in warned.collect()} == {"a", "b", "b2", "nobody"}
    assert recommend_actions(warned).filter("action IS NULL").count() == 0
    assert with_limits(spark.createDataFrame([(None,), ("a",)], "tenant STRING"), limits).count() == 2
    before = spark.createDataFrame([("nobody", 0, bad)], "tenant STRING, interval_no LONG, warning STRING")
    rest = status.filter("tenant_id = 'nobody' AND interval_no > 0")
    assert breaches(rest, limits, before=before).count() == 0
