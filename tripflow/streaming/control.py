"""Live control of tenants: status reports every few seconds, start and stop of runs, warnings.

One stateful operator holds a row per tenant and the counts of its open intervals. Time is arrival time;
what closes an interval or a run is the watermark, which all tenants (and a heartbeat) move on. So a
silent tenant reports zero rows and is stopped, and a replay of the same messages, cut into
micro-batches in any way, gives the same reports and actions.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tripflow.operators.monitor import breaches
from tripflow.schemas import SILENCE_LIMIT, STATUS_INTERVAL
from tripflow.session import interval_seconds
from tripflow.streaming.sinks import AVAILABLE_NOW

CONTROL = """
    tenant STRING, kind STRING, at TIMESTAMP, interval_no BIGINT,
    rows_processed BIGINT, discarded_rows BIGINT, action STRING
"""
_COUNTS = "tenant STRING, ingest_ts TIMESTAMP, arrived_us BIGINT, n BIGINT, discarded BIGINT"
# Intervals whose counts are one entry of the state, and of one output frame: a watermark that jumps
# over a month closes very many at once.
_CHUNK = 16_384
# Instants or runs held before they are put together.
_HELD = 262_144


def _summed(parts):
    """Distinct numbers in order and the sums of their counts; ``parts``: (numbers, n, discarded) each."""
    numbers, n, discarded = (np.concatenate(column) for column in zip(*parts, strict=True))
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    starts = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1))
    return numbers[starts], np.add.reduceat(n[order], starts), np.add.reduceat(discarded[order], starts)


def _joined(runs, gap):
    """First and last instants of the runs that some runs make up together."""
    first, last = (np.concatenate(column) for column in zip(*runs, strict=True))
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    cut = np.flatnonzero(first[1:] - last[:-1] > gap)
    return first[np.append(0, cut + 1)], last[np.append(cut, len(last) - 1)]


class _Fold:
    """What a tenant's rows of a batch come to: counts by ``number`` of their instant, and runs."""

    def __init__(self, number, gap):
        self.number, self.gap = number, gap
        self.counts, self.runs, self.held = [], [], 0

    def add(self, times, n, discarded):
        self.counts.append(_summed([(self.number(times), n, discarded)]))
        self.runs.append(_joined([(times, times)], self.gap))
        self.held += len(self.counts[-1][0]) + len(self.runs[-1][0])
        if self.held >= _HELD:
            self._shrink()

    def _shrink(self):
        self.counts, self.runs = [_summed(self.counts)], [_joined(self.runs, self.gap)]
        # Again when as many more have come.
        self.held = -max(0, len(self.counts[0][0]) + len(self.runs[0][0]) - _HELD)

    def result(self):
        self._shrink()
        return self.counts[0], self.runs[0]


class _Runs(StatefulProcessor):
    """Reports and actions of one tenant. Times are in microseconds.

    Counts of open intervals are kept a chunk of intervals at a time (numbers, counts and discarded
    counts as one array), as each access to the state is a message to the JVM.
    """

    def __init__(self, interval, gap):
        self.width, self.gap = interval * 1_000_000, gap * 1_000_000

    def init(self, handle):
        self.handle = handle
        self.run = handle.getValueState("run", "first BIGINT, next_no BIGINT, last BIGINT, running BOOLEAN")
        self.open = handle.getMapState("open", "chunk BIGINT", "counts BINARY")

    def _counts(self, chunk):
        if not self.open.containsKey((chunk,)):
            return np.zeros((3, 0), np.int64)
        return np.frombuffer(self.open.getValue((chunk,))[0], "<i8").reshape(3, -1)

    def _keep(self, chunk, counts):
        self.open.updateValue((chunk,), (np.asarray(counts, "<i8").tobytes(),))

    def _status(self, tenant, first, start, stop):
        """Reports of intervals of one chunk, whose counts then go."""
        chunk = start // _CHUNK
        numbers, counts = np.arange(start, stop), np.zeros((2, stop - start), np.int64)
        held = self._counts(chunk)
        if held.shape[1]:
            done = held[0] < stop
            counts[:, held[0, done] - start] = held[1:, done]
            if done.all():
                self.open.removeKey((chunk,))
            else:
                self._keep(chunk, held[:, ~done])
        return pd.DataFrame({
            "tenant": tenant, "kind": "status", "at": _stamps(first + (numbers + 1) * self.width),
            "interval_no": numbers, "rows_processed": counts[0], "discarded_rows": counts[1], "action": None,
        })

    def _actions(self, tenant, pairs):
        times, names = zip(*pairs, strict=True)
        return pd.DataFrame({
            "tenant": tenant, "kind": "action", "at": _stamps(np.array(times)),
            "interval_no": pd.array([None] * len(times), "Int64"),
            "rows_processed": pd.array([None] * len(times), "Int64"),
            "discarded_rows": pd.array([None] * len(times), "Int64"), "action": names,
        })

    def _wake(self, first, next_no, last, running):
        for at in (first + (next_no + 1) * self.width, last + self.gap if running else None):
            if at is not None:
                self.handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None:  # the heartbeat
            return
        if self.run.exists():
            first, next_no, last, running = self.run.get()
        else:
            first, next_no, last, running = None, 0, None, False

        def number(times):
            # A row that comes after its interval was reported counts in the first open one.
            return np.maximum((times - first) // self.width, next_no)

        # Of a new tenant the first instant, where its intervals start, is known after all rows.
        fold = _Fold(number if first is not None else np.asarray, self.gap)
        for frame in rows:
            frame = frame[["arrived_us", "n", "discarded"]].dropna(subset="arrived_us")
            if len(frame):
                fold.add(*frame.to_numpy(np.int64).T)
        if not fold.counts:
            return
        counts, (begins, ends) = fold.result()
        if first is None:
            first = int(begins[0])
            counts = _summed([(number(counts[0]), *counts[1:])])
        counts = np.array(counts)
        for chunk in np.unique(counts[0] // _CHUNK).tolist():
            fresh = counts[:, counts[0] // _CHUNK == chunk]
            self._keep(chunk, _summed([self._counts(chunk), fresh]))
        actions = []
        if last is None:
            actions.append((int(begins[0]), "start"))
            running = True
        before = np.append(begins[0] if last is None else last, ends[:-1])
        for at in np.flatnonzero(begins - before > self.gap).tolist():
            if at or running:
                actions.append((int(before[at]) + self.gap, "stop"))
            actions.append((int(begins[at]), "start"))
            running = True
        last = int(ends[-1]) if last is None else max(last, int(ends[-1]))
        self.run.update((first, next_no, last, True))
        self._wake(first, next_no, last, True)
        if actions:
            yield self._actions(key[0], actions)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        first, next_no, last, running = self.run.get()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        until = (now - first) // self.width  # intervals before this one have ended
        start = next_no
        while start < until:
            stop = min(until, (start // _CHUNK + 1) * _CHUNK)
            yield self._status(key[0], first, start, stop)
            start = stop
        if running and last + self.gap <= now:
            running = False
            yield self._actions(key[0], [(last + self.gap, "stop")])
        next_no = max(next_no, until)
        self.run.update((first, next_no, last, running))
        self._wake(first, next_no, last, running)


def _stamps(micros):
    return pd.to_datetime(np.asarray(micros, np.int64), unit="us")


def _combine(batches):
    """A row per tenant and instant of each Arrow batch, so a busy tenant sends the state few rows."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).group_by(["tenant", "ingest_ts", "arrived_us"])
            sums = table.aggregate([("n", "sum"), ("discarded", "sum")])
            out = sums.select(["tenant", "ingest_ts", "arrived_us", "n_sum", "discarded_sum"])
            yield from out.rename_columns(["tenant", "ingest_ts", "arrived_us", "n", "discarded"]).combine_chunks().to_batches()


def heartbeat(spark, rows_per_second=1):
    """Rows of no tenant at the time of the clock: with them a trigger has data when all are silent."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return beats.select(
        F.lit(None).cast("string").alias("tenant"), F.col("timestamp").alias("ingest_ts"),
        F.lit(None).cast("string").alias("disposition"),
    )


def tenant_control(rows, interval=STATUS_INTERVAL, gap=SILENCE_LIMIT, delay="1 second"):
    """Reports and actions (``CONTROL``) of a stream of ``tenant, ingest_ts, disposition``.

    Each tenant reports every ``interval`` from its first row on, also with zero rows. A run starts
    with its first message, in the batch that brings it, and stops after more than ``gap`` without
    one. ``delay``: how far arrivals may be out of order; older rows are dropped by the watermark.
    A null tenant only moves the clock.
    """
    counted = rows.select(
        "tenant", "ingest_ts", F.unix_micros("ingest_ts").alias("arrived_us"), F.lit(1).cast("long").alias("n"),
        F.coalesce(F.col("disposition") == "discarded", F.lit(False)).cast("long").alias("discarded"),
    )
    return (
        counted.mapInArrow(_combine, _COUNTS)
        .withWatermark("ingest_ts", delay)
        .groupBy("tenant")
        .transformWithStateInPandas(
            _Runs(interval_seconds(interval), interval_seconds(gap)), CONTROL, "Append", "EventTime"
        )
    )


def status_reports(control, interval=STATUS_INTERVAL):
    """The status reports, in the form of ``operators.ingest.ingest_status``."""
    return control.filter("kind = 'status'").select(
        F.col("tenant").alias("tenant_id"), "interval_no",
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "rows_processed",
        (F.col("rows_processed") / F.lit(float(interval_seconds(interval)))).alias("rows_per_second"),
        "discarded_rows",
    )


def run_actions(control):
    """``tenant, at, action``: start and stop of runs."""
    return control.filter("kind = 'action'").select("tenant", "at", "action")


def watch(status, read_limits, base, default=None, trigger=None):
    """Start the stream status reports -> ``<base>/breaches/batch_id=N``: ``operators.monitor.breaches``.

    ``read_limits()`` is called for each batch, so new limits hold from the next one on. The last
    warning of each tenant is kept with its batch (``<base>/last``), and a replay of a batch starts
    from the one before it and writes the same.
    """

    def write(batch, batch_id):
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.schema(_LAST).parquet(f"{base}/last/batch_id={batch_id - 1}")
        judged = breaches(batch, read_limits(), default, before, every=True).persist()
        newest = judged.select("tenant", "interval_no", "warning")
        if before is not None:
            newest = newest.unionByName(before)
        newest.groupBy("tenant").agg(F.max_by(F.struct("interval_no", "warning"), "interval_no").alias("r")).select(
            "tenant", "r.interval_no", "r.warning"
        ).write.mode("overwrite").parquet(f"{base}/last/batch_id={batch_id}")
        judged.filter("is_new").drop("is_new").write.mode("overwrite").parquet(f"{base}/breaches/batch_id={batch_id}")
        judged.unpersist()

    return (
        status.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


_LAST = "tenant STRING, interval_no BIGINT, warning STRING"
