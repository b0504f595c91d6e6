"""Late rows, judged record by record in arrival order."""

from pyspark.sql import functions as F

from tripflow.functions.times import epoch_ms
from tripflow.operators.scans import running
from tripflow.schemas import ALLOWED_LATENESS, WATERMARK_DELAY, WINDOW_SIZE
from tripflow.session import interval_seconds, settle


def arrival_number(ingest_ts="ingest_ts", seq="seq"):
    """Arrival order as one number: microseconds of arrival, then the arrival number.

    A decimal is a fixed-width aggregation buffer, so ``min`` over it stays a hash
    aggregate (a struct would fall back to sorting every row).
    """
    return (
        F.unix_micros(ingest_ts).cast("DECIMAL(18,0)") * F.lit("1" + "0" * 19).cast("DECIMAL(20,0)")
        + F.col(seq).cast("DECIMAL(19,0)")
    ).cast("DECIMAL(38,0)")


def _grid_start(ms, size_ms):
    return ms - F.pmod(ms, F.lit(size_ms))


def window_closings(rows, size_ms, wait_ms):
    """For each window, the first arrival that closes it (``_closed_by``).

    A row with event time ``e`` closes every window whose end plus the wait is not after
    ``e``. So the closing arrival of a window is the smallest arrival over all rows that
    far ahead: one partial aggregation to a row per window, then a running minimum from
    the last window back, by a tree over the windows' numbers. Event times of bogus years
    make more stretches, but none that all lie in one task.
    """
    event = F.col("_event_ms")
    cells = rows.groupBy(
        _grid_start(event, size_ms).alias("_window_ms"),
        (_grid_start(event - wait_ms, size_ms) - size_ms).alias("_closes_ms"),
    ).agg(F.min("_arrival").alias("_first"))
    no_arrival = F.lit(None).cast("DECIMAL(38,0)")
    per_window = settle(
        cells.select(
            F.inline(
                F.array(
                    F.struct(F.col("_window_ms"), no_arrival.alias("_first")),
                    F.struct(F.col("_closes_ms").alias("_window_ms"), F.col("_first")),
                )
            )
        )
        .groupBy(F.expr(f"_window_ms div {size_ms}").alias("_number"))
        .agg(F.min("_first").alias("_closed_by")),
        "windows",
    )
    return (
        running(per_window, [], "_number", "_closed_by", F.min, falling=True)
        .select((F.col("_number") * size_ms).alias("_window_ms"), "_closed_by")
        .filter("_closed_by IS NOT NULL")
    )


def mark_late(
    df,
    size=WINDOW_SIZE,
    delay=WATERMARK_DELAY,
    lateness=ALLOWED_LATENESS,
    seen_until_ms=None,
):
    """Add ``late``: the row came after its window was closed for good.

    With ``wm`` = largest event time of all earlier arrivals - delay - 1 ms, a row is late
    if the last millisecond of its window plus the lateness is not after ``wm``.
    ``seen_until_ms`` is the largest event time of arrivals before this set. Batch (or one
    micro-batch); needs ``event_time``, ``ingest_ts`` and ``seq``. Rows flagged ``malformed``
    have no event time of their own: they are judged, but close no window.
    """
    size_ms = interval_seconds(size) * 1000
    wait_ms = (interval_seconds(delay) + interval_seconds(lateness)) * 1000
    rows = df.withColumn("_event_ms", epoch_ms("event_time")).withColumn(
        "_arrival", arrival_number()
    )
    telling = rows.filter(~F.col("malformed")) if "malformed" in df.columns else rows
    closings = settle(window_closings(telling, size_ms, wait_ms), "closings")
    late = F.col("_arrival") > F.col("_closed_by")
    if seen_until_ms is not None:
        window_end = _grid_start(F.col("_event_ms"), size_ms) + size_ms
        late = F.coalesce(late, F.lit(False)) | (window_end + wait_ms <= F.lit(seen_until_ms))
    return (
        rows.withColumn("_window_ms", _grid_start(F.col("_event_ms"), size_ms))
        .join(closings, "_window_ms", "left")
        .withColumn("late", F.coalesce(late, F.lit(False)))
        .select(*df.columns, "late")
    )


def late_rows(df, size=WINDOW_SIZE, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    """Rows that leave the analytics and go back to the tenant."""
    return mark_late(df, size, delay, lateness).filter("late").drop("late")


def on_time_rows(df, size=WINDOW_SIZE, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    return mark_late(df, size, delay, lateness).filter(~F.col("late")).drop("late")
