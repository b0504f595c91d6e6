"""Counters and reports of ingest runs.

Rows carry ``tenant``, ``ingest_ts`` and ``disposition`` (``ok``, ``discarded``, ``errored``).
"""

from pyspark.sql import functions as F

from tripflow.functions.units import per_second, row_kb
from tripflow.operators.scans import running
from tripflow.schemas import SILENCE_LIMIT, STATUS_INTERVAL
from tripflow.session import interval_seconds, settle

# Intervals made per step when the empty ones are filled in; bounds one array.
INTERVALS_PER_STEP = 4096


def ingest_summary(df):
    """Counters per consumer run.

    A row without a value is a transport error and counts as no message; a message that
    is not stored is an insert error.
    """
    received = F.col("value").isNotNull()
    stored = received & (F.col("disposition") == "ok")
    seconds = (F.unix_micros(F.max("ingest_ts")) - F.unix_micros(F.min("ingest_ts"))) / 1e6
    return (
        df.groupBy("consumer")
        .agg(
            F.count_if(received).alias("messages"),
            F.count_if(stored).alias("inserted"),
            F.count_if(received & ~stored).alias("insert_errors"),
            F.count_if(~received).alias("transport_errors"),
            seconds.alias("seconds"),
        )
        .withColumn("inserted_per_second", per_second(F.col("inserted"), F.col("seconds")))
    )


def ingest_status(df, interval=STATUS_INTERVAL):
    """Rows, rows per second and discarded rows per tenant and interval of arrival time.

    Intervals start at the tenant's first row and run without gaps to its last; all rows
    count as processed, the discarded ones too. Batch (a replay); the live form is
    ``streaming.control.status_reports``.
    """
    seconds = interval_seconds(interval)
    width = F.lit(seconds * 1_000_000)
    arrival = F.unix_micros("ingest_ts")
    spans = settle(
        df.groupBy("tenant").agg(F.min(arrival).alias("_first"), F.max(arrival).alias("_last")),
        "spans",
    )
    number = F.expr(f"(unix_micros(ingest_ts) - _first) div {seconds * 1_000_000}")
    counts = (
        df.join(spans, "tenant")
        .groupBy("tenant", number.alias("interval_no"))
        .agg(
            F.count(F.lit(1)).alias("rows_processed"),
            F.count_if(F.col("disposition") == "discarded").alias("discarded_rows"),
        )
    )
    # All interval numbers of a tenant, made in two steps so that no array grows with the span.
    step = INTERVALS_PER_STEP
    grid = (
        spans.withColumn("_intervals", F.expr(f"(_last - _first) div {seconds * 1_000_000}"))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.expr(f"_intervals div {step}"))))
        .withColumn(
            "interval_no",
            F.explode(
                F.sequence(
                    F.col("_step") * step,
                    F.least("_intervals", F.col("_step") * step + step - 1),
                )
            ),
        )
    )
    report_at = F.timestamp_micros(F.col("_first") + (F.col("interval_no") + 1) * width)
    return (
        grid.join(counts, ["tenant", "interval_no"], "left")
        .fillna(0, ["rows_processed", "discarded_rows"])
        .select(
            F.col("tenant").alias("tenant_id"),
            "interval_no",
            F.date_format(report_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            "rows_processed",
            (F.col("rows_processed") / F.lit(float(seconds))).alias("rows_per_second"),
            "discarded_rows",
        )
    )


def _run_counts():
    return {
        "rows": F.count(F.lit(1)),
        "inserted": F.count_if(F.col("disposition") == "ok"),
        "discarded": F.count_if(F.col("disposition") == "discarded"),
        "errored": F.count_if(F.col("disposition") == "errored"),
    }


def activity_sessions(df, gap=SILENCE_LIMIT):
    """Runs of a tenant: a run ends after more than ``gap`` of silence.

    Batch: arrivals are first counted per tenant and gap-long cell. Rows of one cell are
    always in the same run, so the runs follow from at most one row per cell, however
    many messages a tenant sends, and fragments of runs are merged over stretches of cells,
    so no task orders a tenant's history. Streaming (needs a watermark on ``ingest_ts``): Spark's
    session windows.
    """
    seconds = interval_seconds(gap)
    counts = _run_counts()
    if df.isStreaming:
        # Sessions are merged within each task before the shuffle, so a busy tenant sends
        # one row per session and task instead of every message.
        df.sparkSession.conf.set(
            "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
        )
        return (
            df.groupBy("tenant", F.session_window("ingest_ts", f"{seconds} seconds").alias("run"))
            .agg(
                F.min("ingest_ts").alias("start"),
                F.max("ingest_ts").alias("last_msg"),
                *[c.alias(name) for name, c in counts.items()],
            )
            .drop("run")
        )
    arrival = F.unix_micros("ingest_ts")
    width = F.lit(seconds * 1_000_000)
    cells = df.groupBy("tenant", (arrival - F.pmod(arrival, width)).alias("_cell")).agg(
        F.min("ingest_ts").alias("start"),
        F.max("ingest_ts").alias("last_msg"),
        *[c.alias(name) for name, c in counts.items()],
    )
    cells = settle(cells.withColumn("_cell", F.expr(f"_cell div {seconds * 1_000_000}")), "cells")
    # Less than a gap apart are only rows of the same cell or of neighbours, so a cell looks at
    # the one before it, and a run is known by the cell that starts it.
    before = cells.select("tenant", (F.col("_cell") + 1).alias("_cell"), F.col("last_msg").alias("_before"))
    silence = F.unix_micros("start") - F.unix_micros("_before")
    starts = settle(
        cells.join(before, ["tenant", "_cell"], "left")
        .select("tenant", "_cell", F.when(silence <= width, F.lit(None)).otherwise(F.col("_cell")).alias("_run")),
        "run-starts",
    )
    return (
        cells.join(running(starts, ["tenant"], "_cell", "_run", F.max), ["tenant", "_cell"])
        .groupBy("tenant", "_run")
        .agg(
            F.min("start").alias("start"),
            F.max("last_msg").alias("last_msg"),
            *[F.sum(name).alias(name) for name in counts],
        )
        .drop("_run")
    )


def activity_actions(sessions, gap=SILENCE_LIMIT):
    """``start`` at the first message of a run and ``stop`` when the silence limit is reached."""
    stop_at = F.timestamp_micros(
        F.unix_micros("last_msg") + interval_seconds(gap) * 1_000_000
    )
    return sessions.select(
        "tenant",
        F.inline(
            F.array(
                F.struct(F.col("start").alias("at"), F.lit("start").alias("action")),
                F.struct(stop_at.alias("at"), F.lit("stop").alias("action")),
            )
        ),
    )


def run_report(df, gap=SILENCE_LIMIT):
    """Report per tenant run: times, stored rows, size and speed in kB, discarded rows.

    The run lasts from its first to its last message; speed is NULL if that is one instant.
    """
    start = F.unix_micros("start") / 1e6
    end = F.unix_micros("last_msg") / 1e6
    return (
        activity_sessions(df, gap)
        .select(
            "tenant",
            start.alias("start_time"),
            end.alias("end_time"),
            ((F.unix_micros("last_msg") - F.unix_micros("start")) / 1e6).alias("total_time"),
            F.col("inserted").alias("rows"),
            row_kb(F.col("inserted")).alias("total_size"),
            "discarded",
        )
        .withColumn("speed", per_second(F.col("total_size"), F.col("total_time")))
    )


def row_count(table):
    """Number of rows as a one-row table."""
    return table.agg(F.count(F.lit(1)).alias("rows"))


def rows_added(before, after):
    """Rows a run added: count of the table after minus count before."""
    counts = row_count(before).select((-F.col("rows")).alias("rows")).unionAll(row_count(after))
    return counts.agg(F.sum("rows").alias("rows_added"))


def rows_added_by_key(rows, keys, is_old):
    """``rows_added`` (keys that no old row has) and ``rows`` (of all), in one scan.

    ``is_old``: a condition on a row; rows of a key are reduced before the shuffle.
    """
    per_key = rows.groupBy(*keys).agg(F.bool_or(is_old).alias("_old"), F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count(F.when(~F.col("_old"), 1)).alias("rows_added"), F.sum("_n").alias("rows")
    )


def lineage_record(df, source_schema, processing, keyspace, table, source_type="json",
                   user_id=None):
    """One JSON document per tenant run: source, processing steps, totals and times."""
    # Tenths of a percent, rounded half up in whole numbers.
    tenths = F.expr("(inserted * 2000 + rows) div (2 * rows)")
    success = F.format_string("%d.%d%%", F.floor(tenths / 10), tenths % 10)
    seconds = (F.unix_micros("last_msg") - F.unix_micros("start")) / 1e6
    rate = F.floor(per_second(F.col("inserted"), seconds))
    steps = F.create_map(*[F.lit(x) for pair in processing.items() for x in pair])
    return df.select(
        "tenant",
        "start",
        F.to_json(
            F.struct(
                F.col("tenant").alias("tenant_id"),
                F.lit(user_id).cast("string").alias("user_id"),
                F.struct(
                    F.array(*[F.lit(c) for c in source_schema]).alias("schema"),
                    F.lit(source_type).alias("type"),
                ).alias("source"),
                steps.alias("processing"),
                F.struct(
                    F.col("rows").alias("total_rows_processed"),
                    F.col("discarded").alias("total_rows_discarded"),
                    F.col("inserted").alias("successful_db_inserts"),
                    F.col("errored").alias("failed_db_inserts"),
                    success.alias("success_rate"),
                    rate.alias("rows_inserted_per_second"),
                ).alias("ingestion_result"),
                F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_start"),
                F.date_format("last_msg", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_end"),
                F.array(F.lit(keyspace)).alias("cassandra_keyspaces"),
                F.array(F.lit(table)).alias("cassandra_tables"),
            )
        ).alias("lineage"),
    )


def stream_complete(df, expected=None, silence=None, deadline=None, now=None):
    """Whether each tenant's bounded stream has ended, and by which rule.

    ``expected`` rows have come, or ``now`` is past ``deadline``, or nothing has come for
    longer than ``silence``; the first rule that holds is named.
    """
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    ended = F.lit(None).cast("string")
    if silence is not None:
        quiet = (F.unix_micros(now) - F.unix_micros("last_msg")) / 1e6
        ended = F.when(quiet > interval_seconds(silence), "silence").otherwise(ended)
    if deadline is not None:
        ended = F.when(now >= F.lit(deadline).cast("timestamp"), "deadline").otherwise(ended)
    if expected is not None:
        ended = F.when(F.col("rows") >= expected, "count").otherwise(ended)
    return (
        df.groupBy("tenant")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("ingest_ts").alias("last_msg"))
        .withColumn("ended_by", ended)
        .withColumn("complete", F.col("ended_by").isNotNull())
    )
