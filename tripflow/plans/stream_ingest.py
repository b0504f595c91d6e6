"""Stream ingest of the tenants: messages -> verdict -> keyed table, with a ledger of verdicts.

The ledger (tenant, arrival time, disposition) is what status, warnings, actions, sessions
and run reports are computed from.
"""

from pyspark.sql import functions as F

from tripflow.functions.text import tenant_of
from tripflow.functions.times import parse_iso_z
from tripflow.operators.cleanse import drop_unused, nan_to_null, snake_columns, whole_number
from tripflow.operators.disposition import ingest_disposition, quarantine, split_by_tag
from tripflow.operators.ingest import activity_actions, activity_sessions, ingest_status, run_report
from tripflow.operators.monitor import recommend_actions, status_warnings
from tripflow.schemas import CHICAGO_KEY, NY_KEY, NY_RENAMES, NY_UNUSED
from tripflow.streaming.sinks import fan_out, upsert_sink

LEDGER = "tenant STRING, ingest_ts TIMESTAMP, disposition STRING"
ARRIVAL = ["ingest_ts", "seq"]


def chicago_rows(judged):
    """Accepted Chicago messages in the stored form, plus arrival columns."""
    rows = snake_columns(drop_unused(nan_to_null(judged)))
    times = {c: parse_iso_z(c) for c in ("trip_start_timestamp", "trip_end_timestamp")}
    return rows.withColumns(times | {"trip_seconds": whole_number("trip_seconds")}).drop(
        "value", "topic", "malformed", "disposition", "reason"
    )


def ny_rows(judged):
    """Accepted New York messages in the stored form, plus arrival columns."""
    rows = drop_unused(nan_to_null(judged), NY_UNUSED).withColumnsRenamed(NY_RENAMES)
    times = {c: parse_iso_z(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    whole = {c: F.col(c).try_cast("int") for c in ("vendor_id", "passenger_count", "ratecode_id")}
    whole |= {c: whole_number(c) for c in ("pu_location_id", "do_location_id", "payment_type")}
    return rows.withColumns(times | whole).drop(
        "value", "topic", "malformed", "disposition", "valid_key"
    )


def ny_verdict(messages):
    """Quarantine test, then ``errored`` where a key is there but cannot be used."""
    rows = quarantine(messages)
    no_time = parse_iso_z("tpep_dropoff_datetime").isNull()
    no_vendor = F.col("VendorID").try_cast("int").isNull()
    unusable = (F.col("disposition") == "ok") & (no_time | no_vendor)
    return rows.withColumn(
        "disposition", F.when(unusable, "errored").otherwise(F.col("disposition"))
    )


def _ledger_sink(path):
    """Append the verdicts of a batch; a batch owns its folder, so replay changes nothing."""

    def write(batch, batch_id):
        rows = batch.select(
            tenant_of("topic").alias("tenant"),
            "ingest_ts",
            F.when(F.col("disposition") == "quarantine", "discarded")
            .otherwise(F.col("disposition"))
            .alias("disposition"),
        )
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _quarantine_sink(path):
    def write(batch, batch_id):
        _, kept_out = split_by_tag(batch)
        kept_out.select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def ingest_stream(messages, base, judge, to_rows, keys, buckets=16, trigger=None):
    """Start a tenant's ingest: table, ledger and quarantine below ``base``."""
    store = upsert_sink(
        f"{base}/table",
        keys,
        ARRIVAL,
        buckets,
        transform=lambda batch: to_rows(split_by_tag(batch)[0]),
    )
    sinks = [store, _ledger_sink(f"{base}/ledger"), _quarantine_sink(f"{base}/quarantine")]
    return fan_out(judge(messages), sinks, f"{base}/_checkpoint", trigger)


def chicago_stream_ingest(messages, base, **options):
    return ingest_stream(messages, base, ingest_disposition, chicago_rows, CHICAGO_KEY, **options)


def ny_stream_ingest(messages, base, **options):
    return ingest_stream(messages, base, ny_verdict, ny_rows, NY_KEY, **options)


def read_ledger(spark, base):
    return spark.read.schema(LEDGER).parquet(f"{base}/ledger").drop("batch_id")


def control_feeds(ledger, limits):
    """Status, warnings, recommended actions, runs and reports of a ledger, by name."""
    status = ingest_status(ledger)
    warnings = status_warnings(status, limits)
    sessions = activity_sessions(ledger)
    return {
        "status": status,
        "warnings": warnings,
        "actions": recommend_actions(warnings),
        "runs": activity_actions(sessions),
        "reports": run_report(ledger),
    }
