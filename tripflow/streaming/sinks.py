"""Sinks. A streaming DataFrame gives the started query, a batch one is written at once."""

from pyspark.sql import functions as F

from tripflow.functions.text import metric_log_block, to_report_json
from tripflow.functions.times import hour_dir
from tripflow.operators.upsert import upsert
from tripflow.operators.windows import silver_export

HOUR_ZONE = "Europe/Helsinki"
AVAILABLE_NOW = {"availableNow": True}
# Fixed value: a new part of each output every 5 seconds.
CONTINUOUS = {"processingTime": "5 seconds"}


def start(sdf, checkpoint, path=None, fmt="parquet", mode="append", trigger=None, **options):
    writer = sdf.writeStream.format(fmt).outputMode(mode).trigger(**(trigger or AVAILABLE_NOW))
    writer = writer.option("checkpointLocation", checkpoint).options(**options)
    return writer.start(path) if path else writer.start()


def write_messages(df, topic, fmt="kafka", path=None, checkpoint=None, options=None, mode="append",
                   trigger=None):
    """Texts (``value``) to a topic; ``text`` writes lines below ``<path>/<topic>``.

    Kafka delivery is at least once: the texts name their window, so a consumer can drop
    repeats.
    """
    rows = df.select("value")
    options = dict(options or {})
    target = None
    if fmt == "kafka":
        options["topic"] = topic
    else:
        target = f"{path}/{topic}"
    if df.isStreaming:
        return start(rows, checkpoint, target, fmt, mode, trigger, **options)
    writer = rows.write.format(fmt).mode("append").options(**options)
    return writer.save(target) if target else writer.save()


def silver_files(df, zone=HOUR_ZONE, period="hour"):
    """Silver rows in the stored form with the hour (or day) of their directory."""
    directory = hour_dir(F.timestamp_millis("window_start_ts"), zone)
    if period == "day":
        directory = F.substring_index(directory, "--", 1)
    return silver_export(df).withColumn("hour", directory)


def write_silver(sdf, base, checkpoint=None, fmt="parquet", trigger=None, period="hour"):
    """Silver files in hourly directories, each row exactly once (the sink keeps a log).

    Rows of a directory are brought together first, or each task would write a file into
    each of them. Silver is small: a row per area and window. ``period="day"`` makes daily
    directories, for a backfill over months at once or for long windows.
    """
    rows = silver_files(sdf, period=period)
    if sdf.isStreaming:
        writer = rows.repartition("hour").writeStream.format(fmt).outputMode("append").partitionBy("hour")
        return (
            writer.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW))
            .start(base)
        )
    rows = rows.hint("rebalance", "hour")
    return rows.write.format(fmt).mode("append").partitionBy("hour").save(base)


def write_metric_log(sdf, base, checkpoint=None, trigger=None):
    """Seven log lines per window."""
    rows = sdf.select(metric_log_block().alias("value"))
    if sdf.isStreaming:
        return start(rows, checkpoint, base, "text", "append", trigger)
    return rows.write.mode("append").text(base)


def write_gold(df, gold_dir, batch_id=None):
    """Gold CSV with a header, in the directory (``hour``) of the silver it came from.

    A batch of a stream owns the folder ``batch_id=N``, so writing it again changes nothing.
    """
    writer = df.repartition("hour").write.partitionBy("hour").option("header", True)
    if batch_id is None:
        return writer.mode("append").csv(gold_dir)
    return writer.mode("overwrite").csv(f"{gold_dir}/batch_id={batch_id}")


def write_run_report(df, directory):
    """Run reports as JSON texts, one folder per tenant."""
    return (
        df.select("tenant", to_report_json().alias("value"))
        .write.mode("append")
        .partitionBy("tenant")
        .text(directory)
    )


def upsert_sink(table, keys, order_cols, buckets=64, transform=None):
    """A ``foreachBatch`` function that upserts each micro-batch, once also on replay."""

    def write(batch, batch_id):
        spark = batch.sparkSession
        # The id of the query stays the same over restarts from its checkpoint.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = transform(batch) if transform else batch
        upsert(rows, table, keys, order_cols, buckets, f"{query}-{batch_id}")

    return write


def fan_out(df, sinks, checkpoint=None, trigger=None):
    """Write one DataFrame to several sinks, functions of (batch, batch id), reading it once."""

    def write(batch, batch_id):
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    if not df.isStreaming:
        return write(df, 0)
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
