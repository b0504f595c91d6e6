"""Bronze rows: parsed messages with their verdict and lateness, written once per batch."""

from pyspark.sql import functions as F

from tripflow.functions.times import epoch_ms
from tripflow.operators.disposition import analytics_reason, analytics_rows
from tripflow.operators.late import mark_late
from tripflow.schemas import ALLOWED_LATENESS, WATERMARK_DELAY, WINDOW_SIZE
from tripflow.streaming.files import exists, rename
from tripflow.streaming.sinks import AVAILABLE_NOW

BRONZE = """
    value STRING, topic STRING, ingest_ts TIMESTAMP, seq BIGINT, malformed BOOLEAN,
    area INT, start_text STRING, total DECIMAL(18,2), event_time TIMESTAMP,
    time_fallback BOOLEAN, reason STRING, late BOOLEAN
"""


def write_bronze(messages, base, size=WINDOW_SIZE, delay=WATERMARK_DELAY,
                 lateness=ALLOWED_LATENESS, trigger=None):
    """Start the stream messages -> ``<base>/rows/batch_id=N``.

    Spark drops late rows without a trace and one batch behind; here lateness is judged per
    record, over micro-batches: each batch stores the largest event time so far and the next
    one starts from it. A batch is written under a hidden name and renamed when it is
    complete, so readers see all of it or nothing and a replay of it does nothing.
    """

    def write(batch, batch_id):
        spark = batch.sparkSession
        target = f"{base}/rows/batch_id={batch_id}"
        if exists(spark, target):
            return
        seen = None
        if batch_id > 0:
            seen = spark.read.parquet(f"{base}/seen/batch_id={batch_id - 1}").first().seen_ms
        # A source without arrival numbers: the order within the batch.
        numbered = batch.withColumn(
            "seq", F.coalesce("seq", F.monotonically_increasing_id())
        )
        # Read twice: for the closing arrivals and for the rows.
        rows = analytics_reason(analytics_rows(numbered)).persist()
        hidden = f"{base}/rows/_batch_{batch_id}"
        mark_late(rows, size, delay, lateness, seen).write.mode("overwrite").parquet(hidden)
        rows.unpersist()
        newest = F.max(F.when(F.col("reason") != "malformed", epoch_ms("event_time")))
        spark.read.schema(BRONZE).parquet(hidden).agg(
            F.greatest(newest, F.lit(seen).cast("bigint")).alias("seen_ms")
        ).write.mode("overwrite").parquet(f"{base}/seen/batch_id={batch_id}")
        rename(spark, hidden, target)

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_bronze(spark, base, streaming=True, files_per_batch=None):
    """Bronze rows; a file never holds rows of two batches."""
    reader = (spark.readStream if streaming else spark.read).schema(BRONZE + ", batch_id BIGINT")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{base}/rows").drop("batch_id")
