"""Streaming forms of the analytics, status, session and gold operators."""

from pyspark.sql import functions as F

from tripflow.functions.text import alert_message, late_message, silver_message
from tripflow.operators.gold import gold
from tripflow.operators.monitor import quality_alerts
from tripflow.operators.windows import quality_ratios, silver, window_quality
from tripflow.schemas import (
    ALLOWED_LATENESS,
    SILVER,
    WATERMARK_DELAY,
    WINDOW_SIZE,
)
from tripflow.session import interval_seconds
from tripflow.streaming.sinks import AVAILABLE_NOW, write_gold


def watermarked(rows, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    """Windows stay open for the out-of-order delay plus the allowed lateness.

    ``append`` output then gives each window once, when no accepted row can still come;
    ``update`` output gives it again whenever a late row changes it.
    """
    wait = interval_seconds(delay) + interval_seconds(lateness)
    return rows.withWatermark("event_time", f"{wait} seconds")


def silver_stream(bronze, size=WINDOW_SIZE, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    """Silver rows of a bronze stream, without the late rows."""
    good = bronze.filter(~F.col("late") & (F.col("reason") == "good"))
    return silver(watermarked(good, delay, lateness), size)


def quality_stream(bronze, size=WINDOW_SIZE, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    """Window quality with ratios of a bronze stream, without the late rows."""
    on_time = bronze.filter(~F.col("late") & ~F.col("malformed"))
    return quality_ratios(window_quality(watermarked(on_time, delay, lateness), size), size)


def feed_streams(bronze, size=WINDOW_SIZE, delay=WATERMARK_DELAY, lateness=ALLOWED_LATENESS):
    """The three text streams a tenant's feed is made of, by name."""
    quality = quality_stream(bronze, size, delay, lateness)
    return {
        "silver": silver_stream(bronze, size, delay, lateness).select(
            silver_message().alias("value")
        ),
        "late": bronze.filter("late").select(late_message().alias("value")),
        "alerts": quality_alerts(quality).select(alert_message().alias("value")),
    }


def run_gold_incremental(spark, silver_dir, gold_dir, checkpoint, fmt="parquet",
                         archive_dir=None, trigger=None):
    """Gold per silver directory of the files that came since the last run.

    The checkpoint remembers the files taken, so none is counted twice and a run without
    new files writes nothing. ``archive_dir`` also moves taken files out of the way.
    """
    reader = spark.readStream.schema(SILVER + ", hour STRING")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    silver_rows = reader.csv(silver_dir) if fmt == "csv" else reader.parquet(silver_dir)

    def write(batch, batch_id):
        write_gold(gold(batch, "hour"), gold_dir, batch_id)

    return (
        silver_rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
