"""Silver analytics and gold batch over streams."""

from tripflow.schemas import ALLOWED_LATENESS, WATERMARK_DELAY, WINDOW_SIZE
from tripflow.streaming.bronze import read_bronze, write_bronze
from tripflow.streaming.files import make_dir
from tripflow.streaming.runs import (
    feed_streams,
    quality_stream,
    run_gold_incremental,
    silver_stream,
)
from tripflow.streaming.sinks import write_messages, write_metric_log, write_silver

FEED_TOPIC = "chicagotenant_analytics"


def silver_analytics(messages, base, size=WINDOW_SIZE, delay=WATERMARK_DELAY,
                     lateness=ALLOWED_LATENESS, fmt="parquet", period="hour",
                     feed="text", feed_options=None, outputs=("silver", "logs", "feed"),
                     trigger=None):
    """Messages -> bronze -> silver files, window log and the tenant's feed, below ``base``.

    Takes the messages there are and returns when they are through; running it again with
    the same ``base`` takes up where it stopped. The last windows stay open until later
    messages close them. With a trigger such as ``CONTINUOUS`` all streams go on until
    stopped. Returns the queries.
    """
    spark = messages.sparkSession
    make_dir(spark, f"{base}/bronze/rows")
    intake = write_bronze(messages, f"{base}/bronze", size, delay, lateness, trigger)
    if trigger is None:
        intake.awaitTermination()
    timing = (size, delay, lateness)
    checkpoints = f"{base}/_checkpoints"

    def bronze():
        return read_bronze(spark, f"{base}/bronze")

    started = [intake]
    if "silver" in outputs:
        silver_rows = silver_stream(bronze(), *timing)
        started.append(
            write_silver(silver_rows, f"{base}/silverData", f"{checkpoints}/silver", fmt,
                         trigger, period)
        )
    if "logs" in outputs:
        started.append(
            write_metric_log(quality_stream(bronze(), *timing), f"{base}/logs",
                             f"{checkpoints}/logs", trigger)
        )
    if "feed" in outputs:
        for name, texts in feed_streams(bronze(), *timing).items():
            # Each writer of files needs a folder of its own; a topic is shared.
            started.append(
                write_messages(texts, FEED_TOPIC, feed, f"{base}/feed/{name}",
                               f"{checkpoints}/feed_{name}", feed_options, trigger=trigger)
            )
    if trigger is None:
        for query in started:
            query.awaitTermination()
    return started


def gold_batch(spark, base, fmt="parquet"):
    """Gold of the silver files that are new since the last call, below ``base``."""
    run_gold_incremental(
        spark, f"{base}/silverData", f"{base}/goldData", f"{base}/_checkpoints/gold", fmt
    ).awaitTermination()
