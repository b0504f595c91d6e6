"""Event-time windows: silver rows and data quality."""

from pyspark.sql import functions as F

from tripflow.functions.times import epoch_ms
from tripflow.operators.disposition import raw_area_key
from tripflow.schemas import WINDOW_SIZE
from tripflow.session import interval_seconds


def _window(size, slide=None):
    width = f"{interval_seconds(size)} seconds"
    if slide is None:
        return F.window("event_time", width)
    return F.window("event_time", width, f"{interval_seconds(slide)} seconds")


def silver(df, size=WINDOW_SIZE, slide=None, key="area"):
    """Trips and fares of the good rows per key and window (tumbling, or sliding)."""
    return (
        df.filter(F.col("reason") == "good")
        .groupBy(_window(size, slide).alias("window"), key)
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total").alias("total_fares"))
        .select(
            key,
            "trips",
            "total_fares",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


def silver_export(df, key="area"):
    """Silver rows in the stored form, window bounds in epoch milliseconds."""
    return df.select(
        F.col(key).alias("pickup_location_area"),
        "trips",
        F.col("total_fares").cast("DECIMAL(28,2)").alias("total_fares"),
        epoch_ms("window_start").alias("window_start_ts"),
        epoch_ms("window_end").alias("window_end_ts"),
    )


def _quality_counts():
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reason") != "good").alias("discarded"),
        F.count_if(F.col("reason") == "pickup_area").alias("pickup_errors"),
        F.count_if(F.col("reason") == "timestamp").alias("timestamp_errors"),
        F.count_if(F.col("time_fallback") & (F.col("reason") == "good")).alias("time_fallback"),
    ]


def window_quality_by_key(df, size=WINDOW_SIZE):
    """Row and error counts per window and area as sent; faulty areas form own groups."""
    return (
        df.filter(F.col("reason") != "malformed")
        .withColumn("area_key", raw_area_key())
        .groupBy(_window(size).alias("window"), "area_key")
        .agg(*_quality_counts())
        .select(
            "area_key",
            F.col("window.start").alias("window_start"),
            "rows",
            "discarded",
            "pickup_errors",
            "timestamp_errors",
            "time_fallback",
        )
    )


def window_quality(df, size=WINDOW_SIZE):
    """Row and error counts per window over the whole stream.

    The counts add up over keys, so they are taken straight from the rows: one shuffle of
    one partial row per window and task, and no second window stage.
    """
    return (
        df.filter(F.col("reason") != "malformed")
        .groupBy(_window(size).alias("window"))
        .agg(*_quality_counts())
        .select(
            F.col("window.start").alias("window_start"),
            "rows",
            "discarded",
            "pickup_errors",
            "timestamp_errors",
            "time_fallback",
        )
    )


def quality_ratios(df, size=WINDOW_SIZE):
    """Add ``records_per_second`` and ``data_quality`` (NULL for a window without rows)."""
    return df.withColumn(
        "records_per_second", F.col("rows") / F.lit(float(interval_seconds(size)))
    ).withColumn(
        "data_quality",
        F.when(F.col("rows") > 0, F.lit(1.0) - F.col("discarded") / F.col("rows")),
    )
