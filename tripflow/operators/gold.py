"""Reports over silver rows (stored form, see ``schemas.SILVER``)."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def _totals():
    return [
        F.sum("trips").alias("trips"),
        F.sum("total_fares").alias("sum_fares"),
        # Mean of the window totals, not fare per trip; exact sum, so no rounding by order.
        (F.sum("total_fares").cast("double") / F.count("total_fares")).alias("avg_fares"),
        F.min("window_start_ts").alias("window_start_ts"),
        F.max("window_end_ts").alias("window_end_ts"),
    ]


def gold(silver, *more_keys):
    """Trips and fares per area over all windows (and per further columns)."""
    return silver.groupBy("pickup_location_area", *more_keys).agg(*_totals())


def gold_by_day(silver):
    """Trips and fares per area and day."""
    day = F.to_date(F.timestamp_millis("window_start_ts")).alias("day")
    return gold(silver, day)


def gold_by_weekday(silver):
    """Trips and fares per area and weekday (1 = Sunday)."""
    weekday = F.dayofweek(F.timestamp_millis("window_start_ts")).alias("weekday")
    return gold(silver, weekday)


def top_areas(silver, k, ascending=False):
    """The k busiest (or quietest) areas of each window; ties go to the smaller area."""
    trips = F.asc("trips") if ascending else F.desc("trips")
    by_window = Window.partitionBy("window_start_ts").orderBy(trips, "pickup_location_area")
    return silver.withColumn("rank", F.row_number().over(by_window)).filter(F.col("rank") <= k)


def score_anomaly(silver, limit=3.0):
    """Z-score of each window's trips within its area, and whether it is beyond the limit.

    Mean and deviation come from a partial aggregation and are joined back, so no task
    holds all windows of an area.
    """
    stats = silver.groupBy("pickup_location_area").agg(
        F.avg("trips").alias("mean_trips"), F.stddev_pop("trips").alias("dev_trips")
    )
    z = F.when(
        F.col("dev_trips") > 0, (F.col("trips") - F.col("mean_trips")) / F.col("dev_trips")
    ).otherwise(0.0)
    return (
        silver.join(stats, "pickup_location_area")
        .withColumn("z_score", z)
        .withColumn("anomaly", F.abs("z_score") > limit)
    )


def predict_demand(silver):
    """Expected trips per area, weekday and hour: the mean of the windows seen so far."""
    start = F.timestamp_millis("window_start_ts")
    return silver.groupBy(
        "pickup_location_area", F.dayofweek(start).alias("weekday"), F.hour(start).alias("hour")
    ).agg(F.avg("trips").alias("expected_trips"), F.count(F.lit(1)).alias("windows"))
