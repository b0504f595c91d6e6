"""Silver, quality, lateness and gold queries over trip messages made from events."""

from pyspark.sql import functions as F

from tripflow.catalog.fixtures import (
    TRIPS_CTE,
    late_cte,
    quality_cte,
    silver_cte,
    table,
    trip_messages,
)
from tripflow.catalog.registry import query
from tripflow.functions import text, times
from tripflow.operators import gold as reports
from tripflow.operators.disposition import analytics_reason, analytics_rows
from tripflow.operators.late import late_rows, mark_late, on_time_rows
from tripflow.operators.monitor import critical_windows, quality_alerts, tenant_feed
from tripflow.operators.windows import (
    quality_ratios,
    silver,
    silver_export,
    window_quality,
    window_quality_by_key,
)

HOUR = "1 hour"


def judged_rows(spark, sf_dir):
    return analytics_reason(analytics_rows(trip_messages(table(spark, sf_dir, "events"))))


def hourly_silver(spark, sf_dir):
    return silver(judged_rows(spark, sf_dir), HOUR)


def stored_silver(spark, sf_dir):
    return silver_export(hourly_silver(spark, sf_dir))


def hourly_quality(spark, sf_dir):
    return quality_ratios(window_quality(judged_rows(spark, sf_dir), HOUR), HOUR)


def _plain(df, *money):
    """Money as DOUBLE, for comparison with SQL results."""
    return df.withColumns({c: F.col(c).cast("double") for c in money})


def silver_columns(key="area"):
    return [
        F.col(key),
        "trips",
        F.col("total_fares").cast("double").alias("total_fares"),
        times.epoch_ms("window_start").alias("window_start_ms"),
        times.epoch_ms("window_end").alias("window_end_ms"),
    ]


def silver_select(hours_ms=3600000, source="silver"):
    return f"""SELECT area::INTEGER AS area, trips, total_fares::DOUBLE AS total_fares,
  epoch_ms(window_start::TIMESTAMP) AS window_start_ms,
  epoch_ms(window_start::TIMESTAMP) + {hours_ms} AS window_end_ms FROM {source}"""


@query("silver_area_hour", f"WITH {TRIPS_CTE}, {silver_cte(3600)} {silver_select()}")
def silver_area_hour(spark, sf_dir):
    return hourly_silver(spark, sf_dir).select(*silver_columns())


@query("silver_area_minute", f"WITH {TRIPS_CTE}, {silver_cte(60)} {silver_select(60000)}")
def silver_area_minute(spark, sf_dir):
    return silver(judged_rows(spark, sf_dir)).select(*silver_columns())


@query(
    "silver_event_type_minute",
    """SELECT event_type, count(*) AS trips, sum(value::DECIMAL(18,2))::DOUBLE AS total_fares,
         epoch_us(ts) // 60000000 * 60000 AS window_start_ms,
         epoch_us(ts) // 60000000 * 60000 + 60000 AS window_end_ms
       FROM events GROUP BY event_type, epoch_us(ts) // 60000000""",
)
def silver_event_type_minute(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_type",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").cast("DECIMAL(18,2)").alias("total"),
        F.lit("good").alias("reason"),
    )
    return silver(rows, key="event_type").select(*silver_columns("event_type"))


@query(
    "sliding_silver",
    f"""WITH {TRIPS_CTE}, slide AS (
      SELECT area, total, unnest([(epoch_us(event_time) // 1000) // 1800000 * 1800000,
        (epoch_us(event_time) // 1000) // 1800000 * 1800000 - 1800000]) AS window_start_ms
      FROM msg WHERE reason = 'good')
    SELECT area::INTEGER AS area, count(*) AS trips, sum(total)::DOUBLE AS total_fares,
      window_start_ms, window_start_ms + 3600000 AS window_end_ms
    FROM slide GROUP BY area, window_start_ms""",
)
def sliding_silver(spark, sf_dir):
    return silver(judged_rows(spark, sf_dir), HOUR, "30 minutes").select(*silver_columns())


@query(
    "analytics_rows",
    f"""WITH {TRIPS_CTE} SELECT event_id AS seq, reason, total::DOUBLE AS total,
      (epoch_us(event_time) // 1000) AS event_ms, time_fallback FROM msg""",
)
def judged(spark, sf_dir):
    return judged_rows(spark, sf_dir).select(
        "seq",
        "reason",
        F.col("total").cast("double").alias("total"),
        times.epoch_ms("event_time").alias("event_ms"),
        "time_fallback",
    )


_QUALITY = "discarded, pickup_errors, timestamp_errors, time_fallback"


@query(
    "window_quality_by_key",
    f"""WITH {TRIPS_CTE} SELECT (epoch_us(event_time) // 1000) // 3600000 * 3600000 AS window_start_ms,
      CASE WHEN event_id % 37 = 0 THEN '!"NaN"' WHEN event_id % 41 = 0 THEN '!8'
           WHEN event_id % 43 = 0 THEN '!8.0' WHEN event_id % 47 = 0 THEN 'missing'
           ELSE area::VARCHAR END AS area_key,
      count(*) AS n_rows, count(*) FILTER (reason <> 'good') AS discarded,
      count(*) FILTER (reason = 'pickup_area') AS pickup_errors,
      count(*) FILTER (reason = 'timestamp') AS timestamp_errors,
      count(*) FILTER (time_fallback AND reason = 'good') AS time_fallback
    FROM msg WHERE reason <> 'malformed' GROUP BY 1, 2""",
)
def quality_by_key(spark, sf_dir):
    return window_quality_by_key(judged_rows(spark, sf_dir), HOUR).select(
        times.epoch_ms("window_start").alias("window_start_ms"),
        "area_key",
        F.col("rows").alias("n_rows"),
        *_QUALITY.split(", "),
    )


@query(
    "window_quality",
    f"""WITH {TRIPS_CTE}, {quality_cte(3600)} SELECT window_ms AS window_start_ms, n_rows, {_QUALITY},
      round(n_rows / 3600.0, 6) AS records_per_second,
      round(1.0 - discarded / n_rows, 6) AS data_quality FROM quality""",
)
def quality(spark, sf_dir):
    return hourly_quality(spark, sf_dir).select(
        times.epoch_ms("window_start").alias("window_start_ms"),
        F.col("rows").alias("n_rows"),
        *_QUALITY.split(", "),
        F.round("records_per_second", 6).alias("records_per_second"),
        F.round("data_quality", 6).alias("data_quality"),
    )


@query(
    "quality_alerts",
    f"""WITH {TRIPS_CTE}, {quality_cte(3600)} SELECT window_ms AS window_start_ms,
      'data quality alert{{"window":' || window_ms || ',"rows":' || n_rows || ',"discarded":' || discarded
      || ',"data_quality":' || (1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE) || ',"pickup_errors":'
      || pickup_errors || ',"timestamp_errors":' || timestamp_errors || '}}' AS message
    FROM quality WHERE 1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE < 0.99""",
)
def alerts(spark, sf_dir):
    return quality_alerts(hourly_quality(spark, sf_dir)).select(
        times.epoch_ms("window_start").alias("window_start_ms"),
        text.alert_message().alias("message"),
    )


@query(
    "metric_log",
    f"""WITH {TRIPS_CTE}, {quality_cte(3600)} SELECT 'window: ' || window_ms
      || chr(10) || 'records per window: ' || n_rows
      || chr(10) || 'records processed per second: ' || round(n_rows / 3600.0::DOUBLE, 9)
      || chr(10) || 'rows discarded: ' || discarded
      || chr(10) || 'data quality: ' || (1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE)
      || chr(10) || 'pickup area errors: ' || pickup_errors
      || chr(10) || 'timestamp errors: ' || timestamp_errors AS message FROM quality""",
)
def metric_log(spark, sf_dir):
    rounded = F.round("records_per_second", 9)
    return (
        hourly_quality(spark, sf_dir)
        .withColumn("records_per_second", rounded)
        .select(text.metric_log_block().alias("message"))
    )


@query(
    "critical_windows",
    f"""WITH {TRIPS_CTE}, {quality_cte(3600)} SELECT window_ms // 86400000 * 86400000 AS period_start_ms,
      count(*) AS alerts FROM quality WHERE 1.0 - discarded / n_rows < 0.9 GROUP BY 1 HAVING count(*) > 8""",
)
def critical(spark, sf_dir):
    low = quality_alerts(hourly_quality(spark, sf_dir), 0.9)
    return critical_windows(low, 8, "24 hours").select(
        times.epoch_ms("period_start").alias("period_start_ms"), "alerts"
    )


GOLD_SQL = """sum(trips)::BIGINT AS trips, sum(total_fares)::DOUBLE AS sum_fares,
  round(sum(total_fares)::DOUBLE / count(*), 6) AS avg_fares,
  min(epoch_ms(window_start::TIMESTAMP)) AS window_start_ts,
  max(epoch_ms(window_start::TIMESTAMP)) + 3600000 AS window_end_ts"""


def gold_columns(df):
    return _plain(df, "sum_fares").withColumn("avg_fares", F.round("avg_fares", 6))


@query(
    "gold_area",
    f"WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT area::INTEGER AS pickup_location_area, {GOLD_SQL} "
    "FROM silver GROUP BY 1",
)
def gold_area(spark, sf_dir):
    return gold_columns(reports.gold(stored_silver(spark, sf_dir)))


@query(
    "gold_by_day",
    f"WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT area::INTEGER AS pickup_location_area, "
    f"strftime(window_start::TIMESTAMP, '%Y-%m-%d') AS day, {GOLD_SQL} FROM silver GROUP BY 1, 2",
)
def gold_by_day(spark, sf_dir):
    rows = gold_columns(reports.gold_by_day(stored_silver(spark, sf_dir)))
    return rows.withColumn("day", F.col("day").cast("string"))


@query(
    "gold_by_weekday",
    f"WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT area::INTEGER AS pickup_location_area, "
    f"(dayofweek(window_start::TIMESTAMP) + 1)::INTEGER AS weekday, {GOLD_SQL} FROM silver GROUP BY 1, 2",
)
def gold_by_weekday(spark, sf_dir):
    return gold_columns(reports.gold_by_weekday(stored_silver(spark, sf_dir)))


def _top(direction):
    return f"""WITH {TRIPS_CTE}, {silver_cte(3600)}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY trips {direction}, area) AS r FROM silver)
    SELECT area::INTEGER AS pickup_location_area, trips, total_fares::DOUBLE AS total_fares,
      epoch_ms(window_start::TIMESTAMP) AS window_start_ts,
      epoch_ms(window_start::TIMESTAMP) + 3600000 AS window_end_ts, r::INTEGER AS "rank"
    FROM ranked WHERE r <= 3"""


@query("top_areas", _top("DESC"))
def top_areas(spark, sf_dir):
    return _plain(reports.top_areas(stored_silver(spark, sf_dir), 3), "total_fares")


@query("quiet_areas", _top("ASC"))
def quiet_areas(spark, sf_dir):
    return _plain(reports.top_areas(stored_silver(spark, sf_dir), 3, True), "total_fares")


@query(
    "anomaly_scores",
    f"""WITH {TRIPS_CTE}, {silver_cte(3600)}, stats AS (
      SELECT area, avg(trips) AS m, stddev_pop(trips) AS d FROM silver GROUP BY 1)
    SELECT area::INTEGER AS pickup_location_area, epoch_ms(window_start::TIMESTAMP) AS window_start_ts, trips,
      round(CASE WHEN d > 0 THEN (trips - m) / d ELSE 0 END, 6) AS z_score
    FROM silver JOIN stats USING (area)""",
)
def anomaly_scores(spark, sf_dir):
    return reports.score_anomaly(stored_silver(spark, sf_dir)).select(
        "pickup_location_area", "window_start_ts", "trips", F.round("z_score", 6).alias("z_score")
    )


@query(
    "expected_demand",
    f"""WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT area::INTEGER AS pickup_location_area,
      (dayofweek(window_start::TIMESTAMP) + 1)::INTEGER AS weekday,
      hour(window_start::TIMESTAMP)::INTEGER AS "hour", round(avg(trips), 6) AS expected_trips,
      count(*) AS windows FROM silver GROUP BY 1, 2, 3""",
)
def expected_demand(spark, sf_dir):
    rows = reports.predict_demand(stored_silver(spark, sf_dir))
    return rows.withColumn("expected_trips", F.round("expected_trips", 6))


@query(
    "late_rows",
    f"""WITH {TRIPS_CTE}, {late_cte(3600)} SELECT event_id AS seq,
      'Record ignored from analytics due lateness: ' || message AS message FROM judged WHERE late""",
)
def late_hour(spark, sf_dir):
    return late_rows(judged_rows(spark, sf_dir), HOUR).select(
        "seq", text.late_message().alias("message")
    )


@query(
    "late_rows_minute",
    f"WITH {TRIPS_CTE}, {late_cte(60)} SELECT event_id AS seq, late FROM judged",
)
def late_minute(spark, sf_dir):
    return mark_late(judged_rows(spark, sf_dir)).select("seq", "late")


@query(
    "on_time_silver",
    f"WITH {TRIPS_CTE}, {late_cte(3600)}, on_time AS (SELECT * FROM judged WHERE NOT late), "
    f"{silver_cte(3600, 'on_time')} {silver_select()}",
)
def on_time_silver(spark, sf_dir):
    return silver(on_time_rows(judged_rows(spark, sf_dir), HOUR), HOUR).select(*silver_columns())


LINE_SQL = """area || ',' || trips || ',' || total_fares::DECIMAL(18,2) || ','
  || epoch_ms(window_start::TIMESTAMP) || ',' || (epoch_ms(window_start::TIMESTAMP) + 3600000)"""


@query(
    "silver_lines",
    f"WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT {LINE_SQL} AS line FROM silver",
)
def silver_lines(spark, sf_dir):
    return hourly_silver(spark, sf_dir).select(text.silver_line().alias("line"))


@query(
    "tenant_feed",
    f"""WITH {TRIPS_CTE}, {late_cte(3600)}, on_time AS (SELECT * FROM judged WHERE NOT late),
      {silver_cte(3600, 'on_time')}, {quality_cte(3600, 'on_time')}
    SELECT 'Silver data: ' || {LINE_SQL} AS value FROM silver
    UNION ALL SELECT 'Record ignored from analytics due lateness: ' || message FROM judged WHERE late
    UNION ALL SELECT 'data quality alert{{"window":' || window_ms || ',"rows":' || n_rows || ',"discarded":' || discarded
      || ',"data_quality":' || (1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE) || ',"pickup_errors":'
      || pickup_errors || ',"timestamp_errors":' || timestamp_errors || '}}'
    FROM quality WHERE 1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE < 0.99""",
)
def feed(spark, sf_dir):
    marked = mark_late(judged_rows(spark, sf_dir), HOUR)
    on_time = marked.filter(~F.col("late"))
    low = quality_alerts(quality_ratios(window_quality(on_time, HOUR), HOUR))
    return tenant_feed(
        silver(on_time, HOUR).select(text.silver_message().alias("value")),
        marked.filter("late").select(text.late_message().alias("value")),
        low.select(text.alert_message().alias("value")),
    )


@query(
    "silver_paths",
    f"""WITH {TRIPS_CTE}, {silver_cte(3600)}, hours AS (SELECT DISTINCT window_start::TIMESTAMP AS w FROM silver)
    SELECT epoch_ms(w) AS window_start_ms, strftime(w + INTERVAL 2 HOUR, '%Y-%m-%d--%H') AS hour_dir,
      '/t/goldData/' || strftime(w + INTERVAL 2 HOUR, '%Y-%m-%d--%H') || '/' AS gold_path,
      '/t/silverData/' || strftime(w + INTERVAL 2 HOUR, '%Y-%m-%d--%H') || '/part-0_processed.csv' AS processed,
      'csv' AS ext, strftime(w, '%Y-%m-%d %H:%M:%S') AS started FROM hours""",
)
def silver_paths(spark, sf_dir):
    hours = hourly_silver(spark, sf_dir).select("window_start").distinct()
    path = F.concat(F.lit("/t/silverData/"), F.col("hour_dir"), F.lit("/part-0.csv"))
    return (
        hours.withColumn("hour_dir", times.hour_dir("window_start"))
        .withColumn("path", path)
        .select(
            times.epoch_ms("window_start").alias("window_start_ms"),
            "hour_dir",
            text.gold_path("path").alias("gold_path"),
            text.processed_name("path").alias("processed"),
            text.file_ext("path").alias("ext"),
            times.epoch_text(F.unix_seconds("window_start")).alias("started"),
        )
    )


@query(
    "topic_tenants",
    """WITH t AS (SELECT CASE event_id % 3 WHEN 0 THEN 'chicagotenant' WHEN 1 THEN 'nytenant'
        ELSE 'thirdtenant' END AS tenant FROM events)
      SELECT tenant, 'trips' AS kind, count(*) AS messages FROM t GROUP BY 1""",
)
def topic_tenants(spark, sf_dir):
    messages = trip_messages(table(spark, sf_dir, "events"))
    return messages.groupBy(
        text.tenant_of("topic").alias("tenant"), text.message_kind("topic").alias("kind")
    ).agg(F.count(F.lit(1)).alias("messages"))


