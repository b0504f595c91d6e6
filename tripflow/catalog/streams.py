"""Queries that run the platform's jobs on files and streams and read back what they stored.

Each call works in a folder of its own below the shared folder.
"""

from pyspark.sql import functions as F

from tripflow.catalog.analytics import (
    GOLD_SQL,
    HOUR,
    LINE_SQL,
    gold_columns,
    hourly_silver,
    silver_columns,
    silver_select,
)
from tripflow.catalog.fixtures import (
    EVENTS_CTE,
    TENANTS,
    TRIPS_CTE,
    ingest_messages,
    late_cte,
    ledger,
    limits,
    ny_messages,
    quality_cte,
    silver_cte,
    table,
    trip_messages,
)
from tripflow.catalog.ingest import (
    CHICAGO_SQL,
    CLEAN_SQL,
    KEPT_OUT,
    LEDGER_CTE,
    NY_SQL,
    UPSERT_KEY,
    UPSERT_ORDER,
    VERDICT,
    WARNING_SQL,
    chicago_columns,
    clean_columns,
    ny_columns,
    sessions_cte,
    staged_trips,
    status_by_hour,
    status_cte,
)
from tripflow.catalog.registry import ORACLES, query
from tripflow.operators.ingest import activity_sessions, ingest_status, run_report
from tripflow.operators.monitor import breaches, recommend_actions, status_warnings
from tripflow.operators.trips import drop_repeats
from tripflow.operators.upsert import read_table, upsert
from tripflow.plans.analytics import FEED_TOPIC, gold_batch, silver_analytics
from tripflow.plans.batch_ingest import ingest_staged, staging_decisions
from tripflow.plans.dynamic_ingest import ingest_dynamic
from tripflow.plans.stream_ingest import chicago_stream_ingest, ny_stream_ingest, read_ledger
from tripflow.schemas import AGREEMENT, GOLD
from tripflow.session import ROCKS_DB, fresh_dir
from tripflow.sources.agreements import read_agreements
from tripflow.sources.files import new_silver, read_silver
from tripflow.sources.messages import read_messages
from tripflow.streaming.bronze import read_bronze, write_bronze
from tripflow.streaming.control import CONTROL, run_actions, status_reports, tenant_control, watch
from tripflow.streaming.runs import silver_stream
from tripflow.streaming.sinks import (
    start,
    upsert_sink,
    write_messages,
    write_run_report,
    write_silver,
)


# The given events start on this day.
FIRST_DAY = "2024-01-01"


def stream_events(spark, sf_dir):
    whole = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(whole.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return stream


def _analytics_run(spark, sf_dir, output):
    base = fresh_dir(spark, "analytics")
    messages = trip_messages(stream_events(spark, sf_dir))
    # The events span a month, so daily directories.
    silver_analytics(messages, base, HOUR, period="day", outputs=(output,))
    return base


# Windows the stream has closed: their end is not after the watermark (80 s behind).
_CLOSED = f"""{TRIPS_CTE}, {late_cte(3600)}, on_time AS (SELECT * FROM judged WHERE NOT late),
  {silver_cte(3600, 'on_time', 'all_silver')}, silver AS (SELECT * FROM all_silver
    WHERE epoch_ms(window_start::TIMESTAMP) + 3600000 <= (SELECT max(epoch_us(event_time) // 1000) FROM on_time
      WHERE reason = 'good') - 80000),
  {quality_cte(3600, 'on_time', 'all_quality')}, quality AS (SELECT * FROM all_quality
    WHERE window_ms + 3600000 <= (SELECT max(epoch_us(event_time) // 1000) FROM on_time
      WHERE reason <> 'malformed') - 80000)"""


@query("stream_silver", f"WITH {_CLOSED} {silver_select()}")
def stream_silver(spark, sf_dir):
    base = _analytics_run(spark, sf_dir, "silver")
    return read_silver(spark, f"{base}/silverData", "parquet").select(
        F.col("pickup_location_area").alias("area"),
        "trips",
        F.col("total_fares").cast("double").alias("total_fares"),
        F.col("window_start_ts").alias("window_start_ms"),
        F.col("window_end_ts").alias("window_end_ms"),
    )


@query(
    "stream_feed",
    f"""WITH {_CLOSED} SELECT 'Silver data: ' || {LINE_SQL} AS value FROM silver
    UNION ALL SELECT 'Record ignored from analytics due lateness: ' || message FROM judged WHERE late
    UNION ALL SELECT 'data quality alert{{"window":' || window_ms || ',"rows":' || n_rows || ',"discarded":' || discarded
      || ',"data_quality":' || (1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE) || ',"pickup_errors":'
      || pickup_errors || ',"timestamp_errors":' || timestamp_errors || '}}'
    FROM quality WHERE 1.0::DOUBLE - discarded::DOUBLE / n_rows::DOUBLE < 0.99""",
)
def stream_feed(spark, sf_dir):
    base = _analytics_run(spark, sf_dir, "feed")
    return spark.read.text([f"{base}/feed/{n}/{FEED_TOPIC}" for n in ("silver", "late", "alerts")])


@query(
    "stream_metric_log",
    f"""WITH {_CLOSED}, lines AS (SELECT unnest(['window: ' || window_ms, 'records per window: ' || n_rows,
      'rows discarded: ' || discarded, 'pickup area errors: ' || pickup_errors,
      'timestamp errors: ' || timestamp_errors]) AS line FROM quality)
    SELECT line, count(*) AS n FROM lines GROUP BY 1""",
)
def stream_metric_log(spark, sf_dir):
    base = _analytics_run(spark, sf_dir, "logs")
    lines = spark.read.text(f"{base}/logs").withColumnRenamed("value", "line")
    ratios = F.col("line").startswith("data quality") | F.col("line").startswith("records processed")
    return lines.filter(~ratios).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_gold",
    f"""WITH {_CLOSED} SELECT area::INTEGER AS pickup_location_area,
      strftime(window_start::TIMESTAMP + INTERVAL 2 HOUR, '%Y-%m-%d') AS directory, {GOLD_SQL}
    FROM silver GROUP BY 1, 2""",
)
def stream_gold(spark, sf_dir):
    base = _analytics_run(spark, sf_dir, "silver")
    gold_batch(spark, base)
    gold_batch(spark, base)  # nothing new: writes nothing
    rows = spark.read.schema(GOLD + ", batch_id BIGINT, hour STRING").option("header", True)
    stored = rows.csv(f"{base}/goldData").withColumnRenamed("hour", "directory")
    return gold_columns(stored.drop("batch_id"))


@query(
    "silver_csv_files",
    f"WITH {TRIPS_CTE}, {silver_cte(3600)} {silver_select()}",
)
def silver_csv_files(spark, sf_dir):
    base = fresh_dir(spark, "silver")
    write_silver(hourly_silver(spark, sf_dir), base, fmt="csv", period="day")
    return read_silver(spark, base).select(
        F.col("pickup_location_area").alias("area"),
        "trips",
        F.col("total_fares").cast("double").alias("total_fares"),
        F.col("window_start_ts").alias("window_start_ms"),
        F.col("window_end_ts").alias("window_end_ms"),
    )


@query(
    "message_files",
    f"WITH {TRIPS_CTE} SELECT 'chicagotenant_trips' AS topic, message AS value FROM msg",
)
def message_files(spark, sf_dir):
    base = fresh_dir(spark, "topic")
    messages = trip_messages(table(spark, sf_dir, "events"))
    write_messages(messages, "chicagotenant_trips", "text", base)
    return read_messages(spark, base, "text", streaming=False).select("topic", "value")


@query(
    "stream_chicago_table",
    f"WITH {EVENTS_CTE} SELECT {CHICAGO_SQL} FROM ev WHERE {VERDICT} = 'ok/'",
)
def stream_chicago_table(spark, sf_dir):
    base = fresh_dir(spark, "chicago")
    messages = ingest_messages(stream_events(spark, sf_dir))
    chicago_stream_ingest(messages, base, buckets=8).awaitTermination()
    return chicago_columns(read_table(spark, f"{base}/table"))


@query(
    "stream_ny_table",
    f"""WITH {EVENTS_CTE}, newest AS (SELECT *, row_number() OVER (PARTITION BY epoch_us(ts) // 1000000, event_id % 2
        ORDER BY ingest_ts DESC, event_id DESC) AS rn FROM ev WHERE NOT ({KEPT_OUT} OR event_id % 59 = 0))
      SELECT {NY_SQL} FROM newest WHERE rn = 1""",
)
def stream_ny_table(spark, sf_dir):
    base = fresh_dir(spark, "ny")
    ny_stream_ingest(ny_messages(stream_events(spark, sf_dir)), base, buckets=8).awaitTermination()
    return ny_columns(read_table(spark, f"{base}/table"))


@query(
    "stream_ingest_actions",
    status_cte(1800)
    + WARNING_SQL
    + """ SELECT tenant, interval_no, warning,
      CASE WHEN warning = 'maxDiscardedRowsRelation' THEN 'stop' ELSE 'restart' END AS action
    FROM warned WHERE warning IS NOT NULL""",
)
def stream_ingest_actions(spark, sf_dir):
    base = fresh_dir(spark, "ledger")
    messages = ingest_messages(stream_events(spark, sf_dir))
    chicago_stream_ingest(messages, base, buckets=8).awaitTermination()
    status = ingest_status(read_ledger(spark, base), "30 minutes")
    return recommend_actions(status_warnings(status, limits(spark))).select(
        "tenant", "interval_no", "warning", "action"
    )


def _stage(spark, sf_dir):
    """Staged files of three tenants: CSV, JSON, and a type nobody may send."""
    base = fresh_dir(spark, "staging")
    events = table(spark, sf_dir, "events")
    for number, (tenant, ext) in enumerate(zip(TENANTS, ["csv", "json", "txt"])):
        rows = staged_trips(events.filter(F.col("event_id") % 3 == number))
        target = f"{base}/files/{tenant}"
        if ext == "txt":
            rows.select(F.to_json(F.struct("*")).alias("value")).write.text(target)
        else:
            writer = rows.repartition(4).write.option("header", True)
            getattr(writer, ext)(target)
    terms = [
        (t, "clean_chicago", f"/{t}", f"{t}_space", "trips",
         {"csv": True, "json": True, "txt": False}, 1e6, 1000, 10, 1e6, 10)
        for t in TENANTS
    ]
    agreements = spark.createDataFrame(terms, AGREEMENT)
    agreements.write.option("maxRecordsPerFile", 1).json(f"{base}/agreements")
    return f"{base}/files", read_agreements(spark, f"{base}/agreements"), f"{base}/tables"


@query(
    "batch_ingest_tables",
    f"""SELECT CASE event_id % 3 WHEN 0 THEN 'chicagotenant_space' ELSE 'nytenant_space' END AS keyspace, {CLEAN_SQL}
        FROM events WHERE event_id % 3 < 2""",
)
def batch_ingest_tables(spark, sf_dir):
    staging, agreements, tables = _stage(spark, sf_dir)
    ingest_staged(spark, staging, agreements, tables, buckets=8)
    rows = read_table(spark, tables).filter("table = 'trips'")
    return clean_columns(rows, "keyspace")


@query(
    "staging_decisions",
    """SELECT 'chicagotenant' AS tenant, 'csv' AS ext, true AS accepted, '' AS reason, true AS taken
       UNION ALL SELECT 'nytenant', 'json', true, '', true
       UNION ALL SELECT 'thirdtenant', 'txt', false, 'unsupported_type', false""",
)
def decisions(spark, sf_dir):
    staging, agreements, _ = _stage(spark, sf_dir)
    rows = staging_decisions(spark, staging, agreements)
    return rows.select(
        "tenant", "ext", "accepted", "reason", F.col("interval_no").isNotNull().alias("taken")
    ).distinct()


@query(
    "dynamic_ingest",
    f"""WITH {EVENTS_CTE}, m AS (SELECT event_id % 5 AS consumer, ingest_ts,
        event_id % 101 = 0 OR event_id % 37 = 0 OR (event_id % 47 = 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0)
          AS bad FROM ev)
      SELECT consumer, count(*) AS messages, count(*) FILTER (NOT bad) AS inserted,
        count(*) FILTER (bad) AS insert_errors, 0::BIGINT AS transport_errors FROM m GROUP BY 1""",
)
def dynamic_ingest(spark, sf_dir):
    messages = trip_messages(table(spark, sf_dir, "events")).withColumn("consumer", F.col("seq") % 5)
    summary = ingest_dynamic(messages, fresh_dir(spark, "dynamic"), buckets=8)
    return summary.drop("seconds", "inserted_per_second")


@query(
    "dynamic_ingest_table",
    ORACLES["evolve_columns"].replace(",\n      'none' AS old_column", "").split("UNION ALL")[0]
    + """ AND event_id % 37 <> 0 AND NOT (event_id % 47 = 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0)""",
)
def dynamic_ingest_table(spark, sf_dir):
    """The table that two runs store; the second meets columns of the first."""
    path = fresh_dir(spark, "dynamic")
    messages = trip_messages(table(spark, sf_dir, "events")).withColumn("consumer", F.col("seq") % 5)
    for odd in (1, 0):
        ingest_dynamic(messages.filter(F.col("seq") % 2 == odd), path, buckets=8)
    return read_table(spark, path, evolving=True).drop("ingest_ts", "seq").fillna("none")


@query("table_upsert", ORACLES["upsert_latest"])
def table_upsert(spark, sf_dir):
    path = fresh_dir(spark, "keyed")
    lines = table(spark, sf_dir, "lineitem")
    # Two batches that share keys, each holding newer and older versions.
    for odd in (1, 0):
        batch = lines.filter(F.col("l_orderkey") % 2 == odd)
        upsert(batch, path, UPSERT_KEY, UPSERT_ORDER, buckets=16, batch_id=odd)
    return read_table(spark, path).select(
        *UPSERT_KEY,
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ship_s"),
    )


@query(
    "stream_sessions",
    sessions_cte(1200) + """ SELECT * FROM runs WHERE last_us + 1200000000
      <= (SELECT max(epoch_us(ingest_ts)) // 1000 * 1000 FROM led)""",
)
def stream_sessions(spark, sf_dir):
    base = fresh_dir(spark, "sessions")
    rows = ledger(stream_events(spark, sf_dir)).withWatermark("ingest_ts", "0 seconds")
    sessions = activity_sessions(rows, "20 minutes")
    start(sessions, f"{base}/_checkpoint", f"{base}/runs").awaitTermination()
    return spark.read.schema(
        "tenant STRING, start TIMESTAMP, last_msg TIMESTAMP, rows BIGINT, inserted BIGINT, "
        "discarded BIGINT, errored BIGINT"
    ).parquet(f"{base}/runs").select(
        "tenant",
        F.unix_micros("start").alias("start_us"),
        F.unix_micros("last_msg").alias("last_us"),
        F.col("rows").alias("n_rows"),
        "inserted",
        "discarded",
        "errored",
    )


@query(
    "stream_silver_updates",
    f"WITH {TRIPS_CTE}, {late_cte(3600)}, on_time AS (SELECT * FROM judged WHERE NOT late), "
    f"{silver_cte(3600, 'on_time')} {silver_select()}",
)
def stream_silver_updates(spark, sf_dir):
    """A live silver table: each change of a window, open ones too, replaces its row."""
    base = fresh_dir(spark, "updates")
    write_bronze(trip_messages(stream_events(spark, sf_dir)), base, HOUR).awaitTermination()
    store = upsert_sink(f"{base}/live", ["area", "window_start"], ["trips"], buckets=8)
    (
        silver_stream(read_bronze(spark, base), HOUR)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", f"{base}/_live")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return read_table(spark, f"{base}/live").select(*silver_columns())


def control_run(spark, sf_dir, interval, gap, parts=3):
    """The control stream over the ledger, which arrives in parts; the stream stops after each part
    and goes on from its checkpoint."""
    base = fresh_dir(spark, "control")
    rows = ledger(table(spark, sf_dir, "events"))
    days = F.datediff("ingest_ts", F.lit(FIRST_DAY))
    number = F.least(F.floor(days / F.lit(12)), F.lit(parts - 1))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    for part in range(parts):
        rows.filter(number == part).write.mode("append").parquet(f"{base}/arrivals")
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{base}/arrivals")
        control = tenant_control(arrivals, interval, gap)
        start(control, f"{base}/_control", f"{base}/control").awaitTermination()
    return base


def _stored_control(spark, base):
    return spark.read.schema(CONTROL).parquet(f"{base}/control")


# The watermark at the end of the stream: a second behind the last arrival, in whole milliseconds.
END_CTE = """, ended AS (SELECT (max(epoch_us(ingest_ts)) // 1000 - 1000) * 1000 AS wm FROM led)"""


def live_status_cte(seconds):
    """Status of each interval that has ended, also of those after a tenant's last row."""
    us = seconds * 1_000_000
    return f"""WITH {LEDGER_CTE}{END_CTE}, span AS (SELECT tenant, min(epoch_us(ingest_ts)) AS f FROM led GROUP BY 1),
grid AS (SELECT tenant, f, unnest(generate_series(0, (wm - f) // {us} - 1)) AS interval_no FROM span, ended),
cnt AS (SELECT led.tenant, (epoch_us(ingest_ts) - f) // {us} AS interval_no, count(*) AS n,
    count(*) FILTER (disposition = 'discarded') AS d FROM led JOIN span ON led.tenant = span.tenant GROUP BY 1, 2),
status AS (SELECT grid.tenant AS tenant_id, grid.interval_no,
    strftime(make_timestamp(f + (grid.interval_no + 1) * {us}), '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    coalesce(n, 0) AS rows_processed, coalesce(n, 0) / {seconds}.0::DOUBLE AS rows_per_second,
    coalesce(d, 0) AS discarded_rows
  FROM grid LEFT JOIN cnt ON grid.tenant = cnt.tenant AND grid.interval_no = cnt.interval_no)"""


@query("stream_live_status", live_status_cte(600) + " SELECT * FROM status")
def stream_live_status(spark, sf_dir):
    base = control_run(spark, sf_dir, "10 minutes", "20 minutes")
    return status_reports(_stored_control(spark, base), "10 minutes")


@query(
    "stream_status_10s",
    live_status_cte(10) + """ SELECT tenant_id, left("timestamp", 13) AS "hour", count(*) AS intervals,
      count(*) FILTER (rows_processed = 0) AS empty_intervals, sum(rows_processed)::BIGINT AS rows_processed,
      max(rows_per_second) AS max_rate, sum(discarded_rows)::BIGINT AS discarded_rows FROM status GROUP BY 1, 2""",
)
def stream_status_10s(spark, sf_dir):
    base = control_run(spark, sf_dir, "10 seconds", "60 seconds")
    return status_by_hour(status_reports(_stored_control(spark, base), "10 seconds"))


@query(
    "stream_actions",
    sessions_cte(1200) + END_CTE + """ SELECT tenant, start_us AS at_us, 'start' AS action FROM runs
      UNION ALL SELECT tenant, last_us + 1200000000, 'stop' FROM runs, ended WHERE last_us + 1200000000 <= wm""",
)
def stream_actions(spark, sf_dir):
    base = control_run(spark, sf_dir, "1 hour", "20 minutes")
    return run_actions(_stored_control(spark, base)).select("tenant", F.unix_micros("at").alias("at_us"), "action")


# The third tenant states no limits.
_BREACH_SQL = """, lim(tenant, speed, min_rows, ratio) AS (VALUES ('chicagotenant', 10.0, 1, 0.2),
  ('nytenant', 2.0, 10, 0.01)),
warned AS (SELECT tenant_id AS tenant, interval_no, CASE
    WHEN CASE WHEN rows_processed > 0 THEN discarded_rows / (discarded_rows + rows_processed)::DOUBLE ELSE 1 END
      > coalesce(ratio, 0.5) THEN 'maxDiscardedRowsRelation'
    WHEN rows_processed < coalesce(min_rows, 1) THEN 'minRowsProcessed'
    WHEN rows_per_second * 48 < coalesce(speed, 0) THEN 'minimumIngestionSpeed' END AS warning
  FROM status LEFT JOIN lim ON tenant_id = tenant),
told AS (SELECT *, lag(warning) OVER (PARTITION BY tenant ORDER BY interval_no) AS earlier FROM warned)
SELECT tenant, interval_no, warning,
  CASE WHEN warning = 'maxDiscardedRowsRelation' THEN 'stop' ELSE 'restart' END AS action
FROM told WHERE warning IS NOT NULL AND warning IS DISTINCT FROM earlier"""


@query("status_breaches", status_cte(1800) + _BREACH_SQL)
def status_breaches(spark, sf_dir):
    status = ingest_status(ledger(table(spark, sf_dir, "events")), "30 minutes")
    found = breaches(status, limits(spark).filter("tenant <> 'thirdtenant'"))
    return found.select("tenant", "interval_no", "warning", "action")


@query("stream_breaches", live_status_cte(1800) + _BREACH_SQL)
def stream_breaches(spark, sf_dir):
    base = control_run(spark, sf_dir, "30 minutes", "20 minutes")
    stored = spark.readStream.schema(CONTROL).option("maxFilesPerTrigger", 2).parquet(f"{base}/control")
    status = status_reports(stored, "30 minutes")
    watch(status, lambda: limits(spark).filter("tenant <> 'thirdtenant'"), f"{base}/watch").awaitTermination()
    found = spark.read.schema("tenant STRING, interval_no BIGINT, warning STRING, action STRING")
    return found.parquet(f"{base}/watch/breaches/batch_id=*")


@query(
    "run_report_files",
    sessions_cte(1200) + """ SELECT tenant, inserted AS "rows", round(inserted * 48 / 1000.0, 3) AS total_size,
      round((last_us - start_us) / 1e6, 3) AS total_time FROM runs""",
)
def run_report_files(spark, sf_dir):
    base = fresh_dir(spark, "reports")
    write_run_report(run_report(ledger(table(spark, sf_dir, "events")), "20 minutes"), base)
    fields = F.from_json("value", "total_time DOUBLE, rows BIGINT, total_size DOUBLE")
    reports = spark.read.schema("value STRING, tenant STRING").text(base)
    return reports.select("tenant", F.inline(F.array(fields))).select(
        "tenant",
        "rows",
        F.round("total_size", 3).alias("total_size"),
        F.round("total_time", 3).alias("total_time"),
    )


@query(
    "new_silver_days",
    f"""WITH {TRIPS_CTE}, {silver_cte(3600)} SELECT DISTINCT
      'hour=' || strftime(window_start::TIMESTAMP + INTERVAL 2 HOUR, '%Y-%m-%d') AS directory FROM silver
      WHERE strftime(window_start::TIMESTAMP + INTERVAL 2 HOUR, '%Y-%m-%d') <> '2024-01-10'""",
)
def new_silver_days(spark, sf_dir):
    base = fresh_dir(spark, "silver")
    write_silver(hourly_silver(spark, sf_dir), base, fmt="csv", period="day")
    taken = new_silver(spark, base, "hour=2024-01-10")
    directory = F.element_at(F.split("path", "/"), -2).alias("directory")
    return new_silver(spark, base, done=taken).select(directory).distinct()


@query("stream_unique", "SELECT DISTINCT user_id, event_type FROM events")
def stream_unique(spark, sf_dir):
    base = fresh_dir(spark, "unique")
    keys = ["user_id", "event_type"]
    rows = stream_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    unique = drop_repeats(rows, keys, "ts", "30 days").select(*keys)
    start(unique, f"{base}/_checkpoint", f"{base}/rows").awaitTermination()
    return spark.read.schema("user_id BIGINT, event_type STRING").parquet(f"{base}/rows")
