"""Ingest queries: verdicts, stored trips, status, warnings, runs and reports."""

from pyspark.sql import functions as F

from tripflow.catalog.fixtures import (
    EVENTS_CTE,
    ingest_messages,
    ledger,
    limits,
    ny_messages,
    nth,
    table,
    trip_messages,
    with_arrival,
)
from tripflow.catalog.registry import query
from tripflow.functions import text, times, units
from tripflow.operators.cleanse import evolve_columns, fill_total
from tripflow.operators.disposition import ingest_disposition, split_by_tag
from tripflow.operators.ingest import (
    activity_actions,
    activity_sessions,
    ingest_status,
    ingest_summary,
    lineage_record,
    rows_added_by_key,
    run_report,
    stream_complete,
)
from tripflow.operators.monitor import recommend_actions, status_warnings
from tripflow.operators.trips import (
    decrypt_cols,
    dq_rules,
    encrypt_cols,
    mean_trips_per_vehicle,
    split_hot_cold,
    validate_schema,
    vehicle_stats,
)
from tripflow.operators.upsert import latest_per_key
from tripflow.plans.batch_ingest import clean_chicago
from tripflow.plans.registry import run_tenant
from tripflow.plans.stream_ingest import chicago_rows, ny_rows, ny_verdict
from tripflow.sources.messages import to_messages

LEDGER_CTE = EVENTS_CTE + """,
led AS (
  SELECT tenant, ingest_ts, event_id,
    CASE WHEN event_id % 37 = 0 OR event_id % 101 = 0 THEN 'discarded'
         WHEN event_id % 47 = 0 THEN 'errored' ELSE 'ok' END AS disposition
  FROM ev
)"""


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def tenant_ledger(spark, sf_dir):
    return ledger(events(spark, sf_dir))


# Verdict of each ingest message: the first fault decides.
VERDICT = """CASE WHEN event_id % 101 = 0 THEN 'discarded/malformed'
    WHEN event_id % 37 = 0 THEN 'discarded/NaN Pickup Community Area'
    WHEN event_id % 41 = 0 OR (event_id % 47 = 0 AND event_id % 43 <> 0)
      THEN 'errored/missing Pickup Community Area'
    WHEN event_id % 53 = 0 OR event_id % 59 = 0 THEN 'errored/Trip Start Timestamp'
    WHEN event_id % 61 = 0 THEN 'errored/Trip End Timestamp' ELSE 'ok/' END"""


@query(
    "ingest_disposition",
    f"""WITH {EVENTS_CTE} SELECT tenant, {VERDICT} AS verdict, count(*) AS messages
        FROM ev GROUP BY 1, 2""",
)
def disposition(spark, sf_dir):
    rows = ingest_disposition(ingest_messages(events(spark, sf_dir)))
    return rows.groupBy(
        text.tenant_of("topic").alias("tenant"),
        F.concat("disposition", F.lit("/"), "reason").alias("verdict"),
    ).agg(F.count(F.lit(1)).alias("messages"))


CHICAGO_SQL = """CASE WHEN event_id % 43 = 0 THEN 8 ELSE user_id % 77 + 1 END::DOUBLE AS pickup_community_area,
  't' || event_id AS trip_id, 'u' || user_id AS taxi_id, event_type AS company,
  epoch_us(ts) // 1000000 AS start_s, epoch_us(ts) // 1000000 + 900 AS end_s, 900 AS trip_seconds,
  CASE WHEN event_id % 23 = 0 THEN -1 ELSE event_id % 40 END::DOUBLE AS trip_miles,
  CASE WHEN event_id % 29 = 0 OR event_id % 31 = 0 THEN -1 ELSE value END AS trip_total,
  'Cash' AS payment_type"""


def chicago_columns(df, *more):
    """Stored Chicago trips for comparison: times in seconds, missing numbers as -1."""
    return df.select(
        *more,
        "pickup_community_area",
        "trip_id",
        "taxi_id",
        "company",
        F.unix_seconds("trip_start_timestamp").alias("start_s"),
        F.unix_seconds("trip_end_timestamp").alias("end_s"),
        "trip_seconds",
        F.coalesce("trip_miles", F.lit(-1.0)).alias("trip_miles"),
        F.coalesce("trip_total", F.lit(-1.0)).alias("trip_total"),
        "payment_type",
    )


@query(
    "chicago_trips",
    f"WITH {EVENTS_CTE} SELECT {CHICAGO_SQL} FROM ev WHERE {VERDICT} = 'ok/'",
)
def chicago_trips(spark, sf_dir):
    accepted, _ = split_by_tag(ingest_disposition(ingest_messages(events(spark, sf_dir))))
    return chicago_columns(chicago_rows(accepted))


KEPT_OUT = "event_id % 101 = 0 OR event_id % 37 = 0 OR event_id % 47 = 0 OR event_id % 53 = 0"


@query(
    "quarantine",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 101 = 0 THEN 'not json' ELSE 'object' END AS kind
        FROM events WHERE {KEPT_OUT}""",
)
def quarantined(spark, sf_dir):
    _, kept_out = split_by_tag(ny_verdict(ny_messages(events(spark, sf_dir))))
    return kept_out.filter("disposition = 'quarantine'").select(
        "seq", F.when(F.col("malformed"), "not json").otherwise("object").alias("kind")
    )


NY_SQL = """(event_id % 2 + 1)::INTEGER AS vendor_id, epoch_us(ts) // 1000000 AS pickup_s,
  epoch_us(ts) // 1000000 AS dropoff_s,
  CASE WHEN event_id % 23 = 0 THEN -1 ELSE event_id % 5 END::INTEGER AS passenger_count,
  value AS trip_distance, user_id::INTEGER AS pu_location_id, 2 AS payment_type, value AS fare_amount,
  0.0::DOUBLE AS airport_fee"""


def ny_columns(df):
    return df.select(
        "vendor_id",
        F.unix_seconds("tpep_pickup_datetime").alias("pickup_s"),
        F.unix_seconds("tpep_dropoff_datetime").alias("dropoff_s"),
        F.coalesce("passenger_count", F.lit(-1)).alias("passenger_count"),
        "trip_distance",
        "pu_location_id",
        "payment_type",
        "fare_amount",
        "airport_fee",
    )


@query(
    "ny_trips",
    f"SELECT {NY_SQL} FROM events WHERE NOT ({KEPT_OUT} OR event_id % 59 = 0)",
)
def ny_trips(spark, sf_dir):
    accepted, _ = split_by_tag(ny_verdict(ny_messages(events(spark, sf_dir))))
    return ny_columns(ny_rows(accepted))


def staged_trips(rows):
    """Events as rows of a staged Chicago file: spaced names, US 12-hour times, texts."""
    us_time = "MM/dd/yyyy hh:mm:ss a"
    ts = F.col("ts").cast("timestamp")
    none = F.lit(None)
    end = F.timestamp_micros(F.unix_micros(ts) + 900_000_000)
    return rows.select(
        F.concat(F.lit("t"), "event_id").alias("Trip ID"),
        F.concat(F.lit("u"), "user_id").alias("Taxi ID"),
        F.when(nth(53), "not-a-time").otherwise(F.date_format(ts, us_time)).alias("Trip Start Timestamp"),
        F.date_format(end, us_time).alias("Trip End Timestamp"),
        F.lit(900).alias("Trip Seconds"),
        F.when(~nth(23), (F.col("event_id") % 40).cast("double")).alias("Trip Miles"),
        F.lit(17031980000).alias("Pickup Census Tract"),
        none.cast("bigint").alias("Dropoff Census Tract"),
        F.when(~nth(47), (F.col("user_id") % 77 + 1).cast("double")).alias("Pickup Community Area"),
        none.cast("double").alias("Dropoff Community Area"),
        *[none.cast("double").alias(c) for c in ("Fare", "Tips", "Tolls", "Extras")],
        F.when(~nth(31), F.col("value")).alias("Trip Total"),
        F.lit("Cash").alias("Payment Type"),
        F.col("event_type").alias("Company"),
        *[none.cast("double").alias(f"Pickup Centroid {c}") for c in ("Latitude", "Longitude")],
        F.lit("POINT (-87.9 41.9)").alias("Pickup Centroid Location"),
        *[none.cast("double").alias(f"Dropoff Centroid {c}") for c in ("Latitude", "Longitude")],
        none.cast("string").alias("Dropoff Centroid  Location"),
    )


CLEAN_SQL = """'t' || event_id AS trip_id, 'u' || user_id AS taxi_id, event_type AS company,
  CASE WHEN event_id % 47 = 0 THEN -1 ELSE user_id % 77 + 1 END::DOUBLE AS pickup_community_area,
  CASE WHEN event_id % 53 = 0 THEN -1 ELSE epoch_us(ts) // 1000000 END AS start_s,
  epoch_us(ts) // 1000000 + 900 AS end_s, 900 AS trip_seconds,
  CASE WHEN event_id % 23 = 0 THEN -1 ELSE event_id % 40 END::DOUBLE AS trip_miles,
  CASE WHEN event_id % 31 = 0 THEN -1 ELSE value END AS trip_total, 'Cash' AS payment_type"""


def clean_columns(df, *more):
    return chicago_columns(df, *more).fillna({"start_s": -1})


@query("clean_trips", f"SELECT {CLEAN_SQL} FROM events")
def clean_trips(spark, sf_dir):
    return clean_columns(clean_chicago(staged_trips(events(spark, sf_dir))))


@query("tenant_transform", f"SELECT {CLEAN_SQL} FROM events")
def tenant_transform(spark, sf_dir):
    raw = staged_trips(events(spark, sf_dir))
    return clean_columns(run_tenant("clean_chicago", raw, "chicagotenant", "/chicago"))


@query(
    "trip_json",
    """SELECT '{"Trip ID":"t' || event_id || '","Trip Start Timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         || '","Trip Total":' || CASE WHEN event_id % 29 = 0 THEN 'NaN' WHEN event_id % 31 = 0 THEN 'null'
         ELSE value::VARCHAR END || '}' AS value FROM events""",
)
def trip_json(spark, sf_dir):
    total = F.when(nth(29), F.lit(float("nan"))).when(~nth(31), F.col("value"))
    rows = events(spark, sf_dir).select(
        F.concat(F.lit("t"), "event_id").alias("Trip ID"),
        F.col("ts").cast("timestamp").alias("Trip Start Timestamp"),
        total.alias("Trip Total"),
    )
    return to_messages(rows, ["Trip Start Timestamp"])


STATUS_CTE = """, span AS (SELECT tenant, min(epoch_us(ingest_ts)) AS f, max(epoch_us(ingest_ts)) AS l FROM led GROUP BY 1),
grid AS (SELECT tenant, f, unnest(generate_series(0, (l - f) // {us})) AS interval_no FROM span),
cnt AS (SELECT led.tenant, (epoch_us(ingest_ts) - f) // {us} AS interval_no, count(*) AS n,
    count(*) FILTER (disposition = 'discarded') AS d FROM led JOIN span ON led.tenant = span.tenant GROUP BY 1, 2),
status AS (SELECT grid.tenant AS tenant_id, grid.interval_no,
    strftime(make_timestamp(f + (grid.interval_no + 1) * {us}), '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    coalesce(n, 0) AS rows_processed, coalesce(n, 0) / {seconds}.0::DOUBLE AS rows_per_second,
    coalesce(d, 0) AS discarded_rows
  FROM grid LEFT JOIN cnt ON grid.tenant = cnt.tenant AND grid.interval_no = cnt.interval_no)"""


def status_cte(seconds):
    return f"WITH {LEDGER_CTE}" + STATUS_CTE.format(us=seconds * 1_000_000, seconds=seconds)


@query(
    "ingest_status_10s",
    status_cte(10) + """ SELECT tenant_id, left("timestamp", 13) AS "hour", count(*) AS intervals,
      count(*) FILTER (rows_processed = 0) AS empty_intervals, sum(rows_processed)::BIGINT AS rows_processed,
      max(rows_per_second) AS max_rate, sum(discarded_rows)::BIGINT AS discarded_rows FROM status GROUP BY 1, 2""",
)
def status_10s(spark, sf_dir):
    return status_by_hour(ingest_status(tenant_ledger(spark, sf_dir)))


def status_by_hour(status):
    return status.groupBy("tenant_id", F.substring("timestamp", 1, 13).alias("hour")).agg(
        F.count(F.lit(1)).alias("intervals"),
        F.count_if(F.col("rows_processed") == 0).alias("empty_intervals"),
        F.sum("rows_processed").alias("rows_processed"),
        F.max("rows_per_second").alias("max_rate"),
        F.sum("discarded_rows").alias("discarded_rows"),
    )


@query(
    "ingest_status_hour",
    status_cte(3600) + """ SELECT tenant_id, interval_no, "timestamp", rows_processed,
      round(rows_per_second, 6) AS rows_per_second, discarded_rows FROM status""",
)
def status_hour(spark, sf_dir):
    status = ingest_status(tenant_ledger(spark, sf_dir), "1 hour")
    return status.withColumn("rows_per_second", F.round("rows_per_second", 6))


@query(
    "status_json",
    status_cte(1000) + """ SELECT '{"tenant_id":"' || tenant_id || '","timestamp":"' || "timestamp"
      || '","rows_processed":' || rows_processed || ',"rows_per_second":' || rows_processed::DOUBLE
      || ',"discarded_rows":' || discarded_rows || '}' AS value FROM status""",
)
def status_json(spark, sf_dir):
    status = ingest_status(tenant_ledger(spark, sf_dir), 1000)
    # The rate is scaled to whole numbers, which both engines print alike.
    scaled = status.withColumn("rows_per_second", F.round(F.col("rows_per_second") * 1000))
    return scaled.select(text.to_status_json().alias("value"))


WARNING_SQL = """, lim(tenant, speed, min_rows, ratio) AS (VALUES ('chicagotenant', 10.0, 1, 0.2),
  ('nytenant', 2.0, 10, 0.01), ('thirdtenant', 5.0, 1, 0.05)),
warned AS (SELECT tenant, interval_no, CASE
    WHEN CASE WHEN rows_processed > 0 THEN discarded_rows / (discarded_rows + rows_processed)::DOUBLE ELSE 1 END > ratio
      THEN 'maxDiscardedRowsRelation'
    WHEN rows_processed < min_rows THEN 'minRowsProcessed'
    WHEN rows_per_second * 48 < speed THEN 'minimumIngestionSpeed' END AS warning
  FROM status JOIN lim ON tenant_id = tenant)"""


def _warnings(spark, sf_dir):
    status = ingest_status(tenant_ledger(spark, sf_dir), "30 minutes")
    return status_warnings(status, limits(spark))


@query(
    "status_warnings",
    status_cte(1800) + WARNING_SQL + """ SELECT tenant, interval_no, warning,
      '{"tenant":"' || tenant || '","warning":"' || warning || '"}' AS message
    FROM warned WHERE warning IS NOT NULL""",
)
def warnings(spark, sf_dir):
    return _warnings(spark, sf_dir).select(
        "tenant", "interval_no", "warning", text.to_warning_json().alias("message")
    )


@query(
    "recommend_actions",
    status_cte(1800) + WARNING_SQL + """ SELECT tenant, interval_no,
      CASE WHEN warning = 'maxDiscardedRowsRelation' THEN 'stop' ELSE 'restart' END AS action
    FROM warned WHERE warning IS NOT NULL""",
)
def actions(spark, sf_dir):
    return recommend_actions(_warnings(spark, sf_dir)).select("tenant", "interval_no", "action")


def sessions_cte(seconds):
    return f"""WITH {LEDGER_CTE}, marked AS (
      SELECT *, CASE WHEN epoch_us(ingest_ts) - lag(epoch_us(ingest_ts)) OVER w <= {seconds * 1_000_000}
        THEN 0 ELSE 1 END AS starts FROM led WINDOW w AS (PARTITION BY tenant ORDER BY ingest_ts, event_id)
    ), numbered AS (SELECT *, sum(starts) OVER (PARTITION BY tenant ORDER BY ingest_ts, event_id
        ROWS UNBOUNDED PRECEDING) AS run FROM marked),
    runs AS (SELECT tenant, min(epoch_us(ingest_ts)) AS start_us, max(epoch_us(ingest_ts)) AS last_us,
        count(*) AS n_rows, count(*) FILTER (disposition = 'ok') AS inserted,
        count(*) FILTER (disposition = 'discarded') AS discarded,
        count(*) FILTER (disposition = 'errored') AS errored
      FROM numbered GROUP BY tenant, run)"""


def _session_columns(df):
    return df.select(
        "tenant",
        F.unix_micros("start").alias("start_us"),
        F.unix_micros("last_msg").alias("last_us"),
        F.col("rows").alias("n_rows"),
        "inserted",
        "discarded",
        "errored",
    )


@query("activity_sessions", sessions_cte(60) + " SELECT * FROM runs")
def sessions_minute(spark, sf_dir):
    return _session_columns(activity_sessions(tenant_ledger(spark, sf_dir)))


@query("activity_sessions_long", sessions_cte(1200) + " SELECT * FROM runs")
def sessions_long(spark, sf_dir):
    return _session_columns(activity_sessions(tenant_ledger(spark, sf_dir), "20 minutes"))


@query(
    "activity_actions",
    sessions_cte(1200) + """ SELECT tenant, start_us AS at_us, '{"action":"start"}' AS message FROM runs
      UNION ALL SELECT tenant, last_us + 1200000000, '{"action":"stop"}' FROM runs""",
)
def run_actions(spark, sf_dir):
    sessions = activity_sessions(tenant_ledger(spark, sf_dir), "20 minutes")
    return activity_actions(sessions, "20 minutes").select(
        "tenant", F.unix_micros("at").alias("at_us"), text.to_action_json().alias("message")
    )


@query(
    "run_report",
    sessions_cte(1200) + """ SELECT tenant, round(start_us / 1e6, 3) AS start_time,
      round((last_us - start_us) / 1e6, 3) AS total_time, inserted AS "rows", round(inserted * 48 / 1000.0, 3) AS total_size,
      discarded, round(CASE WHEN last_us > start_us THEN inserted * 48 / 1000.0 / ((last_us - start_us) / 1e6)
        ELSE 0 END, 6) AS speed FROM runs""",
)
def reports(spark, sf_dir):
    rows = run_report(tenant_ledger(spark, sf_dir), "20 minutes")
    return rows.select(
        "tenant",
        F.round("start_time", 3).alias("start_time"),
        F.round("total_time", 3).alias("total_time"),
        "rows",
        F.round("total_size", 3).alias("total_size"),
        "discarded",
        F.round(F.coalesce("speed", F.lit(0.0)), 6).alias("speed"),
    )


@query(
    "lineage_record",
    sessions_cte(1200) + """ SELECT tenant, '{"tenant_id":"' || tenant
      || '","user_id":"user_1","source":{"schema":["trip_id","trip_total"],"type":"json"},"processing":{"trip_id":"keep","trip_total":"to_decimal"},'
      || '"ingestion_result":{"total_rows_processed":' || n_rows || ',"total_rows_discarded":' || discarded
      || ',"successful_db_inserts":' || inserted || ',"failed_db_inserts":' || errored || ',"success_rate":"'
      || ((inserted * 2000 + n_rows) // (2 * n_rows) // 10) || '.'
      || ((inserted * 2000 + n_rows) // (2 * n_rows) % 10) || '%"' || CASE WHEN last_us > start_us
         THEN ',"rows_inserted_per_second":' || floor(inserted / ((last_us - start_us) / 1e6))::BIGINT ELSE '' END
      || '},"ingestion_start":"'
      || strftime(make_timestamp(start_us), '%Y-%m-%dT%H:%M:%SZ') || '","ingestion_end":"'
      || strftime(make_timestamp(last_us), '%Y-%m-%dT%H:%M:%SZ')
      || '","cassandra_keyspaces":["trip_space"],"cassandra_tables":["trips"]}' AS lineage
    FROM runs""",
)
def lineage(spark, sf_dir):
    sessions = activity_sessions(tenant_ledger(spark, sf_dir), "20 minutes")
    records = lineage_record(
        sessions,
        ["trip_id", "trip_total"],
        {"trip_id": "keep", "trip_total": "to_decimal"},
        "trip_space",
        "trips",
        user_id="user_1",
    )
    return records.select("tenant", "lineage")


@query(
    "stream_complete",
    f"""WITH {LEDGER_CTE}, per AS (SELECT tenant, count(*) AS n_rows, max(epoch_us(ingest_ts)) AS last_us FROM led GROUP BY 1)
    SELECT tenant, n_rows, CASE WHEN n_rows >= 3333 THEN 'count'
      WHEN epoch_us(TIMESTAMP '2024-01-31 00:10:00') - last_us > 600000000 THEN 'silence' ELSE 'open' END AS ended_by
    FROM per""",
)
def complete(spark, sf_dir):
    ended = stream_complete(
        tenant_ledger(spark, sf_dir), 3333, "10 minutes", now="2024-01-31 00:10:00"
    )
    return ended.select(
        "tenant",
        F.col("rows").alias("n_rows"),
        F.coalesce("ended_by", F.lit("open")).alias("ended_by"),
    )


@query(
    "ingest_summary",
    f"""WITH {EVENTS_CTE}, c AS (SELECT event_id % 5 AS consumer, ingest_ts, event_id % 89 = 0 AS lost,
        event_id % 101 = 0 OR event_id % 47 = 0 AS bad FROM ev),
      s AS (SELECT consumer, count(*) FILTER (NOT lost) AS messages, count(*) FILTER (NOT lost AND NOT bad) AS inserted,
        count(*) FILTER (NOT lost AND bad) AS insert_errors, count(*) FILTER (lost) AS transport_errors,
        (max(epoch_us(ingest_ts)) - min(epoch_us(ingest_ts))) / 1e6 AS seconds FROM c GROUP BY 1)
    SELECT consumer, messages, inserted, insert_errors, transport_errors, round(seconds, 3) AS seconds,
      round(inserted / seconds, 6) AS inserted_per_second FROM s""",
)
def summary(spark, sf_dir):
    rows = with_arrival(events(spark, sf_dir)).select(
        (F.col("event_id") % 5).alias("consumer"),
        "ingest_ts",
        F.when(~nth(89), F.col("event_type")).alias("value"),
        F.when(nth(101) | nth(47), "errored").otherwise("ok").alias("disposition"),
    )
    return ingest_summary(rows).withColumns(
        {
            "seconds": F.round("seconds", 3),
            "inserted_per_second": F.round("inserted_per_second", 6),
        }
    )


@query(
    "evolve_columns",
    f"""WITH {EVENTS_CTE} SELECT 't' || event_id AS trip_id, 'u' || user_id AS taxi_id, event_type AS company,
      CASE WHEN event_id % 37 = 0 OR event_id % 47 = 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0 THEN 'none'
           WHEN event_id % 41 = 0 THEN '8' WHEN event_id % 43 = 0 THEN '8.0'
           ELSE (user_id % 77 + 1)::VARCHAR END AS pickup_community_area,
      CASE WHEN event_id % 53 = 0 THEN 'none' WHEN event_id % 59 = 0 THEN 'not-a-time'
           ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS trip_start_timestamp,
      CASE WHEN event_id % 29 = 0 OR event_id % 31 = 0 THEN 'none' ELSE value::VARCHAR END AS trip_total,
      'none' AS old_column
    FROM ev WHERE event_id % 101 <> 0
    UNION ALL SELECT 'r' || n_nationkey, 'none', 'none', 'none', 'none', 'none', n_name FROM nation""",
)
def evolved(spark, sf_dir):
    old = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("r"), "n_nationkey").alias("trip_id"), F.col("n_name").alias("old_column")
    )
    return evolve_columns(old, trip_messages(events(spark, sf_dir))).fillna("none")


UPSERT_KEY = ["l_partkey", "l_suppkey"]
UPSERT_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


@query(
    "upsert_latest",
    """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         epoch_us(l_shipdate) // 1000000 AS ship_s
       FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
         ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def upsert_latest(spark, sf_dir):
    newest = latest_per_key(table(spark, sf_dir, "lineitem"), UPSERT_KEY, UPSERT_ORDER)
    return newest.select(
        *UPSERT_KEY,
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ship_s"),
    )


@query(
    "rows_added",
    """SELECT (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
      - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem
         WHERE l_shipdate < TIMESTAMP '1998-01-01')) AS rows_added,
      (SELECT count(*) FROM lineitem) AS "rows" """,
)
def added(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    old = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return rows_added_by_key(lines, UPSERT_KEY, old)


VEHICLE_TRIPS_CTE = """vt AS (SELECT 'u' || user_id AS taxi_id, ts,
  CASE WHEN event_id % 29 = 0 THEN 0 ELSE value END::DECIMAL(18,2) AS trip_total, event_id, user_id FROM events)"""


def vehicle_trips(spark, sf_dir):
    total = F.when(nth(29), F.lit(float("nan"))).otherwise(F.col("value"))
    return events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("u"), "user_id").alias("taxi_id"),
        F.col("ts").cast("timestamp").alias("trip_start_timestamp"),
        fill_total(total).alias("trip_total"),
    )


@query(
    "vehicle_stats",
    f"""WITH {VEHICLE_TRIPS_CTE} SELECT taxi_id, epoch_us(ts) // 3600000000 * 3600 AS hour_s, count(*) AS trips,
      sum(trip_total)::DOUBLE AS revenue FROM vt GROUP BY 1, 2""",
)
def vehicles(spark, sf_dir):
    return vehicle_stats(vehicle_trips(spark, sf_dir)).select(
        "taxi_id",
        F.unix_seconds("hour").alias("hour_s"),
        "trips",
        F.col("revenue").cast("double").alias("revenue"),
    )


@query(
    "mean_trips_per_vehicle",
    """SELECT count(*) AS vehicles, round(avg(n), 6) AS mean_trips
       FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""",
)
def mean_trips(spark, sf_dir):
    return mean_trips_per_vehicle(vehicle_trips(spark, sf_dir)).withColumn(
        "mean_trips", F.round("mean_trips", 6)
    )


@query(
    "split_hot_cold",
    """SELECT CASE WHEN ts >= TIMESTAMP '2024-01-19 12:00:00' THEN 'hot' ELSE 'cold' END AS space,
         event_id FROM events""",
)
def hot_cold(spark, sf_dir):
    hot, cold = split_hot_cold(vehicle_trips(spark, sf_dir), "2024-01-20 12:00:00")
    return hot.select(F.lit("hot").alias("space"), "event_id").unionAll(
        cold.select(F.lit("cold").alias("space"), "event_id")
    )


@query(
    "dq_rules",
    """SELECT event_id, concat_ws(';',
         CASE WHEN event_id % 47 = 0 THEN 'missing area' END,
         CASE WHEN value < 1 OR value > 60 THEN 'range value' END,
         CASE WHEN row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY event_id) > 1
              THEN 'duplicate' END) AS reasons FROM events""",
)
def data_quality(spark, sf_dir):
    rows = events(spark, sf_dir).withColumns(
        {
            "area": F.when(~nth(47), F.col("user_id") % 77 + 1),
            "hour": F.date_trunc("hour", F.col("ts").cast("timestamp")),
        }
    )
    checked = dq_rules(
        rows, ["area"], {"value": (1, 60)}, ["user_id", "event_type", "hour"], "event_id"
    )
    return checked.select("event_id", F.concat_ws(";", "reject_reasons").alias("reasons"))


REGISTRY = [
    ("chicagotenant", 1, "Trip ID", "integer", True),
    ("chicagotenant", 2, "Trip ID", "string", True),
    ("chicagotenant", 2, "Pickup Community Area", "integer", True),
    ("chicagotenant", 2, "Trip Total", "number", False),
    ("nytenant", 1, "Trip ID", "string", True),
    ("nytenant", 1, "Trip Start Timestamp", "string", True),
    ("thirdtenant", 1, "Pickup Community Area", "number", True),
]


@query(
    "validate_schema",
    f"""WITH {EVENTS_CTE} SELECT event_id AS seq, CASE tenant WHEN 'chicagotenant' THEN 2 ELSE 1 END AS schema_version,
      CASE WHEN event_id % 101 = 0 THEN 'not an object'
        WHEN tenant = 'nytenant' THEN CASE WHEN event_id % 53 = 0 THEN 'missing Trip Start Timestamp' ELSE '' END
        WHEN event_id % 37 = 0 THEN CASE tenant WHEN 'chicagotenant' THEN 'type Pickup Community Area' ELSE '' END
        WHEN event_id % 41 = 0 THEN 'type Pickup Community Area'
        WHEN event_id % 43 = 0 THEN CASE tenant WHEN 'chicagotenant' THEN 'type Pickup Community Area' ELSE '' END
        WHEN event_id % 47 = 0 THEN 'missing Pickup Community Area' ELSE '' END AS mismatches FROM ev""",
)
def schema_check(spark, sf_dir):
    registry = spark.createDataFrame(
        REGISTRY, "tenant STRING, version INT, field STRING, type STRING, required BOOLEAN"
    )
    messages = trip_messages(events(spark, sf_dir)).withColumn("tenant", text.tenant_of("topic"))
    return validate_schema(messages, registry).select(
        "seq", "schema_version", F.concat_ws(";", "mismatches").alias("mismatches")
    )


@query(
    "encrypted_round_trip",
    "SELECT event_id, user_id, event_type, value, false AS readable FROM events",
)
def encrypted(spark, sf_dir):
    key = spark.createDataFrame([("0123456789abcdef",)], "key STRING")
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    hidden = encrypt_cols(rows, ["user_id", "event_type"], key).withColumn(
        "readable", F.col("event_type").isin("click", "error", "purchase", "signup", "view")
    )
    return decrypt_cols(hidden, {"user_id": "bigint", "event_type": "string"}, key)


@query(
    "ingest_sizes",
    f"""WITH {LEDGER_CTE} SELECT tenant, round(count(*) * 48 / 1000.0, 3) AS kb,
      round(count(*) * 48 / 1000000.0, 6) AS mb FROM led GROUP BY 1""",
)
def sizes(spark, sf_dir):
    counted = tenant_ledger(spark, sf_dir).groupBy("tenant").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "tenant",
        F.round(units.row_kb(F.col("n")), 3).alias("kb"),
        F.round(units.to_mb(F.col("n") * 48), 6).alias("mb"),
    )


@query(
    "event_time_parsing",
    """SELECT event_id, epoch_us(ts) // 1000000 AS iso_s, epoch_us(ts) // 1000000 AS us_s,
         epoch_us(ts) // 1000000 - 7200 AS offset_s, -1 AS bad_s FROM events""",
)
def time_parsing(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    iso = times.iso_z(ts)
    return events(spark, sf_dir).select(
        "event_id",
        F.unix_seconds(times.parse_iso_z(iso)).alias("iso_s"),
        F.unix_seconds(times.parse_us_12h(F.date_format(ts, times.US_12H))).alias("us_s"),
        F.unix_seconds(
            times.event_time(F.replace(iso, F.lit("Z"), F.lit("+02:00")), F.lit(None).cast("timestamp"))
        ).alias("offset_s"),
        F.coalesce(
            F.unix_seconds(times.parse_iso_z(F.concat(F.lit("x"), iso))), F.lit(-1)
        ).cast("int").alias("bad_s"),
    )
