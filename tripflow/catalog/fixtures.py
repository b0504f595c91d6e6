"""Reference-shaped inputs made from the given tables, and the same rules as SQL.

Faults are planted by the number of an event, so both sides agree on every row.
"""

from pyspark.sql import functions as F

from tripflow.schemas import LIMITS
from tripflow.sources.files import read_trips_parquet

TENANTS = ["chicagotenant", "nytenant", "thirdtenant"]
LIMIT_ROWS = [
    ("chicagotenant", 10.0, 1, 0.2),
    ("nytenant", 2.0, 10, 0.01),
    ("thirdtenant", 5.0, 1, 0.05),
]


def table(spark, sf_dir, name):
    return read_trips_parquet(spark, f"{sf_dir}/{name}.parquet")


def nth(n):
    return F.col("event_id") % n == 0


def _number(name, value):
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _text(name, value):
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _object(*fields):
    """JSON object of the fields that are not NULL."""
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def with_arrival(events):
    """Events as they arrive: some 3 h late, some 30 min, the rest within seconds."""
    lag = (
        F.when(F.col("event_id") % 50 == 0, 10800)
        .when(F.col("event_id") % 50 == 1, 1800)
        .otherwise(F.col("event_id") % 5)
    )
    ts = F.col("ts").cast("timestamp")
    return events.withColumns(
        {
            "ts": ts,
            "ingest_ts": F.timestamp_micros(F.unix_micros(ts) + lag * 1_000_000),
            "seq": F.col("event_id"),
        }
    )


def _start_time():
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(~nth(53), F.when(nth(59), "not-a-time").otherwise(iso))


def _area():
    return (
        F.when(nth(37), "NaN")
        .when(nth(41), '"8"')
        .when(nth(43), "8.0")
        .when(~nth(47), (F.col("user_id") % 77 + 1).cast("string"))
    )


def _total():
    return F.when(nth(29), "NaN").when(~nth(31), F.col("value").cast("string"))


def _messages(events, *fields):
    body = F.when(nth(101), "not json").otherwise(_object(*fields))
    tenant = F.element_at(F.array(*[F.lit(t) for t in TENANTS]), (F.col("event_id") % 3 + 1).cast("int"))
    # Making the texts is the work here; a small table comes as a single row group.
    rows = with_arrival(events.repartition("event_id"))
    return rows.select(
        body.alias("value"),
        F.concat(tenant, F.lit("_trips")).alias("topic"),
        "ingest_ts",
        "seq",
    )


def trip_messages(events):
    """Analytics messages: the fields the area analytics reads, with planted faults."""
    return _messages(
        events,
        _text("Trip ID", F.concat(F.lit("t"), "event_id")),
        _text("Taxi ID", F.concat(F.lit("u"), "user_id")),
        _text("Company", F.col("event_type")),
        _number("Pickup Community Area", _area()),
        _text("Trip Start Timestamp", _start_time()),
        _number("Trip Total", _total()),
    )


def ingest_messages(events):
    """Trip messages with the fields the keyed table stores besides."""
    iso_end = F.date_format(
        F.timestamp_micros(F.unix_micros("ts") + 900_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    return _messages(
        events,
        _text("Trip ID", F.concat(F.lit("t"), "event_id")),
        _text("Taxi ID", F.concat(F.lit("u"), "user_id")),
        _text("Company", F.col("event_type")),
        _number("Pickup Community Area", _area()),
        _text("Trip Start Timestamp", _start_time()),
        _text("Trip End Timestamp", F.when(~nth(61), iso_end)),
        # Whole numbers come with and without a decimal point.
        _number("Trip Seconds", F.when(nth(3), "900.0").otherwise("900")),
        _number("Trip Miles", F.when(nth(23), "NaN").otherwise((F.col("event_id") % 40).cast("string"))),
        _number("Pickup Census Tract", F.lit(17031980000)),
        _number("Trip Total", _total()),
        _text("Payment Type", F.lit("Cash")),
        _text("Pickup Centroid Location", F.lit("POINT (-87.9 41.9)")),
    )


def ny_messages(events):
    """New York messages; two vendors, so few distinct vendors per drop-off second."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    vendor = F.when(nth(37), "NaN").when(
        ~nth(47), (F.col("event_id") % 2 + 1).cast("string")
    )
    return _messages(
        events,
        _number("VendorID", vendor),
        _text("tpep_pickup_datetime", iso),
        _text("tpep_dropoff_datetime", _start_time()),
        _number("passenger_count", F.when(nth(23), "NaN").otherwise((F.col("event_id") % 5).cast("string"))),
        _number("trip_distance", F.col("value")),
        _text("store_and_fwd_flag", F.lit("N")),
        _number("PULocationID", F.concat(F.col("user_id").cast("string"), F.when(nth(3), ".0").otherwise(""))),
        _number("payment_type", F.when(nth(5), "2.0").otherwise("2")),
        _number("fare_amount", F.col("value")),
        _number("improvement_surcharge", F.lit(1.0)),
        _number("congestion_surcharge", F.lit(2.5)),
        _number("Airport_fee", F.lit(0.0)),
    )


def ledger(events):
    """Tenant, arrival time and disposition of each event."""
    rows = with_arrival(events)
    discarded = nth(37) | nth(101)
    return rows.select(
        F.element_at(
            F.array(*[F.lit(t) for t in TENANTS]), (F.col("event_id") % 3 + 1).cast("int")
        ).alias("tenant"),
        "ingest_ts",
        F.when(discarded, "discarded").when(nth(47), "errored").otherwise("ok").alias("disposition"),
    )


def limits(spark):
    return spark.createDataFrame(LIMIT_ROWS, LIMITS)


def staged_files(orders, customer):
    """One staged file per customer nation (the tenant) and order month."""
    month = F.month("o_orderdate")
    ext = F.when(month % 6 == 0, "txt").when(month % 6 == 5, "json").otherwise("csv")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(
            F.col("c_nationkey").cast("string").alias("tenant"),
            F.date_format("o_orderdate", "yyyyMM").alias("month"),
            ext.alias("ext"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("DECIMAL(18,2)")).cast("bigint").alias("bytes"))
        .select("tenant", F.concat(F.lit("orders_"), "month", F.lit("."), "ext").alias("file"), "bytes", "ext")
    )


def agreements(nation):
    """Agreements of the nations and of tenant 25, which has no files."""
    ids = nation.select(F.col("n_nationkey").alias("n")).unionAll(
        nation.agg((F.max("n_nationkey") + 1).alias("n"))
    )
    n = F.col("n")
    return ids.select(
        n.cast("string").alias("id"),
        F.lit("clean_chicago").alias("pipeline"),
        F.concat(F.lit("/tenant"), n.cast("string")).alias("fileStorageLocation"),
        F.concat(F.lit("keyspace"), n.cast("string")).alias("coredmsKeyspace"),
        F.lit("trips").alias("coredmsTable"),
        F.create_map(
            F.lit("csv"), F.lit(True), F.lit("json"), n % 4 == 0, F.lit("txt"), F.lit(False)
        ).alias("fileTypesSupported"),
        F.when(n % 2 == 1, 150.0).otherwise(1_000_000.0).alias("maxStagingStorage"),
        F.when(n % 5 == 0, 79).otherwise(100).alias("maxNumFiles"),
        F.lit(10).alias("inputCheckInterval"),
        (n % 3 + 5).cast("double").alias("maxIngestionIntervalSize"),
        F.lit(10).alias("ingestInterval"),
    )


# The same rules for DuckDB.

EVENTS_CTE = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts,
    ts + to_seconds(CASE WHEN event_id % 50 = 0 THEN 10800 WHEN event_id % 50 = 1 THEN 1800
                         ELSE event_id % 5 END) AS ingest_ts,
    CASE event_id % 3 WHEN 0 THEN 'chicagotenant' WHEN 1 THEN 'nytenant'
         ELSE 'thirdtenant' END AS tenant
  FROM events
)"""

TRIPS_CTE = EVENTS_CTE + """,
trip AS (
  SELECT *,
    event_id % 101 = 0 AS malformed,
    CASE WHEN event_id % 101 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0
           OR event_id % 47 = 0 THEN NULL ELSE user_id % 77 + 1 END AS area,
    CASE WHEN event_id % 101 = 0 OR event_id % 53 = 0 OR event_id % 59 = 0 THEN ingest_ts
         ELSE date_trunc('second', ts) END AS event_time,
    CASE WHEN event_id % 101 = 0 THEN 'malformed'
         WHEN event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0
           THEN 'pickup_area'
         WHEN event_id % 53 = 0 THEN 'timestamp' ELSE 'good' END AS reason,
    CASE WHEN event_id % 29 = 0 OR event_id % 31 = 0 OR event_id % 101 = 0 THEN 0
         ELSE value END::DECIMAL(18,2) AS total,
    (event_id % 53 = 0 OR event_id % 59 = 0 OR event_id % 101 = 0) AS time_fallback,
    '{"Trip ID":"t' || event_id || '","Taxi ID":"u' || user_id || '","Company":"' || event_type || '"'
      || CASE WHEN event_id % 37 = 0 THEN ',"Pickup Community Area":NaN'
              WHEN event_id % 41 = 0 THEN ',"Pickup Community Area":"8"'
              WHEN event_id % 43 = 0 THEN ',"Pickup Community Area":8.0'
              WHEN event_id % 47 = 0 THEN ''
              ELSE ',"Pickup Community Area":' || (user_id % 77 + 1) END
      || CASE WHEN event_id % 53 = 0 THEN ''
              WHEN event_id % 59 = 0 THEN ',"Trip Start Timestamp":"not-a-time"'
              ELSE ',"Trip Start Timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"' END
      || CASE WHEN event_id % 29 = 0 THEN ',"Trip Total":NaN' WHEN event_id % 31 = 0 THEN ''
              ELSE ',"Trip Total":' || value END || '}' AS good_text
  FROM ev
), msg AS (
  SELECT *, CASE WHEN malformed THEN 'not json' ELSE good_text END AS message FROM trip
)"""


def silver_cte(size_seconds, source="msg", name="silver"):
    """Silver of good rows; window start as TIMESTAMP."""
    start = (
        f"to_timestamp(((epoch_us(event_time) // 1000) // {size_seconds * 1000}) * {size_seconds})"
        " AT TIME ZONE 'UTC'"
    )
    return f"""{name} AS (
  SELECT area, {start} AS window_start, count(*) AS trips, sum(total) AS total_fares
  FROM {source} WHERE reason = 'good' GROUP BY 1, 2
)"""


def quality_cte(size_seconds, source="msg", name="quality"):
    return f"""{name} AS (
  SELECT ((epoch_us(event_time) // 1000) // {size_seconds * 1000}) * {size_seconds * 1000} AS window_ms,
    count(*) AS n_rows, count(*) FILTER (reason <> 'good') AS discarded,
    count(*) FILTER (reason = 'pickup_area') AS pickup_errors,
    count(*) FILTER (reason = 'timestamp') AS timestamp_errors,
    count(*) FILTER (time_fallback AND reason = 'good') AS time_fallback
  FROM {source} WHERE reason <> 'malformed' GROUP BY 1
)"""


def late_cte(size_seconds, delay_seconds=60, lateness_seconds=20, source="msg", name="judged"):
    """Lateness record by record: a running maximum over the rows in arrival order."""
    return f"""seen AS (
  SELECT *, max((epoch_us(event_time) // 1000)) FILTER (reason <> 'malformed') OVER (ORDER BY ingest_ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_ms
  FROM {source}
), {name} AS (
  SELECT *, coalesce(((epoch_us(event_time) // 1000) // {size_seconds * 1000} + 1) * {size_seconds * 1000} - 1
      + {lateness_seconds * 1000} <= seen_ms - {delay_seconds * 1000} - 1, false) AS late
  FROM seen
)"""


FILES_CTE = """
files AS (
  SELECT c_nationkey::VARCHAR AS tenant,
    'orders_' || strftime(o_orderdate, '%Y%m') || '.' || ext AS file,
    sum(o_totalprice::DECIMAL(18,2))::DECIMAL(38,0) AS rounded,
    trunc(sum(o_totalprice::DECIMAL(18,2)))::BIGINT AS bytes, ext
  FROM (SELECT *, CASE WHEN month(o_orderdate) % 6 = 0 THEN 'txt'
                       WHEN month(o_orderdate) % 6 = 5 THEN 'json' ELSE 'csv' END AS ext
        FROM orders JOIN customer ON o_custkey = c_custkey)
  GROUP BY 1, 2, ext
), agreement AS (
  SELECT n::VARCHAR AS tenant, n,
    CASE WHEN n % 5 = 0 THEN 79 ELSE 100 END AS max_files,
    CASE WHEN n % 2 = 1 THEN 150 ELSE 1000000 END AS max_mb,
    5 + n % 3 AS quota_mb, n % 4 = 0 AS json_ok
  FROM (SELECT n_nationkey AS n FROM nation UNION ALL SELECT max(n_nationkey) + 1 FROM nation)
), checked AS (
  SELECT f.tenant, f.file, f.bytes, f.ext, (f.ext = 'csv' OR (f.ext = 'json' AND json_ok)) AS accepted
  FROM files f JOIN agreement USING (tenant)
), usage AS (
  SELECT tenant, count(*) AS num_files, sum(bytes)::BIGINT AS used_bytes FROM files GROUP BY 1
), admitted AS (
  SELECT a.tenant, coalesce(num_files, 0) AS num_files, coalesce(used_bytes, 0) AS used_bytes,
    CASE WHEN num_files IS NULL THEN 'no_files' WHEN num_files > max_files THEN 'too_many_files'
         WHEN used_bytes > max_mb * 1000000::BIGINT THEN 'storage_exceeded' ELSE 'admitted' END AS decision
  FROM agreement a LEFT JOIN usage USING (tenant)
)"""
