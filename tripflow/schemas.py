"""Declared schemas (DDL text) and the fixed values of the data contracts."""

# Column names and types of the raw Chicago trip message. Whole numbers are
# read as DOUBLE, as producers also write them as ``1749.0``.
CHICAGO_RAW = """
    `Trip ID` STRING, `Taxi ID` STRING,
    `Trip Start Timestamp` STRING, `Trip End Timestamp` STRING,
    `Trip Seconds` DOUBLE, `Trip Miles` DOUBLE,
    `Pickup Census Tract` BIGINT, `Dropoff Census Tract` BIGINT,
    `Pickup Community Area` DOUBLE, `Dropoff Community Area` DOUBLE,
    `Fare` DOUBLE, `Tips` DOUBLE, `Tolls` DOUBLE, `Extras` DOUBLE, `Trip Total` DOUBLE,
    `Payment Type` STRING, `Company` STRING,
    `Pickup Centroid Latitude` DOUBLE, `Pickup Centroid Longitude` DOUBLE,
    `Pickup Centroid Location` STRING,
    `Dropoff Centroid Latitude` DOUBLE, `Dropoff Centroid Longitude` DOUBLE,
    `Dropoff Centroid  Location` STRING
"""

# The Chicago columns no table keeps (the last one has two spaces).
CHICAGO_UNUSED = [
    "Pickup Census Tract",
    "Dropoff Census Tract",
    "Pickup Centroid Location",
    "Dropoff Centroid  Location",
]

# The three fields analytics needs; a typed INT area rejects texts, decimals and NaN.
CHICAGO_ANALYTICS = """
    `Pickup Community Area` INT, `Trip Start Timestamp` STRING, `Trip Total` DOUBLE
"""

# Stored Chicago trip and its primary key.
CHICAGO_STORED = """
    trip_id STRING, taxi_id STRING,
    trip_start_timestamp TIMESTAMP, trip_end_timestamp TIMESTAMP,
    trip_seconds INT, trip_miles DOUBLE,
    pickup_community_area DOUBLE, dropoff_community_area DOUBLE,
    fare DOUBLE, tips DOUBLE, tolls DOUBLE, extras DOUBLE, trip_total DOUBLE,
    payment_type STRING, company STRING,
    pickup_centroid_latitude DOUBLE, pickup_centroid_longitude DOUBLE,
    dropoff_centroid_latitude DOUBLE, dropoff_centroid_longitude DOUBLE
"""
CHICAGO_KEY = ["pickup_community_area", "trip_id"]
CHICAGO_MESSAGE_KEY = ["Pickup Community Area", "Trip ID"]

# Raw New York trip message.
NY_RAW = """
    VendorID DOUBLE, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING,
    passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE,
    store_and_fwd_flag STRING, PULocationID DOUBLE, DOLocationID DOUBLE, payment_type DOUBLE,
    fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE,
    improvement_surcharge DOUBLE, total_amount DOUBLE, congestion_surcharge DOUBLE,
    Airport_fee DOUBLE
"""
NY_UNUSED = ["store_and_fwd_flag", "improvement_surcharge", "congestion_surcharge"]

# Stored New York trip, its key, and the message field each column comes from.
NY_STORED = """
    vendor_id INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP,
    passenger_count INT, trip_distance DOUBLE, ratecode_id INT,
    pu_location_id INT, do_location_id INT, payment_type INT,
    fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE,
    total_amount DOUBLE, airport_fee DOUBLE
"""
NY_KEY = ["tpep_dropoff_datetime", "vendor_id"]
NY_MESSAGE_KEY = ["tpep_dropoff_datetime", "VendorID"]
NY_RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}

# A message with its topic, arrival time and arrival number.
MESSAGE = "value STRING, topic STRING, ingest_ts TIMESTAMP, seq BIGINT"

# Silver and gold rows as stored in files. Sums of money are wider than the
# money of a trip, so that a few absurd totals cannot overflow them.
SILVER = """
    pickup_location_area INT, trips BIGINT, total_fares DECIMAL(28,2),
    window_start_ts BIGINT, window_end_ts BIGINT
"""
GOLD = """
    pickup_location_area INT, trips BIGINT, sum_fares DECIMAL(38,2), avg_fares DOUBLE,
    window_start_ts BIGINT, window_end_ts BIGINT
"""

# Service agreement document.
AGREEMENT = """
    id STRING, pipeline STRING, fileStorageLocation STRING,
    coredmsKeyspace STRING, coredmsTable STRING,
    fileTypesSupported MAP<STRING, BOOLEAN>,
    maxStagingStorage DOUBLE, maxNumFiles INT, inputCheckInterval INT,
    maxIngestionIntervalSize DOUBLE, ingestInterval INT
"""

STAGED_FILE = "tenant STRING, file STRING, bytes BIGINT, ext STRING"

# Monitor limits per tenant (kB/s, rows, ratio).
LIMITS = """
    tenant STRING, minimumIngestionSpeed DOUBLE, minRowsProcessed BIGINT,
    maxDiscardedRowsRelation DOUBLE
"""
DEFAULT_LIMITS = [
    ("chicagotenant", 10.0, 1, 0.2),
    ("nytenant", 2.0, 10, 0.01),
]

# One stored row counts as 48 bytes; windows are 60 s, events may be
# 60 s out of order and another 20 s late; quality below 0.99 raises an alert;
# status is reported every 10 s; a run ends after 60 s of silence.
ROW_BYTES = 48
WINDOW_SIZE = "60 seconds"
WATERMARK_DELAY = "60 seconds"
ALLOWED_LATENESS = "20 seconds"
QUALITY_LIMIT = 0.99
STATUS_INTERVAL = "10 seconds"
SILENCE_LIMIT = "60 seconds"

MONEY = "DECIMAL(18,2)"
