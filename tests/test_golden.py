"""Cases whose input and output are both on record."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow.functions import text, times
from tripflow.operators.disposition import (
    analytics_reason,
    analytics_rows,
    ingest_disposition,
    split_by_tag,
)
from tripflow.operators.ingest import run_report
from tripflow.operators.monitor import default_limits, quality_alerts, status_warnings
from tripflow.operators.sla import admission, file_type_check, quota_batches
from tripflow.operators.windows import quality_ratios, silver, window_quality
from tripflow.plans.batch_ingest import clean_chicago
from tripflow.plans.stream_ingest import chicago_rows, ny_rows, ny_verdict
from tripflow.schemas import AGREEMENT, CHICAGO_RAW, MESSAGE, STAGED_FILE

START = datetime(2025, 3, 29, 15, 24)


def analytics_input(spark, good, bad):
    def message(i, area):
        second = START + timedelta(seconds=i % 60)
        body = {"Trip Start Timestamp": f"{second:%Y-%m-%dT%H:%M:%SZ}", "Trip Total": 10.5}
        if area is not None:
            body["Pickup Community Area"] = area
        return (json.dumps(body), "chicagotenant_trips", second, i)

    rows = [message(i, 8) for i in range(good)] + [message(i, None) for i in range(bad)]
    return analytics_reason(analytics_rows(spark.createDataFrame(rows, MESSAGE)))


@pytest.mark.parametrize(
    "rows, bad, rate, quality",
    [
        (57, 2, 0.95, 0.9649122807017544),
        (114, 6, 1.9, 0.9473684210526316),
        (58, 29, 0.9666666666666667, 0.5),
        (529, 529, 8.816666666666666, 0.0),
        (44, 10, 0.7333333333333333, 0.7727272727272727),
        (2752, 72, 45.86666666666667, 0.9738372093023255),
    ],
)
def test_window_quality(spark, rows, bad, rate, quality):
    judged = analytics_input(spark, rows - bad, bad)
    row = quality_ratios(window_quality(judged)).first()
    assert (row["rows"], row.discarded, row.pickup_errors, row.timestamp_errors) == (rows, bad, bad, 0)
    assert row.records_per_second == rate
    assert row.data_quality == quality
    assert silver(judged).count() == (0 if rows == bad else 1)


def test_alert_and_log_texts(spark):
    quality = quality_ratios(window_quality(analytics_input(spark, 108, 6)))
    log = quality.select(text.metric_log_block().alias("m")).first().m
    window = int(START.timestamp() * 1000)
    assert log.split("\n") == [
        f"window: {window}",
        "records per window: 114",
        "records processed per second: 1.9",
        "rows discarded: 6",
        "data quality: 0.9473684210526316",
        "pickup area errors: 6",
        "timestamp errors: 0",
    ]
    alert = quality_alerts(quality).select(text.alert_message().alias("m")).first().m
    assert alert.startswith("data quality alert{")
    assert json.loads(alert.removeprefix("data quality alert")) == {
        "window": window, "rows": 114, "discarded": 6, "data_quality": 0.9473684210526316,
        "pickup_errors": 6, "timestamp_errors": 0,
    }


def agreement(tenant, **limits):
    terms = {
        "id": tenant, "pipeline": "clean_chicago", "fileStorageLocation": f"/{tenant}",
        "coredmsKeyspace": tenant, "coredmsTable": "trips",
        "fileTypesSupported": {"csv": True, "json": False, "txt": False, "xml": False},
        "maxStagingStorage": 50.0, "maxNumFiles": 10, "inputCheckInterval": 60,
        "maxIngestionIntervalSize": 5.0, "ingestInterval": 10,
    } | limits
    return tuple(terms.values())


def test_quota_intervals(spark):
    sizes = [2.06, 2.06, 2.07, 2.07, 2.06, 2.07, 2.07, 2.07, 2.06, 2.07]
    files = spark.createDataFrame(
        [("t", f"sample{i}.csv", int(mb * 1e6), "csv") for i, mb in enumerate(sizes)], STAGED_FILE
    )
    rows = quota_batches(files, spark.createDataFrame([agreement("t")], AGREEMENT)).collect()
    by_interval = [r.interval_no for r in sorted(rows, key=lambda r: r.file)]
    assert by_interval == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


def test_admission(spark):
    files = [("big", f"f{i}.csv", 11_363_000, "csv") for i in range(10)]
    files += [("one", "sample.csv", 20_660_000, "csv"), ("many", "a.csv", 1, "csv"), ("many", "b.csv", 1, "csv")]
    terms = [agreement("big"), agreement("one"), agreement("many", maxNumFiles=1), agreement("none")]
    decided = admission(
        spark.createDataFrame(files, STAGED_FILE), spark.createDataFrame(terms, AGREEMENT)
    )
    assert {r.tenant: r.decision for r in decided.collect()} == {
        "big": "storage_exceeded", "one": "admitted", "many": "too_many_files", "none": "no_files",
    }


def test_unsupported_type(spark):
    files = [("t", n, 1, n.split(".")[-1]) for n in ("fail.txt", "ok.csv", "odd.bin", "noext")]
    checked = file_type_check(
        spark.createDataFrame(files, STAGED_FILE), spark.createDataFrame([agreement("t")], AGREEMENT)
    )
    assert {r.file: r.accepted for r in checked.collect()} == {
        "fail.txt": False, "ok.csv": True, "odd.bin": False, "noext": False,
    }


def test_run_report(spark):
    first = datetime(2025, 3, 12, 9, 36, 32)
    step = 232.80 / 19999
    rows = [
        ("chicagotenant", first + timedelta(seconds=i * step), "discarded" if i < 557 else "ok")
        for i in range(20000)
    ]
    ledger = spark.createDataFrame(rows, "tenant STRING, ingest_ts TIMESTAMP, disposition STRING")
    row = run_report(ledger).withColumn("log", text.report_log_block()).first()
    assert (row["rows"], row.discarded, row.total_size) == (19443, 557, 933.264)
    assert round(row.total_time, 2) == 232.80
    assert round(row.speed, 2) == 4.01
    assert "Total ingestion size: 933.264 kB" in row.log
    assert "Ingestion speed: 4.01 kB/s" in row.log


def test_status_warning(spark):
    columns = "tenant_id STRING, timestamp STRING, rows_processed BIGINT, rows_per_second DOUBLE, discarded_rows BIGINT"
    rows = [
        ("chicagotenant", "a", 449, 44.9, 16),   # 16 of 465, fast enough: no warning
        ("nytenant", "b", 449, 44.9, 16),        # the same ratio is too much here
        ("nytenant", "c", 9, 0.9, 0),
        ("chicagotenant", "d", 0, 0.0, 0),       # no rows count as ratio 1
        ("chicagotenant", "e", 1, 0.1, 0),       # 4.8 is below 10
        ("chicagotenant", "f", 5, None, 0),
    ]
    status = spark.createDataFrame(rows, columns)
    found = status_warnings(status, default_limits(spark)).collect()
    assert {r.timestamp: r.warning for r in found} == {
        "b": "maxDiscardedRowsRelation", "c": "minRowsProcessed", "d": "maxDiscardedRowsRelation",
        "e": "minimumIngestionSpeed", "f": "minimumIngestionSpeed",
    }


def test_twelve_hour_clock(spark):
    row = spark.range(1).select(
        times.parse_us_12h(F.lit("01/19/2024 05:00:00 PM")).alias("pm"),
        times.parse_us_12h(F.lit("01/19/2024 12:30:00 AM")).alias("am"),
        times.parse_us_12h(F.lit("2024-01-19")).alias("none"),
    ).first()
    assert row.pm == datetime(2024, 1, 19, 17) and row.am == datetime(2024, 1, 19, 0, 30)
    assert row.none is None


CHICAGO_MESSAGE = """{"Trip ID": "000072ee", "Taxi ID": "e51e2c30", "Trip Start Timestamp": "2024-01-28T14:30:00Z",
 "Trip End Timestamp": "2024-01-28T15:00:00Z", "Trip Seconds": 1749, "Trip Miles": 12.7, "Pickup Census Tract": NaN,
 "Dropoff Census Tract": NaN, "Pickup Community Area": 6, "Dropoff Community Area": NaN, "Fare": 33.75, "Tips": 0.0,
 "Tolls": 0.0, "Extras": 0.0, "Trip Total": 33.75, "Payment Type": "Cash", "Company": "Flash Cab",
 "Pickup Centroid Latitude": 41.944226601, "Pickup Centroid Longitude": -87.655998182,
 "Pickup Centroid Location": "POINT (-87.6559981815 41.9442266014)", "Dropoff Centroid Latitude": NaN,
 "Dropoff Centroid Longitude": NaN, "Dropoff Centroid  Location": NaN}"""


def test_chicago_message_to_stored_row(spark):
    messages = spark.createDataFrame([(CHICAGO_MESSAGE, "chicagotenant_trips", START, 1)], MESSAGE)
    accepted, kept_out = split_by_tag(ingest_disposition(messages))
    assert kept_out.count() == 0
    row = chicago_rows(accepted).first().asDict()
    assert row["pickup_community_area"] == 6.0 and row["trip_id"] == "000072ee"
    assert row["trip_start_timestamp"] == datetime(2024, 1, 28, 14, 30)
    assert row["trip_end_timestamp"] == datetime(2024, 1, 28, 15)
    assert row["dropoff_community_area"] is None and row["dropoff_centroid_latitude"] is None
    assert row["trip_total"] == 33.75
    assert not {"pickup_census_tract", "pickup_centroid_location"} & set(row)


def test_ny_message_to_stored_row(spark):
    body = {
        "VendorID": 2, "tpep_pickup_datetime": "2024-01-01T03:51:53Z",
        "tpep_dropoff_datetime": "2024-01-01T04:18:37Z", "passenger_count": 2.0, "trip_distance": 4.23,
        "RatecodeID": 1.0, "store_and_fwd_flag": "N", "PULocationID": 255, "DOLocationID": 198,
        "payment_type": 2, "fare_amount": 25.4, "extra": 1.0, "mta_tax": 0.5, "tip_amount": 0.0,
        "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 27.9,
        "congestion_surcharge": 0.0, "Airport_fee": 0.0,
    }
    messages = spark.createDataFrame([(json.dumps(body), "nytenant_trips", START, 1)], MESSAGE)
    row = ny_rows(split_by_tag(ny_verdict(messages))[0]).drop("ingest_ts", "seq").first()
    assert row.asDict() == {
        "vendor_id": 2, "tpep_pickup_datetime": datetime(2024, 1, 1, 3, 51, 53),
        "tpep_dropoff_datetime": datetime(2024, 1, 1, 4, 18, 37), "passenger_count": 2,
        "trip_distance": 4.23, "ratecode_id": 1, "pu_location_id": 255, "do_location_id": 198,
        "payment_type": 2, "fare_amount": 25.4, "extra": 1.0, "mta_tax": 0.5, "tip_amount": 0.0,
        "tolls_amount": 0.0, "total_amount": 27.9, "airport_fee": 0.0,
    }


def test_staged_row_to_stored_row(spark, tmp_path):
    header = [part.rsplit(" ", 1)[0].strip().strip("`") for part in CHICAGO_RAW.split(",")]
    first = ("0000184e,f538e6b7,01/19/2024 05:00:00 PM,01/19/2024 06:00:00 PM,4051,17.12,17031980000,17031320100,76,32,"
             "45.50,10.00,0.00,4.00,60.00,Credit Card,Flash Cab,41.97907082,-87.903039661,POINT (-87.9 41.9),"
             "41.884987192,-87.620992913,POINT (-87.6 41.8)")
    second = ("000072ee,e51e2c30,01/28/2024 02:30:00 PM,01/28/2024 03:00:00 PM,1749,12.7,,,,,33.75,0.00,0.00,0.00,33.75,"
              "Cash,Flash Cab,41.944226601,-87.655998182,POINT (-87.6 41.9),,,")
    path = tmp_path / "sample.csv"
    path.write_text("\n".join([",".join(header), first, second]))
    from tripflow.sources.files import read_staged_csv

    rows = {r.trip_id: r for r in clean_chicago(read_staged_csv(spark, str(path), CHICAGO_RAW)).collect()}
    assert rows["0000184e"].trip_start_timestamp == datetime(2024, 1, 19, 17)
    assert rows["0000184e"].pickup_community_area == 76.0
    assert rows["000072ee"].pickup_community_area == -1.0
    assert len(rows["000072ee"].asDict()) == 19
