"""Streaming forms against batch forms, over several micro-batches, restarts and replays."""

import json
import random
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.disposition import analytics_reason, analytics_rows, ingest_disposition, split_by_tag
from tripflow.operators.gold import gold
from tripflow.operators.ingest import activity_sessions, ingest_status, run_report
from tripflow.operators.late import mark_late
from tripflow.operators.trips import drop_repeats
from tripflow.operators.upsert import latest_per_key, read_table
from tripflow.operators.windows import quality_ratios, silver, silver_export, window_quality
from tripflow.plans.analytics import FEED_TOPIC, gold_batch, silver_analytics
from tripflow.operators.sla import batch_run_stats
from tripflow.plans.batch_ingest import clean_chicago, ingest_staged
from tripflow.plans.dynamic_ingest import ingest_dynamic
from tripflow.plans.registry import register_pipeline
from tripflow.plans.stream_ingest import (
    chicago_rows,
    chicago_stream_ingest,
    control_feeds,
    ny_stream_ingest,
    read_ledger,
)
from tripflow.operators.monitor import default_limits
from tripflow.schemas import AGREEMENT, CHICAGO_KEY, CHICAGO_RAW, GOLD
from tripflow.sources.files import read_silver, stream_staged_csv
from tripflow.sources.messages import read_messages
from tripflow.streaming.bronze import read_bronze, write_bronze
from tripflow.streaming.runs import run_gold_incremental, silver_stream
from tripflow.streaming.sinks import (
    fan_out,
    silver_files,
    start,
    write_gold,
    write_metric_log,
    write_run_report,
)

NOW = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


def trip(rng, seq, at):
    """A message arriving at ``at``; some are bad, some are late."""
    lag = rng.choice([0, 0, 0, 5, 20, 70, 200, 4000])
    begin = at - timedelta(seconds=lag)
    body = {
        "Trip ID": f"t{rng.randrange(150)}",
        "Pickup Community Area": rng.choice([8, 8, 8, 32, 76, "8", None]),
        "Trip Start Timestamp": f"{begin:%Y-%m-%dT%H:%M:%SZ}",
        "Trip End Timestamp": f"{at:%Y-%m-%dT%H:%M:%SZ}",
        "Trip Total": float(rng.randrange(100)),
    }
    value = "broken" if rng.random() < 0.03 else json.dumps(body)
    return {"value": value, "topic": "chicagotenant_trips", "ingest_ts": at, "seq": seq}


def captured(seed, files=5, rows=120):
    """Messages in arrival order, cut into files."""
    rng = random.Random(seed)
    at, out = NOW, []
    for seq in range(files * rows):
        at += timedelta(milliseconds=rng.randrange(4000))
        out.append(trip(rng, seq, at))
    return [out[i * rows:(i + 1) * rows] for i in range(files)]


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    schema = pa.schema([("value", pa.string()), ("topic", pa.string()),
                        ("ingest_ts", pa.timestamp("us", tz="UTC")), ("seq", pa.int64())])
    path = folder / f"part-{number:03}.parquet"
    pq.write_table(pa.Table.from_pylist(rows, schema), path)
    import os

    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def topic(spark, folder, **options):
    return read_messages(spark, str(folder), "parquet", {"maxFilesPerTrigger": 1, **options})


def all_rows(spark, folder):
    return analytics_reason(analytics_rows(read_messages(spark, str(folder), "parquet", streaming=False)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def closed_silver(spark, folder):
    on_time = mark_late(all_rows(spark, folder)).filter("NOT late")
    last = on_time.filter("reason = 'good'").agg(F.unix_millis(F.max("event_time"))).first()[0]
    rows = silver_export(silver(on_time))
    return rows.filter(F.col("window_end_ts") <= last - 80_000)


@pytest.mark.parametrize("seed", [1, 2])
def test_silver_over_batches_and_restarts(spark, tmp_path, seed):
    files, folder, base = captured(seed), tmp_path / "topic", str(tmp_path / "run")
    for number, rows in enumerate(files):
        put(folder, number, rows)
        if number in (1, 2, 4):  # run, restart, restart
            silver_analytics(topic(spark, folder), base)

    # Lateness over five batches is the lateness over all rows at once.
    bronze = read_bronze(spark, f"{base}/bronze", streaming=False)
    judged = mark_late(all_rows(spark, folder))
    columns = ["seq", "reason", "late", "event_time"]
    assert rows_of(bronze.select(columns)) == rows_of(judged.select(columns))
    assert judged.filter("late").count() > 0

    stored = read_silver(spark, f"{base}/silverData", "parquet")
    expected = closed_silver(spark, folder)
    assert rows_of(stored) == rows_of(expected) and expected.count() > 5

    late_texts = spark.read.text(f"{base}/feed/late/{FEED_TOPIC}").count()
    assert late_texts == judged.filter("late").count()
    log = spark.read.text(f"{base}/logs").filter("value LIKE 'records per window: %'")
    counted = log.agg(F.sum(F.substring_index("value", " ", -1).cast("int"))).first()[0]
    on_time = judged.filter("NOT late AND NOT malformed")
    last = on_time.agg(F.unix_millis(F.max("event_time"))).first()[0]
    closed = window_quality(on_time).filter(F.unix_millis("window_start") + 60_000 <= last - 80_000)
    assert counted == closed.agg(F.sum("rows")).first()[0]


def test_continuous_run_equals_batch(spark, tmp_path):
    files, folder, base = captured(9, 3, 80), tmp_path / "topic", str(tmp_path / "run")
    put(folder, 0, files[0])
    queries = silver_analytics(topic(spark, folder), base, outputs=("silver",), trigger={"processingTime": "1 second"})
    try:
        for number in (1, 2):
            put(folder, number, files[number])
            queries[0].processAllAvailable()
            queries[1].processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert rows_of(read_silver(spark, f"{base}/silverData", "parquet")) == rows_of(closed_silver(spark, folder))


def test_bronze_replay_adds_nothing(spark, tmp_path):
    files, folder, base = captured(3, 3, 60), tmp_path / "topic", tmp_path / "bronze"
    for number, rows in enumerate(files):
        put(folder, number, rows)
    write_bronze(topic(spark, folder), str(base)).awaitTermination()
    first = rows_of(read_bronze(spark, str(base), streaming=False))
    # The last batch was written but its commit was lost.
    (base / "_checkpoint/commits/2").unlink()
    for crc in (base / "_checkpoint/commits").glob(".2.crc"):
        crc.unlink()
    write_bronze(topic(spark, folder), str(base)).awaitTermination()
    assert rows_of(read_bronze(spark, str(base), streaming=False)) == first
    assert len(first) == 180


def test_gold_runs_once_per_file(spark, tmp_path):
    files, folder, base = captured(4), tmp_path / "topic", str(tmp_path / "run")
    for number, rows in enumerate(files):
        put(folder, number, rows)
        if number in (2, 4):
            silver_analytics(topic(spark, folder), base, outputs=("silver",))
            gold_batch(spark, base)
            gold_batch(spark, base)
    parts = spark.read.schema(GOLD).option("header", True).csv(f"{base}/goldData")
    totals = parts.groupBy("pickup_location_area").agg(F.sum("trips"), F.sum("sum_fares"))
    whole = gold(read_silver(spark, f"{base}/silverData", "parquet"))
    assert rows_of(totals) == rows_of(whole.select("pickup_location_area", "trips", "sum_fares"))
    assert spark.read.option("header", True).csv(f"{base}/goldData").select("batch_id").distinct().count() == 2


def test_gold_archives_taken_csv_files(spark, tmp_path):
    hour = tmp_path / "silver" / "hour=2024-01-10--14"
    hour.mkdir(parents=True)
    archive = str(tmp_path / "archive")
    for name in ("a", "b"):
        (hour / f"{name}.csv").write_text("8,2,5.50,0,60000\n")
        run_gold_incremental(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "ck"),
                             "csv", archive).awaitTermination()
    rows = spark.read.schema(GOLD).option("header", True).csv(str(tmp_path / "gold"))
    assert [(r.trips, float(r.sum_fares)) for r in rows.collect()] == [(2, 5.5), (2, 5.5)]


def test_update_mode_emits_a_window_again(spark, tmp_path):
    folder = tmp_path / "topic"

    def message(seq, second, area=8):
        at = NOW + timedelta(seconds=second)
        body = {"Pickup Community Area": area, "Trip Start Timestamp": f"{at:%Y-%m-%dT%H:%M:%SZ}", "Trip Total": 1.0}
        return {"value": json.dumps(body), "topic": "t_trips", "ingest_ts": at, "seq": seq}

    put(folder, 0, [message(0, 10), message(1, 100)])
    put(folder, 1, [message(2, 20)])  # late, but its window is still open
    write_bronze(topic(spark, folder), str(tmp_path / "b")).awaitTermination()
    rows = silver_stream(read_bronze(spark, str(tmp_path / "b"), files_per_batch=1))
    emitted = []
    query = (
        rows.writeStream.outputMode("update")
        .foreachBatch(lambda df, i: emitted.extend((i, r.window_start, r.trips) for r in df.collect()))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    first = NOW.replace(tzinfo=None)
    assert [(w, n) for _, w, n in emitted if w == first] == [(first, 1), (first, 2)]


@pytest.fixture(scope="module")
def chicago_run(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("chicago")
    folder, base = tmp / "topic", tmp / "run"
    for number, rows in enumerate(captured(5, 4, 80)):
        put(folder, number, rows)
        if number in (1, 3):
            chicago_stream_ingest(topic(spark, folder), str(base), buckets=4).awaitTermination()
    return folder, base


def test_chicago_table_over_restarts(spark, chicago_run):
    folder, base = chicago_run
    batch = read_messages(spark, str(folder), "parquet", streaming=False)
    accepted, _ = split_by_tag(ingest_disposition(batch))
    expected = latest_per_key(chicago_rows(accepted), CHICAGO_KEY, ["ingest_ts", "seq"])
    columns = [*CHICAGO_KEY, "trip_total", "seq", "trip_start_timestamp"]
    assert rows_of(read_table(spark, f"{base}/table").select(columns)) == rows_of(expected.select(columns))
    assert read_ledger(spark, str(base)).count() == 320


def test_chicago_replay_changes_nothing(spark, chicago_run):
    folder, base = chicago_run
    before = rows_of(read_table(spark, f"{base}/table"))
    commits = base / "_checkpoint/commits"
    (commits / "3").unlink()
    (commits / ".3.crc").unlink(missing_ok=True)
    chicago_stream_ingest(topic(spark, folder), str(base), buckets=4).awaitTermination()
    assert rows_of(read_table(spark, f"{base}/table")) == before
    assert read_ledger(spark, str(base)).count() == 320


def test_control_feeds(spark, chicago_run):
    ledger = read_ledger(spark, str(chicago_run[1]))
    feeds = control_feeds(ledger, default_limits(spark))
    assert feeds["status"].agg(F.sum("rows_processed")).first()[0] == 320
    assert {r.action for r in feeds["actions"].collect()} <= {"stop", "restart"}
    runs = feeds["reports"].collect()
    assert sum(r["rows"] for r in runs) == ledger.filter("disposition = 'ok'").count()
    assert feeds["runs"].count() == 2 * len(runs)


def test_ny_quarantine(spark, tmp_path):
    values = ['{"VendorID":1,"tpep_dropoff_datetime":"2024-01-10T10:00:00Z"}',
              '{"VendorID":1,"tpep_dropoff_datetime":"soon"}',
              '{"VendorID":1e12,"tpep_dropoff_datetime":"2024-01-10T10:00:00Z"}', '{"VendorID":NaN}', "x"]
    put(tmp_path / "topic", 0, [{"value": v, "topic": "nytenant_trips", "ingest_ts": NOW, "seq": i}
                               for i, v in enumerate(values)])
    ny_stream_ingest(topic(spark, tmp_path / "topic"), str(tmp_path / "run"), buckets=2).awaitTermination()
    assert read_table(spark, str(tmp_path / "run/table")).count() == 1
    counts = {r.disposition: r["count"] for r in read_ledger(spark, str(tmp_path / "run")).groupBy("disposition").count().collect()}
    assert counts == {"ok": 1, "errored": 2, "discarded": 2}
    assert spark.read.text(str(tmp_path / "run/quarantine")).count() == 4


def test_sessions_stream_equals_batch(spark, tmp_path):
    rng, at, rows = random.Random(6), NOW, []
    for seq in range(200):
        at += timedelta(seconds=rng.choice([1, 10, 59, 60, 61, 300]))
        rows.append({"value": "v", "topic": rng.choice(["a_trips", "b_trips"]), "ingest_ts": at, "seq": seq})
    for number in range(4):
        put(tmp_path / "topic", number, rows[number * 50:(number + 1) * 50])

    def ledger(df):
        return df.select(F.substring_index("topic", "_", 1).alias("tenant"), "ingest_ts", F.lit("ok").alias("disposition"))

    sessions = activity_sessions(ledger(topic(spark, tmp_path / "topic")).withWatermark("ingest_ts", "0 seconds"))
    start(sessions, str(tmp_path / "ck"), str(tmp_path / "out")).awaitTermination()
    columns = ["tenant", "start", "last_msg", "rows"]
    batch = activity_sessions(ledger(read_messages(spark, str(tmp_path / "topic"), "parquet", streaming=False)))
    closed = batch.filter(F.col("last_msg") + F.expr("INTERVAL 60 SECONDS") <= F.lit(at))
    found = rows_of(spark.read.parquet(str(tmp_path / "out")).select(columns))
    assert found == rows_of(closed.select(columns)) and len(found) > 10


def test_fan_out(spark, tmp_path):
    for number, rows in enumerate(captured(7, 2, 40)):
        put(tmp_path / "topic", number, rows)
    sinks = [lambda df, i, n=n: df.write.mode("overwrite").parquet(str(tmp_path / f"{n}/batch_id={i}")) for n in "xy"]
    fan_out(topic(spark, tmp_path / "topic"), sinks, str(tmp_path / "ck2")).awaitTermination()
    assert [spark.read.parquet(str(tmp_path / n)).count() for n in "xy"] == [80, 80]


def test_drop_repeats(spark, tmp_path):
    rows = [{"value": v, "topic": "t_x", "ingest_ts": NOW, "seq": i} for i, v in enumerate("aab")]
    put(tmp_path / "topic", 0, rows)
    put(tmp_path / "topic", 1, [dict(rows[2], seq=9)])
    unique = drop_repeats(topic(spark, tmp_path / "topic"), ["value"], "ingest_ts", "1 hour")
    start(unique, str(tmp_path / "ck"), str(tmp_path / "out")).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_batch_sinks(spark, tmp_path):
    put(tmp_path / "topic", 0, captured(8, 1, 50)[0])
    judged = all_rows(spark, tmp_path / "topic")
    write_metric_log(quality_ratios(window_quality(judged)), str(tmp_path / "log"))
    windows = window_quality(judged).count()
    assert spark.read.text(str(tmp_path / "log")).count() == 7 * windows
    write_gold(gold(silver_files(silver(judged)), "hour"), str(tmp_path / "gold"))
    assert spark.read.option("header", True).csv(str(tmp_path / "gold")).count() > 0
    ledger = judged.select(F.lit("a").alias("tenant"), "ingest_ts", F.lit("ok").alias("disposition"))
    write_run_report(run_report(ledger), str(tmp_path / "reports"))
    report = json.loads(spark.read.text(str(tmp_path / "reports")).first().value)
    assert set(report) == {"start_time", "end_time", "total_time", "rows", "total_size", "speed"}
    assert ingest_status(ledger).agg(F.sum("rows_processed")).first()[0] == 50


def test_staged_stream_deletes_taken_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / f"in/{name}.csv").write_text("k,v\n1,x\n")
        rows = stream_staged_csv(spark, str(tmp_path / "in"), "k INT, v STRING", "delete")
        start(rows, str(tmp_path / "ck"), str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_staged_ingest_by_interval(spark, tmp_path):
    header = ("Trip ID,Taxi ID,Trip Start Timestamp,Trip End Timestamp,Trip Seconds,Trip Miles,Pickup Census Tract,"
              "Dropoff Census Tract,Pickup Community Area,Dropoff Community Area,Fare,Tips,Tolls,Extras,Trip Total,"
              "Payment Type,Company,Pickup Centroid Latitude,Pickup Centroid Longitude,Pickup Centroid Location,"
              "Dropoff Centroid Latitude,Dropoff Centroid Longitude,Dropoff Centroid  Location")
    folder = tmp_path / "staging" / "t"
    folder.mkdir(parents=True)

    def line(trip, total):
        return f"{trip},x,01/19/2024 05:00:00 PM,01/19/2024 06:00:00 PM,1,1.0,,,8,,,,,,{total},Cash,c,,,,,,"

    (folder / "a.csv").write_text("\n".join([header, line("t1", 1), line("t2", 1), line("t2", 2)]))
    (folder / "b.csv").write_text("\n".join([header, line("t1", 5)]))
    (folder / "c.txt").write_text("junk")
    terms = ("t", "clean_chicago", "/t", "space", "trips", {"csv": True}, 1.0, 5, 10, 0.0001, 10)
    agreements = spark.createDataFrame([terms], AGREEMENT)
    table = str(tmp_path / "table")

    def totals():
        return {r.trip_id: r.trip_total for r in read_table(spark, table).collect()}

    ingest_staged(spark, str(tmp_path / "staging"), agreements, table, 0, [0], 2)
    assert totals() == {"t1": 1.0, "t2": 2.0}  # quota of 100 bytes: one file per interval
    decisions = ingest_staged(spark, str(tmp_path / "staging"), agreements, table, 1, [1], 2, delete=True)
    assert sorted(p.name for p in folder.glob("*.*") if not p.name.startswith(".")) == ["a.csv", "c.txt"]
    assert totals() == {"t1": 5.0, "t2": 2.0}
    assert {r.file: (r.accepted, r.interval_no) for r in decisions.collect()} == {
        "a.csv": (True, 0), "b.csv": (True, 1), "c.txt": (False, None)}


def test_staged_ingest_keeps_odd_names_and_headers(spark, tmp_path):
    names = T.StructType.fromDDL(CHICAGO_RAW).names
    values = {"Trip ID": "t", "Pickup Community Area": "8", "Trip Total": "5", "Trip Miles": "1.5"}

    def stage(tenant, file, columns, trip):
        folder = tmp_path / "staging" / tenant
        folder.mkdir(parents=True, exist_ok=True)
        row = ",".join({**values, "Trip ID": trip}.get(c, "") for c in columns)
        (folder / file).write_text(",".join(columns) + "\n" + row + "\n")

    stage("two words+", "a.csv", names, "t1")
    stage("two words+", "a[1].csv", names, "t2")
    stage("two words+", "back.csv", names[::-1], "t3")
    stage("two words+", "odd.csv", ["Trip", *names[1:]], "t4")
    stage("nobody", "a.csv", names, "t5")
    terms = ("two words+", "clean_chicago", "/t", "space", "trips", {"csv": True}, 1.0, 50, 10, 10.0, 10)
    agreements = spark.createDataFrame([terms], AGREEMENT)
    table = str(tmp_path / "table")
    decisions = ingest_staged(spark, str(tmp_path / "staging"), agreements, table, buckets=2, delete=True)
    rows = read_table(spark, table).select("trip_id", "pickup_community_area", "trip_total", "trip_miles").collect()
    assert sorted(map(tuple, rows)) == [(t, 8.0, 5.0, 1.5) for t in ("t1", "t2", "t3")]
    left = sorted(str(p.relative_to(tmp_path / "staging")) for p in (tmp_path / "staging").glob("*/[!.]*.csv"))
    assert left == ["nobody/a.csv", "two words+/odd.csv"]
    assert {(r.tenant, r.file): r.reason for r in decisions.collect() if not r.accepted} == {
        ("nobody", "a.csv"): "no_agreement", ("two words+", "odd.csv"): "unknown_header"}


def test_staged_elsewhere_and_run_totals(spark, tmp_path):
    """Folders that agreements name, a transform of one location, and totals from what the run returns."""
    names = T.StructType.fromDDL(CHICAGO_RAW).names
    places = {"a": tmp_path / "staging" / "a", "b": tmp_path / "elsewhere" / "drop box", "c": tmp_path / "staging" / "other"}
    for tenant, folder in places.items():
        folder.mkdir(parents=True)
        for n in range(2):
            row = ",".join({"Trip ID": f"{tenant}{n}", "Pickup Community Area": "8"}.get(c, "") for c in names)
            (folder / f"f{n}.csv").write_text(",".join(names) + "\n" + row + "\n")
    here = f"file://{tmp_path}/elsewhere/drop box"
    terms = [(t, "clean_chicago", where, f"{t}_space", "trips", {"csv": True}, 1.0, 50, 10, 10.0, 10)
             for t, where in (("a", "/a"), ("b", here), ("c", "other"))]
    register_pipeline("clean_chicago", lambda df: clean_chicago(df).withColumn("company", F.lit("own")), "b", here)
    table = str(tmp_path / "table")
    decisions = ingest_staged(spark, str(tmp_path / "staging"), spark.createDataFrame(terms, AGREEMENT), table, 7, None, 2, True)
    rows = {(r.keyspace, r.trip_id, r.company) for r in read_table(spark, table).collect()}
    assert rows == {(f"{t}_space", f"{t}{n}", "own" if t == "b" else None) for t in "abc" for n in range(2)}
    totals = batch_run_stats(decisions.filter("seconds IS NOT NULL")).collect()
    assert sorted((r.tenant, r.run, r.files) for r in totals) == [("a", 7, 2), ("b", 7, 2), ("c", 7, 2)]
    assert all(r.seconds > 0 and r.mb > 0 for r in totals) and not list(tmp_path.glob("*/*/[!.]*.csv"))


def test_dynamic_ingest_takes_new_columns(spark, tmp_path):
    schema = "value STRING, consumer STRING, ingest_ts TIMESTAMP, seq BIGINT"

    def batch(*values):
        return spark.createDataFrame([(v, "c1", NOW, i) for i, v in enumerate(values)], schema)

    table = str(tmp_path / "t")
    ingest_dynamic(batch('{"Trip ID":"a","Pickup Community Area":8}', "x"), table, buckets=4)
    row = ingest_dynamic(
        batch('{"Trip ID":"b","Pickup Community Area":8,"New Key":1}', '{"Trip ID":"c"}', None), table, buckets=4
    ).first()
    assert (row.messages, row.inserted, row.insert_errors, row.transport_errors) == (2, 1, 1, 1)
    rows = {r.trip_id: r.new_key for r in read_table(spark, table, evolving=True).collect()}
    assert rows == {"a": None, "b": "1"}
