"""Operators on small literal inputs, and against brute force."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow.functions import text, times
from tripflow.operators.cleanse import (
    cast_trips,
    drop_unused,
    evolve_columns,
    fill_area,
    nan_to_null,
    parse_trips,
    snake_columns,
)
from tripflow.operators.disposition import (
    analytics_reason,
    analytics_rows,
    ingest_disposition,
    quarantine,
    valid_key,
)
from tripflow.operators.gold import gold, top_areas
from tripflow.operators.ingest import activity_sessions, ingest_status
from tripflow.operators.late import mark_late
from tripflow.operators.trips import decrypt_cols, dq_rules, encrypt_cols
from tripflow.operators.upsert import append_table, compact_table, latest_per_key, read_table, upsert
from tripflow.operators.windows import silver, silver_export
from tripflow.plans.registry import register_pipeline, run_tenant
from tripflow.schemas import MESSAGE, SILVER
from tripflow.session import interval_seconds
from tripflow.sources.files import new_silver, number_rows, read_staged, split_samples, write_samples
from tripflow.sources.messages import kafka_options, read_messages, to_messages
from tripflow.streaming.files import exists

NOW = datetime(2024, 1, 10, 12)


def utc(seconds):
    return datetime(1970, 1, 1) + timedelta(seconds=seconds)


def messages(spark, values):
    return spark.createDataFrame([(v, "t_trips", NOW, i) for i, v in enumerate(values)], MESSAGE)


def test_interval_seconds():
    assert [interval_seconds(x) for x in (5, "5 seconds", "2 minutes", "1 hour", "1 day")] == [
        5, 5, 120, 3600, 86400]


def test_analytics_reason_matrix(spark):
    ok_time = '"Trip Start Timestamp":"2024-01-10T10:00:00Z"'
    cases = {
        '{"Pickup Community Area":8,%s}' % ok_time: "good",
        '{"Pickup Community Area":"8",%s}' % ok_time: "pickup_area",
        '{"Pickup Community Area":8.0,%s}' % ok_time: "pickup_area",
        '{"Pickup Community Area":NaN,%s}' % ok_time: "pickup_area",
        '{"Pickup Community Area":true,%s}' % ok_time: "pickup_area",
        '{"Pickup Community Area":null,%s}' % ok_time: "pickup_area",
        "{%s}" % ok_time: "pickup_area",
        '{"Pickup Community Area":8}': "timestamp",
        '{"Pickup Community Area":8,"Trip Start Timestamp":NaN}': "timestamp",
        '{"Pickup Community Area":8,"Trip Start Timestamp":"nan"}': "timestamp",
        '{"Pickup Community Area":8,"Trip Start Timestamp":"later"}': "good",
        '{"Pickup Community Area":8,"Trip Start Timestamp":2024}': "good",
        "[8]": "malformed",
        "nothing": "malformed",
        '{"Pickup Community Area":8': "malformed",
    }
    rows = analytics_reason(analytics_rows(messages(spark, list(cases)))).collect()
    assert {r.value: r.reason for r in rows} == cases
    assert {r.value for r in rows if not r.time_fallback} == {v for v in cases if ok_time in v}
    assert all(r.event_time == NOW for r in rows if r.time_fallback)


def test_total(spark):
    values = ['{"Trip Total":12.345}', '{"Trip Total":NaN}', "{}", '{"Trip Total":1e30}']
    rows = analytics_rows(messages(spark, values)).orderBy("seq").collect()
    assert [float(r.total) for r in rows] == [12.35, 0.0, 0.0, 0.0]


def test_absurd_totals_do_not_stop_the_job(spark):
    body = '{"Pickup Community Area":8,"Trip Start Timestamp":"2024-01-10T10:00:00Z","Trip Total":9e15}'
    rows = analytics_reason(analytics_rows(messages(spark, [body] * 50)))
    assert float(silver_export(silver(rows)).first().total_fares) == 50 * 9e15
    assert float(gold(silver_export(silver(rows))).first().sum_fares) == 50 * 9e15


def test_event_time_forms(spark):
    forms = {
        "2024-01-10T10:00:00Z": datetime(2024, 1, 10, 10),
        "2024-01-10T10:00:00+02:00": datetime(2024, 1, 10, 8),
        "2024-01-10T10:00:00.250": datetime(2024, 1, 10, 10, 0, 0, 250000),
        "2024-01-10": datetime(2024, 1, 10),
        "10:00": NOW,
        "2024": NOW,
    }
    df = spark.createDataFrame([(k, NOW) for k in forms], "t STRING, at TIMESTAMP")
    rows = df.select("t", times.event_time("t", "at").alias("e")).collect()
    assert {r.t: r.e for r in rows} == forms


def test_ingest_disposition(spark):
    times_ok = '"Trip Start Timestamp":"2024-01-10T10:00:00Z","Trip End Timestamp":"2024-01-10T10:10:00Z"'
    cases = {
        '{"Pickup Community Area":8,"Trip ID":"a",%s}' % times_ok: "ok",
        '{"Pickup Community Area":NaN,"Trip ID":"a",%s}' % times_ok: "discarded",
        '{"Pickup Community Area":8,"Trip ID":NaN,%s}' % times_ok: "discarded",
        '{"Trip ID":NaN,%s}' % times_ok: "errored",
        '{"Pickup Community Area":8,%s}' % times_ok: "errored",
        '{"Pickup Community Area":8,"Trip ID":"a"}': "errored",
        "{": "discarded",
    }
    rows = ingest_disposition(messages(spark, list(cases))).collect()
    assert {r.value: r.disposition for r in rows} == cases


def test_quarantine(spark):
    cases = {
        '{"VendorID":1,"tpep_dropoff_datetime":"2024-01-10T10:00:00Z"}': "ok",
        '{"VendorID":NaN,"tpep_dropoff_datetime":"2024-01-10T10:00:00Z"}': "quarantine",
        '{"VendorID":1}': "quarantine",
        '{"VendorID":1,"tpep_dropoff_datetime":NaN}': "quarantine",
        "x": "quarantine",
    }
    rows = quarantine(messages(spark, list(cases))).collect()
    assert {r.value: r.disposition for r in rows} == cases


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, 2.0, float("nan"))], "`Dropoff Centroid  Location` INT, `Trip Miles` DOUBLE, `A  B` DOUBLE"
    )
    assert snake_columns(df).columns == ["dropoff_centroid_location", "trip_miles", "a_b"]
    assert drop_unused(df).columns == ["Trip Miles", "A  B"]
    assert nan_to_null(df).first()["A  B"] is None
    assert valid_key(df, ["A  B"]).first().valid_key is False
    assert fill_area(spark.createDataFrame([(None,)], "pickup_community_area DOUBLE")).first()[0] == -1.0
    cast = cast_trips(spark.createDataFrame([("x", "3")], "a STRING, b STRING"), {"a": "double", "b": "int"})
    assert tuple(cast.first()) == (None, 3)


def test_parse_is_done_once(spark):
    """Filters on parsed fields stay above the parse."""
    rows = analytics_reason(analytics_rows(messages(spark, ["{}"]))).filter("reason = 'good'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == 1


def test_evolve_columns(spark):
    old = spark.createDataFrame([("r1", 1)], "trip_id STRING, trip_seconds INT")
    first = evolve_columns(old, messages(spark, ['{"Trip ID":"a","Trip Seconds":5,"New Key":NaN}', "x"]))
    assert first.columns == ["trip_id", "trip_seconds", "new_key"]
    second = evolve_columns(first, messages(spark, ['{"Trip ID":"b","Pickup Census Tract":4,"Other":"o"}']))
    rows = {r.trip_id: r for r in second.collect()}
    assert set(rows) == {"r1", "a", "b"} and second.columns[-1] == "other"
    assert (rows["a"].trip_seconds, rows["a"].new_key, rows["b"].other) == (5, None, "o")
    assert evolve_columns(None, messages(spark, ['{"K":1}'])).collect()[0].k == "1"


def test_more_keys_than_columns(spark, monkeypatch):
    """10,000 keys: the frequent ones are columns, no value of the others is lost, known columns stay."""
    texts = [f'{{"Trip ID":"t{i}","Odd Key":{i},"Key {i}":"v{i}","more_fields":{i % 3}}}' for i in range(10_000)]
    first = evolve_columns(None, messages(spark, texts))
    assert len(first.columns) == 501 and {"trip_id", "odd_key", "more_fields"} <= set(first.columns)
    named = F.size(F.array_compact(F.array(*(F.col(c) for c in first.columns if c.startswith("key_")))))
    kept = first.select(F.coalesce(F.size("more_fields"), F.lit(0)).alias("rest"), named.alias("named"))
    assert kept.filter("rest + named = 2").count() == 10_000 and kept.agg(F.sum("named")).first()[0] == 498
    old = spark.createDataFrame([("r", "k", {"a": "b"})], "trip_id STRING, key_77 STRING, more_fields MAP<STRING, STRING>")
    second = evolve_columns(old, messages(spark, texts[:1000]))
    rows = {r.trip_id: r for r in second.filter("trip_id IN ('r', 't77', 't999')").collect()}
    assert rows["t77"].key_77 == "v77" and rows["r"].more_fields == {"a": "b"}
    assert rows["t999"].more_fields["more_fields"] == "0" and "Key 77" not in rows["t77"].more_fields


def brute_late(rows, size, wait):
    """Late flags by going through the rows in arrival order (all times in ms)."""
    seen, late = None, set()
    for arrival, seq, event in sorted(rows):
        end = event // size * size + size
        if seen is not None and end + wait <= seen:
            late.add(seq)
        seen = event if seen is None else max(seen, event)
    return late


@pytest.mark.parametrize("seed", range(4))
def test_late_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = 1_704_880_800_000
    rows = []
    for seq in range(600):
        # A third of all rows share one arrival instant; some come hours late.
        arrival = base + (300_000 if rng.random() < 0.33 else rng.randrange(900) * 1000)
        lag = rng.choice([0, 0, 1000, 30_000, 90_000, 300_000, 20_000_000])
        rows.append((arrival, seq, arrival - lag + rng.randrange(5000)))
    df = spark.createDataFrame(
        [(s, utc(a / 1000), utc(e / 1000)) for a, s, e in rows],
        "seq BIGINT, ingest_ts TIMESTAMP, event_time TIMESTAMP",
    )
    found = {r.seq for r in mark_late(df).filter("late").collect()}
    assert found == brute_late(rows, 60_000, 80_000)
    assert found


def test_late_with_earlier_batches(spark):
    df = spark.createDataFrame([(1, NOW, NOW - timedelta(minutes=5)), (2, NOW, NOW)],
                               "seq BIGINT, ingest_ts TIMESTAMP, event_time TIMESTAMP")
    seen = int(NOW.timestamp() * 1000)
    assert {r.seq: r.late for r in mark_late(df, seen_until_ms=seen).collect()} == {1: True, 2: False}
    assert {r.late for r in mark_late(df).collect()} == {False}


def brute_sessions(arrivals, gap):
    runs = []
    for t in sorted(arrivals):
        if runs and t - runs[-1][1] <= gap:
            runs[-1][1] = t
            runs[-1][2] += 1
        else:
            runs.append([t, t, 1])
    return [tuple(r) for r in runs]


@pytest.mark.parametrize("seed", range(3))
def test_sessions_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = int(NOW.timestamp())
    arrivals = [base + rng.randrange(0, 20000) for _ in range(300)] + [base, base + 60, base + 120]
    df = spark.createDataFrame(
        [("t", utc(a), "ok") for a in arrivals],
        "tenant STRING, ingest_ts TIMESTAMP, disposition STRING",
    )
    rows = activity_sessions(df).select(
        F.unix_seconds("start"), F.unix_seconds("last_msg"), "rows"
    ).collect()
    assert sorted(tuple(r) for r in rows) == brute_sessions(arrivals, 60)


def test_status_fills_gaps(spark):
    offsets = [0, 9.999, 10, 35, 35.5]
    rows = [("a", NOW + timedelta(seconds=s), "discarded" if s == 35 else "ok") for s in offsets]
    rows += [("b", NOW + timedelta(seconds=3), "ok")]
    status = ingest_status(spark.createDataFrame(rows, "tenant STRING, ingest_ts TIMESTAMP, disposition STRING"))
    found = {(r.tenant_id, r.interval_no): (r.rows_processed, r.discarded_rows) for r in status.collect()}
    assert found == {("a", 0): (2, 0), ("a", 1): (1, 0), ("a", 2): (0, 0), ("a", 3): (2, 1), ("b", 0): (1, 0)}


def test_gold_mean_is_over_windows(spark):
    rows = spark.createDataFrame(
        [(8, 2, 10.0, 0, 60), (8, 1, 20.0, 60, 120), (9, 4, 1.0, 0, 60)],
        "pickup_location_area INT, trips BIGINT, total_fares DOUBLE, window_start_ts BIGINT, window_end_ts BIGINT",
    )
    found = {r.pickup_location_area: r for r in gold(rows).collect()}
    assert (found[8].trips, found[8].sum_fares, found[8].avg_fares) == (3, 30.0, 15.0)
    assert (found[8].window_start_ts, found[8].window_end_ts) == (0, 120)
    assert [r.pickup_location_area for r in top_areas(rows, 1).orderBy("window_start_ts").collect()] == [9, 8]


def test_upsert_replaces_and_replays(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "k INT, v STRING, at INT"
    upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema), table, ["k"], ["at"], 4, 0)
    second = spark.createDataFrame([(1, "old", 0), (2, "d", 5), (3, "e", 1)], schema)
    upsert(second, table, ["k"], ["at"], 4, 1)
    want = {1: "b", 2: "d", 3: "e"}
    assert {r.k: r.v for r in read_table(spark, table).collect()} == want
    upsert(second, table, ["k"], ["at"], 4, 1)
    assert {r.k: r.v for r in read_table(spark, table).collect()} == want
    wider = spark.createDataFrame([(4, "f", 1, "x")], schema + ", w STRING")
    with pytest.raises(ValueError):
        upsert(wider, table, ["k"], ["at"], 4, 2)
    # An evolving table takes new columns; rows without them have NULL.
    upsert(wider, table, ["k"], ["at"], 4, 2, evolving=True)
    upsert(second, table, ["k"], ["at"], 4, 3, evolving=True)
    rows = read_table(spark, table, evolving=True).collect()
    assert {r.k: r.w for r in rows} == {1: None, 2: None, 3: None, 4: "x"}
    compact_table(spark, table, evolving=True)
    assert read_table(spark, table, evolving=True).collect() == rows


def test_upsert_refuses_other_terms(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("CAST(id AS INT) AS k", "1 AS at")
    upsert(rows, table, ["k"], ["at"], 8)
    for keys, buckets in ((["k"], 12), (["at"], 8)):
        with pytest.raises(ValueError):
            upsert(rows, table, keys, ["at"], buckets)
    assert read_table(spark, table).count() == 100


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = str(tmp_path / "t")
    upsert(spark.range(20_000).selectExpr("id AS k", "'a' AS v", "1 AS at"), table, ["k"], ["at"], 4, "q-0")
    base = {p: p.stat().st_mtime_ns for p in (tmp_path / "t/rows").rglob("*.parquet")}
    upsert(spark.range(200).selectExpr("id * 7 AS k", "'b' AS v", "2 AS at"), table, ["k"], ["at"], 4, "q-1")
    assert all(p.stat().st_mtime_ns == at for p, at in base.items())
    assert spark.read.parquet(f"{table}/rows/batch_id=q-1").count() == 200
    read = read_table(spark, table)
    assert (read.count(), read.filter("v = 'b'").count()) == (20_000, 200)


def test_compaction_survives_a_crash_before_the_deletion(spark, tmp_path, monkeypatch):
    from tripflow.operators import upsert as module

    table, schema = str(tmp_path / "t"), "k INT, v STRING, at INT"
    for n in range(3):
        rows = [(k, str(n), n) for k in range(5 * n, 5 * n + 10)]
        upsert(spark.createDataFrame(rows, schema), table, ["k"], ["at"], 4, f"q-{n}")
    want = sorted(read_table(spark, table).collect())

    def crash(spark, paths):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(module, "delete_folders", crash)
        with pytest.raises(OSError):
            compact_table(spark, table)
    assert sorted(read_table(spark, table).collect()) == want
    compact_table(spark, table, batches=["q-0", "q-1"])
    assert not exists(spark, f"{table}/rows/batch_id=q-0") and exists(spark, f"{table}/rows/batch_id=q-2")
    assert sorted(read_table(spark, table).collect()) == want
    compact_table(spark, table)
    assert len(list((tmp_path / "t/rows").glob("batch_id=*"))) == 1
    assert sorted(read_table(spark, table).collect()) == want
    # A batch that is played again after its folder was merged changes nothing.
    upsert(spark.createDataFrame([(k, "0", 0) for k in range(10)], schema), table, ["k"], ["at"], 4, "q-0")
    assert sorted(read_table(spark, table).collect()) == want


def test_upsert_partitions_keep_tenants_apart(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "tenant STRING, k INT, v STRING, at INT"
    for rows in ([("007", 1, "a", 1), ("8", 1, "b", 1)], [("8", 1, "c", 2)], [("007", 2, "d", 1)]):
        upsert(spark.createDataFrame(rows, schema), table, ["k"], ["at"], 4, None, ["tenant"])
    stored = read_table(spark, table).collect()
    assert {(r.tenant, r.v) for r in stored} == {("007", "a"), ("8", "c"), ("007", "d")}


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS at")
    newest = latest_per_key(df, ["k"], ["at"])
    assert {tuple(r) for r in newest.collect()} == {(0, 999), (1, 997), (2, 998)}
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()


def test_append_table(spark):
    df = spark.createDataFrame([(1,)], "k INT")
    append_table(df, "append_space", "trips")
    append_table(df, "append_space", "trips")
    assert spark.table("append_space.trips").count() == 2


def test_number_rows_and_samples(spark, tmp_path):
    # A third of the rows share the first order column.
    df = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7, id % 50) AS a")
    rows = number_rows(df, ["a", "id"]).collect()
    order = sorted((r.a, r.id) for r in rows)
    assert {(r.a, r.id): r.row_no for r in rows} == {key: i for i, key in enumerate(order)}
    cut = split_samples(df, 2, 100, ["a", "id"])
    assert sorted(r.row_no for r in cut.collect()) == list(range(200))
    write_samples(cut, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s/sample_id=1")).count() == 100


def test_messages_round_trip(spark):
    df = spark.createDataFrame(
        [("NaN", float("nan"), NOW, None), ("b", 1.5, NOW, 3)], "`Trip ID` STRING, `Trip Miles` DOUBLE, at TIMESTAMP, n INT"
    )
    values = [r.value for r in to_messages(df, ["at"]).collect()]
    assert values[0] == '{"Trip ID":"NaN","Trip Miles":NaN,"at":"2024-01-10T12:00:00Z","n":null}'
    assert json.loads(values[1]) == {"Trip ID": "b", "Trip Miles": 1.5, "at": "2024-01-10T12:00:00Z", "n": 3}


def test_kafka_options():
    plain = kafka_options("b:9092", "g1")
    assert plain["startingOffsets"] == "earliest" and "kafka.security.protocol" not in plain
    secure = kafka_options("b:9092", "g1", "me", "pw")
    assert secure["kafka.sasl.mechanism"] == "PLAIN" and 'username="me"' in secure["kafka.sasl.jaas.config"]


def test_read_text_messages(spark, tmp_path):
    (tmp_path / "nytenant_trips").mkdir()
    (tmp_path / "nytenant_trips" / "a.txt").write_text('{"a":1}\nnot json\n')
    rows = read_messages(spark, str(tmp_path), streaming=False)
    found = rows.select("value", text.tenant_of("topic").alias("tenant")).collect()
    assert {tuple(r) for r in found} == {('{"a":1}', "nytenant"), ("not json", "nytenant")}


@pytest.mark.parametrize("ext", ["csv", "json", "xml", "parquet", "txt"])
def test_staged_formats(spark, tmp_path, ext):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "id STRING, fare DOUBLE")
    path = str(tmp_path / ext)
    writer = df.write
    if ext == "txt":
        writer.option("sep", "\t").option("header", True).csv(path)
    elif ext == "xml":
        writer.option("rowTag", "row").xml(path)
    elif ext == "csv":
        writer.option("header", True).csv(path)
    else:
        getattr(writer, ext)(path)
    rows = read_staged(spark, path, ext, "id STRING, fare DOUBLE")
    assert {tuple(r) for r in rows.collect()} == {("a", 1.5), ("b", None)}


def test_unknown_staged_format(spark):
    with pytest.raises(ValueError):
        read_staged(spark, "x", "bin", "a INT")


def test_new_silver(spark, tmp_path):
    for name in ("2024-01-10--14/part-0.csv", "2024-01-10--14/part-1_processed.csv", "2024-01-10--15/part-2.csv",
                 "2024-01-10--14/notes.log"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("8,1,2.00,0,60000\n")
    base = str(tmp_path)
    assert new_silver(spark, base).count() == 2
    hour = new_silver(spark, base, "2024-01-10--14")
    assert hour.first().path.endswith("part-0.csv") and hour.count() == 1
    assert new_silver(spark, base, "2024-01-10--14", done=hour).isEmpty()
    from tripflow.sources.files import read_silver

    rows = read_silver(spark, [r.path for r in hour.collect()])
    assert rows.schema.simpleString() == spark.createDataFrame([], SILVER).schema.simpleString()
    assert rows.first().window_end_ts == 60000


def test_names_and_paths(spark):
    row = spark.range(1).select(
        text.gold_path(F.lit("hdfs://h:9000/chicagoTenant/silverData/2025-03-29--14/part-0.csv")).alias("gold"),
        text.processed_name(F.lit("/a.b/part-0-0.csv")).alias("done"),
        text.file_ext(F.lit("a.b.csv")).alias("ext"),
        text.tenant_of(F.lit("nytenant_ingestion_report_warning")).alias("tenant"),
        text.message_kind(F.lit("nytenant_ingestion_report_warning")).alias("kind"),
        text.message_kind(F.lit("plain")).alias("no_kind"),
        times.hour_dir(F.lit(NOW)).alias("hour"),
        times.epoch_text(F.lit(1741772192.7)).alias("at"),
    ).first()
    assert row.gold == "hdfs://h:9000/chicagoTenant/goldData/2025-03-29--14/"
    assert (row.done, row.ext) == ("/a.b/part-0-0_processed.csv", "csv")
    assert (row.tenant, row.kind, row.no_kind) == ("nytenant", "ingestion_report_warning", "")
    assert (row.hour, row.at) == ("2024-01-10--14", "2025-03-12 09:36:32")


def test_dq_rules(spark):
    df = spark.createDataFrame([(1, "k", 5.0), (2, "k", None), (3, "k", 900.0), (4, "m", 1.0)],
                               "id INT, k STRING, fare DOUBLE")
    rows = dq_rules(df, ["fare"], {"fare": (0, 500)}, ["k"], "id").collect()
    assert {r.id: r.reject_reasons for r in rows} == {
        1: [], 2: ["missing fare", "duplicate"], 3: ["range fare", "duplicate"], 4: []}


def test_encryption(spark):
    df = spark.createDataFrame([("a", 1.5), (None, 2.5)], "who STRING, fare DOUBLE")
    key = spark.createDataFrame([("0123456789abcdef",)], "key STRING")
    hidden = encrypt_cols(df, ["who", "fare"], key)
    assert "a" not in [r.who for r in hidden.collect()]
    shown = decrypt_cols(hidden, {"who": "string", "fare": "double"}, key)
    assert {tuple(r) for r in shown.collect()} == {("a", 1.5), (None, 2.5)}


def test_no_plan_shows_the_key(spark, tmp_path, capsys):
    (tmp_path / "key.txt").write_text("0123456789abcdef")
    df = spark.createDataFrame([("a",)], "who STRING")
    for key in (
        spark.createDataFrame([("0123456789abcdef",)], "key STRING"),
        spark.read.text(str(tmp_path / "key.txt")),
    ):
        encrypt_cols(df, ["who"], key).explain("extended")
    plans = capsys.readouterr().out
    assert "aes" in plans and "0123456789abcdef" not in plans and "30 31 32 33" not in plans


def test_registry(spark):
    register_pipeline("double", lambda df: df.selectExpr("id * 2 AS id"))
    register_pipeline("double", lambda df: df.selectExpr("id * 20 AS id"), "t", "/special")
    df = spark.range(1, 2)
    assert run_tenant("double", df, "t", "/any").first().id == 2
    assert run_tenant("double", df, "t", "/special").first().id == 20
    with pytest.raises(KeyError):
        run_tenant("missing", df)


def test_parse_keeps_columns(spark):
    rows = parse_trips(messages(spark, ['{"a":1}']), "a INT")
    assert rows.columns == ["value", "topic", "ingest_ts", "seq", "a", "malformed"]


def test_only_one_json_object_is_good(spark):
    good = ['{"a":1}', ' {"a":1}\n', '{"a":1,"b":{"c":"}"}}', '{"a":"x{y}"}', '{"a":NaN}']
    bad = ['{"a":1} trailing', '{"a":1}{"a":2}', "{'a':1}", '{"a":1},{"a":2}', '[{"a":1}]', "", "1", None]
    rows = parse_trips(messages(spark, good + bad), "a STRING").select("seq", "malformed").collect()
    assert [r.malformed for r in sorted(rows)] == [False] * len(good) + [True] * len(bad)


def test_malformed_rows_close_no_window(spark):
    old = '{"Pickup Community Area":8,"Trip Start Timestamp":"2024-01-10T07:00:0%dZ"}'
    rows = analytics_rows(messages(spark, ["junk", *[old % i for i in range(5)]]))
    assert [r.late for r in mark_late(rows).orderBy("seq").collect()] == [False] * 6
