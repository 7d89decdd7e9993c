import json
import os
import time
from datetime import date, datetime

from pyspark.sql import functions as F

from aerolith.functions.constants import SENSOR_SIGMA
from aerolith.operators.windows import window_aggregates
from aerolith import sinks
from aerolith.streaming.hot_path import STORE_KEYS, STORE_PARTITION, hot_aggregates, start_hot_path, store_batch

SCHEMA = "sensor_id string, sensor_type string, zone_id string, value double, target double, is_anomaly boolean, reading_ts_utc timestamp"


def _readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_window_boundaries_and_rules(spark):
    rows = [
        ("s1", "temperature", "Z01", 22.0, 22.0, False, datetime(2026, 1, 1, 10, 0, 0)),
        ("s1", "temperature", "Z01", 22.0, 22.0, True, datetime(2026, 1, 1, 10, 0, 59, 999000)),
        ("s1", "temperature", "Z01", 30.0, 22.0, False, datetime(2026, 1, 1, 10, 1, 0)),
        ("s2", None, None, 4.0, 0.0, False, datetime(2026, 1, 1, 10, 0, 30)),   # unknown type, sigma 1
        ("s3", "temperature", "Z02", 26.5, 22.0, False, datetime(2026, 1, 1, 10, 0, 30)),  # exactly 3 sigma
    ]
    out = {(r.sensor_id, r.window_start.minute): r for r in window_aggregates(_readings(spark, rows)).collect()}
    w = out[("s1", 0)]
    assert w.reading_count == 2 and w.anomaly_count == 1 and w.is_anomaly is False
    assert out[("s1", 1)].is_anomaly is True
    assert out[("s2", 0)].sensor_type == "unknown" and out[("s2", 0)].zone_id == "unknown" and out[("s2", 0)].is_anomaly
    assert out[("s3", 0)].is_anomaly is False


def test_stream_update_equals_batch_and_late_data(spark, tmp):
    src = os.path.join(tmp, "src")
    store, chk = (os.path.join(tmp, d) for d in ("store", "chk"))
    first = [
        ("s1", "flow", "Z01", 50.0, 50.0, False, datetime(2026, 1, 1, 10, 0, 5)),
        ("s1", "flow", "Z01", 60.0, 50.0, True, datetime(2026, 1, 1, 10, 0, 35)),
        ("s2", "flow", "Z02", 51.0, 50.0, False, datetime(2026, 1, 1, 10, 20, 0)),
    ]
    _readings(spark, first).write.mode("append").parquet(src)
    stream = spark.readStream.schema(_readings(spark, first).schema).parquet(src)
    q = start_hot_path(stream, store, chk, trigger={"processingTime": "1 second"},
                       watermark="5 minutes", decimals=False)
    try:
        q.processAllAvailable()
        # late but within the watermark (max event 10:20, watermark 10:15): dropped window 10:00
        # is beyond it; a row for 10:17 is within and merges.
        late = [
            ("s1", "flow", "Z01", 70.0, 50.0, True, datetime(2026, 1, 1, 10, 0, 50)),   # beyond watermark
            ("s2", "flow", "Z02", 53.0, 50.0, False, datetime(2026, 1, 1, 10, 20, 40)),  # same window, merges
        ]
        time.sleep(1.1)
        _readings(spark, late).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.sensor_id, r.window_start.minute): r for r in sinks.read_store(spark, store, STORE_KEYS).collect()}
    assert got[("s1", 0)].reading_count == 2  # late row beyond the watermark dropped
    assert got[("s2", 20)].reading_count == 2 and got[("s2", 20)].avg_value == 52.0
    assert len(got) == 2
    assert all(r.ttl > 0 and r.updated_at is not None for r in got.values())
    batch = window_aggregates(_readings(spark, first), sigma=SENSOR_SIGMA)
    assert batch.count() == 2


def test_versioned_tables_and_observed_counts(spark, tmp):
    base = os.path.join(tmp, "dim")
    assert not sinks.table_exists(spark, base)
    df = spark.range(10).withColumn("reading_date", F.lit(date(2026, 1, 1)))
    sinks.write_version(df, base)
    nxt = sinks.read_latest(spark, base).withColumn("id", F.col("id") + 100)
    sinks.write_version(nxt, base)  # reads v=1 while writing v=2: input is never deleted
    assert sinks.versions(spark, base) == [1, 2]
    assert sorted(r.id for r in sinks.read_latest(spark, base).collect())[0] == 100
    n = sinks.write_observed(df, os.path.join(tmp, "t"), ["reading_date"])
    assert n == 10 and spark.read.parquet(os.path.join(tmp, "t")).count() == 10


def _windows(spark, rows):
    return spark.createDataFrame(rows, "sensor_id string, window_start timestamp, v double")


def test_store_keeps_latest_row_per_key_and_filters_by_ttl(spark, tmp):
    path = os.path.join(tmp, "store")
    ten, eleven = datetime(2026, 1, 1, 10, 5), datetime(2026, 1, 1, 11, 5)
    put = store_batch(path)
    put(_windows(spark, [("s1", ten, 1.0), ("s2", ten, 2.0), ("s1", eleven, 3.0)]), 0)
    put(_windows(spark, [("s1", ten, 9.0)]), 1)
    put(_windows(spark, [("s1", ten, 9.0)]), 1)  # retried epoch: its own folder again
    store = sinks.read_store(spark, path, STORE_KEYS)
    assert {(r.sensor_id, r.window_start): r.v for r in store.collect()} == {("s1", ten): 9.0, ("s2", ten): 2.0, ("s1", eleven): 3.0}
    pruned = sinks.read_store(spark, path, STORE_KEYS, F.col(STORE_PARTITION) >= "2026-01-01-11")
    assert [r.v for r in pruned.collect()] == [3.0]
    assert sinks.live_rows(store).count() == 3
    assert sinks.read_store(spark, path, STORE_KEYS, live_at="now").count() == 3
    assert sinks.read_store(spark, path, STORE_KEYS, live_at=datetime(2100, 1, 1)).count() == 0
    assert sinks.live_rows(store, datetime(2100, 1, 1)).count() == 0


def test_crash_while_an_epoch_is_written_loses_no_row(spark, tmp):
    path = os.path.join(tmp, "store")
    t = datetime(2026, 1, 1, 10, 5)
    put = store_batch(path)
    put(_windows(spark, [(f"s{k}", t, 1.0) for k in range(50)]), 0)

    def boom(x):
        raise RuntimeError("lost")

    bad = _windows(spark, [("s1", t, 2.0)]).withColumn("v", F.udf(boom, "double")("v"))
    try:
        put(bad, 1)
    except Exception:
        pass
    assert sinks.read_store(spark, path, STORE_KEYS).count() == 50
    put(_windows(spark, [("s1", t, 2.0)]), 1)
    got = {r.sensor_id: r.v for r in sinks.read_store(spark, path, STORE_KEYS).collect()}
    assert len(got) == 50 and got["s1"] == 2.0


def test_one_hour_is_written_by_several_tasks(spark, tmp):
    path = os.path.join(tmp, "store")
    store_batch(path)(_windows(spark, [(f"s{k}", datetime(2026, 1, 1, 10, k % 60), 1.0) for k in range(500)]), 0)
    hour = os.path.join(path, "window_part=2026-01-01-10", "epoch=000000000000")
    assert len([f for f in os.listdir(hour) if f.endswith(".parquet")]) > 1


def test_expired_hours_go_and_compaction_keeps_the_latest_rows(spark, tmp):
    path, small = os.path.join(tmp, "store"), os.path.join(tmp, "small")
    ten, eleven = datetime(2026, 1, 1, 10, 5), datetime(2026, 1, 1, 11, 5)
    put = store_batch(path)
    put(_windows(spark, [("s1", ten, 1.0), ("s1", eleven, 3.0)]), 0)
    put(_windows(spark, [("s1", eleven, 4.0)]), 1)
    sinks.compact_store(spark, path, small, STORE_KEYS, STORE_PARTITION)
    assert sorted(r.v for r in spark.read.parquet(small).collect()) == [1.0, 4.0]
    gone = sinks.expire_partitions(spark, path, STORE_PARTITION, "2026-01-01-11")
    assert gone == ["2026-01-01-10"]
    assert [r.v for r in sinks.read_store(spark, path, STORE_KEYS).collect()] == [4.0]


def test_full_and_touched_partition_replacement(spark, tmp):
    path = os.path.join(tmp, "t")
    two = spark.createDataFrame([(1, date(2026, 1, 1)), (2, date(2026, 1, 2))], "id int, reading_date date")
    one = two.where("id = 2")
    sinks.write_partitioned(two, path)
    sinks.write_partitioned(one, path, replace="touched")
    assert spark.read.parquet(path).count() == 2
    sinks.write_partitioned(one, path)
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]


def test_a_bad_first_reading_does_not_blank_the_window(spark):
    rows = [
        ("s1", "flow", "Z01", 90.0, None, False, datetime(2026, 1, 1, 10, 0, 1)),
        ("s1", "flow", "Z02", 90.0, 50.0, False, datetime(2026, 1, 1, 10, 0, 2)),
        ("s2", "flow", "Z03", None, None, False, datetime(2026, 1, 1, 10, 0, 2)),
    ]
    out = {r.sensor_id: r for r in hot_aggregates(_readings(spark, rows)).collect()}
    assert out["s1"].is_anomaly is True and out["s1"].zone_id == "Z02" and out["s1"].invalid_count == 1
    assert out["s2"].is_anomaly is None and out["s2"].zone_id == "Z03"


def test_scratch_needs_a_shared_folder_off_one_machine():
    from aerolith import session

    assert session._one_machine("local[4]") and session._one_machine("local")
    assert not session._one_machine("local-cluster[3,2,1024]") and not session._one_machine("spark://host:7077")


def test_csv_reader_quarantines_bad_lines(spark, tmp):
    from pyspark.sql.types import FloatType, StringType, StructField, StructType

    from aerolith.sources import read_csv

    p = os.path.join(tmp, "in.csv")
    with open(p, "w") as f:
        f.write("station_id,station_name,pm25,reading_time\n02t,A,35.5,08:00\n03t,B,notanumber,09:00\n")
    schema = StructType([StructField("station_id", StringType()), StructField("station_name", StringType()),
                         StructField("pm25", FloatType()), StructField("reading_time", StringType())])
    good, bad = read_csv(spark, p, schema)
    assert [r.station_id for r in good.collect()] == ["02t"]
    assert bad.count() == 1


def test_append_mode_emits_closed_windows_only(spark, tmp):
    src = os.path.join(tmp, "src")
    store, chk = (os.path.join(tmp, d) for d in ("store", "chk"))
    rows = [
        ("s1", "flow", "Z01", 50.0, 50.0, False, datetime(2026, 1, 1, 10, 0, 5)),
        ("s1", "flow", "Z01", 60.0, 50.0, True, datetime(2026, 1, 1, 10, 0, 35)),
        ("s2", "flow", "Z02", 51.0, 50.0, False, datetime(2026, 1, 1, 10, 20, 0)),
    ]
    _readings(spark, rows).write.mode("append").parquet(src)
    stream = spark.readStream.schema(_readings(spark, rows).schema).parquet(src)
    q = start_hot_path(stream, store, chk, output_mode="append", trigger={"processingTime": "1 second"},
                       watermark="5 minutes", decimals=False)
    try:
        q.processAllAvailable()
        time.sleep(2.5)  # let the no-data batch run after the watermark advanced
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.sensor_id, r.window_start.minute): r.reading_count for r in sinks.read_store(spark, store, STORE_KEYS).collect()}
    assert got == {("s1", 0): 2}  # 10:00 closed (watermark 10:15); 10:20 still open


def test_invalid_readings_are_counted_not_dropped(spark):
    rows = [
        ("s1", "flow", "Z01", 50.0, 50.0, False, datetime(2026, 1, 1, 10, 0, 1)),
        ("s1", "flow", "Z01", None, 50.0, False, datetime(2026, 1, 1, 10, 0, 2)),
        ("s1", "flow", "Z01", 52.0, None, False, datetime(2026, 1, 1, 10, 0, 3)),
    ]
    r = hot_aggregates(_readings(spark, rows)).first()
    assert r.reading_count == 3 and r.invalid_count == 2 and r.avg_value == 51.0
    assert r.is_anomaly is False


def test_topic_routing_lands_each_topic_and_quarantines_bad_messages(spark, tmp):
    from pyspark.sql.types import StringType, StructField, StructType

    from aerolith.schemas import BRONZE_SENSOR, BRONZE_WEATHER
    from aerolith.sources import file_stream
    from aerolith.streaming.ingest import Route, start_routes

    msgs = [
        ("sensor-stream", "s1", json.dumps({"sensor_id": "s1", "value": 1.5, "target": 1.0, "reading_ts": "2026-01-01T00:00:00Z"})),
        ("sensor-stream", "s2", "{not json"),
        ("sensor-stream", "s3", json.dumps({"sensor_id": "s3", "value": "warm"})),
        ("sensor-stream", "s4", json.dumps({"sensor_id": " ", "value": 1.0})),
        ("sensor-stream", "s5", None),
        ("weather-raw", "1", json.dumps({"city_id": 1, "city_name": "BKK", "reading_ts": 1700000000, "temp_c": 30.5})),
        ("elsewhere", "1", "{}"),
        (None, "1", "{}"),
    ]
    schema = StructType([StructField(c, StringType()) for c in ("topic", "key", "value")])
    spark.createDataFrame(msgs, schema).repartition(3).write.parquet(os.path.join(tmp, "msgs"))
    stream = file_stream(spark, os.path.join(tmp, "msgs"), schema)
    routes = {
        "sensor-stream": Route(BRONZE_SENSOR, os.path.join(tmp, "bronze", "sensor"), "sensor_id"),
        "weather-raw": Route(BRONZE_WEATHER, os.path.join(tmp, "bronze", "weather"), "city_id"),
    }
    q = start_routes(stream, routes, os.path.join(tmp, "chk"), os.path.join(tmp, "quarantine"), trigger={"availableNow": True})
    q.awaitTermination()
    # The source is scanned, and so each message parsed, once although three tables are written from the batch.
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(msgs)
    sensor = spark.read.parquet(routes["sensor-stream"].path).collect()
    weather = spark.read.parquet(routes["weather-raw"].path)
    assert [(r.sensor_id, r.value, r.topic, r.key) for r in sensor] == [("s1", 1.5, "sensor-stream", "s1")]
    assert [(r.city_id, r.temp_c) for r in weather.collect()] == [(1, 30.5)]
    assert {"date", "hour", "topic", "key"} <= set(weather.columns)
    bad = spark.read.parquet(os.path.join(tmp, "quarantine"))
    assert {(r.topic, r.key, r.reason) for r in bad.collect()} == {
        ("sensor-stream", "s2", "malformed"), ("sensor-stream", "s3", "malformed"), ("sensor-stream", "s4", "missing id"),
        ("sensor-stream", "s5", "no value"), ("elsewhere", "1", "no route"), (None, "1", "no route"),
    }
    assert bad.where("key = 's2'").first().raw == "{not json"


def test_a_batch_cut_off_before_its_commit_lands_once(spark, tmp):
    """The batch's files are written, its commit is lost, the restarted query runs it again."""
    from aerolith.schemas import BRONZE_SENSOR
    from aerolith.sources import file_stream
    from aerolith.streaming.ingest import Resends, start_ingest

    src, out, chk = (os.path.join(tmp, d) for d in ("src", "out", "chk"))
    schema = "id string, sent_at timestamp, value string"
    t = datetime(2026, 1, 1)

    def send(ids):
        rows = [(i, t, json.dumps({"sensor_id": i, "value": 1.0})) for i in ids]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)

    def run(checkpoint=chk):
        stream = file_stream(spark, src, spark.createDataFrame([], schema).schema)
        start_ingest(stream, BRONZE_SENSOR, out, checkpoint, resends=Resends(["id"], "sent_at", "1 hour"), trigger={"availableNow": True}).awaitTermination()
        return sorted(r.sensor_id for r in spark.read.parquet(out).collect())

    send(["a", "b", "a"])
    assert run() == ["a", "b"]
    send(["b", "c"])
    assert run() == ["a", "b", "c"]
    last = max(int(f) for f in os.listdir(os.path.join(chk, "commits")) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(chk, "commits", f)):
            os.remove(os.path.join(chk, "commits", f))
    assert run() == ["a", "b", "c"]
    send(["d", "a"])
    assert run() == ["a", "b", "c", "d"]
    # A fresh checkpoint reads all again beside, not over, what the first one landed.
    assert run(os.path.join(tmp, "other")) == ["a", "a", "b", "b", "c", "c", "d", "d"]


def test_a_store_refuses_a_second_checkpoint_and_expires_old_hours(spark, tmp):
    src, store = os.path.join(tmp, "src"), os.path.join(tmp, "store")
    schema = _readings(spark, []).schema

    def run(checkpoint, hour):
        rows = [("s1", "flow", "Z01", 50.0, 50.0, False, datetime(2026, 1, hour // 24 + 1, hour % 24, 0, 5))]
        _readings(spark, rows).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        start_hot_path(stream, store, os.path.join(tmp, checkpoint), trigger={"availableNow": True}, watermark="90 days", expire_every=1).awaitTermination()
        return sorted(f for f in os.listdir(store) if f.startswith("window_part"))

    assert run("chk", 3) == ["window_part=2026-01-01-03"]
    assert run("chk", 20) == ["window_part=2026-01-01-03", "window_part=2026-01-01-20"]
    assert run("chk", 29) == ["window_part=2026-01-01-20", "window_part=2026-01-02-05"]  # 24 h and the hour itself
    try:
        run("other", 30)
        raised = False
    except Exception as e:
        raised = "store of its own" in str(e)
    assert raised


def test_a_routed_batch_is_kept_in_files_and_not_in_memory(spark, tmp, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.types import StringType, StructField, StructType

    from aerolith.schemas import BRONZE_SENSOR
    from aerolith.session import scratch_root
    from aerolith.streaming.ingest import Route, land_batch, landing_columns, parse_routes

    def never(*_):
        raise AssertionError("persisted")

    monkeypatch.setattr(DataFrame, "persist", never)
    monkeypatch.setattr("aerolith.streaming.ingest.checkpoint_id", lambda *_: "0" * 8)
    schema = StructType([StructField(c, StringType()) for c in ("topic", "key", "value")])
    msgs = [("sensor-stream", "s1", json.dumps({"sensor_id": "s1", "value": 1.5})), ("sensor-stream", "s2", "{not json"), ("elsewhere", "1", "{}")]
    routes = {"sensor-stream": Route(BRONZE_SENSOR, os.path.join(tmp, "sensor"), "sensor_id")}
    batch = landing_columns(parse_routes(spark.createDataFrame(msgs, schema), routes))
    land_batch(routes, os.path.join(tmp, "chk"), os.path.join(tmp, "quarantine"))(batch, 0)
    assert [(r.sensor_id, r.value) for r in spark.read.parquet(os.path.join(tmp, "sensor")).collect()] == [("s1", 1.5)]
    assert {(r.key, r.reason) for r in spark.read.parquet(os.path.join(tmp, "quarantine")).collect()} == {("s2", "malformed"), ("1", "no route")}
    root = scratch_root(spark).removeprefix("file:")
    assert not [f for f in os.listdir(root) if f.startswith("batch-")]


def test_a_lot_of_the_hot_store_is_read_by_all_cores(spark, monkeypatch):
    from aerolith.plans import registry

    small = "/root/testdata/sf0.001"
    wanted = {(r.sensor_id, r.window_start, r.reading_count) for r in sinks.read_store(spark, registry.hot_store(spark, small), STORE_KEYS).collect()}
    monkeypatch.setattr(registry, "LOT_FILE_BYTES", (1 << 10, 64 << 20))
    path = registry.hot_store(spark, small)
    files = [f for f in os.listdir(path.removesuffix("store") + "events") if f.endswith(".parquet")]
    assert len(files) == 4 * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(path).select(sinks.EPOCH).distinct().count() == 4
    assert {(r.sensor_id, r.window_start, r.reading_count) for r in sinks.read_store(spark, path, STORE_KEYS).collect()} == wanted
    monkeypatch.setattr(registry, "LOT_FILE_BYTES", (1 << 10, 1 << 10))
    assert registry.lot_files(spark, registry.S.table(spark, small, "events")) > spark.sparkContext.defaultParallelism


def test_a_kept_batch_holds_the_text_of_rejects_only(spark, tmp, monkeypatch):
    from pyspark.sql.types import StringType, StructField, StructType

    from aerolith.schemas import BRONZE_SENSOR
    from aerolith.streaming.ingest import Route, land_batch, landing_columns, parse_routes

    kept = []
    monkeypatch.setattr("aerolith.streaming.ingest.delete_path", lambda _, path: kept.append(path))
    monkeypatch.setattr("aerolith.streaming.ingest.checkpoint_id", lambda *_: "0" * 8)
    schema = StructType([StructField(c, StringType()) for c in ("topic", "key", "value")])
    msgs = [("sensor-stream", "s1", json.dumps({"sensor_id": "s1", "value": 1.5})), ("sensor-stream", "s2", "{not json"), ("elsewhere", "1", "{}")]
    routes = {"sensor-stream": Route(BRONZE_SENSOR, os.path.join(tmp, "sensor"), "sensor_id")}
    batch = landing_columns(parse_routes(spark.createDataFrame(msgs, schema), routes))
    land_batch(routes, "chk", os.path.join(tmp, "quarantine"))(batch, 0)
    assert {(r.key, r.raw) for r in spark.read.parquet(kept[0]).collect()} == {("s1", None), ("s2", "{not json"), ("1", "{}")}
    rejects = spark.read.parquet(os.path.join(tmp, "quarantine")).collect()
    assert {(r.raw, r.reason) for r in rejects} == {("{not json", "malformed"), ("{}", "no route")}
    assert [r.value for r in spark.read.parquet(os.path.join(tmp, "sensor")).collect()] == [1.5]
