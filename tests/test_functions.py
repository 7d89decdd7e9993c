from datetime import date, datetime

from pyspark.sql import functions as F

from aerolith.functions import clean as C
from aerolith.functions import time as T
from aerolith.functions.constants import SENSOR_SIGMA


def one(df):
    return df.collect()


def test_sentinels_and_safe_parsing(spark):
    df = spark.createDataFrame(
        [("1.5",), ("-1",), ("-999",), ("-",), ("12.0",), ("nan",), (None,), (" 7 ",)], "s string"
    )
    rows = df.select(C.parse_double("s").alias("d"), C.parse_int("s").alias("i")).collect()
    d = [r.d for r in rows]
    i = [r.i for r in rows]
    assert d[0] == 1.5 and d[1] is None and d[2] is None and d[3] is None
    assert d[4] == 12.0 and d[5] != d[5] and d[6] is None
    assert i[4] is None  # "12.0" is not an int
    assert i[7] == 7 and i[1] is None


def test_null_sentinels_only_existing_columns(spark):
    df = spark.createDataFrame([(-1.0, 5.0, -3.0)], "pm25_value double, o3_value double, other double")
    out = C.null_sentinels(df, ["pm25_value", "o3_value", "absent"]).first()
    assert out.pm25_value is None and out.o3_value == 5.0 and out.other == -3.0


def test_local_strings_to_utc_day_boundaries(spark):
    df = spark.createDataFrame(
        [("2026-03-01", "00:30"), ("2026-03-01", "06:59"), ("2026-03-01", "07:00"), ("2026-03-01", "xx")],
        "d string, t string",
    )
    u = df.select(T.local_strings_to_utc("d", "t").alias("u")).select("u", T.date_key("u").alias("k")).collect()
    assert u[0].u == datetime(2026, 2, 28, 17, 30) and u[0].k == 20260228
    assert u[1].k == 20260228
    assert u[2].u == datetime(2026, 3, 1, 0, 0) and u[2].k == 20260301
    assert u[3].u is None


def test_iso_and_epoch(spark):
    df = spark.createDataFrame(
        [("2026-01-01T10:00:00Z", 0), ("2026-01-01T10:00:00+00:00", 1), ("2026-01-01T17:00:00+07:00", 2), ("bad", 3)],
        "s string, e long",
    )
    rows = df.select(T.iso_to_ts("s").alias("t"), T.epoch_seconds_to_ts("e").alias("z")).collect()
    assert rows[0].t == rows[1].t == rows[2].t == datetime(2026, 1, 1, 10, 0)
    assert rows[3].t is None
    assert rows[0].z == datetime(1970, 1, 1, 0, 0)


def test_calendar_iso_weekday(spark):
    df = spark.createDataFrame([(date(2026, 1, 4),), (date(2026, 1, 5),)], "d date")  # Sun, Mon
    rows = df.select(*[c.alias(n) for n, c in T.calendar_columns("d").items()]).collect()
    assert rows[0].day_of_week == 7 and rows[0].is_weekend and rows[0].day_name == "Sunday"
    assert rows[1].day_of_week == 1 and not rows[1].is_weekend and rows[1].month_name == "January"
    assert rows[1].date_key == 20260105 and rows[1].quarter == 1


def test_sigma_default_and_strict_threshold(spark):
    df = spark.createDataFrame(
        [("temperature", 26.5, 22.0), ("temperature", 26.51, 22.0), ("mystery", 4.0, 0.0), (None, 2.0, 0.0)],
        "t string, v double, tgt double",
    )
    sig = C.sigma_lookup("t", SENSOR_SIGMA)
    rows = df.select(sig.alias("s"), C.beyond_sigma("v", "tgt", sig).alias("a")).collect()
    assert rows[0].s == 1.5 and rows[0].a is False  # exactly 3 sigma: not flagged
    assert rows[1].a is True
    assert rows[2].s == 1.0 and rows[2].a is True
    assert rows[3].s == 1.0


def test_deviation_decimal_unknown(spark):
    df = spark.createDataFrame([(22.123456, 22.0, None)], "v double, t double, z string")
    r = df.select(
        C.deviation("v", "t").alias("d"), C.decimal4("v").alias("x"), C.or_unknown("z").alias("u")
    ).first()
    assert r.d == 0.1235 and str(r.x) == "22.1235" and r.u == "unknown"


def test_any_changed_null_safe(spark):
    df = spark.createDataFrame([(1, 1), (None, None), (None, 2), (3, None)], "a int, b int")
    rows = df.select(C.any_changed([("a", "b")]).alias("c")).collect()
    assert [r.c for r in rows] == [False, False, True, True]


def test_json_field_and_payload(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from aerolith.functions.json import is_malformed, json_field, parse_payload

    df = spark.createDataFrame([('{"k": 5}',), ("{bad",), ('{"k": "x"}',)], "p string")
    out = parse_payload(df, "p", StructType([StructField("k", IntegerType())]))
    rows = out.select(json_field("p", "$.k", "int").alias("k"), is_malformed("payload").alias("m")).collect()
    assert rows[0].k == 5 and rows[0].m is False
    assert rows[1].m is True and rows[1].k is None
    assert rows[2].k is None


def test_subscription_options():
    import pytest

    from aerolith.sources import kafka_options

    archive = kafka_options("a:9092,b:9092", ["air", "weather"], max_offsets_per_trigger=500, failOnDataLoss="false")
    assert archive == {"kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "air,weather", "startingOffsets": "earliest",
                       "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false"}
    assert kafka_options("a:9092", ["sensors"], starting="latest") == {
        "kafka.bootstrap.servers": "a:9092", "subscribe": "sensors", "startingOffsets": "latest"}
    with pytest.raises(ValueError):
        kafka_options("a:9092", ["sensors"], starting="newest")


def test_drifting_documents(spark):
    from aerolith.operators import drift

    docs = [
        '{"stationID":"a","lat":"1.5","long":-3,"firmware":{"v":1},"AQILast":{"date":"d","PM25":{"value":7,"color":"red"},"PM10":{"value":{"x":1}},'
        '"O3":{"value":"n/a"},"AQI":{"aqi":"12.0","param":null}}}',
        '{"stationID":" "}', "[1]", "{x", None, "7", '{"stationID":5,"AQILast":3}',
    ]
    df = spark.createDataFrame([(d, k) for k, d in enumerate(docs)], "value string, n int")
    out = drift.flatten_variant(df, drift.AIR_FIELDS, id_column="station_id").orderBy("n").collect()
    assert [r.rejected for r in out] == [False, True, True, True, True, True, False]
    assert [r.reasons for r in out[1:]] == [["missing id"], ["malformed"], ["malformed"], ["malformed"], ["malformed"], ["wrong type: AQILast"]]
    one = out[0]
    assert (one.station_id, one.lat, one.lon, one.pm25_value, one.pm10_value, one.aqi_param) == ("a", 1.5, None, 7.0, None, None)
    assert one.extras == {"firmware": '{"v":1}', "AQILast.PM25.color": '"red"'}
    assert one.reasons == ["wrong type: pm10_value", "wrong type: o3_value", "wrong type: overall_aqi"]


def test_drifting_documents_are_walked_once_for_all_fields(spark):
    from aerolith.operators import drift

    df = spark.createDataFrame([("{}",)], "value string")
    plan = drift.flatten_variant(df, drift.AIR_FIELDS, id_column="station_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") <= 2 + 3 * len(drift._levels(drift.AIR_FIELDS))


def test_drifting_documents_with_fields_in_one_place(spark):
    from aerolith.operators import drift

    fields = {
        "n": ("a.x", "double"), "t": ("a.x", "string"), "whole": ("a", "string"), "upper": ("a.X", "int"), "other": ("A.y", "int"), "list": ("l", "string"),
        "id": ("id", "string"),
    }
    docs = ['{"id":"i","a":{"x":"5","X":6},"A":{"y":-7,"z":[1]},"l":[1,2]}', '{"id":{"q":1},"a":3,"A":[],"l":"w"}', '{"a":null,"A":{},"l":null}', "{}", "null"]
    df = spark.createDataFrame([(d, k) for k, d in enumerate(docs)], "value string, k int")
    out = drift.flatten_variant(df, fields, id_column="id").orderBy("k").collect()
    assert [tuple(r[c] for c in fields) for r in out] == [(5.0, "5", None, 6, None, None, "i"), (None, None, "3", None, None, "w", None)] + [(None,) * 7] * 3
    assert [r.extras for r in out] == [{"A.z": "[1]"}, {}, {}, {}, {}]
    assert [r.reasons for r in out] == [
        ["wrong type: whole", "wrong type: list"], ["wrong type: id", "wrong type: a", "wrong type: A", "missing id"], ["missing id"], ["missing id"], ["malformed"],
    ]


def test_wide_keys(spark):
    from aerolith.operators.keys import wide_key

    df = spark.range(1000).select("id", wide_key(["id"]).alias("k"), wide_key(["id"]).alias("again"))
    assert df.select("k").distinct().count() == 1000 and df.where("k <> again OR length(k) <> 32").count() == 0
    assert df.where("substring(k, 1, 16) = substring(k, 17, 16)").count() == 0
