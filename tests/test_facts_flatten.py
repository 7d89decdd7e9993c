import json
from datetime import date, datetime

from pyspark.sql import functions as F

from aerolith.operators import dims, facts, scd2
from aerolith.operators.flatten import flatten_air, flatten_weather


def _silver_weather(spark):
    return spark.createDataFrame(
        [(1, "BKK", 1000, "Rain", "light rain", 30.0, date(2026, 1, 1), 20260101,
          datetime(2026, 1, 1, 0, 0), 70, 2.0),
         (1, "BKK", 4600, "Rain", "heavy rain", 29.0, date(2026, 1, 1), 20260101,
          datetime(2026, 1, 1, 1, 0), 80, 3.0)],
        "city_id int, city_name string, reading_ts long, weather_main string, weather_desc string, "
        "temp_c double, reading_date date, date_key int, reading_ts_utc timestamp, humidity_pct int, "
        "wind_speed_ms double",
    ).withColumns({c: F.lit(None).cast(t) for c, t in [
        ("feels_like_c", "double"), ("pressure_hpa", "int"), ("wind_deg", "int"), ("visibility_m", "int")]})


def test_weather_fact_keeps_row_count(spark):
    sw = _silver_weather(spark)
    dwc = dims.dim_weather_condition(sw)
    assert dwc.count() == 2
    assert facts.fct_weather_hourly(sw, dwc).count() == 2  # join on (main, description): no fan-out
    dd = dims.dim_date(spark, date(2026, 1, 1), date(2026, 1, 31))
    assert facts.unmatched_dates(sw, dd).count() == 0


def test_daily_summary_edges(spark):
    rows = [
        ("s1", "A1", 50.0, "PM25", 20260101), ("s1", "A1", 51.0, "PM10", 20260101),
        ("s1", "A1", 10.0, "PM10", 20260101), ("s1", "A1", None, "PM25", 20260101),
        ("s2", "A1", None, "O3", 20260101), ("s2", "A1", None, "O3", 20260101),
        ("s3", "A2", 1.0, "CO", 20260101), ("s3", "A2", 2.0, "NO2", 20260101),
        ("s9", None, 5.0, "CO", 20260101),  # no station version / no region
    ]
    sa = spark.createDataFrame(rows, "station_id string, area_en string, pm25_value double, aqi_param string, date_key int")
    sa = sa.withColumn("reading_date", F.lit(date(2026, 1, 1)))
    snapshot = sa.select("station_id").distinct().filter("station_id != 's9'")
    ds = scd2.first_load(snapshot, "station_id", "station_key", date(2026, 1, 1))
    dr = dims.dim_region(sa)
    out = {r.station_key: r for r in facts.fct_pollution_daily_summary(sa, ds, dr).collect()}
    s1 = out[1]
    assert s1.hours_exceeding_threshold == 1  # exactly 50.0 is not counted
    assert s1.max_pm25 == 51.0 and s1.min_pm25 == 10.0
    assert s1.dominant_aqi_param == "PM10" or s1.dominant_aqi_param == "PM25"
    assert s1.dominant_aqi_param == "PM10"  # tie 2-2 -> smallest value
    s2 = out[2]
    assert s2.avg_pm25 is None and s2.hours_exceeding_threshold == 0 and s2.dominant_aqi_param == "O3"
    assert out[3].dominant_aqi_param == "CO"
    assert out[None].region_key is None  # unmatched station and null area stay visible


def test_fact_keys_stable_and_unique(spark):
    sa = spark.createDataFrame(
        [("s1", "A", 1.0, datetime(2026, 1, 1, h)) for h in range(24)],
        "station_id string, area_en string, pm25_value double, reading_ts_utc timestamp",
    ).withColumns({"date_key": F.lit(20260101), "reading_date": F.lit(date(2026, 1, 1))})
    for c in ("pm10_value", "o3_value", "co_value", "no2_value", "so2_value"):
        sa = sa.withColumn(c, F.lit(None).cast("double"))
    sa = sa.withColumns({"overall_aqi": F.lit(1), "aqi_param": F.lit("PM25")})
    ds = scd2.first_load(sa.select("station_id").distinct(), "station_id", "station_key", date(2026, 1, 1))
    dr = dims.dim_region(sa)
    a = facts.fct_air_quality_hourly(sa, ds, dr)
    b = facts.fct_air_quality_hourly(sa.repartition(5), ds, dr)
    ka = sorted(r.air_quality_key for r in a.collect())
    assert ka == sorted(r.air_quality_key for r in b.collect())
    assert len(set(ka)) == 24
    assert sorted(r.reading_hour for r in a.collect()) == list(range(24))


def test_anomaly_fact_and_rate(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None), (4, True)], "sensor_reading_key long, is_anomaly boolean")
    for c in facts.ANOMALY_EVENT_COLUMNS:
        df = df.withColumn(c, F.lit(None).cast("string"))
    assert facts.fct_sensor_anomaly_event(df).count() == 2
    r = facts.anomaly_rate(df).first()
    assert (r.total_readings, r.anomaly_events, r.anomaly_pct) == (4, 2, 50.0)
    e = facts.anomaly_rate(df.filter(F.lit(False))).first()
    assert e.anomaly_pct == 0.0


def _air_doc(**over):
    doc = {
        "stationID": "02t", "nameEN": "Station", "nameTH": "th", "areaEN": "Bangkok", "areaTH": "th",
        "stationType": "GROUND", "lat": "13.7", "long": "100.5",
        "AQILast": {"date": "2026-01-01", "time": "08:00", "PM25": {"value": "35.5", "aqi": "80"},
                    "PM10": {"value": "-1"}, "O3": {"value": "-999"}, "CO": {"value": "-"},
                    "NO2": {"value": "nan"}, "SO2": {"value": "12.0"}, "AQI": {"aqi": "12.0", "param": "PM25"}},
    }
    doc.update(over)
    return json.dumps(doc)


def test_flatten_air_edge_cases(spark):
    docs = [
        (_air_doc(),),
        (_air_doc(AQILast=None),),
        (json.dumps({"nameEN": "no id"}),),
        (_air_doc(stationID=""),),
        ("{not json",),
    ]
    raw = spark.createDataFrame(docs, "value string")
    good, bad = flatten_air(raw)
    g = good.orderBy(F.col("reading_date").asc_nulls_last()).collect()
    assert len(g) == 2
    r = g[0]
    assert r.pm25_value == 35.5 and r.pm25_aqi == 80 and r.lat == 13.7
    assert r.pm10_value is None and r.o3_value is None and r.co_value is None
    assert r.no2_value != r.no2_value  # NaN kept
    assert r.so2_value == 12.0 and r.overall_aqi is None  # "12.0" is not an int
    assert g[1].reading_date is None and g[1].pm25_value is None  # missing AQILast
    reasons = sorted(x.reason for x in bad.collect())
    assert reasons == ["malformed", "missing station id", "missing station id"]
    assert len(good.columns) == 20


def test_flatten_weather_array_rules(spark):
    base = {"id": 1, "name": "BKK", "dt": 1700000000, "visibility": 10000, "coord": {"lat": 13.7, "lon": 100.5},
            "sys": {"country": "TH"}, "main": {"temp": 30.1, "feels_like": 35.0, "pressure": 1009, "humidity": 70},
            "wind": {"speed": 2.5, "deg": 180}}
    docs = [
        json.dumps({**base, "weather": [{"main": "Rain", "description": "light rain", "icon": "10d"},
                                         {"main": "Mist", "description": "mist", "icon": "50d"}]}),
        json.dumps({**base, "weather": []}),
        json.dumps(base),
    ]
    good, bad = flatten_weather(spark.createDataFrame([(d,) for d in docs], "value string"))
    rows = good.collect()
    assert len(rows) == 2 and rows[0].weather_main == "Rain" and rows[0].humidity_pct == 70
    assert rows[1].weather_main is None
    assert [b.reason for b in bad.collect()] == ["empty weather"]


def test_unknown_member_and_unmatched_observation(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "station_key int, region_key int")
    out, obs = facts.observe_unmatched(df, ["station_key", "region_key"])
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "station_key_unmatched": 1, "region_key_unmatched": 1}
    filled = facts.unknown_member(df, ["station_key", "region_key"]).collect()
    assert sorted((r.station_key, r.region_key) for r in filled) == [(-1, 2), (1, -1), (3, 4)]


def test_a_document_is_parsed_once_whatever_is_tested_on_it(spark):
    texts = ['{"stationID":"a","lat":"-1","AQILast":{"PM25":{"value":"3.5","aqi":"4.0"}}}', '{"stationID":" "}', "{cut", None]
    good, bad = flatten_air(spark.createDataFrame([(t, "now") for t in texts], "value string, ingested_at string"), "value", "ingested_at")
    assert [(r.station_id, r.lat, r.pm25_value, r.pm25_aqi) for r in good.collect()] == [("a", None, 3.5, None)]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "malformed", "missing station id"]
    for df in (good, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
