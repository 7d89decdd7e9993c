"""Registered queries over the benchmark tables and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator (or a chain of
them) over whole tables; ``ORACLE[name]`` is the DuckDB SQL computing the same
result from the same parquet files. Output timestamps are cast to
``TIMESTAMP_NTZ`` (UTC wall clock) so both sides carry zone-less values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from aerolith.operators import dims, facts, scd2, silver
from aerolith.plans import standins as S
from aerolith.plans.oracle import with_ctes
from aerolith.session import configure, scratch_path
from aerolith.sinks import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return ntz(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def ntz(df: DataFrame) -> DataFrame:
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    return df.withColumns(casts) if casts else df


# --- shared stand-in chain ------------------------------------------------------


def silver_air_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_air(S.bronze_air(spark, sf_dir))


def air_star(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ("*",)):
    # Silver is written once and read by the dimension and fact stages, as in
    # the cold pipeline (no stage chain recomputed per consumer).
    return star_of(materialize(silver_air_of(spark, sf_dir).select(*columns), "silver-air"))


def star_of(sa: DataFrame):
    station_snap = scd2.snapshot(
        sa, "station_id",
        ["station_name_en", "station_name_th", "area_en", "station_type", "lat", "lon"],
        "reading_ts_utc",
    )
    dim_station = scd2.first_load(station_snap, "station_id", "station_key", S.AS_OF_LOAD)
    dim_region = dims.dim_region(sa)
    return sa, dim_station, dim_region


# --- queries ---------------------------------------------------------------------


@register("silver_air", with_ctes(("silver_air",), "SELECT * FROM silver_air"))
def q_silver_air(spark, sf_dir):
    """Sentinels, latest-per-slot dedup, local->UTC, date key."""
    return silver_air_of(spark, sf_dir)


@register("dim_station", with_ctes(("dim_station",), "SELECT * FROM dim_station"))
def q_dim_station(spark, sf_dir):
    """C11 first load over the latest station attributes (H3 order)."""
    return air_star(spark, sf_dir)[1]


@register("dim_region", with_ctes(("dim_region",), "SELECT * FROM dim_region"))
def q_dim_region(spark, sf_dir):
    """C7 + G1: distinct non-null areas with dense keys."""
    return air_star(spark, sf_dir)[2]


@register("fct_hourly", with_ctes(("fct_air",), "SELECT * FROM fct_air"))
def q_fct_hourly(spark, sf_dir):
    """Star join of Silver air to station (current) and region keys."""
    sa, ds, dr = air_star(spark, sf_dir)
    return facts.fct_air_quality_hourly(sa, ds, dr).drop("air_quality_key")


@register(
    "top10",
    with_ctes(("fct_air", "dim_station"), """
SELECT * FROM (
  SELECT names.station_name_en, names.area_en, avg(pm25_value) AS avg_pm25, max(pm25_value) AS max_pm25,
         count(pm25_value) AS hourly_readings
  FROM (FROM dim_station SELECT station_key, station_name_en, area_en WHERE is_current) names
  INNER JOIN fct_air USING (station_key)
  GROUP BY ALL HAVING count(pm25_value) > 0)
QUALIFY row_number() OVER (ORDER BY avg_pm25 DESC, station_name_en, area_en) <= 10"""),
)
def q_top10(spark, sf_dir):
    """Q1: top-10 stations by average PM2.5."""
    from aerolith.plans import marts

    sa, ds, dr = air_star(spark, sf_dir)
    fct = facts.fct_air_quality_hourly(sa, ds, dr)
    return marts.top_polluted_stations(fct, ds)


def silver_sensor_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_sensor(S.bronze_sensor(spark, sf_dir))


def silver_weather_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_weather(S.bronze_weather(spark, sf_dir))


def sensor_star(spark: SparkSession, sf_dir: str):
    ss = materialize(silver_sensor_of(spark, sf_dir), "silver-sensor")
    snap = scd2.snapshot(ss, "sensor_id", ["sensor_type", "zone_id", "target", "unit"], "reading_ts_utc")
    dim_sensor = scd2.first_load(snap, "sensor_id", "sensor_key", S.AS_OF_LOAD)
    return ss, dim_sensor, dims.dim_zone(ss), dims.dim_sensor_type(ss)


def fct_sensor_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ss, ds, dz, dt = sensor_star(spark, sf_dir)
    return facts.fct_sensor_reading(ss, ds, dz, dt)


def customer_dims(spark: SparkSession, sf_dir: str):
    snap1 = S.customer_snapshot(spark, sf_dir, S.SCD2_FIRST_SNAPSHOT, known_only=True)
    v1 = scd2.first_load(snap1, "c_custkey", "customer_key", S.SCD2_FIRST_SNAPSHOT)
    last = S.last_snapshot(spark, sf_dir)
    snap2 = S.customer_snapshot(spark, sf_dir, last)
    v2 = scd2.merge(
        v1, snap2, "c_custkey", ["c_mktsegment", "c_nationkey", "last_priority"], "customer_key",
        last, type1=["c_name", "last_status"], one_row_per_key=True,
    )
    return v1, v2


@register("silver_sensor", with_ctes(("silver_sensor",), "SELECT * FROM silver_sensor"))
def q_silver_sensor(spark, sf_dir):
    """ISO time parse, date key, deviation, latest-per-(sensor, time)."""
    return silver_sensor_of(spark, sf_dir)


@register("silver_weather", with_ctes(("silver_weather",), "SELECT * FROM silver_weather"))
def q_silver_weather(spark, sf_dir):
    """C4: epoch seconds -> UTC, date key, latest-per-(city, time)."""
    return silver_weather_of(spark, sf_dir)


@register("dim_sensor", with_ctes(("dim_sensor",), "SELECT * FROM dim_sensor"))
def q_dim_sensor(spark, sf_dir):
    """C12 first load: latest sensor attributes, dense keys."""
    return sensor_star(spark, sf_dir)[1]


@register("dim_zone", with_ctes(("dim_zone",), "SELECT * FROM dim_zone"))
def q_dim_zone(spark, sf_dir):
    """Distinct zones with dense keys."""
    return sensor_star(spark, sf_dir)[2]


@register("dim_sensor_type", with_ctes(("dim_sensor_type",), "SELECT * FROM dim_sensor_type"))
def q_dim_sensor_type(spark, sf_dir):
    """Distinct (type, unit) with dense keys and the typical range."""
    return sensor_star(spark, sf_dir)[3]


@register("dim_weather_condition", with_ctes(("dim_weather_condition",), "SELECT * FROM dim_weather_condition"))
def q_dim_weather_condition(spark, sf_dir):
    """Distinct (main, description), main non-null, dense keys."""
    return dims.dim_weather_condition(silver_weather_of(spark, sf_dir))


@register("fct_sensor", with_ctes(("fct_sensor",), "SELECT * FROM fct_sensor"))
def q_fct_sensor(spark, sf_dir):
    """Readings with sensor, zone and sensor-type keys."""
    return fct_sensor_of(spark, sf_dir).drop("sensor_reading_key")


@register("fct_anomaly", with_ctes(("fct_sensor",), """
SELECT date_key, sensor_key, zone_key, value, target, deviation, reading_ts_utc, reading_date
FROM fct_sensor WHERE is_anomaly = true"""))
def q_fct_anomaly(spark, sf_dir):
    """C17: anomalous readings, keys inherited from the reading fact."""
    return facts.fct_sensor_anomaly_event(fct_sensor_of(spark, sf_dir)).drop("anomaly_event_key")


@register("anomaly_rate", with_ctes(("fct_sensor",), """
SELECT count(*) AS total_readings, count(*) FILTER (WHERE is_anomaly = true) AS anomaly_events,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE is_anomaly = true) * 100.0 / count(*)
            ELSE 0.0 END AS anomaly_pct
FROM fct_sensor"""))
def q_anomaly_rate(spark, sf_dir):
    """Total, anomalies and percentage in one aggregate."""
    return facts.anomaly_rate(fct_sensor_of(spark, sf_dir))


@register("fct_weather", with_ctes(("fct_weather",), "SELECT * FROM fct_weather"))
def q_fct_weather(spark, sf_dir):
    """Readings with the condition key on (main, description) — row count preserved."""
    sw = materialize(silver_weather_of(spark, sf_dir), "silver-weather")
    dwc = dims.dim_weather_condition(sw)
    ddate = dims.dim_date_covering(sw, "reading_date")
    return facts.fct_weather_hourly(sw, dwc, ddate).drop("weather_hourly_key")


@register("by_city_day", with_ctes(("fct_weather", "dim_weather_condition"), """
SELECT *, CAST(row_number() OVER (PARTITION BY city_name ORDER BY reading_date, weather_main, weather_description)
               AS INTEGER) AS city_row
FROM (SELECT city_name, reading_date, weather_main, weather_description, avg(temp_c) AS avg_temp_c,
             avg(humidity_pct) AS avg_humidity_pct, avg(wind_speed_ms) AS avg_wind_ms, count(1) AS hourly_readings
      FROM dim_weather_condition INNER JOIN fct_weather USING (weather_condition_key) GROUP BY ALL)"""))
def q_by_city_day(spark, sf_dir):
    """Q2: weather by city, day and condition."""
    from aerolith.plans import marts

    sw = materialize(silver_weather_of(spark, sf_dir), "silver-weather")
    dwc = dims.dim_weather_condition(sw)
    return marts.weather_by_city_day(facts.fct_weather_hourly(sw, dwc), dwc)


@register("hot_windows", with_ctes(("hot_windows",), "SELECT * FROM hot_windows"))
def q_hot_windows(spark, sf_dir):
    """T-1/T-5/A8 batch form: 1-minute windows per sensor with the mean rule."""
    from aerolith.operators.windows import window_aggregates

    return window_aggregates(silver_sensor_of(spark, sf_dir), sigma=S.EVENT_SIGMA)


@register("scd2_first_load", with_ctes(("dim_customer_v1",), "SELECT * FROM dim_customer_v1"))
def q_scd2_first_load(spark, sf_dir):
    """C11 first load of the customer snapshot."""
    return customer_dims(spark, sf_dir)[0]


@register("scd2_merge", with_ctes(("dim_customer_v2",), "SELECT * FROM dim_customer_v2"))
def q_scd2_merge(spark, sf_dir):
    """C11 merge of the second snapshot: new, changed (close + insert), type-1 refresh."""
    return customer_dims(spark, sf_dir)[1]


@register("history_listing", with_ctes(("dim_customer_v2",), """
SELECT c_custkey, c_name, c_mktsegment, effective_date, expiry_date, is_current
FROM dim_customer_v2 WHERE is_current = false ORDER BY c_custkey, effective_date"""))
def q_history_listing(spark, sf_dir):
    """Q3: superseded versions."""
    from aerolith.plans import marts

    return marts.scd2_history(customer_dims(spark, sf_dir)[1], "c_custkey", ["c_name", "c_mktsegment"])


@register("asof_lookup", with_ctes(("dim_customer_v2",), """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, d.customer_key, d.last_priority
FROM orders o LEFT JOIN (
  SELECT *, CASE WHEN effective_date = min(effective_date) OVER (PARTITION BY c_custkey)
                 THEN NULL ELSE effective_date END AS valid_from
  FROM dim_customer_v2) d
ON o.o_custkey = d.c_custkey
   AND (d.valid_from IS NULL OR CAST(o.o_orderdate AS DATE) >= d.valid_from)
   AND CAST(o.o_orderdate AS DATE) < d.expiry_date"""))
def q_asof_lookup(spark, sf_dir):
    """Each order gets the customer version valid on its order date."""
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    dim = customer_dims(spark, sf_dir)[1]
    return scd2.asof_lookup(orders, dim, "o_custkey", "c_custkey", "o_orderdate", ["customer_key", "last_priority"])


# --- scalar functions over whole tables -------------------------------------------

from aerolith.functions import clean as C  # noqa: E402
from aerolith.functions import json as J  # noqa: E402
from aerolith.functions import time as T  # noqa: E402
from aerolith.operators.dedup import latest_per_key  # noqa: E402
from aerolith.plans.oracle import calendar_sql  # noqa: E402
from aerolith.plans.oracle import sigma_case  # noqa: E402
from aerolith.plans.oracle import int_text  # noqa: E402

_LI = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@register("dedup_latest", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  {", ".join(c + " DESC NULLS LAST" for c in ("l_shipdate",) + tuple(c for c in _LI if c not in ("l_orderkey", "l_linenumber", "l_shipdate")))}) = 1""")
def q_dedup_latest(spark, sf_dir):
    """Latest row per (order, line) by ship date with a total tie-break."""
    return latest_per_key(S.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("sentinel_null", f"""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal_clean,
       CASE WHEN TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) < 0 THEN NULL
            ELSE TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) END AS acctbal_parsed,
       CASE WHEN {int_text('CAST(c_acctbal AS VARCHAR)')} < 0 THEN NULL
            ELSE {int_text('CAST(c_acctbal AS VARCHAR)')} END AS acctbal_int,
       {int_text('CAST(c_nationkey AS VARCHAR)')} AS nation_parsed,
       {int_text('c_mktsegment')} AS segment_int
FROM customer""")
def q_sentinel_null(spark, sf_dir):
    """Negative sentinels to NULL; safe text->double/int parsing."""
    c = S.table(spark, sf_dir, "customer")
    txt = F.col("c_acctbal").cast("string")
    return c.select(
        "c_custkey",
        C.sentinel_to_null("c_acctbal").alias("acctbal_clean"),
        C.parse_double(txt).alias("acctbal_parsed"),
        C.parse_int(txt).alias("acctbal_int"),
        C.parse_int(F.col("c_nationkey").cast("string")).alias("nation_parsed"),
        C.parse_int("c_mktsegment").alias("segment_int"),
    )


@register("utc_normalize", """
SELECT event_id, u AS reading_ts_utc,
       CAST(year(u) * 10000 + month(u) * 100 + day(u) AS INTEGER) AS date_key,
       CAST(hour(u) AS INTEGER) AS reading_hour, CAST(hour(u + INTERVAL 7 HOUR) AS INTEGER) AS local_hour,
       CAST(u AS DATE) AS reading_date
FROM (SELECT event_id, date_trunc('minute', ts) - INTERVAL 7 HOUR AS u FROM events)""")
def q_utc_normalize(spark, sf_dir):
    """Local date + HH:mm strings (Bangkok) -> UTC, keys, hours."""
    ev = S.table(spark, sf_dir, "events")
    u = T.local_strings_to_utc(F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm"))
    df = ev.select("event_id", u.alias("reading_ts_utc"))
    return df.select(
        "event_id",
        "reading_ts_utc",
        T.date_key("reading_ts_utc").alias("date_key"),
        F.hour("reading_ts_utc").alias("reading_hour"),
        F.hour(T.utc_to_local("reading_ts_utc")).alias("local_hour"),
        F.to_date("reading_ts_utc").alias("reading_date"),
    )


@register("time_parsing", """
SELECT event_id, date_trunc('second', ts) AS from_epoch, date_trunc('second', ts) AS from_iso_offset,
       date_trunc('millisecond', ts) AS from_iso_z, CAST(NULL AS TIMESTAMP) AS from_bad_text,
       CAST(ts AS DATE) AS reading_date
FROM events""")
def q_time_parsing(spark, sf_dir):
    """Epoch seconds, ISO text with offset or Z, bad text -> NULL."""
    ev = S.table(spark, sf_dir, "events")
    local = F.col("ts") + F.expr("INTERVAL 7 HOURS")
    return ev.select(
        "event_id",
        T.epoch_seconds_to_ts(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("from_epoch"),
        T.iso_to_ts(F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))).alias("from_iso_offset"),
        T.iso_to_ts(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))).alias("from_iso_z"),
        T.iso_to_ts(F.concat(F.col("event_type"), F.lit("T99"))).alias("from_bad_text"),
        F.to_date(T.epoch_seconds_to_ts(F.unix_seconds(F.col("ts").cast("timestamp")))).alias("reading_date"),
    )


@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_struct, false AS malformed
FROM events""")
def q_json_extract(spark, sf_dir):
    """JSON path and schema parsing of the props payload."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    ev = S.table(spark, sf_dir, "events")
    parsed = J.parse_payload(ev, "props", StructType([StructField("k", IntegerType())]))
    return parsed.select(
        "event_id",
        J.json_field("props", "$.k", "int").alias("k"),
        F.col("payload.k").alias("k_struct"),
        J.is_malformed("payload").alias("malformed"),
    )


@register("deviation", f"""
SELECT event_id, coalesce(event_type, 'unknown') AS sensor_type,
       round(value - {S.EVENT_TARGET}, 4) AS deviation,
       {sigma_case('event_type')} AS sigma,
       abs(value - {S.EVENT_TARGET}) > 3.0 * {sigma_case('event_type')} AS is_anomaly,
       CAST(round(value, 4) AS DECIMAL(18, 4)) AS value_dec
FROM events""")
def q_deviation(spark, sf_dir):
    """Deviation, sigma lookup with default, 3-sigma test, decimal."""
    ev = S.table(spark, sf_dir, "events")
    sigma = C.sigma_lookup("event_type", S.EVENT_SIGMA)
    return ev.select(
        "event_id",
        C.or_unknown("event_type").alias("sensor_type"),
        C.deviation("value", F.lit(S.EVENT_TARGET)).alias("deviation"),
        sigma.alias("sigma"),
        C.beyond_sigma("value", F.lit(S.EVENT_TARGET), sigma).alias("is_anomaly"),
        C.decimal4("value").alias("value_dec"),
    )


@register("dim_date", calendar_sql("SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem"))
def q_dim_date(spark, sf_dir):
    """Calendar dimension covering the ship dates (ISO weekday, holidays)."""
    return dims.dim_date_covering(S.table(spark, sf_dir, "lineitem"), "l_shipdate")


# --- facts and marts --------------------------------------------------------------

STANDIN_PM25_THRESHOLD = 25.0


@register("fct_daily_summary", with_ctes(("air_keyed",), f"""
SELECT d.*, m.aqi_param AS dominant_aqi_param FROM (
  SELECT date_key, station_key, region_key, reading_date, avg(pm25_value) AS avg_pm25,
         max(pm25_value) AS max_pm25, min(pm25_value) AS min_pm25,
         count(*) FILTER (WHERE pm25_value > {STANDIN_PM25_THRESHOLD}) AS hours_exceeding_threshold
  FROM air_keyed GROUP BY date_key, station_key, region_key, reading_date) d
LEFT JOIN (
  SELECT date_key, station_key, region_key, reading_date, aqi_param FROM (
    SELECT date_key, station_key, region_key, reading_date, aqi_param,
           row_number() OVER (PARTITION BY date_key, station_key, region_key, reading_date
                              ORDER BY count(*) DESC, aqi_param ASC) AS rn
    FROM air_keyed WHERE aqi_param IS NOT NULL
    GROUP BY date_key, station_key, region_key, reading_date, aqi_param) WHERE rn = 1) m
ON d.date_key = m.date_key AND d.station_key IS NOT DISTINCT FROM m.station_key
   AND d.region_key IS NOT DISTINCT FROM m.region_key AND d.reading_date = m.reading_date"""))
def q_fct_daily_summary(spark, sf_dir):
    """C14/A1-A3: per station-day avg/max/min, hours above threshold, dominant parameter."""
    sa, ds, dr = air_star(spark, sf_dir)
    return facts.fct_pollution_daily_summary(sa, ds, dr, threshold=STANDIN_PM25_THRESHOLD).drop("daily_summary_key")


def _marts():
    from aerolith.plans import marts

    return marts


def air_measures(spark, sf_dir):
    """The hourly fact's measures and times alone: questions without a
    dimension build none (each reading has one row in the fact, matched or not)."""
    sa = silver_air_of(spark, sf_dir)
    return sa.select("area_en", "date_key", F.hour("reading_ts_utc").alias("reading_hour"), "pm25_value", "aqi_param")


def fct_air_of(spark, sf_dir):
    sa, ds, dr = air_star(spark, sf_dir)
    return sa, ds, dr, facts.fct_air_quality_hourly(sa, ds, dr)


@register("b1_region_month", with_ctes(("fct_air", "dim_region", "dim_date_air"), """
SELECT r.region_name, d.year, d.month, avg(f.pm25_value) AS avg_pm25, count(f.pm25_value) AS readings
FROM fct_air f JOIN dim_region r ON f.region_key = r.region_key JOIN dim_date_air d ON f.date_key = d.date_key
GROUP BY r.region_name, d.year, d.month"""))
def q_b1(spark, sf_dir):
    """B1: average PM2.5 by region by month (star join incl. dim_date)."""
    sa, ds, dr, fct = fct_air_of(spark, sf_dir)
    return _marts().b1_pm25_by_region_month(fct, dr, dims.dim_date_covering(sa, "reading_date"))


@register("b2_exceedance_top", with_ctes(("fct_air", "dim_station"), f"""
SELECT s.station_id, s.station_name_en,
       count(*) FILTER (WHERE f.pm25_value > {STANDIN_PM25_THRESHOLD}) AS hours_exceeding,
       count(f.pm25_value) AS readings
FROM fct_air f JOIN (SELECT * FROM dim_station WHERE is_current) s ON f.station_key = s.station_key
GROUP BY s.station_id, s.station_name_en ORDER BY hours_exceeding DESC, s.station_id LIMIT 10"""))
def q_b2(spark, sf_dir):
    """B2: stations most often above the threshold (top 10)."""
    sa, ds, dr, fct = fct_air_of(spark, sf_dir)
    return _marts().b2_threshold_exceedance(fct, ds, STANDIN_PM25_THRESHOLD)


@register("b3_air_weather_corr", with_ctes(("fct_air", "dim_region", "fct_weather"), """
SELECT CASE WHEN isnan(corr(a.pm25, b.humidity)) THEN NULL ELSE corr(a.pm25, b.humidity) END AS corr_pm25_humidity,
       CASE WHEN isnan(corr(a.pm25, b.wind)) THEN NULL ELSE corr(a.pm25, b.wind) END AS corr_pm25_wind,
       count(*) AS matched_periods
FROM (SELECT r.region_name AS city, f.date_key, avg(f.pm25_value) AS pm25
      FROM fct_air f JOIN dim_region r ON f.region_key = r.region_key GROUP BY r.region_name, f.date_key) a
JOIN (SELECT city_name AS city, date_key, avg(humidity_pct) AS humidity, avg(wind_speed_ms) AS wind
      FROM fct_weather GROUP BY city_name, date_key) b
ON a.city = b.city AND a.date_key = b.date_key"""))
def q_b3(spark, sf_dir):
    """PM2.5 vs humidity / wind correlation, pre-aggregated to (city, day)."""
    air = air_measures(spark, sf_dir).where("area_en IS NOT NULL").withColumnRenamed("area_en", "region_name")
    return _marts().b3_air_weather_correlation(air, None, silver_weather_of(spark, sf_dir), grain="day")


@register("b4_local_hour", with_ctes(("fct_air",), """
SELECT CAST((reading_hour + 7) % 24 AS INTEGER) AS local_hour, avg(pm25_value) AS avg_pm25,
       count(pm25_value) AS readings
FROM fct_air GROUP BY CAST((reading_hour + 7) % 24 AS INTEGER)"""))
def q_b4(spark, sf_dir):
    """PM2.5 by local hour of day."""
    return _marts().b4_worst_local_hour(air_measures(spark, sf_dir))


@register("b5_aqi_driver", with_ctes(("fct_air",), """
SELECT aqi_param, count(*) AS readings, count(*) * 100.0 / (SELECT count(*) FROM fct_air) AS share_pct
FROM fct_air GROUP BY aqi_param"""))
def q_b5(spark, sf_dir):
    """Frequency of each AQI driver parameter."""
    return _marts().b5_aqi_driver_frequency(air_measures(spark, sf_dir))


def partitioned_fct_sensor(spark, sf_dir):
    """The reading fact as the cold path stores it, by date; its newest date from the folder names."""
    from aerolith.sinks import partition_values, write_partitioned

    ss, dsn, dz, dt = sensor_star(spark, sf_dir)
    path = scratch_path(spark, "fct-sensor")
    write_partitioned(facts.fct_sensor_reading(ss, dsn, dz, dt), path)
    dim_date = materialize(dims.dim_date_covering(ss, "reading_date"), "dim-date")
    return spark.read.parquet(path), dim_date, partition_values(spark, path, "reading_date")[-1], dz, dt


@register("b6_zone_anomaly_7d", with_ctes(("fct_sensor", "dim_zone"), """
SELECT z.zone_id, count(*) AS readings, count(*) FILTER (WHERE f.is_anomaly) AS anomalies,
       count(*) FILTER (WHERE f.is_anomaly) * 100.0 / count(*) AS anomaly_pct
FROM fct_sensor f JOIN dim_zone z ON f.zone_key = z.zone_key
WHERE f.reading_date > (SELECT max(reading_date) FROM fct_sensor) - 7
GROUP BY z.zone_id"""))
def q_b6(spark, sf_dir):
    """Zone anomaly rates over the last 7 days, of which alone the fact's folders are read."""
    fact, dim_date, newest, dz, _ = partitioned_fct_sensor(spark, sf_dir)
    return _marts().b6_zone_anomaly_rates(fact, dz, as_of=newest, dim_date=dim_date)


STANDIN_TREND_TYPE = "view"
STANDIN_PAIR = ("click", "purchase")


@register("b7_zone_trend_30d", with_ctes(("fct_sensor", "dim_zone", "dim_sensor_type"), f"""
SELECT zone_id, reading_date, avg_value,
       avg(avg_value) OVER (PARTITION BY zone_id ORDER BY reading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg
FROM (SELECT z.zone_id, f.reading_date, avg(f.value) AS avg_value
      FROM fct_sensor f
      JOIN dim_sensor_type t ON f.sensor_type_key = t.sensor_type_key AND t.sensor_type = '{STANDIN_TREND_TYPE}'
      JOIN dim_zone z ON f.zone_key = z.zone_key
      WHERE f.reading_date > (SELECT max(reading_date) FROM fct_sensor) - 30
      GROUP BY z.zone_id, f.reading_date)"""))
def q_b7(spark, sf_dir):
    """30-day daily trend per zone with a 7-day moving average."""
    fact, dim_date, newest, dz, dt = partitioned_fct_sensor(spark, sf_dir)
    return _marts().b7_zone_trend(fact, dz, dt, STANDIN_TREND_TYPE, as_of=newest, dim_date=dim_date)


@register("b8_sensor_drift", with_ctes(("fct_sensor", "dim_sensor"), """
SELECT s.sensor_id, avg(abs(f.deviation)) AS mean_abs_deviation, count(*) AS readings
FROM fct_sensor f JOIN dim_sensor s ON f.sensor_key = s.sensor_key
GROUP BY s.sensor_id ORDER BY mean_abs_deviation DESC, s.sensor_id LIMIT 10"""))
def q_b8(spark, sf_dir):
    """Sensors furthest from target on average (top 10)."""
    ss, dsn, dz, dt = sensor_star(spark, sf_dir)
    return _marts().b8_sensor_drift(facts.fct_sensor_reading(ss, dsn, dz, dt), dsn)


@register("b9_anomalies_type_day", with_ctes(("fct_sensor", "dim_sensor_type"), """
SELECT t.sensor_type, f.reading_date, count(*) AS anomalies
FROM fct_sensor f JOIN dim_sensor_type t ON f.sensor_type_key = t.sensor_type_key
WHERE f.is_anomaly GROUP BY t.sensor_type, f.reading_date"""))
def q_b9(spark, sf_dir):
    """Anomalies per sensor type per day."""
    ss, dsn, dz, dt = sensor_star(spark, sf_dir)
    return _marts().b9_anomalies_by_type_day(facts.fct_sensor_reading(ss, dsn, dz, dt), dt)


@register("b10_pair_corr", with_ctes(("fct_sensor", "dim_zone", "dim_sensor_type"), f"""
SELECT zone_id, CASE WHEN isnan(corr(a, b)) THEN NULL ELSE corr(a, b) END AS correlation,
       count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS paired_buckets
FROM (SELECT z.zone_id, date_trunc('hour', f.reading_ts_utc) AS bucket,
             avg(CASE WHEN t.sensor_type = '{STANDIN_PAIR[0]}' THEN f.value END) AS a,
             avg(CASE WHEN t.sensor_type = '{STANDIN_PAIR[1]}' THEN f.value END) AS b
      FROM fct_sensor f JOIN dim_sensor_type t ON f.sensor_type_key = t.sensor_type_key
      JOIN dim_zone z ON f.zone_key = z.zone_key
      WHERE t.sensor_type IN ('{STANDIN_PAIR[0]}', '{STANDIN_PAIR[1]}')
      GROUP BY z.zone_id, date_trunc('hour', f.reading_ts_utc))
GROUP BY zone_id"""))
def q_b10(spark, sf_dir):
    """Per-zone correlation of two sensor types' hourly means."""
    ss, dsn, dz, dt = sensor_star(spark, sf_dir)
    return _marts().b10_type_pair_correlation(
        facts.fct_sensor_reading(ss, dsn, dz, dt), dz, dt, STANDIN_PAIR[0], STANDIN_PAIR[1], "1 hour")


@register("b11_share_above", with_ctes(("fct_air",), """
SELECT count(*) AS hours, count(*) FILTER (WHERE pm25_value > 15.0) AS hours_above,
       avg(CAST(pm25_value > 15.0 AS INTEGER)) AS share_above
FROM fct_air WHERE pm25_value IS NOT NULL"""))
def q_b11(spark, sf_dir):
    """Share of hourly readings above 15."""
    return _marts().b11_share_above(air_measures(spark, sf_dir))


@register("b12_hot_cold", with_ctes(("hot_windows", "silver_sensor"), """
SELECT CAST(sum(coalesce(hot_count, 0)) AS BIGINT) AS hot_anomalies,
       CAST(sum(coalesce(cold_count, 0)) AS BIGINT) AS cold_anomalies,
       CAST(sum(coalesce(cold_count, 0)) - sum(coalesce(hot_count, 0)) AS BIGINT) AS delta,
       count(*) FILTER (WHERE coalesce(hot_count, 0) <> coalesce(cold_count, 0)) AS mismatched_windows
FROM (SELECT sensor_id, window_start, anomaly_count AS hot_count FROM hot_windows WHERE anomaly_count > 0) h
FULL OUTER JOIN (SELECT sensor_id, date_trunc('minute', reading_ts_utc) AS window_start, count(*) AS cold_count
                 FROM silver_sensor WHERE is_anomaly GROUP BY sensor_id, date_trunc('minute', reading_ts_utc)) c
ON h.sensor_id = c.sensor_id AND h.window_start = c.window_start"""))
def q_b12(spark, sf_dir):
    """Hot vs cold anomaly reconciliation per (sensor, minute)."""
    from aerolith.operators.windows import window_aggregates

    ss = silver_sensor_of(spark, sf_dir)
    return _marts().b12_hot_cold_reconciliation(window_aggregates(ss, sigma=S.EVENT_SIGMA), ss)


HOT_DURATION = "1 hour"
LIVE_DAYS = 3


def hot_of(spark, sf_dir):
    """The stored aggregates of the last days before the newest window, pruned by store partition."""
    from aerolith.sinks import read_store
    from aerolith.streaming.hot_path import STORE_KEYS, STORE_PARTITION

    path = hot_store(spark, sf_dir)
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max(STORE_PARTITION)).first()[0]
    as_of = stored.where(F.col(STORE_PARTITION) == newest).agg(F.max("window_end")).scalar()
    oldest = F.date_format(F.date_sub(F.lit(newest).cast("date"), LIVE_DAYS + 1), "yyyy-MM-dd")
    return read_store(spark, path, STORE_KEYS, F.col(STORE_PARTITION) >= oldest, live_at="now"), as_of


@register("live_kpis", with_ctes(("recent_days",), """
SELECT count(*) AS total_readings, count(*) FILTER (WHERE is_anomaly) AS anomalies_detected,
       count(DISTINCT sensor_id) AS active_sensors,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE is_anomaly) * 100.0 / count(*) END AS anomaly_pct
FROM recent_days"""))
def q_live_kpis(spark, sf_dir):
    """Q4: KPI row over the last days of the stored hot aggregates."""
    hot, as_of = hot_of(spark, sf_dir)
    return _marts().live_kpis(_marts().recent_window(hot, as_of, LIVE_DAYS * 24 * 60))


@register("live_anomalies", with_ctes(("recent_days",), """
SELECT sensor_id, sensor_type, zone_id, avg_value, target_value, window_start FROM recent_days WHERE is_anomaly"""))
def q_live_anomalies(spark, sf_dir):
    """Q5: anomalous windows of the last days."""
    hot, as_of = hot_of(spark, sf_dir)
    return _marts().live_anomalies(_marts().recent_window(hot, as_of, LIVE_DAYS * 24 * 60))


@register("recent50", with_ctes(("recent_days",), """
SELECT sensor_id, sensor_type, zone_id, avg_value, target_value, is_anomaly, reading_count, window_start
FROM recent_days ORDER BY window_start DESC, sensor_id LIMIT 50"""))
def q_recent50(spark, sf_dir):
    """Q6: newest 50 stored aggregates."""
    hot, as_of = hot_of(spark, sf_dir)
    return _marts().recent_aggregates(_marts().recent_window(hot, as_of, LIVE_DAYS * 24 * 60))


@register("recent50_filtered", with_ctes(("recent_days",), """
SELECT sensor_id, sensor_type, zone_id, avg_value, target_value, is_anomaly, reading_count, window_start
FROM recent_days WHERE is_anomaly AND zone_id = 'Z02' ORDER BY window_start DESC, sensor_id LIMIT 50"""))
def q_recent50_filtered(spark, sf_dir):
    """The newest anomalous aggregates of one zone."""
    hot, as_of = hot_of(spark, sf_dir)
    recent = _marts().recent_window(hot, as_of, LIVE_DAYS * 24 * 60)
    return _marts().recent_aggregates(recent, anomalies_only=True, zone="Z02")


@register("key_versions", with_ctes(("dim_customer_v2",), """
SELECT c_custkey, c_name, last_priority, effective_date, expiry_date, is_current FROM dim_customer_v2
WHERE c_custkey = (SELECT min(c_custkey) FROM dim_customer_v2 WHERE NOT is_current)
ORDER BY effective_date"""))
def q_key_versions(spark, sf_dir):
    """All versions of one key that has history."""
    dim = customer_dims(spark, sf_dir)[1]
    key = dim.filter(~F.col("is_current")).agg(F.min("c_custkey")).scalar()
    return _marts().key_versions(dim, "c_custkey", key, ["c_name", "last_priority"])


# --- sources, sinks and streams -----------------------------------------------------


@register("flatten_air", with_ctes(("bronze_air",), """
SELECT station_id, station_name_en, station_name_th, area_en, area_th, station_type,
       CASE WHEN lat < 0 THEN NULL ELSE lat END AS lat, CASE WHEN lon < 0 THEN NULL ELSE lon END AS lon,
       reading_date, reading_time,
       CASE WHEN pm25_value < 0 THEN NULL ELSE pm25_value END AS pm25_value,
       CASE WHEN pm25_aqi < 0 THEN NULL ELSE pm25_aqi END AS pm25_aqi,
       CASE WHEN pm10_value < 0 THEN NULL ELSE pm10_value END AS pm10_value,
       CASE WHEN o3_value < 0 THEN NULL ELSE o3_value END AS o3_value,
       CASE WHEN co_value < 0 THEN NULL ELSE co_value END AS co_value,
       CASE WHEN no2_value < 0 THEN NULL ELSE no2_value END AS no2_value,
       CASE WHEN so2_value < 0 THEN NULL ELSE so2_value END AS so2_value,
       CASE WHEN overall_aqi < 0 THEN NULL ELSE overall_aqi END AS overall_aqi,
       aqi_param, ingested_at
FROM bronze_air"""))
def q_flatten_air(spark, sf_dir):
    """Station documents (numbers as text) -> Bronze records."""
    from aerolith.operators.flatten import flatten_air

    b = S.bronze_air(spark, sf_dir)
    txt = lambda c: F.col(c).cast("string")
    doc = F.struct(
        F.col("station_id").alias("stationID"), F.col("station_name_en").alias("nameEN"),
        F.col("station_name_th").alias("nameTH"), F.col("area_en").alias("areaEN"),
        F.col("area_th").alias("areaTH"), F.col("station_type").alias("stationType"),
        txt("lat").alias("lat"), txt("lon").alias("long"),
        F.struct(
            F.col("reading_date").alias("date"), F.col("reading_time").alias("time"),
            F.struct(txt("pm25_value").alias("value"), txt("pm25_aqi").alias("aqi")).alias("PM25"),
            F.struct(txt("pm10_value").alias("value")).alias("PM10"),
            F.struct(txt("o3_value").alias("value")).alias("O3"),
            F.struct(txt("co_value").alias("value")).alias("CO"),
            F.struct(txt("no2_value").alias("value")).alias("NO2"),
            F.struct(txt("so2_value").alias("value")).alias("SO2"),
            F.struct(txt("overall_aqi").alias("aqi"), F.col("aqi_param").alias("param")).alias("AQI"),
        ).alias("AQILast"),
    )
    raw = b.select(F.to_json(doc).alias("value"), "ingested_at")
    return flatten_air(raw, "value", "ingested_at")[0]


@register("flatten_weather", with_ctes(("bronze_weather",), """
SELECT CAST(city_id AS BIGINT) AS city_id, city_name, country, lat, lon, reading_ts, temp_c,
       feels_like_c, pressure_hpa, humidity_pct, wind_speed_ms, wind_deg, visibility_m,
       weather_main, weather_desc, weather_icon, ingested_at
FROM bronze_weather"""))
def q_flatten_weather(spark, sf_dir):
    """Nested weather documents (struct paths, array element 0) -> Bronze."""
    from aerolith.operators.flatten import flatten_weather

    b = S.bronze_weather(spark, sf_dir)
    doc = F.struct(
        F.col("city_id").alias("id"), F.col("city_name").alias("name"), F.col("reading_ts").alias("dt"),
        F.col("visibility_m").alias("visibility"),
        F.struct("lat", "lon").alias("coord"), F.struct("country").alias("sys"),
        F.struct(F.col("temp_c").alias("temp"), F.col("feels_like_c").alias("feels_like"),
                 F.col("pressure_hpa").alias("pressure"), F.col("humidity_pct").alias("humidity")).alias("main"),
        F.struct(F.col("wind_speed_ms").alias("speed"), F.col("wind_deg").alias("deg")).alias("wind"),
        F.array(F.struct(F.col("weather_main").alias("main"), F.col("weather_desc").alias("description"),
                         F.col("weather_icon").alias("icon"))).alias("weather"),
    )
    raw = b.select(F.to_json(doc).alias("value"), "ingested_at")
    return flatten_weather(raw, "value", "ingested_at")[0]


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf_dir):
    """Write CSV with a header, read it back with an explicit schema."""
    from aerolith.sinks import rebalanced
    from aerolith.sources import read_csv

    cust = S.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    rebalanced(cust).write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path, cust.schema)[0]


@register("bronze_ingest", with_ctes(("bronze_sensor",), "SELECT * FROM bronze_sensor"))
def q_bronze_ingest(spark, sf_dir):
    """Keyed JSON messages -> stream -> partitioned Bronze files."""
    from pyspark.sql.types import StringType, StructField, StructType

    from aerolith.schemas import BRONZE_SENSOR
    from aerolith.sinks import publish
    from aerolith.sources import file_stream
    from aerolith.streaming.ingest import start_ingest

    root = scratch_path(spark, "ingest")
    publish(S.bronze_sensor(spark, sf_dir), "sensor_id", fmt="parquet", path=f"{root}/messages")
    msg_schema = StructType([StructField("key", StringType()), StructField("value", StringType())])
    stream = file_stream(spark, f"{root}/messages", msg_schema, "parquet")
    q = start_ingest(stream, BRONZE_SENSOR, f"{root}/bronze", f"{root}/chk", f"{root}/quarantine", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select(*BRONZE_SENSOR.fieldNames())


@register("hot_windows_stream", with_ctes(("hot_windows",), "SELECT * FROM hot_windows"))
def q_hot_windows_stream(spark, sf_dir):
    """C18/T-1..T-6/K9/K10: streaming windows (watermark, update mode) appended
    to the epoch store, drained with availableNow, then read back."""
    from aerolith.functions.time import iso_to_ts
    from aerolith.operators.windows import WINDOW_COLUMNS
    from aerolith.sinks import read_store
    from aerolith.sources import file_stream
    from aerolith.streaming.hot_path import STORE_KEYS, start_hot_path

    root = scratch_path(spark, "hot")
    schema = S.table(spark, sf_dir, "events").schema
    events = file_stream(spark, sf_dir, schema, "parquet", glob="events.parquet")
    readings = S.sensor_messages(events).withColumn("reading_ts_utc", iso_to_ts("reading_ts"))
    # A replay: the whole month arrives in one micro-batch, so the store is laid
    # out by day (live operation keeps the hourly default).
    q = start_hot_path(readings, f"{root}/store", f"{root}/chk",
                       trigger={"availableNow": True}, partition_grain="day", sigma=S.EVENT_SIGMA, decimals=False)
    q.awaitTermination()
    return read_store(spark, f"{root}/store", STORE_KEYS).select(*WINDOW_COLUMNS)


HOT_LOTS = 4
LOT_FILE_BYTES = (1 << 20, 64 << 20)


def lot_files(spark, events) -> int:
    """Files in each lot of the events: one a core while that leaves a megabyte to each, and as many as keep them under 64."""
    from aerolith.operators.joins import estimated_bytes

    lot = (estimated_bytes(events) or 0) / HOT_LOTS
    least, most = LOT_FILE_BYTES
    return max(1, min(spark.sparkContext.defaultParallelism, int(lot / least)), math.ceil(lot / most))


def hot_store(spark, sf_dir) -> str:
    """Path of a hot store filled over several micro-batches: the events lie in
    four lots of files by a hash, so each batch adds readings to windows of
    earlier ones (late rows), within a watermark that covers the whole replay."""
    from aerolith.functions.time import iso_to_ts
    from aerolith.sources import file_stream
    from aerolith.streaming.hot_path import start_hot_path

    root = scratch_path(spark, "hot-multi")
    events = S.table(spark, sf_dir, "events")
    files = lot_files(spark, events)
    events.repartitionByRange(HOT_LOTS * files, F.xxhash64("event_id")).write.parquet(f"{root}/events")
    stream = file_stream(spark, f"{root}/events", events.schema, "parquet", max_files_per_trigger=files)
    readings = S.sensor_messages(stream).withColumn("reading_ts_utc", iso_to_ts("reading_ts"))
    q = start_hot_path(readings, f"{root}/store", f"{root}/chk", trigger={"availableNow": True}, partition_grain="day",
                       watermark="3650 days", duration=HOT_DURATION, sigma=S.EVENT_SIGMA, decimals=False)
    q.awaitTermination()
    return f"{root}/store"


@register("hot_store_multi_batch", with_ctes(("hot_hours",), "SELECT * FROM hot_hours"))
def q_hot_store_multi_batch(spark, sf_dir):
    """Several micro-batches into one store, one epoch written twice, then the latest row per key."""
    from aerolith.operators.windows import WINDOW_COLUMNS
    from aerolith.sinks import EPOCH, append_epoch, read_store
    from aerolith.streaming.hot_path import STORE_KEYS, STORE_PARTITION

    path = hot_store(spark, sf_dir)
    rows = spark.read.parquet(path)
    replayed = materialize(rows.where(F.col(EPOCH) == 1).drop(EPOCH).withColumn(STORE_PARTITION, F.date_format(STORE_PARTITION, "yyyy-MM-dd")), "replayed-epoch")
    append_epoch(replayed, path, 1, STORE_KEYS, STORE_PARTITION)
    return read_store(spark, path, STORE_KEYS).select(*WINDOW_COLUMNS)


@register("cold_path", with_ctes(("fct_air",), "SELECT * FROM fct_air"))
def q_cold_path(spark, sf_dir):
    """The whole cold pipeline written stage by stage; returns the hourly fact."""
    from aerolith.plans.pipeline import run_cold_path

    res = run_cold_path(
        spark, S.bronze_air(spark, sf_dir), S.bronze_weather(spark, sf_dir), S.bronze_sensor(spark, sf_dir),
        scratch_path(spark, "cold"), S.AS_OF_LOAD,
    )
    return spark.read.parquet(res.path("gold/fct_air_quality_hourly")).drop("air_quality_key")


# --- SQL over catalog views (S4, entry C) ----------------------------------------------


@register("top10_sql", ORACLE["top10"])
def q_top10_sql(spark, sf_dir):
    """Q1 as Spark SQL over temp views of the Gold tables."""
    from aerolith.plans.sql import register_views, top_stations_sql

    sa, ds, dr = air_star(spark, sf_dir)
    views = register_views(
        {"fct_air_quality_hourly": facts.fct_air_quality_hourly(sa, ds, dr), "dim_station": ds}, prefix="gold_q1_"
    )
    return top_stations_sql(spark, views)


@register("by_city_day_sql", ORACLE["by_city_day"])
def q_by_city_day_sql(spark, sf_dir):
    """Q2 as Spark SQL over temp views."""
    from aerolith.plans.sql import register_views, weather_by_city_day_sql

    sw = materialize(silver_weather_of(spark, sf_dir), "silver-weather")
    dwc = dims.dim_weather_condition(sw)
    views = register_views(
        {"fct_weather_hourly": facts.fct_weather_hourly(sw, dwc), "dim_weather_condition": dwc}, prefix="gold_q2_"
    )
    return weather_by_city_day_sql(spark, views)


@register("history_sql", ORACLE["history_listing"])
def q_history_sql(spark, sf_dir):
    """Q3 as Spark SQL over a temp view of the merged SCD2 dimension."""
    from aerolith.plans.sql import scd2_history_sql

    return scd2_history_sql(spark, customer_dims(spark, sf_dir)[1], "c_custkey", ["c_name", "c_mktsegment"])


# --- source-compatible modes (H2, H4) ----------------------------------------------------


def _daily_sql(keyed: str) -> str:
    return f"""
SELECT d.*, m.aqi_param AS dominant_aqi_param FROM (
  SELECT date_key, station_key, region_key, reading_date, avg(pm25_value) AS avg_pm25,
         max(pm25_value) AS max_pm25, min(pm25_value) AS min_pm25,
         count(*) FILTER (WHERE pm25_value > {STANDIN_PM25_THRESHOLD}) AS hours_exceeding_threshold
  FROM {keyed} GROUP BY date_key, station_key, region_key, reading_date) d
LEFT JOIN (
  SELECT date_key, station_key, region_key, reading_date, aqi_param FROM (
    SELECT date_key, station_key, region_key, reading_date, aqi_param,
           row_number() OVER (PARTITION BY date_key, station_key, region_key, reading_date
                              ORDER BY count(*) DESC, aqi_param ASC) AS rn
    FROM {keyed} WHERE aqi_param IS NOT NULL
    GROUP BY date_key, station_key, region_key, reading_date, aqi_param) WHERE rn = 1) m
ON d.date_key = m.date_key AND d.station_key IS NOT DISTINCT FROM m.station_key
   AND d.region_key IS NOT DISTINCT FROM m.region_key AND d.reading_date = m.reading_date"""


@register("fct_daily_summary_local", with_ctes(("air_keyed_local",), _daily_sql("air_keyed_local")))
def q_fct_daily_summary_local(spark, sf_dir):
    """C14 with Silver's local reading_date (compat): UTC day split at 07:00 local."""
    sa_local = materialize(silver.silver_air(S.bronze_air(spark, sf_dir), compat=True), "silver-air-local")
    snap = scd2.snapshot(
        sa_local, "station_id",
        ["station_name_en", "station_name_th", "area_en", "station_type", "lat", "lon"], "reading_ts_utc",
    )
    ds = scd2.first_load(snap, "station_id", "station_key", S.AS_OF_LOAD)
    out = facts.fct_pollution_daily_summary(sa_local, ds, dims.dim_region(sa_local), threshold=STANDIN_PM25_THRESHOLD)
    return out.drop("daily_summary_key")


# --- further registered queries -------------------------------------------------------------

from aerolith.plans import gaps, layout, loads, reports, streams  # noqa: E402, F401
