"""Registered queries: the cold path as a checked whole, merges on changed input, hot against cold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from aerolith.operators import dims, facts, scd2
from aerolith.plans import marts, standins as S
from aerolith.plans.oracle import CTES, with_ctes
from aerolith.plans.pipeline import SENSOR_ATTRS, STATION_ATTRS, fact_key_report, run_cold_path
from aerolith.plans.registry import HOT_DURATION, air_star, register, sensor_star, silver_sensor_of, silver_weather_of
from aerolith.plans.streams import closed_windows
from aerolith.session import scratch_path
from aerolith.sinks import materialize, read_latest

# --- keys and counts ---------------------------------------------------------------------------


# What dimensions, keys and the daily grain are made from; no more of Silver is written down for the key report.
KEYED_AIR = ("station_id", *STATION_ATTRS, "reading_ts_utc", "reading_date", "date_key", "pm25_value", "aqi_param")
KEYED_WEATHER = ("city_id", "reading_ts_utc", "weather_main", "weather_desc")


@register("fact_keys_unique", with_ctes(("silver_air", "air_keyed", "silver_sensor", "silver_weather"), """
SELECT 'fct_air_quality_hourly' AS fact, count(*) AS row_count, count(DISTINCT (station_id, reading_ts_utc)) AS distinct_keys, 0::BIGINT AS null_keys FROM silver_air
UNION ALL
SELECT 'fct_pollution_daily_summary', count(*), count(*), 0 FROM (SELECT DISTINCT date_key, station_key, region_key, reading_date FROM air_keyed)
UNION ALL
SELECT 'fct_weather_hourly', count(*), count(DISTINCT (city_id, reading_ts_utc)), 0 FROM silver_weather
UNION ALL
SELECT 'fct_sensor_reading', count(*), count(DISTINCT (sensor_id, reading_ts_utc)), 0 FROM silver_sensor
UNION ALL
SELECT 'fct_sensor_anomaly_event', count(*), count(DISTINCT (sensor_id, reading_ts_utc)), 0 FROM silver_sensor WHERE is_anomaly"""))
def q_fact_keys_unique(spark, sf_dir):
    """128-bit keys of all five facts: as many distinct ones as rows, none NULL."""
    sa, station, region = air_star(spark, sf_dir, KEYED_AIR)
    ss, sensor, zone, kind = sensor_star(spark, sf_dir)
    sw = materialize(silver_weather_of(spark, sf_dir).select(*KEYED_WEATHER), "silver-weather")
    reading = facts.fct_sensor_reading(ss, sensor, zone, kind, key="wide")
    packed = lambda key: F.unhex(key).alias(key)  # noqa: E731 - 32 hex digits as their 16 bytes, half of what the report shuffles
    return fact_key_report({
        "fct_air_quality_hourly": facts.fct_air_quality_hourly(sa, station, region, key="wide", columns=()).select(packed("air_quality_key")),
        "fct_pollution_daily_summary": facts.fct_pollution_daily_summary(sa, station, region, key="wide").select(packed("daily_summary_key")),
        "fct_weather_hourly": facts.fct_weather_hourly(sw, dims.dim_weather_condition(sw), key="wide", columns=()).select(packed("weather_hourly_key")),
        "fct_sensor_reading": reading.select(packed("sensor_reading_key")),
        "fct_sensor_anomaly_event": facts.fct_sensor_anomaly_event(reading, key="wide").select(packed("anomaly_event_key")),
    })


# A calendar that ends before the newest readings do: their facts are counted as unmatched.
CALENDAR = (date(1990, 1, 1), date(1998, 3, 31))


def _count_sql(table: str, source: str, columns: str, missing: str = "0") -> str:
    first, *rest = columns.split()
    rows = [f"SELECT '{table}' AS table_name, count(*) AS row_count, '{c}' AS column_name, 0::BIGINT AS missing FROM {source}" for c in ([first, *rest] if missing == "0" else [first, *rest[:-1]])]
    if missing != "0":
        rows.append(f"SELECT '{table}', count(*), '{rest[-1]}', count(*) FILTER (WHERE {missing}) FROM {source}")
    return "\nUNION ALL\n".join(rows)


_LATE = f"reading_date NOT BETWEEN DATE '{CALENDAR[0]}' AND DATE '{CALENDAR[1]}'"


@register("load_report", with_ctes(
    ("silver_air", "silver_weather", "silver_sensor", "dim_region", "dim_weather_condition", "dim_zone", "dim_sensor_type", "dim_station", "dim_sensor", "air_keyed"),
    "\nUNION ALL\n".join([
        _count_sql("silver_air", "silver_air", "station_id reading_ts_utc"),
        _count_sql("silver_weather", "silver_weather", "city_id reading_ts_utc"),
        _count_sql("silver_sensor", "silver_sensor", "sensor_id reading_ts_utc"),
        _count_sql("dim_date", f"generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY)", "date_key"),
        _count_sql("dim_region", "dim_region", "region_name"),
        _count_sql("dim_weather_condition", "dim_weather_condition", "weather_description"),
        _count_sql("dim_zone", "dim_zone", "zone_id"),
        _count_sql("dim_sensor_type", "dim_sensor_type", "sensor_type"),
        _count_sql("dim_station", "dim_station", "station_id"),
        _count_sql("dim_sensor", "dim_sensor", "sensor_id"),
        _count_sql("fct_air_quality_hourly", "silver_air", "station_key region_key calendar_key", _LATE),
        _count_sql("fct_pollution_daily_summary", "(SELECT DISTINCT date_key, station_key, region_key, reading_date FROM air_keyed)",
                   "station_key region_key calendar_key", _LATE),
        _count_sql("fct_sensor_reading", "silver_sensor", "sensor_key zone_key sensor_type_key calendar_key", _LATE),
        _count_sql("fct_weather_hourly", "silver_weather", "weather_condition_key calendar_key", _LATE),
        _count_sql("fct_sensor_anomaly_event", "(SELECT * FROM silver_sensor WHERE is_anomaly)", "sensor_key zone_key calendar_key", _LATE),
    ])))
def q_load_report(spark, sf_dir):
    """Rows and missing keys of all fifteen tables, counted in the passes that wrote them."""
    bronze = (S.bronze_air(spark, sf_dir), S.bronze_weather(spark, sf_dir), S.bronze_sensor(spark, sf_dir))
    return run_cold_path(spark, *bronze, scratch_path(spark, "cold"), S.AS_OF_LOAD, CALENDAR).report(spark)


# --- second runs ------------------------------------------------------------------------------------

FIRST_RUN, SECOND_RUN = date(2024, 1, 1), date(2024, 2, 1)
RUN_CUT = "1997-01-01"


def earlier_air(spark, sf_dir):
    """Bronze as the first run saw it: fewer readings, and other names of the stations with a negative balance."""
    air = S.bronze_air(spark, sf_dir).where(F.col("reading_date") < RUN_CUT)
    renamed = F.when(F.col("lat") < 0, F.concat(F.lit("old "), F.col("station_name_en"))).otherwise(F.col("station_name_en"))
    return air.withColumn("station_name_en", renamed)


CTES["station_first"] = (("silver_air",), f"""
SELECT station_id, CASE WHEN lat < 0 THEN 'old ' || station_name_en ELSE station_name_en END AS station_name_en,
       CAST(row_number() OVER (ORDER BY station_id) AS INTEGER) AS station_key
FROM (SELECT DISTINCT station_id, station_name_en, lat FROM bronze_air WHERE reading_date < '{RUN_CUT}')""")
CTES["station_second"] = (("station_first", "dim_station"), f"""
SELECT f.station_id, f.station_name_en, f.station_key, DATE '{FIRST_RUN}' AS effective_date,
       CASE WHEN f.station_name_en <> d.station_name_en THEN DATE '{SECOND_RUN}' ELSE DATE '9999-12-31' END AS expiry_date,
       f.station_name_en = d.station_name_en AS is_current
FROM station_first f JOIN dim_station d USING (station_id)
UNION ALL
SELECT d.station_id, d.station_name_en,
       CAST((SELECT max(station_key) FROM station_first) + row_number() OVER (ORDER BY d.station_id) AS INTEGER),
       DATE '{SECOND_RUN}', DATE '9999-12-31', true
FROM dim_station d LEFT JOIN station_first f USING (station_id)
WHERE f.station_id IS NULL OR f.station_name_en <> d.station_name_en""")


def second_run(spark, sf_dir):
    root = scratch_path(spark, "cold-twice")
    weather, sensor = S.bronze_weather(spark, sf_dir), S.bronze_sensor(spark, sf_dir)
    run_cold_path(spark, earlier_air(spark, sf_dir), weather, sensor, root, FIRST_RUN, CALENDAR)
    return run_cold_path(spark, S.bronze_air(spark, sf_dir), weather, sensor, root, SECOND_RUN, CALENDAR)


@register("cold_path_second_run", with_ctes(("silver_air", "station_second"), """
SELECT s.station_key, s.station_id, s.station_name_en, s.effective_date, s.expiry_date, s.is_current, coalesce(n, 0) AS readings
FROM station_second s LEFT JOIN (SELECT station_id, count(*) AS n FROM silver_air GROUP BY 1) a ON s.station_id = a.station_id AND s.is_current"""))
def q_cold_path_second_run(spark, sf_dir):
    """The whole cold path again, on changed and grown input: every station version, and the readings that the new fact gives it."""
    res = second_run(spark, sf_dir)
    versions = read_latest(spark, res.path("gold/dim_station"))
    fact = spark.read.parquet(res.path("gold/fct_air_quality_hourly")).groupBy("station_key").agg(F.count(F.lit(1)).alias("readings"))
    joined = versions.join(fact, "station_key", "left")
    return joined.select(
        "station_key", "station_id", "station_name_en", "effective_date", "expiry_date", "is_current", F.coalesce("readings", F.lit(0)).alias("readings")
    )


# --- sensors merged -----------------------------------------------------------------------------------

_ATTRS = ", ".join(SENSOR_ATTRS)


def _half_sql(half: str) -> str:
    return f"""
SELECT sensor_id, {_ATTRS} FROM silver_sensor, (SELECT min(reading_ts_utc) + (max(reading_ts_utc) - min(reading_ts_utc)) / 2 AS cut FROM silver_sensor)
WHERE epoch_us(reading_ts_utc) {half} epoch_us(cut)
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY reading_ts_utc DESC, {', '.join(c + ' DESC NULLS LAST' for c in SENSOR_ATTRS)}) = 1"""


CTES["sensor_old"] = (("silver_sensor",), _half_sql("<"))
CTES["sensor_new"] = (("silver_sensor",), _half_sql(">="))
CTES["sensor_classes"] = (("sensor_old", "sensor_new"), f"""
SELECT coalesce(o.sensor_id, n.sensor_id) AS id, CAST(row_number() OVER (ORDER BY o.sensor_id NULLS LAST) AS INTEGER) AS old_key, o, n,
       CASE WHEN o.sensor_id IS NULL THEN 'new' WHEN n.sensor_id IS NULL THEN 'missing'
            WHEN {' OR '.join(f'o.{c} IS DISTINCT FROM n.{c}' for c in SENSOR_ATTRS)} THEN 'changed' ELSE 'unchanged' END AS class
FROM sensor_old o FULL OUTER JOIN sensor_new n ON o.sensor_id = n.sensor_id""")
_OLD, _NEW = (", ".join(f"{side}.{c} AS {c}" for c in SENSOR_ATTRS) for side in "on")
CTES["sensor_merged"] = (("sensor_classes",), f"""
SELECT id AS sensor_id, {_OLD}, old_key AS sensor_key, DATE '{FIRST_RUN}' AS effective_date,
       CASE class WHEN 'changed' THEN DATE '{SECOND_RUN}' ELSE DATE '9999-12-31' END AS expiry_date, class <> 'changed' AS is_current, class
FROM sensor_classes WHERE class <> 'new'
UNION ALL
SELECT id, {_NEW}, CAST((SELECT count(*) FROM sensor_old) + row_number() OVER (ORDER BY id) AS INTEGER),
       DATE '{SECOND_RUN}', DATE '9999-12-31', true, class
FROM sensor_classes WHERE class IN ('new', 'changed')""")


def sensor_merge(spark, sf_dir):
    """The sensor dimension of the first half's readings, and of the second half merged into it."""
    ss = materialize(silver_sensor_of(spark, sf_dir), "silver-sensor")
    us = F.unix_micros("reading_ts_utc")
    lo, hi = (ss.agg(f(us).alias("t")).scalar() for f in (F.min, F.max))
    later = us >= lo + F.floor((hi - lo) / 2)
    snap = lambda rows: scd2.snapshot(rows, "sensor_id", SENSOR_ATTRS, "reading_ts_utc")
    first = materialize(scd2.first_load(snap(ss.where(~later)), "sensor_id", "sensor_key", FIRST_RUN), "dim-sensor")
    return first, scd2.merge(first, snap(ss.where(later)), "sensor_id", SENSOR_ATTRS, "sensor_key", SECOND_RUN)


@register("sensor_scd2_merge", with_ctes(("sensor_merged",), "SELECT * EXCLUDE (class) FROM sensor_merged"))
def q_sensor_scd2_merge(spark, sf_dir):
    """The sensor dimension after a merge of new, changed, unchanged and missing sensors."""
    return sensor_merge(spark, sf_dir)[1]


# Customers of this nation come with the second snapshot only, those of this segment with the first only.
NEW_NATION, GONE_SEGMENT = 3, "BUILDING"
CASE_ATTRS = ["c_mktsegment", "c_nationkey", "last_priority"]
CTES["case_rows"] = (("snap1", "snap2"), f"""
SELECT coalesce(o.c_custkey, n.c_custkey) AS key,
       CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'missing'
            WHEN {' OR '.join(f'o.{c} IS DISTINCT FROM n.{c}' for c in CASE_ATTRS)} THEN 'changed' ELSE 'unchanged' END AS class
FROM (SELECT * FROM snap1 WHERE c_nationkey <> {NEW_NATION}) o
FULL OUTER JOIN (SELECT * FROM snap2 WHERE c_mktsegment <> '{GONE_SEGMENT}') n ON o.c_custkey = n.c_custkey""")


@register("scd2_all_cases", with_ctes(("case_rows",), """
SELECT class, count(*) AS keys, CAST(sum(CASE class WHEN 'changed' THEN 2 ELSE 1 END) AS BIGINT) AS versions,
       count(*) FILTER (WHERE class <> 'missing') AS current_versions, count(*) FILTER (WHERE class IN ('changed', 'missing')) AS closed_versions
FROM case_rows GROUP BY class"""))
def q_scd2_all_cases(spark, sf_dir):
    """Every case of a merge and what it leaves: new, changed, unchanged and missing keys, the last closed."""
    last = S.last_snapshot(spark, sf_dir)
    old = S.customer_snapshot(spark, sf_dir, S.SCD2_FIRST_SNAPSHOT, known_only=True).where(F.col("c_nationkey") != NEW_NATION)
    new = materialize(S.customer_snapshot(spark, sf_dir, last).where(F.col("c_mktsegment") != GONE_SEGMENT), "snapshot")
    first = materialize(scd2.first_load(old, "c_custkey", "customer_key", S.SCD2_FIRST_SNAPSHOT), "dim-customer")
    merged = scd2.merge(first, new, "c_custkey", CASE_ATTRS, "customer_key", last, close_missing=True)
    per_key = merged.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("versions"), F.count_if("is_current").alias("current"), F.count_if(~F.col("is_current")).alias("closed")
    )
    known = first.select("c_custkey", F.lit(True).alias("old"))
    kind = (
        F.when(F.col("old").isNull(), "new").when(F.col("versions") > 1, "changed").when(F.col("current") == 0, "missing").otherwise("unchanged")
    )
    return per_key.join(known, "c_custkey", "left").groupBy(kind.alias("class")).agg(
        F.count(F.lit(1)).alias("keys"), F.sum("versions").alias("versions"), F.sum("current").alias("current_versions"), F.sum("closed").alias("closed_versions")
    )


# --- hot against cold -------------------------------------------------------------------------------------


@register("hot_cold_delta", with_ctes(("timely_hours", "watermarks", "silver_sensor"), """
SELECT CAST(sum(coalesce(hot_count, 0)) AS BIGINT) AS hot_anomalies, CAST(sum(coalesce(cold_count, 0)) AS BIGINT) AS cold_anomalies,
       CAST(sum(coalesce(cold_count, 0)) - sum(coalesce(hot_count, 0)) AS BIGINT) AS delta,
       count(*) FILTER (WHERE coalesce(hot_count, 0) <> coalesce(cold_count, 0)) AS mismatched_windows
FROM (SELECT sensor_id, window_start, anomaly_count AS hot_count FROM timely_hours
      WHERE anomaly_count > 0 AND epoch_us(window_end) <= (SELECT max(after) FROM watermarks)) h
FULL OUTER JOIN (SELECT sensor_id, date_trunc('hour', reading_ts_utc) AS window_start, count(*) AS cold_count
                 FROM silver_sensor WHERE is_anomaly GROUP BY ALL) c
ON h.sensor_id = c.sensor_id AND h.window_start = c.window_start"""))
def q_hot_cold_delta(spark, sf_dir):
    """A streamed store of closed windows against Silver: late readings and open windows are the difference."""
    hot = spark.read.parquet(closed_windows(spark, sf_dir)[0])
    return marts.b12_hot_cold_reconciliation(hot, silver_sensor_of(spark, sf_dir), duration=HOT_DURATION)
