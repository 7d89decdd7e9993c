"""Registered queries over inputs with gaps: missing areas, values, types and stamps, and days that are holidays."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import dims, facts, flatten, scd2
from aerolith.operators.windows import window_aggregates
from aerolith.plans import marts, standins as S
from aerolith.plans.oracle import CTES, windows_sql, with_ctes
from aerolith.plans.registry import register, silver_air_of, silver_sensor_of
from aerolith.sinks import materialize

# Stations of this kind name no area, readings of this hour have no PM2.5, sensors of this type do not say it.
NO_AREA, NO_VALUE, NO_TYPE = "R3", "03:00", "error"

CTES["air_gaps"] = (("silver_air",), f"""
SELECT * REPLACE (CASE WHEN station_type <> '{NO_AREA}' THEN area_en END AS area_en,
                  CASE WHEN reading_time <> '{NO_VALUE}' THEN pm25_value END AS pm25_value) FROM silver_air""")


def air_with_gaps(spark, sf_dir):
    return materialize(silver_air_of(spark, sf_dir).withColumns({
        "area_en": F.when(F.col("station_type") != NO_AREA, F.col("area_en")),
        "pm25_value": F.when(F.col("reading_time") != NO_VALUE, F.col("pm25_value")),
    }), "air-gaps")


@register("regions_with_gaps", with_ctes(("air_gaps",), """
SELECT r.region_key, a.area_en AS region_name, count(*) AS readings, count(pm25_value) AS measured, avg(pm25_value) AS avg_pm25
FROM air_gaps a LEFT JOIN (
  SELECT area_en, CAST(row_number() OVER (ORDER BY area_en) AS INTEGER) AS region_key FROM (SELECT DISTINCT area_en FROM air_gaps WHERE area_en IS NOT NULL)) r
ON r.area_en = a.area_en GROUP BY r.region_key, a.area_en"""))
def q_regions_with_gaps(spark, sf_dir):
    """Areas that are NULL make no member and match none; their readings stay."""
    sa = air_with_gaps(spark, sf_dir)
    region = dims.dim_region(sa)
    station = scd2.first_load(scd2.snapshot(sa, "station_id", ["station_name_en", "area_en"], "reading_ts_utc"), "station_id", "station_key", S.AS_OF_LOAD)
    fact = facts.fct_air_quality_hourly(sa, station, region)
    named = fact.join(F.broadcast(region.select("region_key", "region_name")), "region_key", "left")
    return named.groupBy("region_key", "region_name").agg(
        F.count(F.lit(1)).alias("readings"), F.count("pm25_value").alias("measured"), F.avg("pm25_value").alias("avg_pm25")
    )


@register("top10_with_gaps", with_ctes(("air_gaps",), """
SELECT station_name_en, area_en, avg(pm25_value) AS avg_pm25, max(pm25_value) AS max_pm25, count(*) AS hourly_readings
FROM air_gaps WHERE pm25_value IS NOT NULL GROUP BY station_name_en, area_en
QUALIFY row_number() OVER (ORDER BY avg_pm25 DESC, station_name_en, area_en NULLS FIRST) <= 10"""))
def q_top10_with_gaps(spark, sf_dir):
    """Readings without PM2.5 count neither for the average nor for the number."""
    sa = air_with_gaps(spark, sf_dir)
    station = scd2.first_load(scd2.snapshot(sa, "station_id", ["station_name_en", "area_en"], "reading_ts_utc"), "station_id", "station_key", S.AS_OF_LOAD)
    return marts.top_polluted_stations(facts.fct_air_quality_hourly(sa, station, dims.dim_region(sa)), station)


CTES["sensor_untyped"] = (("silver_sensor",), f"""
SELECT * REPLACE (CASE WHEN sensor_type <> '{NO_TYPE}' THEN sensor_type END AS sensor_type,
                  CASE WHEN zone_id <> 'Z01' THEN zone_id END AS zone_id) FROM silver_sensor""")


@register("hot_windows_untyped", with_ctes(("sensor_untyped",), windows_sql("minute", "sensor_untyped")))
def q_hot_windows_untyped(spark, sf_dir):
    """Readings without type or zone are "unknown" and take the default sigma."""
    gaps = silver_sensor_of(spark, sf_dir).withColumns({
        "sensor_type": F.when(F.col("sensor_type") != NO_TYPE, F.col("sensor_type")),
        "zone_id": F.when(F.col("zone_id") != "Z01", F.col("zone_id")),
    })
    return window_aggregates(gaps, sigma=S.EVENT_SIGMA)


HOLIDAYS = ("1994-01-01", "1995-04-13", "1996-12-31", "1997-05-01", "2026-01-01")


@register("holiday_readings", f"""
SELECT CAST(year(d) AS INTEGER) AS year, d IN ({', '.join(f"DATE '{h}'" for h in HOLIDAYS)}) AS is_thai_holiday, isodow(d) >= 6 AS is_weekend,
       count(DISTINCT d) AS days, count(*) AS readings
FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY ALL""")
def q_holiday_readings(spark, sf_dir):
    """Readings by year on holidays and weekends of the calendar."""
    li = S.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    calendar = dims.dim_date_covering(li, "day", holidays=HOLIDAYS)
    joined = li.join(F.broadcast(calendar), F.col("day") == F.col("full_date"))  # a row a day
    return joined.groupBy("year", "is_thai_holiday", "is_weekend").agg(F.count_distinct("day").alias("days"), F.count(F.lit(1)).alias("readings"))


@register("ingest_stamp", with_ctes(("bronze_weather",), "SELECT count(*) AS records, count(*) AS stamped_now FROM bronze_weather"))
def q_ingest_stamp(spark, sf_dir):
    """Documents that bring no stamp get the time of their ingestion, as ISO text."""
    raw = S.bronze_weather(spark, sf_dir).drop("ingested_at")
    doc = F.to_json(F.struct(F.col("city_id").alias("id"), F.col("reading_ts").alias("dt")))
    records, _ = flatten.flatten_weather(raw.select(doc.alias("value")))
    at = F.to_timestamp("ingested_at")
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(at)
    iso = F.col("ingested_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}")
    return records.agg(F.count(F.lit(1)).alias("records"), F.count_if(iso & age.between(-60, 3600)).alias("stamped_now"))


