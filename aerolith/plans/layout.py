"""Registered queries: drifting documents, bucketed tables, stored sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aerolith.operators import facts
from aerolith.operators.dedup import latest_per_key
from aerolith.operators.drift import AIR_FIELDS, flatten_variant
from aerolith.plans import marts, standins as S
from aerolith.plans.oracle import with_ctes
from aerolith.plans.registry import LIVE_DAYS, ORACLE, hot_of, register, silver_air_of, star_of
from aerolith.session import scratch_path
from aerolith.sinks import materialize, write_bucketed

# --- documents whose shape drifts ------------------------------------------------------------


def drifting_documents(spark, sf_dir):
    """Station documents of several generations, broken ones among them, by their contents."""
    b = S.bronze_air(spark, sf_dir)
    txt = lambda c: F.col(c).cast("string")
    quoted = lambda c: F.concat(F.lit('"'), txt(c), F.lit('"'))
    newer = F.col("station_type") == "R1"  # numbers as numbers, a firmware field, a unit inside PM25
    odd = F.col("reading_time") == "06:00"  # an object where PM10's number belongs
    vague = F.col("reading_time") == "05:00"  # a text that is no number
    pm25 = F.concat(
        F.lit('{"value":'), F.when(newer, txt("pm25_value")).otherwise(quoted("pm25_value")),
        F.lit(',"aqi":'), quoted("pm25_aqi"), F.when(newer, F.lit(',"unit":"ug"')).otherwise(F.lit("")), F.lit("}"),
    )
    pm10 = F.when(odd, F.lit('{"low":1}')).when(vague, F.lit('"n/a"')).otherwise(quoted("pm10_value"))
    text = F.concat(
        F.lit('{"stationID":"'), F.when(F.col("reading_time") == "04:00", F.lit(" ")).otherwise(F.col("station_id")),
        F.lit('","AQILast":{"date":"'), F.col("reading_date"), F.lit('","time":"'), F.col("reading_time"),
        F.lit('","PM25":'), pm25, F.lit(',"PM10":{"value":'), pm10, F.lit("}}"),
        F.when(newer, F.concat(F.lit(',"firmware":{"flag":"'), F.col("aqi_param"), F.lit('"}'))).otherwise(F.lit("")), F.lit("}"),
    )
    cut = (F.col("aqi_param") == "R") & (F.col("reading_time") == "07:00")
    return b.select(F.when(cut, F.substring(text, 1, 30)).otherwise(text).alias("value"), F.col("ingested_at"))


@register("flatten_variant", with_ctes(("bronze_air",), """
SELECT ingested_at,
       CASE WHEN malformed THEN NULL WHEN reading_time = '04:00' THEN ' ' ELSE station_id END AS station_id,
       CASE WHEN NOT malformed THEN reading_date END AS reading_date, CASE WHEN NOT malformed THEN reading_time END AS reading_time,
       CASE WHEN NOT malformed THEN pm25_value END AS pm25_value, CASE WHEN NOT malformed THEN pm25_aqi END AS pm25_aqi,
       CASE WHEN NOT malformed AND reading_time NOT IN ('05:00', '06:00') THEN pm10_value END AS pm10_value,
       CASE WHEN NOT malformed AND station_type = 'R1' THEN 'AQILast.PM25.unit="ug";firmware={"flag":"' || aqi_param || '"}' ELSE '' END AS extras,
       CASE WHEN malformed THEN 'malformed'
            ELSE concat_ws(';', CASE WHEN reading_time IN ('05:00', '06:00') THEN 'wrong type: pm10_value' END,
                           CASE WHEN reading_time = '04:00' THEN 'missing id' END) END AS reasons,
       malformed OR reading_time = '04:00' AS rejected
FROM (SELECT *, aqi_param = 'R' AND reading_time = '07:00' AS malformed FROM bronze_air)"""))
def q_flatten_variant(spark, sf_dir):
    """Every document becomes a row; undeclared fields and unreadable ones are kept and named."""
    found = flatten_variant(drifting_documents(spark, sf_dir), AIR_FIELDS, id_column="station_id")
    pairs = F.array_sort(F.transform(F.map_entries("extras"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select(
        "ingested_at", "station_id", "reading_date", "reading_time", "pm25_value", "pm25_aqi", "pm10_value",
        F.array_join(pairs, ";").alias("extras"), F.array_join("reasons", ";").alias("reasons"), "rejected",
    )


# --- bucketed tables --------------------------------------------------------------------------

BUCKETS = 8


def bucketed_star(spark, sf_dir):
    """Silver and the station dimension as catalog tables bucketed by station; the fact from them."""
    name = f"aerolith_{uuid.uuid4().hex[:12]}"
    sa, dim_station, dim_region = star_of(materialize(silver_air_of(spark, sf_dir), "silver-air"))
    key = ["station_id"]
    silver = write_bucketed(sa, f"{name}_silver", scratch_path(spark, "bucketed-silver"), BUCKETS, key)
    stations = write_bucketed(dim_station, f"{name}_station", scratch_path(spark, "bucketed-station"), BUCKETS, key)
    slots = latest_per_key(silver, ["station_id", "reading_ts_utc"], ["ingested_at"])
    keyed = slots.join(stations.where("is_current").select("station_id", "station_key").hint("merge"), "station_id", "left")
    return keyed, dim_region


@register("star_bucketed", ORACLE["fct_hourly"])
def q_star_bucketed(spark, sf_dir):
    """De-duplication and star join on the bucket key, without an exchange of the fact."""
    keyed, dim_region = bucketed_star(spark, sf_dir)
    regions = dim_region.select("region_key", F.col("region_name").alias("area_en"))
    out = keyed.join(F.broadcast(regions), "area_en", "left").withColumn("reading_hour", F.hour("reading_ts_utc"))
    return out.select(*facts.AIR_HOURLY_COLUMNS)


# --- sketches -----------------------------------------------------------------------------------


@register("live_kpis_sketch", with_ctes(("recent_days",), """
SELECT count(*) AS total_readings, count(*) FILTER (WHERE is_anomaly) AS anomalies_detected,
       count(DISTINCT sensor_id) AS active_sensors,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE is_anomaly) * 100.0 / count(*) END AS anomaly_pct, true AS within_3_pct
FROM recent_days"""))
def q_live_kpis_sketch(spark, sf_dir):
    """The KPI row from stored hours; the sketches' union beside the exact number of sensors."""
    hot, as_of = hot_of(spark, sf_dir)
    recent = materialize(marts.recent_window(hot, as_of, LIVE_DAYS * 24 * 60), "recent")
    stored = materialize(marts.hour_sketches(recent), "hour-sketches")
    kpis = marts.live_kpis_from_sketches(stored).withColumn("exact", recent.agg(F.count_distinct("sensor_id")).scalar())
    near = F.abs(F.col("active_sensors") - F.col("exact")) <= F.col("exact") * 0.03
    return kpis.select("total_readings", "anomalies_detected", F.col("exact").alias("active_sensors"), "anomaly_pct", near.alias("within_3_pct"))
