"""Registered queries: history from all readings, point-in-time facts, incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators import facts, incremental
from aerolith.operators.history import VERSION, history
from aerolith.operators.joins import fits_broadcast
from aerolith.operators.scd2 import EFFECTIVE, EXPIRY
from aerolith.plans import standins as S
from aerolith.plans.oracle import CTES, with_ctes
from aerolith.plans.registry import (
    ORACLE,
    STANDIN_PM25_THRESHOLD,
    air_star,
    register,
    silver_air_of,
    silver_sensor_of,
    star_of,
)
from aerolith.session import scratch_path
from aerolith.sinks import materialize

# --- history ------------------------------------------------------------------------------


def history_sql(source: str, key: str, tracked: list[str], order: list[str], surrogate: str, type1: tuple[str, ...] = ()) -> str:
    """The last reading of each day, islands of equal days, and each island's successor."""
    attrs = [*tracked, *type1]
    latest = ", ".join(f"{c} DESC NULLS LAST" for c in [*order, *[a for a in attrs if a not in order]])
    differs = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER k" for c in tracked)
    last = "".join(f", last_value({c}) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}" for c in type1)
    return f"""
SELECT {key}, {', '.join(attrs)}, CAST(row_number() OVER (ORDER BY {key}, day) AS INTEGER) AS {surrogate}, day AS {EFFECTIVE},
       coalesce(lead(day) OVER v, DATE '9999-12-31') AS {EXPIRY}, lead(day) OVER v IS NULL AS is_current,
       CAST(row_number() OVER v AS INTEGER) AS {VERSION}
FROM (
  SELECT {key}, {', '.join(tracked)}{last}, day, row_number() OVER k = 1 OR {differs} AS starts
  FROM (SELECT *, CAST({order[0]} AS DATE) AS day FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {key}, CAST({order[0]} AS DATE) ORDER BY {latest}) = 1)
  WINDOW k AS (PARTITION BY {key} ORDER BY day))
WHERE starts WINDOW v AS (PARTITION BY {key} ORDER BY day)"""


SENSOR = ("sensor_id", ["sensor_type", "zone_id", "target", "unit"], ["reading_ts_utc"], "sensor_key")
CUSTOMER = ("o_custkey", ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "customer_key", ("o_orderstatus",))
STATION = ("station_id", ["station_name_en", "area_en", "aqi_param"], ["reading_ts_utc"], "station_key")
CTES["sensor_history"] = (("silver_sensor",), history_sql("silver_sensor", *SENSOR))
CTES["customer_history"] = ((), history_sql("orders", *CUSTOMER))
CTES["station_history"] = (("silver_air",), history_sql("silver_air", *STATION))


@register("sensor_history_backfill", with_ctes(("sensor_history",), "SELECT * FROM sensor_history"))
def q_sensor_history_backfill(spark, sf_dir):
    """Every version of every sensor, from all readings at once."""
    return history(silver_sensor_of(spark, sf_dir), *SENSOR)


@register("customer_history_backfill", with_ctes(("customer_history",), "SELECT * FROM customer_history"))
def q_customer_history_backfill(spark, sf_dir):
    """C11/H5: versions of each customer's order priority, its latest order status on all of them."""
    return history(S.table(spark, sf_dir, "orders"), *CUSTOMER)


def asof_sql(fact: str, key: str, dim: str, surrogate: str, columns: str) -> str:
    return f"""
SELECT {columns} FROM {fact} a LEFT JOIN {dim} h
ON h.{key} = a.{key} AND (h.{VERSION} = 1 OR CAST(a.reading_ts_utc AS DATE) >= h.{EFFECTIVE}) AND CAST(a.reading_ts_utc AS DATE) < h.{EXPIRY}"""


@register("fct_hourly_asof", with_ctes(("silver_air", "station_history", "dim_region"), asof_sql(
    "(SELECT s.*, region_key FROM silver_air s LEFT JOIN dim_region r ON s.area_en = r.region_name)", "station_id", "station_history", "station_key",
    """a.date_key, h.station_key, a.region_key, a.pm25_value, a.pm10_value, a.o3_value, a.co_value, a.no2_value, a.so2_value,
       a.overall_aqi, a.aqi_param, CAST(hour(a.reading_ts_utc) AS INTEGER) AS reading_hour, a.reading_date""")))
def q_fct_hourly_asof(spark, sf_dir):
    """The hourly fact with the station version valid at each reading (H5)."""
    sa, _, region = air_star(spark, sf_dir)
    versions = materialize(history(sa, *STATION), "station-history")
    return facts.fct_air_quality_hourly(sa, versions, region, mode="as_of").drop("air_quality_key")


@register("fct_sensor_asof", with_ctes(("silver_sensor", "sensor_history"), asof_sql(
    "silver_sensor", "sensor_id", "sensor_history", "sensor_key",
    "a.sensor_id, a.reading_ts_utc, a.sensor_type, a.value, h.sensor_key, h.sensor_type AS version_type")))
def q_fct_sensor_asof(spark, sf_dir):
    """Every reading with its sensor's version of that day; several versions a sensor."""
    from aerolith.operators.history import carry_lookup

    readings = silver_sensor_of(spark, sf_dir).select("sensor_id", "reading_ts_utc", "sensor_type", "value")
    versions = materialize(history(silver_sensor_of(spark, sf_dir), *SENSOR), "sensor-history")
    shown = versions.withColumnRenamed("sensor_type", "version_type")
    return carry_lookup(readings, shown, "sensor_id", "sensor_id", "reading_ts_utc", ["sensor_key", "version_type"])


# --- incremental loads ------------------------------------------------------------------------


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze as it might arrive: the newest days, and corrections of the half year before, come in a second load.

    It is written down only if making it takes a shuffle, which every reading of it would repeat.
    """
    bronze = S.bronze_air(spark, sf_dir)
    if not all(fits_broadcast(S.table(spark, sf_dir, t)) for t in ("supplier", "nation")):
        bronze = materialize(bronze, "bronze-air")
    day, last = F.to_date("reading_date"), bronze.agg(F.max(F.to_date("reading_date"))).scalar()
    corrected = (day > F.date_sub(last, 390)) & (F.second(F.to_timestamp("ingested_at")) % 2 == 1)
    second = (day > F.date_sub(last, 200)) | corrected
    return bronze.where(~second), bronze.where(second)


def loaded_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of Silver and of the daily states after both loads."""
    root = scratch_path(spark, "incremental")
    for load in two_loads(spark, sf_dir):
        touched = incremental.load_silver_air(spark, load, f"{root}/silver")
        incremental.load_daily_states(spark, f"{root}/silver", f"{root}/states", touched, STANDIN_PM25_THRESHOLD)
    return f"{root}/silver", f"{root}/states"


@register("silver_incremental", ORACLE["silver_air"])
def q_silver_incremental(spark, sf_dir):
    """Two loads with corrections leave the Silver table that one load makes."""
    return incremental.silver_rows(spark, loaded_twice(spark, sf_dir)[0]).drop(incremental.PARTITION)


@register("daily_incremental", ORACLE["fct_daily_summary"])
def q_daily_incremental(spark, sf_dir):
    """A1-A3: the daily summary from stored states, of which the second load rebuilt the touched months only."""
    silver_path, states = loaded_twice(spark, sf_dir)
    _, station, region = star_of(incremental.silver_rows(spark, silver_path))
    return incremental.daily_summary(spark.read.parquet(states), station, region)


CTES["air_months"] = (("silver_air",), "SELECT *, CAST(date_trunc('month', reading_date) AS DATE) AS month FROM silver_air")


@register("air_states_monthly", with_ctes(("air_months",), f"""
SELECT a.*, p.aqi_param AS dominant_aqi_param FROM (
  SELECT month, station_id, avg(pm25_value) AS avg_pm25, max(pm25_value) AS max_pm25, min(pm25_value) AS min_pm25,
         count(*) FILTER (WHERE pm25_value > {STANDIN_PM25_THRESHOLD}) AS hours_exceeding_threshold
  FROM air_months GROUP BY month, station_id) a
LEFT JOIN (
  SELECT month, station_id, aqi_param FROM air_months WHERE aqi_param IS NOT NULL GROUP BY month, station_id, aqi_param
  QUALIFY row_number() OVER (PARTITION BY month, station_id ORDER BY count(*) DESC, aqi_param) = 1) p
ON p.month = a.month AND p.station_id = a.station_id"""))
def q_air_states_monthly(spark, sf_dir):
    """A1-A3 at a coarser grain: daily states add up to months without the readings."""
    states = incremental.daily_states(silver_air_of(spark, sf_dir), STANDIN_PM25_THRESHOLD)
    return incremental.finish_states(states.withColumn("month", F.trunc("reading_date", "month")), ["month", "station_id"])
