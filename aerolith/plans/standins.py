"""Adapters that present the benchmark tables in the feeds' shapes.

The benchmark tables are not sensor or air-quality data; these functions
project them into the Bronze shapes the pipeline consumes, so every operator
runs over whole tables and its work grows with them:

* air-quality Bronze: one reading per ``lineitem`` row; station = supplier,
  area = the supplier's nation, local date = ship date, local hour slot =
  line number, ingestion time = ship date + order key seconds (re-sent
  readings of a slot are de-duplicated by it), PM2.5 = quantity, SO2 =
  supplier balance / 100 (negative balances act as missing-data sentinels);
* weather Bronze: one reading per ``lineitem`` row; city = the supplier's
  nation, condition = the part's (type, brand);
* sensor Bronze: one reading per ``events`` row; sensor = user, type = event
  type, zone = ``Z0`` + (user % 5 + 1), target 50, label = beyond 3 sigma with
  the stand-in sigmas below;
* customer snapshots for SCD2: customer attributes plus the priority and
  status of the customer's latest order placed before the snapshot date: a
  first snapshot of the customers that ever order, and a last one of all
  customers, the day after the newest order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.clean import beyond_sigma, sigma_lookup
from aerolith.operators.dedup import latest_per_key
from aerolith.operators.joins import lookup, maybe_broadcast

# Stand-in parameters (not fixed values of the source system).
EVENT_TARGET = 50.0
EVENT_SIGMA = {"view": 20.0, "click": 25.0, "error": 30.0, "signup": 35.0, "purchase": 40.0}
EVENT_UNIT = "count"
SCD2_FIRST_SNAPSHOT = date(1997, 1, 1)
AS_OF_LOAD = date(2024, 1, 1)


def _iso_seconds_after(ts: str, secs: str):
    """ISO-8601 text (``yyyy-MM-ddTHH:mm:ss``) of a wall-clock time plus seconds."""
    shifted = F.timestamp_seconds(F.unix_seconds(F.col(ts).cast("timestamp")) + F.col(secs))
    return F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    return sup.join(maybe_broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left")


def with_places(spark: SparkSession, sf_dir: str, li: DataFrame) -> DataFrame:
    """Lineitem rows with their supplier and its nation, each looked up by its own size
    (the product of both, as Spark estimates their join, is over any limit)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    df = lookup(li, sup, li.l_suppkey == sup.s_suppkey)
    return lookup(df, nat, df.s_nationkey == nat.n_nationkey)


def bronze_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    df = with_places(spark, sf_dir, li)
    return df.select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("station_name_en"),
        F.lower("s_name").alias("station_name_th"),
        F.col("n_name").alias("area_en"),
        F.lower("n_name").alias("area_th"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("station_type"),
        (F.col("s_acctbal") / 1000).alias("lat"),
        F.col("s_nationkey").cast("double").alias("lon"),
        F.to_date("l_shipdate").cast("string").alias("reading_date"),
        F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00")).alias("reading_time"),
        F.col("l_quantity").alias("pm25_value"),
        F.col("l_quantity").cast("int").alias("pm25_aqi"),
        (F.col("l_extendedprice") / 1000).alias("pm10_value"),
        (F.col("l_discount") * 100).alias("o3_value"),
        (F.col("l_tax") * 100).alias("co_value"),
        (F.col("l_discount") * F.col("l_quantity")).alias("no2_value"),
        (F.col("s_acctbal") / 100).alias("so2_value"),
        F.floor(F.col("l_extendedprice") / 1000).cast("int").alias("overall_aqi"),
        F.col("l_returnflag").alias("aqi_param"),
        _iso_seconds_after("l_shipdate", "l_orderkey").alias("ingested_at"),
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    df = with_places(spark, sf_dir, li)
    df = lookup(df, part, df.l_partkey == part.p_partkey)
    ts = F.col("l_shipdate").cast("timestamp")
    return df.select(
        F.col("s_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.lit("TH").alias("country"),
        F.col("n_regionkey").cast("double").alias("lat"),
        F.col("s_nationkey").cast("double").alias("lon"),
        (F.unix_seconds(ts) + F.col("l_linenumber") * 3600 + F.col("l_suppkey")).alias("reading_ts"),
        (F.col("l_extendedprice") / 2000).alias("temp_c"),
        (F.col("l_extendedprice") / 2000 + F.col("l_tax")).alias("feels_like_c"),
        (F.lit(1000) + F.col("l_linenumber")).cast("int").alias("pressure_hpa"),
        F.col("l_quantity").cast("int").alias("humidity_pct"),
        (F.col("l_discount") * 100).alias("wind_speed_ms"),
        (F.col("l_partkey") % 360).cast("int").alias("wind_deg"),
        (F.col("l_orderkey") % 10000).cast("int").alias("visibility_m"),
        F.col("p_type").alias("weather_main"),
        F.col("p_brand").alias("weather_desc"),
        F.col("l_returnflag").alias("weather_icon"),
        _iso_seconds_after("l_shipdate", "l_orderkey").alias("ingested_at"),
    )


def bronze_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_messages(table(spark, sf_dir, "events"))


def sensor_messages(ev: DataFrame, *extra: str) -> DataFrame:
    """Events (batch or stream) -> flat sensor-reading records (and ``extra`` columns)."""
    sigma = sigma_lookup("event_type", EVENT_SIGMA)
    return ev.select(
        *extra,
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        F.concat(F.lit("Z0"), (F.col("user_id") % 5 + 1).cast("string")).alias("zone_id"),
        F.lit(EVENT_UNIT).alias("unit"),
        F.col("value"),
        F.lit(EVENT_TARGET).alias("target"),
        beyond_sigma("value", F.lit(EVENT_TARGET), sigma).alias("is_anomaly"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("reading_ts"),
        F.lit(None).cast("string").alias("ingested_at"),
    )


def last_snapshot(spark: SparkSession, sf_dir: str) -> Column:
    """The day after the newest order, from the data: every order falls before it."""
    return table(spark, sf_dir, "orders").agg(F.date_add(F.max("o_orderdate").cast("date"), 1)).scalar()


def customer_snapshot(spark: SparkSession, sf_dir: str, as_of: date | Column, known_only: bool = False) -> DataFrame:
    """Customers with the priority and status of their latest order before
    ``as_of`` (ties: greater order key), NULL where there is none yet.
    ``known_only`` leaves out customers that never order at all."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    orders = table(spark, sf_dir, "orders")
    latest = latest_per_key(
        orders.filter(F.col("o_orderdate") < day).select(
            "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus"
        ),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    cust = table(spark, sf_dir, "customer")
    if known_only:
        cust = cust.join(orders, cust.c_custkey == orders.o_custkey, "left_semi")
    return cust.join(latest, cust.c_custkey == latest.o_custkey, "left").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_mktsegment",
        F.col("o_orderpriority").alias("last_priority"),
        F.col("o_orderstatus").alias("last_status"),
    )
