"""Analytic marts over the Gold star: saved queries, live view, business questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.constants import (
    LIVE_LOOKBACK_MINUTES,
    LIVE_ROWS,
    PM25_GUIDELINE,
    PM25_THRESHOLD,
)
from aerolith.operators.joins import maybe_broadcast
from aerolith.operators.scd2 import current_versions


def _avg(col: str, digits: int | None):
    a = F.avg(col)
    return F.round(a, digits) if digits is not None else a


def top_polluted_stations(
    fct_air: DataFrame, dim_station: DataFrame, k: int = 10, digits: int | None = None
) -> DataFrame:
    """Q1: stations by average PM2.5 (non-null readings), top ``k``.

    Join to the station's current version; ties on the average are broken
    by name and area so the top-k set is deterministic.
    """
    st = current_versions(dim_station).select("station_key", "station_name_en", "area_en")
    df = fct_air.filter(F.col("pm25_value").isNotNull()).join(maybe_broadcast(st), "station_key")
    agg = df.groupBy("station_name_en", "area_en").agg(
        _avg("pm25_value", digits).alias("avg_pm25"),
        F.max("pm25_value").alias("max_pm25"),
        F.count(F.lit(1)).alias("hourly_readings"),
    )
    return agg.orderBy(F.desc("avg_pm25"), "station_name_en", "area_en").limit(k)


def weather_by_city_day(
    fct_weather: DataFrame, dim_weather_condition: DataFrame, digits: int | None = None
) -> DataFrame:
    """Q2: average temperature, humidity and wind per city, day and condition.

    Aggregated by condition key first, named last. Sorted by city and day;
    ``city_row`` is a row's place among its city's rows.
    """
    per_key = fct_weather.groupBy("city_name", "reading_date", "weather_condition_key").agg(
        _avg("temp_c", digits).alias("avg_temp_c"),
        _avg("humidity_pct", digits).alias("avg_humidity_pct"),
        _avg("wind_speed_ms", digits).alias("avg_wind_ms"),
        F.count(F.lit(1)).alias("hourly_readings"),
    )
    wc = dim_weather_condition.select("weather_condition_key", "weather_main", "weather_description")
    named = per_key.join(maybe_broadcast(wc), "weather_condition_key").drop("weather_condition_key")
    in_city = Window.partitionBy("city_name").orderBy("reading_date", "weather_main", "weather_description")
    return named.withColumn("city_row", F.row_number().over(in_city)).orderBy("city_name", "city_row")


def scd2_history(dim: DataFrame, natural_key: str, attributes: list[str]) -> DataFrame:
    """Q3: superseded (non-current) versions, ordered by key and start date."""
    return (
        dim.filter(F.col("is_current") == F.lit(False))
        .select(natural_key, *attributes, "effective_date", "expiry_date", "is_current")
        .orderBy(natural_key, "effective_date")
    )


def key_versions(dim: DataFrame, natural_key: str, value, attributes: list[str]) -> DataFrame:
    """All versions of one natural key, oldest first."""
    return (
        dim.filter(F.col(natural_key) == (value if isinstance(value, Column) else F.lit(value)))
        .select(natural_key, *attributes, "effective_date", "expiry_date", "is_current")
        .orderBy("effective_date")
    )


# --- live view over the hot-path table (Q4-Q6) ---------------------------------------


def recent_window(hot: DataFrame, as_of, lookback_minutes: int = LIVE_LOOKBACK_MINUTES) -> DataFrame:
    """Aggregates whose window starts within ``lookback_minutes`` before
    ``as_of`` (a timestamp literal or a scalar column), compared as timestamps."""
    t = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return hot.filter(F.col("window_start") >= t - F.make_dt_interval(mins=F.lit(lookback_minutes)))


def live_kpis(recent: DataFrame, approx: bool = False) -> DataFrame:
    """Q4: one row — windows, anomalous windows, anomaly %, active sensors
    (``approx=True``: HyperLogLog++ distinct count, a fixed-size sketch per
    partition instead of shuffling every distinct sensor id)."""
    distinct = F.approx_count_distinct("sensor_id") if approx else F.count_distinct("sensor_id")
    agg = recent.agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomalies_detected"),
        distinct.alias("active_sensors"),
    )
    return agg.withColumn(
        "anomaly_pct",
        F.when(F.col("total_readings") > 0, F.col("anomalies_detected") * 100.0 / F.col("total_readings")),
    )


def live_anomalies(recent: DataFrame) -> DataFrame:
    """Q5: anomalous windows (before any zone filter)."""
    return recent.filter(F.col("is_anomaly") == F.lit(True)).select(
        "sensor_id", "sensor_type", "zone_id", "avg_value", "target_value", "window_start"
    )


def recent_aggregates(
    recent: DataFrame, anomalies_only: bool = False, zone: str | None = None, n: int = LIVE_ROWS
) -> DataFrame:
    """Q6: optional filters, newest ``n`` windows (ties by sensor id)."""
    df = recent
    if anomalies_only:
        df = df.filter(F.col("is_anomaly") == F.lit(True))
    if zone and zone != "All":
        df = df.filter(F.col("zone_id") == F.lit(zone))
    cols = [c for c in ("sensor_id", "sensor_type", "zone_id", "avg_value", "target_value", "is_anomaly",
                        "reading_count", "window_start") if c in df.columns]
    return df.select(*cols).orderBy(F.desc("window_start"), "sensor_id").limit(n)


def hour_sketches(hot: DataFrame, lg_k: int = 14) -> DataFrame:
    """Per hour: counts and a HyperLogLog sketch of its sensors, a few KB whatever the number of windows."""
    return hot.groupBy(F.date_trunc("hour", "window_start").alias("hour")).agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomalies"),
        F.hll_sketch_agg("sensor_id", F.lit(lg_k)).alias("sensors"),
    )


def live_kpis_from_sketches(sketches: DataFrame) -> DataFrame:
    """Q4 from stored hours: counts add up, sketches merge; no window is read again."""
    agg = sketches.agg(
        F.sum("windows").alias("total_readings"),
        F.sum("anomalies").alias("anomalies_detected"),
        F.hll_sketch_estimate(F.hll_union_agg("sensors")).alias("active_sensors"),
    )
    return agg.withColumn(
        "anomaly_pct",
        F.when(F.col("total_readings") > 0, F.col("anomalies_detected") * 100.0 / F.col("total_readings")),
    )


# --- documented business questions (B1-B12) ------------------------------------------


def b1_pm25_by_region_month(fct_air: DataFrame, dim_region: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average PM2.5 per region per calendar month (star join to region and date)."""
    r = dim_region.select("region_key", "region_name")
    d = dim_date.select("date_key", "year", "month")
    df = fct_air.join(maybe_broadcast(r), "region_key").join(maybe_broadcast(d), "date_key")
    return df.groupBy("region_name", "year", "month").agg(
        F.avg("pm25_value").alias("avg_pm25"), F.count("pm25_value").alias("readings")
    )


def b2_threshold_exceedance(
    fct_air: DataFrame, dim_station: DataFrame, threshold: float = PM25_THRESHOLD, k: int = 10
) -> DataFrame:
    """Stations most often above ``threshold`` (strict); top ``k``."""
    st = current_versions(dim_station).select("station_key", "station_id", "station_name_en")
    df = fct_air.join(maybe_broadcast(st), "station_key")
    agg = df.groupBy("station_id", "station_name_en").agg(
        F.count_if(F.col("pm25_value") > F.lit(float(threshold))).alias("hours_exceeding"),
        F.count("pm25_value").alias("readings"),
    )
    return agg.orderBy(F.desc("hours_exceeding"), "station_id").limit(k)


def b3_air_weather_correlation(fct_air: DataFrame, dim_region: DataFrame | None, fct_weather: DataFrame,
                               grain: str = "hour") -> DataFrame:
    """Correlation of PM2.5 with humidity and wind, matching a station's region
    to the weather city. Both sides are first aggregated to the join grain
    (city, date_key[, hour]) so the join is one-to-one, never all pairs.
    Without ``dim_region`` the readings name their region themselves."""
    keys = ["city", "date_key"] + (["hour"] if grain == "hour" else [])
    air = fct_air
    if dim_region is not None:
        air = fct_air.join(maybe_broadcast(dim_region.select("region_key", "region_name")), "region_key")
    air = air.select(F.col("region_name").alias("city"), "date_key", F.col("reading_hour").alias("hour"), "pm25_value")
    w = fct_weather.select(
        F.col("city_name").alias("city"), "date_key", F.hour("reading_ts_utc").alias("hour"),
        "humidity_pct", "wind_speed_ms",
    )
    a = air.groupBy(*keys).agg(F.avg("pm25_value").alias("pm25"))
    b = w.groupBy(*keys).agg(F.avg("humidity_pct").alias("humidity"), F.avg("wind_speed_ms").alias("wind"))
    j = a.join(b, keys)
    return j.agg(
        F.corr("pm25", "humidity").alias("corr_pm25_humidity"),
        F.corr("pm25", "wind").alias("corr_pm25_wind"),
        F.count(F.lit(1)).alias("matched_periods"),
    )


def b4_worst_local_hour(fct_air: DataFrame, offset_hours: int = 7) -> DataFrame:
    """Average PM2.5 by local hour of day (UTC hour + fixed offset)."""
    local = ((F.col("reading_hour") + F.lit(offset_hours)) % 24).alias("local_hour")
    return fct_air.groupBy(local).agg(F.avg("pm25_value").alias("avg_pm25"), F.count("pm25_value").alias("readings"))


def b5_aqi_driver_frequency(fct_air: DataFrame) -> DataFrame:
    """How often each parameter drives the AQI, with its share of readings."""
    counts = fct_air.groupBy("aqi_param").agg(F.count(F.lit(1)).alias("readings"))
    total = F.sum("readings").over(Window.partitionBy(F.lit(0)))  # over the few counts, not a second pass over the fact
    return counts.withColumn("share_pct", F.col("readings") * 100.0 / total)


def _last_days(df: DataFrame, days: int, as_of=None, dim_date: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` (default: the newest date of ``df``, read from it).

    With ``dim_date`` the days come from the calendar: on a table partitioned
    by ``reading_date`` Spark prunes the scan to the folders of those days
    (dynamic partition pruning), however the days were chosen.
    """
    end = df.agg(F.max("reading_date")).scalar() if as_of is None else F.lit(as_of).cast("date")
    if dim_date is None:
        return df.filter(F.col("reading_date") > F.date_sub(end, days))
    recent = dim_date.filter((F.col("full_date") > F.date_sub(end, days)) & (F.col("full_date") <= end)).select("full_date")
    return df.join(maybe_broadcast(recent), F.col("reading_date") == F.col("full_date")).drop("full_date")


def b6_zone_anomaly_rates(
    fct_sensor: DataFrame, dim_zone: DataFrame, days: int = 7, as_of=None, dim_date: DataFrame | None = None
) -> DataFrame:
    """Per zone over the last ``days`` days up to ``as_of`` (default: latest date)."""
    df = _last_days(fct_sensor, days, as_of, dim_date).join(maybe_broadcast(dim_zone.select("zone_key", "zone_id")), "zone_key")
    agg = df.groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomalies")
    )
    return agg.withColumn("anomaly_pct", F.col("anomalies") * 100.0 / F.col("readings"))


def b7_zone_trend(
    fct_sensor: DataFrame, dim_zone: DataFrame, dim_sensor_type: DataFrame, sensor_type: str = "temperature",
    days: int = 30, as_of=None, moving: int = 7, dim_date: DataFrame | None = None,
) -> DataFrame:
    """Daily average per zone for one sensor type over ``days`` days, with a
    ``moving``-day moving average (window over the small daily series)."""
    t = dim_sensor_type.filter(F.col("sensor_type") == F.lit(sensor_type)).select("sensor_type_key")
    df = _last_days(fct_sensor, days, as_of, dim_date).join(maybe_broadcast(t), "sensor_type_key", "left_semi")
    df = df.join(maybe_broadcast(dim_zone.select("zone_key", "zone_id")), "zone_key")
    daily = df.groupBy("zone_id", "reading_date").agg(F.avg("value").alias("avg_value"))
    w = Window.partitionBy("zone_id").orderBy("reading_date").rowsBetween(-(moving - 1), 0)
    return daily.withColumn("moving_avg", F.avg("avg_value").over(w))


def b8_sensor_drift(fct_sensor: DataFrame, dim_sensor: DataFrame, k: int = 10) -> DataFrame:
    """Sensors with the largest mean absolute deviation from target; top ``k``."""
    s = dim_sensor.select("sensor_key", "sensor_id")
    df = fct_sensor.join(maybe_broadcast(s), "sensor_key")
    agg = df.groupBy("sensor_id").agg(F.avg(F.abs("deviation")).alias("mean_abs_deviation"),
                                      F.count(F.lit(1)).alias("readings"))
    return agg.orderBy(F.desc("mean_abs_deviation"), "sensor_id").limit(k)


def b9_anomalies_by_type_day(fct_sensor: DataFrame, dim_sensor_type: DataFrame) -> DataFrame:
    """Anomaly count per sensor type per day."""
    t = dim_sensor_type.select("sensor_type_key", "sensor_type")
    df = fct_sensor.filter(F.col("is_anomaly") == F.lit(True)).join(maybe_broadcast(t), "sensor_type_key")
    return df.groupBy("sensor_type", "reading_date").agg(F.count(F.lit(1)).alias("anomalies"))


def b10_type_pair_correlation(
    fct_sensor: DataFrame, dim_zone: DataFrame, dim_sensor_type: DataFrame,
    type_a: str = "pressure", type_b: str = "flow", bucket: str = "1 minute",
) -> DataFrame:
    """Per zone, correlation of the bucket means of two sensor types (a
    two-value pivot by conditional aggregation, then ``corr``)."""
    t = dim_sensor_type.select("sensor_type_key", "sensor_type")
    z = dim_zone.select("zone_key", "zone_id")
    df = fct_sensor.join(maybe_broadcast(t), "sensor_type_key").join(maybe_broadcast(z), "zone_key")
    df = df.filter(F.col("sensor_type").isin(type_a, type_b))
    b = df.groupBy("zone_id", F.window("reading_ts_utc", bucket).alias("bucket")).agg(
        F.avg(F.when(F.col("sensor_type") == F.lit(type_a), F.col("value"))).alias("a"),
        F.avg(F.when(F.col("sensor_type") == F.lit(type_b), F.col("value"))).alias("b"),
    )
    return b.groupBy("zone_id").agg(
        F.corr("a", "b").alias("correlation"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("paired_buckets"),
    )


def b11_share_above(fct_air: DataFrame, threshold: float = PM25_GUIDELINE) -> DataFrame:
    """Share of (non-null) hourly readings above ``threshold``."""
    v = F.col("pm25_value")
    return fct_air.filter(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_if(v > F.lit(float(threshold))).alias("hours_above"),
        F.avg((v > F.lit(float(threshold))).cast("int")).alias("share_above"),
    )


def b12_hot_cold_reconciliation(hot: DataFrame, cold_readings: DataFrame,
                                ts_col: str = "reading_ts_utc", duration: str = "1 minute") -> DataFrame:
    """Compare hot-path anomaly counts with the cold path's, per (sensor,
    window): totals, delta and the number of keys whose counts differ."""
    cold = cold_readings.filter(F.col("is_anomaly") == F.lit(True)).groupBy(
        "sensor_id", F.window(ts_col, duration).start.alias("window_start")
    ).agg(F.count(F.lit(1)).alias("cold_count"))
    h = hot.filter(F.col("anomaly_count") > 0).select("sensor_id", "window_start", F.col("anomaly_count").alias("hot_count"))
    j = h.join(cold, ["sensor_id", "window_start"], "full_outer")
    hc, cc = F.coalesce("hot_count", F.lit(0)), F.coalesce("cold_count", F.lit(0))
    return j.agg(
        F.sum(hc).cast("long").alias("hot_anomalies"),
        F.sum(cc).cast("long").alias("cold_anomalies"),
        (F.sum(cc) - F.sum(hc)).cast("long").alias("delta"),
        F.count_if(hc != cc).alias("mismatched_windows"),
    )
