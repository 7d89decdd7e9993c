"""Gold fact tables (star-schema loads by surrogate-key lookup)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.constants import PM25_THRESHOLD
from aerolith.operators.history import carry_lookup
from aerolith.operators.joins import lookup, maybe_broadcast
from aerolith.operators.keys import hash_key, run_key, wide_key
from aerolith.operators.scd2 import current_versions


def _fact_key(kind: str, natural: list[str]) -> Column:
    if kind == "hash":
        return hash_key(natural)
    if kind == "wide":
        return wide_key(natural)
    if kind == "run":
        return run_key()
    raise ValueError(f"unknown key kind {kind!r}")


def _station_keys(silver_air: DataFrame, dim_station: DataFrame, mode: str) -> DataFrame:
    if mode == "current":
        return lookup(
            silver_air, current_versions(dim_station).select("station_id", "station_key"), "station_id"
        )
    if mode == "as_of":
        return carry_lookup(
            silver_air, dim_station, "station_id", "station_id", "reading_ts_utc", ["station_key"]
        )
    raise ValueError(f"unknown mode {mode!r}")


def _air_keys(silver_air: DataFrame, dim_station: DataFrame, dim_region: DataFrame, mode: str) -> DataFrame:
    df = _station_keys(silver_air, dim_station, mode)
    regions = dim_region.select("region_key", "region_name")
    return df.join(maybe_broadcast(regions), F.col("area_en") == F.col("region_name"), "left").drop(
        "region_name"
    )


AIR_HOURLY_COLUMNS = (
    "date_key", "station_key", "region_key", "pm25_value", "pm10_value", "o3_value",
    "co_value", "no2_value", "so2_value", "overall_aqi", "aqi_param", "reading_hour",
    "reading_date",
)


def unknown_member(df: DataFrame, key_cols, value: int = -1) -> DataFrame:
    """Replace NULL dimension keys (no matching member) by ``value``."""
    return df.fillna({c: value for c in key_cols})


def observe_unmatched(df: DataFrame, key_cols, name: str = "unmatched"):
    """Attach per-key NULL counts, collected in whichever pass writes ``df``.

    Returns ``(df, observation)``; ``observation.get`` holds
    ``{"rows": n, "<key>_unmatched": m, ...}`` after the action.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"{c}_unmatched") for c in key_cols
    ]
    return df.observe(obs, *metrics), obs


CALENDAR_KEY = "calendar_key"


def with_calendar_key(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``fact`` with the calendar's own key of its day, NULL where the calendar ends."""
    days = dim_date.select("date_key", F.col("date_key").alias(CALENDAR_KEY))
    return fact.join(maybe_broadcast(days), "date_key", "left").select(*fact.columns, CALENDAR_KEY)


def fct_air_quality_hourly(
    silver_air: DataFrame,
    dim_station: DataFrame,
    dim_region: DataFrame,
    mode: str = "current",
    key: str = "hash",
    unknown_key: int | None = None,
    columns: Sequence[str] = AIR_HOURLY_COLUMNS,
) -> DataFrame:
    """One row per Silver air reading with station and region keys.

    ``mode="as_of"`` picks the station version valid at the reading time.
    ``air_quality_key`` is a stable 64-bit hash of (station_id, reading_ts_utc)
    by default; ``key="wide"`` gives 128 bits, ``key="run"`` the per-run unique id. Unmatched keys stay
    NULL unless ``unknown_key`` (e.g. -1) names an unknown member. ``columns``
    may name fewer: Silver then needs no others.
    """
    df = _air_keys(silver_air, dim_station, dim_region, mode)
    if unknown_key is not None:
        df = unknown_member(df, ["station_key", "region_key"], unknown_key)
    df = df.withColumns(
        {
            "reading_hour": F.hour("reading_ts_utc"),
            "air_quality_key": _fact_key(key, ["station_id", "reading_ts_utc"]),
        }
    )
    return df.select("air_quality_key", *columns)


def fct_pollution_daily_summary(
    silver_air: DataFrame,
    dim_station: DataFrame,
    dim_region: DataFrame,
    threshold: float = PM25_THRESHOLD,
    dominant: str = "mode",
    digits: int | None = None,
    mode: str = "current",
    key: str = "hash",
) -> DataFrame:
    """Per station per day: avg/max/min PM2.5, hours above ``threshold``
    (strict, NULL not counted), dominant AQI parameter.

    ``dominant="mode"`` is the most frequent parameter (ties -> smallest
    value); ``"first"`` is the original job's arbitrary pick. Grain is
    ``(date_key, station_key, region_key)`` plus ``reading_date``; Silver
    built with ``silver_air(compat=True)`` keeps the local ``reading_date``,
    which splits a UTC day in two as the original job does.
    """
    df = _air_keys(silver_air, dim_station, dim_region, mode)
    avg = F.avg("pm25_value")
    if dominant == "mode":
        dom = F.mode("aqi_param", deterministic=True)
    elif dominant == "first":
        dom = F.first("aqi_param")
    else:
        raise ValueError(f"unknown dominant {dominant!r}")
    grain = ["date_key", "station_key", "region_key", "reading_date"]
    out = df.groupBy(*grain).agg(
        (F.round(avg, digits) if digits is not None else avg).alias("avg_pm25"),
        F.max("pm25_value").alias("max_pm25"),
        F.min("pm25_value").alias("min_pm25"),
        F.count_if(F.col("pm25_value") > F.lit(float(threshold))).alias("hours_exceeding_threshold"),
        dom.alias("dominant_aqi_param"),
    )
    return out.withColumn(
        "daily_summary_key", _fact_key(key, ["date_key", "station_key", "region_key", "reading_date"])
    )


SENSOR_READING_COLUMNS = (
    "date_key", "sensor_key", "zone_key", "value", "target", "deviation", "is_anomaly",
    "reading_ts_utc", "reading_date",
)


def fct_sensor_reading(
    silver_sensor: DataFrame,
    dim_sensor: DataFrame,
    dim_zone: DataFrame,
    dim_sensor_type: DataFrame | None = None,
    mode: str = "current",
    key: str = "hash",
    unknown_key: int | None = None,
) -> DataFrame:
    """One row per Silver sensor reading with sensor, zone (and type) keys."""
    if mode == "current":
        df = lookup(silver_sensor, current_versions(dim_sensor).select("sensor_id", "sensor_key"), "sensor_id")
    else:
        df = carry_lookup(silver_sensor, dim_sensor, "sensor_id", "sensor_id", "reading_ts_utc", ["sensor_key"])
    df = lookup(df, dim_zone.select("zone_id", "zone_key"), "zone_id")
    cols = list(SENSOR_READING_COLUMNS)
    if dim_sensor_type is not None:
        types = dim_sensor_type.select(F.col("sensor_type").alias("__t"), F.col("unit").alias("__u"), "sensor_type_key")
        same = F.col("sensor_type").eqNullSafe(F.col("__t")) & F.col("unit").eqNullSafe(F.col("__u"))
        df = lookup(df, types, same).drop("__t", "__u")
        cols.insert(3, "sensor_type_key")
    if unknown_key is not None:
        df = unknown_member(df, [c for c in ("sensor_key", "zone_key", "sensor_type_key") if c in df.columns], unknown_key)
    df = df.withColumn("sensor_reading_key", _fact_key(key, ["sensor_id", "reading_ts_utc"]))
    return df.select("sensor_reading_key", *cols)


WEATHER_HOURLY_COLUMNS = (
    "date_key", "weather_condition_key", "city_id", "city_name", "temp_c", "feels_like_c",
    "pressure_hpa", "humidity_pct", "wind_speed_ms", "wind_deg", "visibility_m",
    "reading_ts_utc", "reading_date",
)


def fct_weather_hourly(
    silver_weather: DataFrame,
    dim_weather_condition: DataFrame,
    dim_date: DataFrame | None = None,
    key: str = "hash",
    columns: Sequence[str] = WEATHER_HOURLY_COLUMNS,
) -> DataFrame:
    """One row per city reading with its weather-condition key.

    The condition is looked up on (main, description), the dimension's grain,
    so each reading matches at most one member. (Joining on ``weather_main``
    alone, as the original job does, repeats a reading once per description
    of its main condition — a many-to-many fan-out that is not reproduced.)
    ``dim_date`` (optional) is a conformance check: the left join adds no
    columns; use :func:`unmatched_dates` to report keys missing from it.
    ``columns`` may name fewer: Silver then needs no others.
    """
    conds = dim_weather_condition.select(
        F.col("weather_main").alias("__m"), F.col("weather_description").alias("__d"), "weather_condition_key"
    )
    # A member may lack a description; NULL matches NULL there.
    same = (F.col("weather_main") == F.col("__m")) & F.col("weather_desc").eqNullSafe(F.col("__d"))
    df = lookup(silver_weather, conds, same).drop("__m", "__d")
    if dim_date is not None:
        df = df.join(maybe_broadcast(dim_date.select("date_key")), "date_key", "left")
    df = df.withColumn("weather_hourly_key", _fact_key(key, ["city_id", "reading_ts_utc", "weather_condition_key"]))
    return df.select("weather_hourly_key", *columns)


def unmatched_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact ``date_key`` values absent from ``dim_date`` (left anti join)."""
    return fact.select("date_key").distinct().join(maybe_broadcast(dim_date.select("date_key")), "date_key", "left_anti")


ANOMALY_EVENT_COLUMNS = (
    "date_key", "sensor_key", "zone_key", "value", "target", "deviation", "reading_ts_utc",
    "reading_date",
)


def fct_sensor_anomaly_event(fct_sensor: DataFrame, key: str = "hash") -> DataFrame:
    """Anomalous readings only; keys inherited from the reading fact."""
    df = fct_sensor.filter(F.col("is_anomaly") == F.lit(True))
    k = _fact_key(key, ["sensor_reading_key"])
    return df.select(k.alias("anomaly_event_key"), *ANOMALY_EVENT_COLUMNS)


def anomaly_rate(fct_sensor: DataFrame) -> DataFrame:
    """One pass: total readings, anomalies and percentage (0 when empty)."""
    agg = fct_sensor.agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomaly_events"),
    )
    return agg.withColumn(
        "anomaly_pct",
        F.when(F.col("total_readings") > 0, F.col("anomaly_events") * 100.0 / F.col("total_readings")).otherwise(
            F.lit(0.0)
        ),
    )
