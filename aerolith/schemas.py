"""Declared schemas: raw API payloads, Bronze records and the hot-path store.

One ``StructType`` per feed, used both when parsing JSON and when reading
files, so column types never drift between batches.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


def _value(*names: str) -> StructType:
    return StructType(_s(*names))


# Air-quality station document as returned by the API (numbers as text).
AIR_API = StructType(
    _s("stationID", "nameEN", "nameTH", "areaEN", "areaTH", "stationType", "lat", "long")
    + [
        StructField(
            "AQILast",
            StructType(
                _s("date", "time")
                + [
                    StructField("PM25", _value("value", "aqi")),
                    StructField("PM10", _value("value")),
                    StructField("O3", _value("value")),
                    StructField("CO", _value("value")),
                    StructField("NO2", _value("value")),
                    StructField("SO2", _value("value")),
                    StructField("AQI", _value("aqi", "param")),
                ]
            ),
        )
    ]
)

# City weather document as returned by the API.
WEATHER_API = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("dt", LongType()),
        StructField("visibility", IntegerType()),
        StructField("coord", StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])),
        StructField("sys", StructType([StructField("country", StringType())])),
        StructField(
            "main",
            StructType(
                [
                    StructField("temp", DoubleType()),
                    StructField("feels_like", DoubleType()),
                    StructField("pressure", IntegerType()),
                    StructField("humidity", IntegerType()),
                ]
            ),
        ),
        StructField("wind", StructType([StructField("speed", DoubleType()), StructField("deg", IntegerType())])),
        StructField("weather", ArrayType(_value("main", "description", "icon"))),
    ]
)

BRONZE_AIR = StructType(
    _s("station_id", "station_name_en", "station_name_th", "area_en", "area_th", "station_type")
    + [StructField("lat", DoubleType()), StructField("lon", DoubleType())]
    + _s("reading_date", "reading_time")
    + [
        StructField("pm25_value", DoubleType()),
        StructField("pm25_aqi", IntegerType()),
        StructField("pm10_value", DoubleType()),
        StructField("o3_value", DoubleType()),
        StructField("co_value", DoubleType()),
        StructField("no2_value", DoubleType()),
        StructField("so2_value", DoubleType()),
        StructField("overall_aqi", IntegerType()),
    ]
    + _s("aqi_param", "ingested_at")
)

BRONZE_WEATHER = StructType(
    [
        StructField("city_id", LongType()),
        StructField("city_name", StringType()),
        StructField("country", StringType()),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField("reading_ts", LongType()),
        StructField("temp_c", DoubleType()),
        StructField("feels_like_c", DoubleType()),
        StructField("pressure_hpa", IntegerType()),
        StructField("humidity_pct", IntegerType()),
        StructField("wind_speed_ms", DoubleType()),
        StructField("wind_deg", IntegerType()),
        StructField("visibility_m", IntegerType()),
    ]
    + _s("weather_main", "weather_desc", "weather_icon", "ingested_at")
)

BRONZE_SENSOR = StructType(
    _s("sensor_id", "sensor_type", "zone_id", "unit")
    + [
        StructField("value", DoubleType()),
        StructField("target", DoubleType()),
        StructField("is_anomaly", BooleanType()),
    ]
    + _s("reading_ts", "ingested_at")
)

BRONZE = {"air_quality": BRONZE_AIR, "weather": BRONZE_WEATHER, "sensor_readings": BRONZE_SENSOR}
