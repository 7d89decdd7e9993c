"""Raw API documents -> flat Bronze records (with a quarantine of rejects)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.clean import non_blank, null_sentinels
from aerolith.functions.json import CORRUPT, is_malformed, parse_payload
from aerolith.schemas import AIR_API, WEATHER_API

_P = "payload"


def _ingested(df: DataFrame, ingested_col: str | None) -> Column:
    if ingested_col and ingested_col in df.columns:
        return F.col(ingested_col).cast("string")
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def _split(parsed: DataFrame, good_cond: Column, value_col: str, reason: Column):
    good = parsed.filter(good_cond)
    bad = parsed.filter(~good_cond).select(
        F.col(value_col).cast("string").alias("raw"), reason.alias("reason")
    )
    return good, bad


AIR_NUMBERS = ("lat", "lon", "pm25_value", "pm25_aqi", "pm10_value", "o3_value", "co_value", "no2_value", "so2_value", "overall_aqi")


def flatten_air(raw: DataFrame, value_col: str = "value", ingested_col: str | None = None):
    """Station documents -> 20 Bronze columns; returns ``(records, rejects)``.

    Numbers arrive as text: unparseable or negative values become NULL
    (``"12.0"`` is not an int). Documents without a station id, or that are
    not valid JSON, go to ``rejects`` with a reason.
    """
    parsed = parse_payload(raw, value_col, AIR_API, _P)
    a = f"{_P}.AQILast"
    malformed = is_malformed(_P)
    has_id = non_blank(f"{_P}.stationID")
    good, bad = _split(
        parsed,
        ~malformed & has_id,
        value_col,
        F.when(malformed, F.lit("malformed")).otherwise(F.lit("missing station id")),
    )
    records = good.select(
        F.col(f"{_P}.stationID").alias("station_id"),
        F.col(f"{_P}.nameEN").alias("station_name_en"),
        F.col(f"{_P}.nameTH").alias("station_name_th"),
        F.col(f"{_P}.areaEN").alias("area_en"),
        F.col(f"{_P}.areaTH").alias("area_th"),
        F.col(f"{_P}.stationType").alias("station_type"),
        F.col(f"{_P}.lat").try_cast("double").alias("lat"),
        F.col(f"{_P}.long").try_cast("double").alias("lon"),
        F.col(f"{a}.date").alias("reading_date"),
        F.col(f"{a}.time").alias("reading_time"),
        F.col(f"{a}.PM25.value").try_cast("double").alias("pm25_value"),
        F.col(f"{a}.PM25.aqi").try_cast("int").alias("pm25_aqi"),
        F.col(f"{a}.PM10.value").try_cast("double").alias("pm10_value"),
        F.col(f"{a}.O3.value").try_cast("double").alias("o3_value"),
        F.col(f"{a}.CO.value").try_cast("double").alias("co_value"),
        F.col(f"{a}.NO2.value").try_cast("double").alias("no2_value"),
        F.col(f"{a}.SO2.value").try_cast("double").alias("so2_value"),
        F.col(f"{a}.AQI.aqi").try_cast("int").alias("overall_aqi"),
        F.col(f"{a}.AQI.param").alias("aqi_param"),
        _ingested(good, ingested_col).alias("ingested_at"),
    )
    # A step of its own: the test and the value share one cast of the text.
    return null_sentinels(records, AIR_NUMBERS), bad


def flatten_weather(raw: DataFrame, value_col: str = "value", ingested_col: str | None = None):
    """City weather documents -> 17 Bronze columns; returns ``(records, rejects)``.

    The first element of ``weather`` supplies the condition; a document whose
    ``weather`` array is present but empty is rejected (the source skips it),
    a missing array gives NULL conditions.
    """
    parsed = parse_payload(raw, value_col, WEATHER_API, _P)
    malformed = is_malformed(_P)
    empty = F.col(f"{_P}.weather").isNotNull() & (F.size(f"{_P}.weather") == 0)
    good, bad = _split(
        parsed,
        ~malformed & ~empty,
        value_col,
        F.when(malformed, F.lit("malformed")).otherwise(F.lit("empty weather")),
    )
    w0 = F.get(F.col(f"{_P}.weather"), 0)
    records = good.select(
        F.col(f"{_P}.id").alias("city_id"),
        F.col(f"{_P}.name").alias("city_name"),
        F.col(f"{_P}.sys.country").alias("country"),
        F.col(f"{_P}.coord.lat").alias("lat"),
        F.col(f"{_P}.coord.lon").alias("lon"),
        F.col(f"{_P}.dt").alias("reading_ts"),
        F.col(f"{_P}.main.temp").alias("temp_c"),
        F.col(f"{_P}.main.feels_like").alias("feels_like_c"),
        F.col(f"{_P}.main.pressure").alias("pressure_hpa"),
        F.col(f"{_P}.main.humidity").alias("humidity_pct"),
        F.col(f"{_P}.wind.speed").alias("wind_speed_ms"),
        F.col(f"{_P}.wind.deg").alias("wind_deg"),
        F.col(f"{_P}.visibility").alias("visibility_m"),
        w0.getField("main").alias("weather_main"),
        w0.getField("description").alias("weather_desc"),
        w0.getField("icon").alias("weather_icon"),
        _ingested(good, ingested_col).alias("ingested_at"),
    )
    return records, bad


def parse_bronze(raw: DataFrame, schema, value_col: str = "value"):
    """Flat Bronze JSON messages -> typed columns; returns ``(records, rejects)``."""
    parsed = parse_payload(raw, value_col, schema, _P)
    malformed = is_malformed(_P)
    good, bad = _split(parsed, ~malformed, value_col, F.lit("malformed"))
    extra = [c for c in raw.columns if c != value_col]
    records = good.select(*extra, *[F.col(f"{_P}.{f.name}").alias(f.name) for f in schema.fields])
    return records, bad


__all__ = ["flatten_air", "flatten_weather", "parse_bronze", "CORRUPT"]
