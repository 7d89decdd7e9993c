"""Bronze -> Silver cleaning for the three feeds.

Each function is ``DataFrame -> DataFrame``; writing (partitioned by
``reading_date``) is done by :mod:`aerolith.sinks`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.clean import deviation, null_sentinels
from aerolith.functions.constants import POLLUTANT_COLUMNS, SOURCE_TIMEZONE
from aerolith.functions.time import (
    date_key,
    epoch_seconds_to_ts,
    iso_to_ts,
    local_strings_to_utc,
)
from aerolith.operators.dedup import latest_of_repeated

_INGEST = "__ingest_ts"


def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Latest ingested row per key; ``ingested_at`` is ISO text (parsed, NULL last)."""
    if "ingested_at" in df.columns:
        df = df.withColumn(_INGEST, iso_to_ts("ingested_at"))
    else:
        df = df.withColumn(_INGEST, F.lit(None).cast("timestamp"))
    return latest_of_repeated(df, keys, [_INGEST]).drop(_INGEST)


def silver_air(bronze: DataFrame, tz: str = SOURCE_TIMEZONE, compat: bool = False) -> DataFrame:
    """Sentinels -> NULL, latest per (station, local date, local time), UTC time.

    ``reading_date`` is the UTC date of ``reading_ts_utc`` (consistent with
    ``date_key``). ``compat=True`` keeps the source's local date string, as the
    original job does, where 00:00-06:59 local rows differ from ``date_key``.
    """
    df = null_sentinels(bronze, POLLUTANT_COLUMNS)
    df = _latest(df, ["station_id", "reading_date", "reading_time"])
    df = df.withColumns(
        {
            "reading_ts_utc": local_strings_to_utc("reading_date", "reading_time", tz),
            "lat": F.col("lat").try_cast("double"),
            "lon": F.col("lon").try_cast("double"),
        }
    )
    df = df.withColumn("date_key", date_key("reading_ts_utc"))
    if not compat:
        df = df.withColumn("reading_date", F.to_date("reading_ts_utc"))
    return df


def silver_weather(bronze: DataFrame) -> DataFrame:
    """Epoch seconds -> UTC timestamp, date, date key; latest per (city, time)."""
    df = bronze.withColumn("reading_ts_utc", epoch_seconds_to_ts("reading_ts"))
    df = df.withColumns(
        {"reading_date": F.to_date("reading_ts_utc"), "date_key": date_key("reading_ts_utc")}
    )
    return _latest(df, ["city_id", "reading_ts"])


def silver_sensor(bronze: DataFrame, digits: int | None = 4) -> DataFrame:
    """ISO text -> timestamp, date, date key, deviation; latest per (sensor, instant).

    Texts of one instant (``Z`` or an offset) are one reading. Rows whose time
    does not parse have no instant: :func:`unparsed_times` lists them for
    quarantine, and they are told apart here by their text.
    """
    df = bronze.withColumn("reading_ts_utc", iso_to_ts("reading_ts"))
    df = df.withColumns(
        {
            "reading_date": F.to_date("reading_ts_utc"),
            "date_key": date_key("reading_ts_utc"),
            "deviation": deviation("value", "target", digits),
        }
    )
    df = df.withColumn("__bad_time", F.when(F.col("reading_ts_utc").isNull(), F.col("reading_ts")))
    return _latest(df, ["sensor_id", "reading_ts_utc", "__bad_time"]).drop("__bad_time")


def unparsed_times(bronze: DataFrame, ts_col: str = "reading_ts") -> DataFrame:
    """Rows whose ISO time text does not parse (for quarantine)."""
    return bronze.filter(iso_to_ts(ts_col).isNull())
