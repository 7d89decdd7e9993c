"""Static and type-1 dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.constants import (
    COUNTRY,
    DIM_DATE_END,
    DIM_DATE_START,
    HOLIDAYS_2026,
    SENSOR_RANGE_MAX,
    SENSOR_RANGE_MIN,
    ZONE_DESCRIPTION,
)
from aerolith.functions.time import calendar_columns
from aerolith.operators.keys import dense_keys


def _calendar(days: DataFrame, holidays: Iterable[str]) -> DataFrame:
    cols = calendar_columns("full_date")
    hol = [date.fromisoformat(h) for h in holidays]
    cols["is_thai_holiday"] = F.col("full_date").isin(hol) if hol else F.lit(False)
    return days.select(*[c.alias(n) for n, c in cols.items()])


def dim_date(
    spark: SparkSession,
    start: date = DIM_DATE_START,
    end: date = DIM_DATE_END,
    holidays: Iterable[str] = HOLIDAYS_2026,
) -> DataFrame:
    """One row per calendar day in [start, end], generated across partitions."""
    n_days = (end - start).days + 1
    days = spark.range(n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return _calendar(days, holidays)


def dim_date_covering(
    facts: DataFrame, date_col: str | Column, holidays: Iterable[str] = HOLIDAYS_2026
) -> DataFrame:
    """Date dimension spanning the min..max date found in ``facts``.

    The bounds are a one-row aggregate; the calendar between them is bounded by
    the number of days, not by the number of fact rows.
    """
    d = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    bounds = facts.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return _calendar(days, holidays)


def _distinct_keyed(df: DataFrame, nk: list[str], key: str, known: DataFrame | None = None) -> DataFrame:
    """Members with dense keys. With the ``known`` members of an earlier run
    their keys stay and new members continue after the largest; members no
    longer seen stay too (facts may point at them)."""
    if known is None:
        return dense_keys(df.distinct(), nk, key)
    known = known.select(*nk, key)
    new, old = df.distinct().alias("n"), known.alias("k")
    fresh = new.join(old, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in nk], "left_anti").select(*nk)
    start = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).scalar()
    return known.unionByName(dense_keys(fresh, nk, key, start=start).select(*nk, key))


def dim_region(silver_air: DataFrame, country: str = COUNTRY, known: DataFrame | None = None) -> DataFrame:
    regions = silver_air.select(F.col("area_en").alias("region_name")).filter(
        F.col("region_name").isNotNull()
    )
    return _distinct_keyed(regions, ["region_name"], "region_key", known).select(
        "region_name", "region_key", F.lit(country).alias("country")
    )


def dim_weather_condition(silver_weather: DataFrame, known: DataFrame | None = None) -> DataFrame:
    conds = silver_weather.select(
        "weather_main", F.col("weather_desc").alias("weather_description")
    ).filter(F.col("weather_main").isNotNull())
    return _distinct_keyed(
        conds, ["weather_main", "weather_description"], "weather_condition_key", known
    ).select("weather_main", "weather_description", "weather_condition_key")


def dim_zone(
    silver_sensor: DataFrame,
    names: Mapping[str, str] | None = None,
    description: str = ZONE_DESCRIPTION,
    known: DataFrame | None = None,
) -> DataFrame:
    """Zones; ``zone_name`` is the zone id unless a ``names`` map is given."""
    zones = silver_sensor.select("zone_id")
    keyed = _distinct_keyed(zones, ["zone_id"], "zone_key", known)
    if names:
        pairs = []
        for k, v in names.items():
            pairs += [F.lit(k), F.lit(v)]
        name = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("zone_id")), F.col("zone_id"))
    else:
        name = F.col("zone_id")
    return keyed.select(
        "zone_id", "zone_key", name.alias("zone_name"), F.lit(description).alias("description")
    )


def dim_sensor_type(
    silver_sensor: DataFrame,
    range_min: float = SENSOR_RANGE_MIN,
    range_max: float = SENSOR_RANGE_MAX,
    known: DataFrame | None = None,
) -> DataFrame:
    types = silver_sensor.select("sensor_type", "unit")
    return _distinct_keyed(types, ["sensor_type", "unit"], "sensor_type_key", known).select(
        "sensor_type",
        "unit",
        "sensor_type_key",
        F.lit(float(range_min)).alias("typical_range_min"),
        F.lit(float(range_max)).alias("typical_range_max"),
    )
