"""Saved SQL over the Gold star, run with ``spark.sql`` on catalog views.

Gold tables are exposed as temporary views (or catalog tables on a
cluster); each query is plain Spark SQL, so Catalyst plans it like the
DataFrame marts (broadcast of current station versions, partial/final
aggregation, ``TakeOrderedAndProject`` for the top-k).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Hourly rows shrink to one row per station version before names are looked up:
# the join meets about as many rows as there are stations.
TOP_STATIONS = """
WITH per_version AS (
  SELECT station_key, sum(pm25_value) AS total, max(pm25_value) AS highest, count(pm25_value) AS n
  FROM {fct_air_quality_hourly} GROUP BY station_key
), named AS (
  SELECT station_name_en, area_en, sum(total) / sum(n) AS avg_pm25, max(highest) AS max_pm25, sum(n) AS hourly_readings
  FROM per_version INNER JOIN {dim_station} USING (station_key)
  WHERE is_current AND n > 0
  GROUP BY ALL
)
SELECT * FROM named ORDER BY avg_pm25 DESC, station_name_en, area_en LIMIT {k}
"""

# Conditions are looked up after the aggregate by key; the place of a row among
# its city's rows is part of the result.
WEATHER_BY_CITY_DAY = """
WITH per_key AS (
  SELECT city_name, reading_date, weather_condition_key, avg(temp_c) AS avg_temp_c, avg(humidity_pct) AS avg_humidity_pct,
         avg(wind_speed_ms) AS avg_wind_ms, count(1) AS hourly_readings
  FROM {fct_weather_hourly} GROUP BY ALL
)
SELECT k.* EXCEPT (weather_condition_key), d.weather_main, d.weather_description,
       row_number() OVER (PARTITION BY k.city_name ORDER BY k.reading_date, d.weather_main, d.weather_description) AS city_row
FROM per_key k INNER JOIN {dim_weather_condition} d USING (weather_condition_key)
ORDER BY k.city_name, city_row
"""


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Register each frame as a temp view; returns logical name -> view name."""
    names = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names


def top_stations_sql(spark: SparkSession, views: Mapping[str, str], k: int = 10) -> DataFrame:
    return spark.sql(TOP_STATIONS.format(k=int(k), **views))


def weather_by_city_day_sql(spark: SparkSession, views: Mapping[str, str]) -> DataFrame:
    return spark.sql(WEATHER_BY_CITY_DAY.format(**views))


def scd2_history_sql(spark: SparkSession, dim: DataFrame, key: str, attrs: list[str], view: str = "scd2_history") -> DataFrame:
    """Closed versions through a view of the mart, as a dashboard would read them."""
    from aerolith.plans.marts import scd2_history

    scd2_history(dim, key, attrs).createOrReplaceTempView(view)
    return spark.sql(f"FROM {view} SELECT *")
