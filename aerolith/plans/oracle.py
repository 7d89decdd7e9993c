"""DuckDB SQL formulations of the stand-in pipeline (the independent oracle).

Each named CTE mirrors one Spark stage; a query's SQL is its final SELECT
preceded by the CTEs it needs (resolved transitively, in dependency order).
Surrogate keys are ``row_number() OVER (ORDER BY natural key)``; tie-breaks
mirror the Spark operators' total orders.
"""

from __future__ import annotations

from aerolith.functions.constants import HOLIDAYS_2026
from aerolith.plans import standins as S

_POLLUTANTS = ("pm25_value", "pm10_value", "o3_value", "co_value", "no2_value", "so2_value")

_BRONZE_AIR_COLS = (
    "station_id", "station_name_en", "station_name_th", "area_en", "area_th", "station_type",
    "lat", "lon", "reading_date", "reading_time", "pm25_value", "pm25_aqi", "pm10_value",
    "o3_value", "co_value", "no2_value", "so2_value", "overall_aqi", "aqi_param", "ingested_at",
)


def sigma_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST({float(v)} AS DOUBLE)" for k, v in S.EVENT_SIGMA.items())
    return f"(CASE {col} {whens} ELSE CAST(1.0 AS DOUBLE) END)"


def _date_key(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INTEGER)"


def _tiebreak(keys: tuple[str, ...], order: tuple[str, ...], cols: tuple[str, ...]) -> str:
    rest = [c for c in cols if c not in keys and c not in order]
    return ", ".join(f"{c} DESC NULLS LAST" for c in (*order, *rest))


_AIR_KEYS = ("station_id", "reading_date", "reading_time")
_EPOCH_TS = "(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(reading_ts))"

_SENSOR_COLS = (
    "sensor_id", "sensor_type", "zone_id", "unit", "value", "target", "is_anomaly", "reading_ts",
    "ingested_at", "reading_ts_utc", "reading_date", "date_key", "deviation",
)

_WEATHER_COLS = (
    "city_id", "city_name", "country", "lat", "lon", "reading_ts", "temp_c", "feels_like_c",
    "pressure_hpa", "humidity_pct", "wind_speed_ms", "wind_deg", "visibility_m", "weather_main",
    "weather_desc", "weather_icon", "ingested_at", "reading_ts_utc", "reading_date", "date_key",
)


def calendar_sql(bounds: str) -> str:
    hol = ", ".join(f"DATE '{h}'" for h in HOLIDAYS_2026)
    return f"""
SELECT {_date_key('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
       d IN ({hol}) AS is_thai_holiday
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM ({bounds}))"""


def int_text(expr: str) -> str:
    """Text -> INTEGER only for plain integer text (as Spark's try_cast)."""
    return f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') THEN TRY_CAST(trim({expr}) AS INTEGER) END"


LAST_SNAPSHOT = "(SELECT CAST(max(o_orderdate) AS DATE) + 1 FROM orders)"


def _snapshot_sql(as_of: str, known: str = "") -> str:
    return f"""
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, o.o_orderpriority AS last_priority,
       o.o_orderstatus AS last_status
FROM customer c LEFT JOIN (
  SELECT * FROM orders WHERE o_orderdate < {as_of}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC,
    o_orderpriority DESC NULLS LAST, o_orderstatus DESC NULLS LAST) = 1) o
ON c.c_custkey = o.o_custkey {known}"""


def windows_sql(unit: str, source: str = "silver_sensor") -> str:
    return f"""
SELECT sensor_id, window_start, window_start + INTERVAL 1 {unit} AS window_end,
       coalesce(f_type, 'unknown') AS sensor_type, coalesce(f_zone, 'unknown') AS zone_id,
       avg_value, max_value, min_value, f_target AS target_value, reading_count, anomaly_count,
       reading_rule_count, invalid_count, abs(avg_value - f_target) > 3.0 * {sigma_case("coalesce(f_type, 'unknown')")} AS is_anomaly
FROM (
  SELECT sensor_id, date_trunc('{unit}', reading_ts_utc) AS window_start,
         avg(value) AS avg_value, max(value) AS max_value, min(value) AS min_value,
         count(*) AS reading_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
         count(*) FILTER (WHERE abs(value - target) > 3.0 * {sigma_case("coalesce(sensor_type, 'unknown')")}) AS reading_rule_count,
         count(*) FILTER (WHERE value IS NULL OR target IS NULL) AS invalid_count,
         arg_min_null(sensor_type, (reading_ts_utc, sensor_type, zone_id, target)) AS f_type,
         arg_min_null(zone_id, (reading_ts_utc, sensor_type, zone_id, target)) AS f_zone,
         arg_min_null(target, (reading_ts_utc, sensor_type, zone_id, target)) AS f_target
  FROM {source} GROUP BY sensor_id, date_trunc('{unit}', reading_ts_utc))"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "bronze_air": ((), f"""
SELECT CAST(l.l_suppkey AS VARCHAR) AS station_id, s.s_name AS station_name_en,
       lower(s.s_name) AS station_name_th, n.n_name AS area_en, lower(n.n_name) AS area_th,
       'R' || CAST(n.n_regionkey AS VARCHAR) AS station_type, s.s_acctbal / 1000 AS lat,
       CAST(s.s_nationkey AS DOUBLE) AS lon, strftime(l.l_shipdate, '%Y-%m-%d') AS reading_date,
       lpad(CAST(l.l_linenumber AS VARCHAR), 2, '0') || ':00' AS reading_time,
       l.l_quantity AS pm25_value, CAST(l.l_quantity AS INTEGER) AS pm25_aqi,
       l.l_extendedprice / 1000 AS pm10_value, l.l_discount * 100 AS o3_value,
       l.l_tax * 100 AS co_value, l.l_discount * l.l_quantity AS no2_value,
       s.s_acctbal / 100 AS so2_value, CAST(floor(l.l_extendedprice / 1000) AS INTEGER) AS overall_aqi,
       l.l_returnflag AS aqi_param,
       strftime(l.l_shipdate + to_seconds(l.l_orderkey), '%Y-%m-%dT%H:%M:%S') AS ingested_at
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "air_clean": (("bronze_air",), "SELECT * REPLACE ("
        + ", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in _POLLUTANTS)
        + "), CAST(ingested_at AS TIMESTAMP) AS ingest_ts FROM bronze_air"),
    "air_dedup": (("air_clean",), f"""
SELECT * EXCLUDE (rn, ingest_ts) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(_AIR_KEYS)}
    ORDER BY {_tiebreak(_AIR_KEYS, ('ingest_ts',), _BRONZE_AIR_COLS)}) AS rn FROM air_clean)
WHERE rn = 1"""),
    "silver_air": (("air_dedup",), f"""
SELECT * REPLACE (CAST(reading_ts_utc AS DATE) AS reading_date),
       {_date_key('reading_ts_utc')} AS date_key
FROM (SELECT *, CAST(strptime(reading_date || ' ' || reading_time || ':00', '%Y-%m-%d %H:%M:%S')
                     - INTERVAL 7 HOUR AS TIMESTAMP) AS reading_ts_utc FROM air_dedup)"""),
    "dim_station": (("silver_air",), f"""
SELECT *, CAST(row_number() OVER (ORDER BY station_id) AS INTEGER) AS station_key,
       DATE '{S.AS_OF_LOAD.isoformat()}' AS effective_date, DATE '9999-12-31' AS expiry_date,
       true AS is_current
FROM (SELECT DISTINCT station_id, station_name_en, station_name_th, area_en, station_type, lat, lon
      FROM silver_air)"""),
    "dim_region": (("silver_air",), """
SELECT region_name, CAST(row_number() OVER (ORDER BY region_name) AS INTEGER) AS region_key,
       'Thailand' AS country
FROM (SELECT DISTINCT area_en AS region_name FROM silver_air WHERE area_en IS NOT NULL)"""),
    "fct_air": (("silver_air", "dim_station", "dim_region"), """
SELECT a.date_key, s.station_key, r.region_key, a.pm25_value, a.pm10_value, a.o3_value,
       a.co_value, a.no2_value, a.so2_value, a.overall_aqi, a.aqi_param,
       CAST(hour(a.reading_ts_utc) AS INTEGER) AS reading_hour, a.reading_date
FROM silver_air a
LEFT JOIN (SELECT station_id, station_key FROM dim_station WHERE is_current) s ON a.station_id = s.station_id
LEFT JOIN dim_region r ON a.area_en = r.region_name"""),
    "silver_sensor": ((), f"""
SELECT * FROM (
  SELECT CAST(user_id AS VARCHAR) AS sensor_id, event_type AS sensor_type,
         'Z0' || CAST(user_id % 5 + 1 AS VARCHAR) AS zone_id, '{S.EVENT_UNIT}' AS unit, value,
         CAST({S.EVENT_TARGET} AS DOUBLE) AS target,
         abs(value - {S.EVENT_TARGET}) > 3.0 * {sigma_case('event_type')} AS is_anomaly,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS reading_ts, CAST(NULL AS VARCHAR) AS ingested_at,
         ts AS reading_ts_utc, CAST(ts AS DATE) AS reading_date, {_date_key('ts')} AS date_key,
         round(value - {S.EVENT_TARGET}, 4) AS deviation
  FROM events)
QUALIFY row_number() OVER (PARTITION BY sensor_id, reading_ts ORDER BY
  {_tiebreak(('sensor_id', 'reading_ts'), (), _SENSOR_COLS)}) = 1"""),
    "dim_sensor": (("silver_sensor",), f"""
SELECT sensor_id, sensor_type, zone_id, target, unit,
       CAST(row_number() OVER (ORDER BY sensor_id) AS INTEGER) AS sensor_key,
       DATE '{S.AS_OF_LOAD.isoformat()}' AS effective_date, DATE '9999-12-31' AS expiry_date,
       true AS is_current
FROM (SELECT * FROM silver_sensor
      QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY reading_ts_utc DESC NULLS LAST,
        sensor_type DESC NULLS LAST, zone_id DESC NULLS LAST, target DESC NULLS LAST,
        unit DESC NULLS LAST) = 1)"""),
    "dim_zone": (("silver_sensor",), """
SELECT zone_id, CAST(row_number() OVER (ORDER BY zone_id) AS INTEGER) AS zone_key,
       zone_id AS zone_name, 'Bangkok facility zone' AS description
FROM (SELECT DISTINCT zone_id FROM silver_sensor)"""),
    "dim_sensor_type": (("silver_sensor",), """
SELECT sensor_type, unit,
       CAST(row_number() OVER (ORDER BY sensor_type, unit) AS INTEGER) AS sensor_type_key,
       CAST(0.0 AS DOUBLE) AS typical_range_min, CAST(999.0 AS DOUBLE) AS typical_range_max
FROM (SELECT DISTINCT sensor_type, unit FROM silver_sensor)"""),
    "fct_sensor": (("silver_sensor", "dim_sensor", "dim_zone", "dim_sensor_type"), """
SELECT r.date_key, d.sensor_key, z.zone_key, t.sensor_type_key, r.value, r.target, r.deviation,
       r.is_anomaly, r.reading_ts_utc, r.reading_date
FROM silver_sensor r
LEFT JOIN (SELECT sensor_id, sensor_key FROM dim_sensor WHERE is_current) d ON r.sensor_id = d.sensor_id
LEFT JOIN dim_zone z ON r.zone_id = z.zone_id
LEFT JOIN dim_sensor_type t ON r.sensor_type = t.sensor_type AND r.unit = t.unit"""),
    "hot_windows": (("silver_sensor",), windows_sql("minute")),
    "hot_hours": (("silver_sensor",), windows_sql("hour")),
    "bronze_weather": ((), f"""
SELECT n.n_nationkey AS city_id, n.n_name AS city_name, 'TH' AS country,
       CAST(n.n_regionkey AS DOUBLE) AS lat, CAST(s.s_nationkey AS DOUBLE) AS lon,
       epoch(l.l_shipdate)::BIGINT + l.l_linenumber * 3600 + l.l_suppkey AS reading_ts,
       l.l_extendedprice / 2000 AS temp_c, l.l_extendedprice / 2000 + l.l_tax AS feels_like_c,
       CAST(1000 + l.l_linenumber AS INTEGER) AS pressure_hpa, CAST(l.l_quantity AS INTEGER) AS humidity_pct,
       l.l_discount * 100 AS wind_speed_ms, CAST(l.l_partkey % 360 AS INTEGER) AS wind_deg,
       CAST(l.l_orderkey % 10000 AS INTEGER) AS visibility_m, p.p_type AS weather_main,
       p.p_brand AS weather_desc, l.l_returnflag AS weather_icon,
       strftime(l.l_shipdate + to_seconds(l.l_orderkey), '%Y-%m-%dT%H:%M:%S') AS ingested_at
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""),
    "silver_weather": (("bronze_weather",), f"""
SELECT * EXCLUDE (ingest_ts) FROM (
  SELECT *, CAST(ingested_at AS TIMESTAMP) AS ingest_ts,
         (TIMESTAMP '1970-01-01 00:00:00' + to_seconds(reading_ts)) AS reading_ts_utc,
         CAST((TIMESTAMP '1970-01-01 00:00:00' + to_seconds(reading_ts)) AS DATE) AS reading_date,
         {_date_key(_EPOCH_TS)} AS date_key
  FROM bronze_weather)
QUALIFY row_number() OVER (PARTITION BY city_id, reading_ts ORDER BY
  {_tiebreak(('city_id', 'reading_ts'), ('ingest_ts',), _WEATHER_COLS)}) = 1"""),
    "dim_weather_condition": (("silver_weather",), """
SELECT weather_main, weather_description,
       CAST(row_number() OVER (ORDER BY weather_main, weather_description) AS INTEGER) AS weather_condition_key
FROM (SELECT DISTINCT weather_main, weather_desc AS weather_description FROM silver_weather
      WHERE weather_main IS NOT NULL)"""),
    "fct_weather": (("silver_weather", "dim_weather_condition"), """
SELECT w.date_key, c.weather_condition_key, w.city_id, w.city_name, w.temp_c, w.feels_like_c,
       w.pressure_hpa, w.humidity_pct, w.wind_speed_ms, w.wind_deg, w.visibility_m,
       w.reading_ts_utc, w.reading_date
FROM silver_weather w LEFT JOIN dim_weather_condition c
  ON w.weather_main = c.weather_main AND w.weather_desc = c.weather_description"""),
    "snap1": ((), _snapshot_sql(
        f"DATE '{S.SCD2_FIRST_SNAPSHOT.isoformat()}'", "WHERE c.c_custkey IN (SELECT o_custkey FROM orders)")),
    "snap2": ((), _snapshot_sql(LAST_SNAPSHOT)),
    "dim_customer_v1": (("snap1",), f"""
SELECT *, CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS customer_key,
       DATE '{S.SCD2_FIRST_SNAPSHOT.isoformat()}' AS effective_date,
       DATE '9999-12-31' AS expiry_date, true AS is_current
FROM snap1"""),
    "scd2_joined": (("dim_customer_v1", "snap2"), """
SELECT d.*, s.c_custkey AS i_c_custkey, s.c_name AS i_c_name, s.c_nationkey AS i_c_nationkey,
       s.c_mktsegment AS i_c_mktsegment, s.last_priority AS i_last_priority,
       s.last_status AS i_last_status,
       d.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL AND (
         d.c_mktsegment IS DISTINCT FROM s.c_mktsegment OR d.c_nationkey IS DISTINCT FROM s.c_nationkey
         OR d.last_priority IS DISTINCT FROM s.last_priority) AS changed
FROM (SELECT * FROM dim_customer_v1 WHERE is_current) d
FULL OUTER JOIN snap2 s ON d.c_custkey = s.c_custkey"""),
    "dim_customer_v2": (("scd2_joined", "dim_customer_v1"), f"""
SELECT c_custkey, CASE WHEN i_c_custkey IS NOT NULL THEN i_c_name ELSE c_name END AS c_name,
       c_nationkey, c_mktsegment, last_priority,
       CASE WHEN i_c_custkey IS NOT NULL THEN i_last_status ELSE last_status END AS last_status,
       customer_key, effective_date,
       CASE WHEN changed THEN {LAST_SNAPSHOT} ELSE expiry_date END AS expiry_date,
       CASE WHEN changed THEN false ELSE is_current END AS is_current
FROM scd2_joined WHERE c_custkey IS NOT NULL
UNION ALL
SELECT i_c_custkey, i_c_name, i_c_nationkey, i_c_mktsegment, i_last_priority, i_last_status,
       CAST((SELECT coalesce(max(customer_key), 0) FROM dim_customer_v1)
            + row_number() OVER (ORDER BY i_c_custkey) AS INTEGER),
       {LAST_SNAPSHOT}, DATE '9999-12-31', true
FROM scd2_joined WHERE i_c_custkey IS NOT NULL AND (c_custkey IS NULL OR changed)"""),
    "air_keyed": (("silver_air", "dim_station", "dim_region"), """
SELECT a.*, s.station_key, r.region_key FROM silver_air a
LEFT JOIN (SELECT station_id, station_key FROM dim_station WHERE is_current) s ON a.station_id = s.station_id
LEFT JOIN dim_region r ON a.area_en = r.region_name"""),
    "dim_date_air": (("silver_air",), calendar_sql("SELECT min(reading_date) AS lo, max(reading_date) AS hi FROM silver_air")),
    "recent_days": (("hot_hours",), """
SELECT * FROM hot_hours
WHERE window_start >= (SELECT max(window_end) FROM hot_hours) - INTERVAL 3 DAY"""),
    "bronze_sensor": ((), f"""
SELECT CAST(user_id AS VARCHAR) AS sensor_id, event_type AS sensor_type,
       'Z0' || CAST(user_id % 5 + 1 AS VARCHAR) AS zone_id, '{S.EVENT_UNIT}' AS unit, value,
       CAST({S.EVENT_TARGET} AS DOUBLE) AS target,
       abs(value - {S.EVENT_TARGET}) > 3.0 * {sigma_case('event_type')} AS is_anomaly,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS reading_ts, CAST(NULL AS VARCHAR) AS ingested_at
FROM events"""),
    "silver_air_local": (("air_dedup",), f"""
SELECT *, {_date_key('reading_ts_utc')} AS date_key
FROM (SELECT *, CAST(strptime(reading_date || ' ' || reading_time || ':00', '%Y-%m-%d %H:%M:%S')
                     - INTERVAL 7 HOUR AS TIMESTAMP) AS reading_ts_utc FROM air_dedup)"""),
    "air_keyed_local": (("silver_air_local", "dim_station", "dim_region"), """
SELECT a.*, s.station_key, r.region_key FROM silver_air_local a
LEFT JOIN (SELECT station_id, station_key FROM dim_station WHERE is_current) s ON a.station_id = s.station_id
LEFT JOIN dim_region r ON a.area_en = r.region_name"""),
}


def with_ctes(needs: tuple[str, ...], final: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {body}\n{final.strip()}"
