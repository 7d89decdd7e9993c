"""Cold path: Bronze -> Silver -> Gold dimensions -> facts -> anomaly fact.

Stages run in dependency order; each stage reads what the previous one wrote
(state passes through tables, as between separate jobs), so a failed stage is
re-run alone and lineage never spans the whole pipeline. Type-2 dimensions are
versioned: a merge reads the latest committed version and writes the next
one, so the input of a running merge is never deleted. After a stage its shuffle
files are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators import dims, facts, scd2, silver
from aerolith.operators.joins import fits_broadcast
from aerolith.operators.keys import duplicate_keys
from aerolith.session import free_shuffles
from aerolith.sinks import read_latest, table_exists, write_partitioned, write_table, write_version

STATION_ATTRS = ["station_name_en", "station_name_th", "area_en", "station_type", "lat", "lon"]
STATION_TRACKED = ["station_name_en", "area_en", "lat", "lon"]
SENSOR_ATTRS = ["sensor_type", "zone_id", "target", "unit"]


FACT_KEYS = {
    "fct_air_quality_hourly": "air_quality_key",
    "fct_sensor_reading": "sensor_reading_key",
    "fct_weather_hourly": "weather_hourly_key",
}


REPORT = "table_name string, row_count long, column_name string, missing long"


@dataclass
class ColdPathResult:
    """Where the tables are, and what their writing passes counted: rows, and
    per table the NULLs of natural keys (Silver, dimensions) or of looked-up keys (facts)."""

    root: str
    counts: dict[str, int] = field(default_factory=dict)
    missing: dict[str, dict[str, int]] = field(default_factory=dict)
    duplicate_keys: dict[str, int] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def report(self, spark: SparkSession) -> DataFrame:
        """One row for each table and observed column."""
        rows = [(t, self.counts[t], c, n) for t, cols in self.missing.items() for c, n in cols.items()]
        return spark.createDataFrame(rows, REPORT)


def _load_scd2(spark, snapshot: DataFrame, base: str, key: str, surrogate: str, tracked, as_of) -> DataFrame:
    """The dimension's next version."""
    if table_exists(spark, base):
        return scd2.merge(read_latest(spark, base), snapshot, key, tracked, surrogate, as_of, one_row_per_key=True)
    return scd2.first_load(snapshot, key, surrogate, as_of)


def _known(spark, base: str) -> DataFrame | None:
    """Members of a type-1 dimension's last version: they keep their keys."""
    return read_latest(spark, base) if table_exists(spark, base) else None


def run_cold_path(
    spark: SparkSession,
    bronze_air: DataFrame,
    bronze_weather: DataFrame,
    bronze_sensor: DataFrame,
    root: str,
    as_of: date,
    dim_date_range: tuple[date, date] | None = None,
) -> ColdPathResult:
    """Run every stage and return the Gold location with what each table's
    writing pass observed. Facts count looked-up keys without a member, and
    days that the calendar lacks."""
    res = ColdPathResult(root.rstrip("/"))
    p = res.path

    def load(table: str, df: DataFrame, must: Sequence[str], write: Callable[[DataFrame], object], extra: Sequence[str] = ()) -> None:
        seen, observation = facts.observe_unmatched(df, must, table)
        write(seen.drop(*extra))
        counted = observation.get
        res.counts[table] = int(counted["rows"])
        res.missing[table] = {c: int(counted[f"{c}_unmatched"]) for c in must}

    def by_date(path: str, in_place: bool = False) -> Callable[[DataFrame], object]:
        return lambda df: write_partitioned(df, p(path), ["reading_date"], in_place=in_place)

    # Stage 1: Silver (three independent jobs).
    load("silver_air", silver.silver_air(bronze_air), ["station_id", "reading_ts_utc"], by_date("silver/air_quality"))
    load("silver_weather", silver.silver_weather(bronze_weather), ["city_id", "reading_ts_utc"], by_date("silver/weather"))
    load("silver_sensor", silver.silver_sensor(bronze_sensor), ["sensor_id", "reading_ts_utc"], by_date("silver/sensor_readings"))
    sa = spark.read.parquet(p("silver/air_quality"))
    sw = spark.read.parquet(p("silver/weather"))
    ss = spark.read.parquet(p("silver/sensor_readings"))

    free_shuffles(spark)

    # Stage 2: dimensions.
    load("dim_date", dims.dim_date(spark, *(dim_date_range or ())), ["date_key"], lambda df: write_table(df, p("gold/dim_date")))
    type1 = {
        "dim_region": (lambda known: dims.dim_region(sa, known=known), "region_name"),
        "dim_weather_condition": (lambda known: dims.dim_weather_condition(sw, known=known), "weather_description"),
        "dim_zone": (lambda known: dims.dim_zone(ss, known=known), "zone_id"),
        "dim_sensor_type": (lambda known: dims.dim_sensor_type(ss, known=known), "sensor_type"),
    }
    for name, (build, natural) in type1.items():
        base = p(f"gold/{name}")
        load(name, build(_known(spark, base)), [natural], lambda df, base=base: write_version(df, base))
    station_snap = scd2.snapshot(sa, "station_id", STATION_ATTRS, "reading_ts_utc")
    sensor_snap = scd2.snapshot(ss, "sensor_id", SENSOR_ATTRS, "reading_ts_utc")
    for name, snap, tracked in (("station", station_snap, STATION_TRACKED), ("sensor", sensor_snap, SENSOR_ATTRS)):
        base = p(f"gold/dim_{name}")
        merged = _load_scd2(spark, snap, base, f"{name}_id", f"{name}_key", tracked, as_of)
        load(f"dim_{name}", merged, [f"{name}_id"], lambda df, base=base: write_version(df, base))

    dim_station = read_latest(spark, p("gold/dim_station"))
    dim_sensor = read_latest(spark, p("gold/dim_sensor"))
    dim_region, dim_zone, dim_type, dim_wc = (
        read_latest(spark, p(f"gold/{n}")) for n in ("dim_region", "dim_zone", "dim_sensor_type", "dim_weather_condition")
    )
    dim_date = spark.read.parquet(p("gold/dim_date"))
    free_shuffles(spark)

    # Stage 3: facts. Where all lookups are broadcast, a reading's fact row lies where Silver has the
    # reading, in a file of its date: it is written from there.
    def in_place(*looked_up: DataFrame) -> bool:
        return all(fits_broadcast(d) for d in (*looked_up, dim_date))

    def load_fact(table: str, fact: DataFrame, keys: Sequence[str], write: Callable[[DataFrame], object]) -> None:
        load(table, facts.with_calendar_key(fact, dim_date), [*keys, facts.CALENDAR_KEY], write, [facts.CALENDAR_KEY])

    air, daily, reading, hourly = "fct_air_quality_hourly", "fct_pollution_daily_summary", "fct_sensor_reading", "fct_weather_hourly"
    load_fact(air, facts.fct_air_quality_hourly(sa, dim_station, dim_region), ["station_key", "region_key"],
              by_date(f"gold/{air}", in_place(dim_station, dim_region)))
    load_fact(daily, facts.fct_pollution_daily_summary(sa, dim_station, dim_region), ["station_key", "region_key"], by_date(f"gold/{daily}"))
    load_fact(
        reading, facts.fct_sensor_reading(ss, dim_sensor, dim_zone, dim_type), ["sensor_key", "zone_key", "sensor_type_key"],
        by_date(f"gold/{reading}", in_place(dim_sensor, dim_zone, dim_type)),
    )
    load_fact(hourly, facts.fct_weather_hourly(sw, dim_wc), ["weather_condition_key"],
              lambda df: write_table(df, p(f"gold/{hourly}"), in_place=in_place(dim_wc)))

    free_shuffles(spark)

    # Stage 4: anomaly fact from the written reading fact.
    event = "fct_sensor_anomaly_event"
    readings = spark.read.parquet(p(f"gold/{reading}"))
    load_fact(event, facts.fct_sensor_anomaly_event(readings), ["sensor_key", "zone_key"], lambda df: write_table(df, p(f"gold/{event}")))

    for name, key in FACT_KEYS.items():
        res.duplicate_keys[name] = duplicate_keys(spark.read.parquet(p(f"gold/{name}")).select(key), key).count()
    return res


def fact_key_report(keyed: dict[str, DataFrame]) -> DataFrame:
    """(fact, rows, keys, null_keys) of several facts, each a one-column frame of keys: one aggregate over all."""
    frames = [df.select(F.lit(name).alias("fact"), F.col(df.columns[0]).alias("key")) for name, df in keyed.items()]
    every = frames[0]
    for df in frames[1:]:
        every = every.unionByName(df)
    return every.groupBy("fact").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("key").alias("distinct_keys"), F.count_if(F.col("key").isNull()).alias("null_keys")
    )
