"""Incremental loads: only the partitions that new rows touch are read, merged and written again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.constants import PM25_THRESHOLD
from aerolith.functions.time import iso_to_ts
from aerolith.operators.dedup import latest_of_repeated
from aerolith.operators.joins import lookup
from aerolith.operators.silver import silver_air
from aerolith.session import free_shuffles
from aerolith.sinks import delete_path, materialize, partition_values, write_partitioned

PARTITION = "load_part"
_INGEST = "__ingest_ts"


def month_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def upsert_partitions(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition: str) -> list[str]:
    """Merge ``new`` into a partitioned table, the greatest ``order`` per key staying; returns the touched partitions.

    Equal to de-duplicating old and new rows together: the latest of a union is
    the latest of both latest rows. The partition must follow from the keys.
    Touched values are few (days, months); only their folders are read and
    replaced, so the files of all others stay as they are. ``new`` is made
    once; what is merged is written aside only where it holds rows of the table.
    Both, and the shuffle files, are deleted when the table is written.
    """
    new = materialize(new, "load")
    aside = [new.saved_path]
    touched = sorted(r[0] for r in new.select(partition).distinct().collect())
    rows = new
    known = set(partition_values(spark, path, partition)) & set(touched)
    if known:
        old = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{partition}={v}" for v in sorted(known)])
        rows = old.withColumn(partition, F.col(partition).cast(new.schema[partition].dataType)).unionByName(new)
    columns = [F.col(c) for c in new.columns]
    merged = latest_of_repeated(rows.select(*columns), keys, order)
    if known:
        merged = materialize(merged, "upsert")  # what is read is not overwritten while it is read
        aside.append(merged.saved_path)
    write_partitioned(merged, path, [partition], replace="touched")
    for done in aside:
        delete_path(spark, done)
    free_shuffles(spark)
    return touched


def load_silver_air(spark: SparkSession, bronze: DataFrame, path: str) -> list[str]:
    """Clean one Bronze load of air readings and merge it into Silver (by month of the reading's UTC time).

    A slot sent again later replaces the reading that Silver holds. Readings
    whose time does not parse have no partition and are left to quarantine.
    """
    new = silver_air(bronze).where(F.col("reading_ts_utc").isNotNull())
    new = new.withColumns({_INGEST: iso_to_ts("ingested_at"), PARTITION: month_of("reading_ts_utc")})
    return upsert_partitions(spark, new, path, ["station_id", "reading_ts_utc", "reading_time", PARTITION], [_INGEST], PARTITION)


def silver_rows(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The table's rows (of some partitions) in Silver's own columns."""
    rows = spark.read.parquet(path)
    if parts is not None:
        rows = rows.where(F.col(PARTITION).isin(list(parts)))
    return rows.drop(_INGEST)


# --- mergeable daily states --------------------------------------------------------------

GRAIN = ("reading_date", "date_key", "station_id", "area_en")


def daily_states(silver: DataFrame, threshold: float = PM25_THRESHOLD) -> DataFrame:
    """Partial states of the daily summary, one row per day, station, area and AQI parameter.

    Sums, counts and extremes add up over any split of the readings, and the
    rows by parameter are the counts that the dominant one is chosen from.
    """
    v = F.col("pm25_value")
    return silver.groupBy(*GRAIN, "aqi_param").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count(v).alias("pm25_count"),
        F.sum(v).alias("pm25_sum"),
        F.min(v).alias("pm25_min"),
        F.max(v).alias("pm25_max"),
        F.count_if(v > F.lit(float(threshold))).alias("exceeding"),
    )


def merge_states(states: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """States of any number of loads, or of a coarser ``grain``, added up."""
    return states.groupBy(*grain, "aqi_param").agg(
        *[F.sum(c).alias(c) for c in ("readings", "pm25_count", "pm25_sum", "exceeding")],
        F.min("pm25_min").alias("pm25_min"),
        F.max("pm25_max").alias("pm25_max"),
    )


def finish_states(states: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Averages, extremes, hours above the threshold and the most frequent parameter (ties: the smallest)."""
    vote = F.when(F.col("aqi_param").isNotNull(), F.struct((-F.col("readings")).alias("n"), F.col("aqi_param").alias("p")))
    return merge_states(states, grain).groupBy(*grain).agg(
        F.try_divide(F.sum("pm25_sum"), F.sum("pm25_count")).alias("avg_pm25"),
        F.max("pm25_max").alias("max_pm25"),
        F.min("pm25_min").alias("min_pm25"),
        F.sum("exceeding").alias("hours_exceeding_threshold"),
        F.min(vote)["p"].alias("dominant_aqi_param"),
    )


def load_daily_states(spark: SparkSession, silver_path: str, path: str, touched: Sequence[str], threshold: float = PM25_THRESHOLD) -> None:
    """States of the touched Silver partitions, replacing those partitions of the state table.

    A correction may take an extreme away, which no state can undo: a touched
    partition's states are built from its readings, all others are kept.
    """
    states = daily_states(silver_rows(spark, silver_path, touched), threshold)
    states = states.withColumn(PARTITION, F.date_format("reading_date", "yyyy-MM"))
    write_partitioned(states, path, [PARTITION], replace="touched")
    free_shuffles(spark)


def daily_summary(states: DataFrame, dim_station: DataFrame, dim_region: DataFrame) -> DataFrame:
    """The daily summary fact from states: keys are looked up on the few state rows, not on the readings.

    States are of a day already, so that adding them up takes few rows away: they are dealt once, by the fact's grain.
    """
    grain = ["date_key", "station_key", "region_key", "reading_date"]
    stations = dim_station.where("is_current").select("station_id", "station_key")
    regions = dim_region.select(F.col("region_name").alias("area_en"), "region_key")
    keyed = lookup(lookup(states, stations, "station_id"), regions, "area_en")
    return finish_states(keyed.repartition(*grain), grain)
