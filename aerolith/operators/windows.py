"""Per-key tumbling-window aggregates with a window-mean anomaly flag.

Shared by the batch form and the Structured Streaming hot path: the same
``groupBy(key, window(ts))`` aggregate runs over a static frame or a stream.
All aggregates are algebraic (partial + final), so a hot key is combined map
side and in the state store without holding its rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.clean import beyond_sigma, decimal4, or_unknown, sigma_lookup
from aerolith.functions.constants import ANOMALY_SIGMA, DEFAULT_SIGMA, SENSOR_SIGMA, WINDOW_DURATION

WINDOW_COLUMNS = (
    "sensor_id", "window_start", "window_end", "sensor_type", "zone_id", "avg_value",
    "max_value", "min_value", "target_value", "reading_count", "anomaly_count",
    "reading_rule_count", "invalid_count", "is_anomaly",
)


def window_aggregates(
    readings: DataFrame,
    ts_col: str = "reading_ts_utc",
    key: str = "sensor_id",
    duration: str = WINDOW_DURATION,
    sigma: Mapping[str, float] = SENSOR_SIGMA,
    default_sigma: float = DEFAULT_SIGMA,
    k: float = ANOMALY_SIGMA,
    decimals: bool = False,
) -> DataFrame:
    """One row per (key, window): avg/max/min value, reading count, count of
    labelled anomalies, ``reading_rule_count`` = readings individually beyond
    ``k`` sigma of their target (per-reading rule), and ``is_anomaly`` = the
    window mean beyond ``k`` sigma of the target (window rule). Readings
    lacking a value or target are kept and counted in ``invalid_count``; the
    aggregates ignore their NULLs, so one bad reading never fails or poisons
    its window. Type, zone and target come from the window's first valid
    reading (earliest event time; ties broken by the values), from its first
    reading if none is valid; a missing type or zone becomes ``"unknown"``.
    ``decimals=True`` stores measures as decimal(18,4).
    """
    reading = F.struct(F.col(ts_col), "sensor_type", "zone_id", "target")
    valid = F.col("value").isNotNull() & F.col("target").isNotNull()
    first = F.coalesce(F.min(F.when(valid, reading)), F.min(reading)).alias("__first")
    agg = readings.groupBy(F.col(key).alias("sensor_id"), F.window(ts_col, duration).alias("__w")).agg(
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_if(F.col("is_anomaly") == F.lit(True)).alias("anomaly_count"),
        F.count_if(
            beyond_sigma("value", "target", sigma_lookup(or_unknown("sensor_type"), sigma, default_sigma), k)
        ).alias("reading_rule_count"),
        F.count_if(F.col("value").isNull() | F.col("target").isNull()).alias("invalid_count"),
        first,
    )
    stype = or_unknown("__first.sensor_type")
    out = agg.select(
        "sensor_id",
        F.col("__w.start").alias("window_start"),
        F.col("__w.end").alias("window_end"),
        stype.alias("sensor_type"),
        or_unknown("__first.zone_id").alias("zone_id"),
        "avg_value",
        "max_value",
        "min_value",
        F.col("__first.target").alias("target_value"),
        "reading_count",
        "anomaly_count",
        "reading_rule_count",
        "invalid_count",
        beyond_sigma("avg_value", "__first.target", sigma_lookup(stype, sigma, default_sigma), k).alias(
            "is_anomaly"
        ),
    )
    if decimals:
        out = out.withColumns({c: decimal4(c) for c in ("avg_value", "max_value", "min_value", "target_value")})
    return out
