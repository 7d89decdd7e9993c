"""Registered streaming queries: re-sent messages, one-pass routing, closed windows and what stays in state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.time import iso_to_ts
from aerolith.operators.windows import WINDOW_COLUMNS
from aerolith.plans import standins as S
from aerolith.plans.oracle import CTES, windows_sql, with_ctes
from aerolith.plans.registry import HOT_DURATION, register
from aerolith.schemas import BRONZE_AIR, BRONZE_SENSOR, BRONZE_WEATHER
from aerolith.session import scratch_path
from aerolith.sources import file_stream
from aerolith.streaming.hot_path import start_hot_path
from aerolith.streaming.ingest import Resends, Route, start_ingest, start_routes
from aerolith.streaming.replay import SLICE, feed, state_rows, time_slices

ONCE = {"availableNow": True}
SLICES = 3

# --- messages sent twice ---------------------------------------------------------


@register("ingest_resent", with_ctes(("bronze_sensor",), "SELECT * FROM bronze_sensor"))
def q_ingest_resent(spark, sf_dir):
    """K4/T-7: every message is sent in its own slice of time and again in the
    next; the query stops and resumes between slices; Bronze holds it once."""
    root = scratch_path(spark, "resent")
    ev = S.table(spark, sf_dir, "events")
    sent = S.sensor_messages(ev.withColumn("sent_at", F.col("ts").cast("timestamp")), "event_id", "sent_at")
    body = F.to_json(F.struct(*BRONZE_SENSOR.fieldNames())).alias("value")
    messages = time_slices(sent, F.col("sent_at"), SLICES).select(SLICE, "event_id", "sent_at", body)
    twice = messages.unionByName(messages.withColumn(SLICE, F.col(SLICE) + 1))
    schema = messages.drop(SLICE).schema

    def start():
        stream = file_stream(spark, f"{root}/messages", schema)
        return start_ingest(stream, BRONZE_SENSOR, f"{root}/bronze", f"{root}/chk", id_col="sensor_id",
                            resends=Resends(("event_id",), "sent_at", "10 days"), trigger=ONCE)

    feed(twice, SLICES + 1, f"{root}/messages", start)
    return spark.read.parquet(f"{root}/bronze").select(*BRONZE_SENSOR.fieldNames())


# --- topics and quarantine -----------------------------------------------------------

AIR, WEATHER, SENSOR, UNROUTED = "air-raw", "weather-raw", "sensor-stream", "sensor-trial"


def messages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream's worth of messages of three feeds. Some are broken, by their
    contents: cut-off documents, messages without value, blank ids, a topic nobody routes."""

    def message(df, topic, key, offset, value):
        offset = offset.cast("long")
        return df.select(
            topic.alias("topic"), F.pmod(offset, F.lit(3)).cast("int").alias("partition"), offset.alias("offset"),
            key.cast("string").alias("key"), value.alias("value"),
        )

    doc = F.to_json(F.struct("*"))
    sent = F.unix_seconds(F.to_timestamp("ingested_at"))
    air = message(
        S.bronze_air(spark, sf_dir), F.lit(AIR), F.col("station_id"), sent,
        F.when((F.col("aqi_param") == "R") & (F.col("reading_time") == "07:00"), F.expr("substring(to_json(struct(*)), 1, 40)")).otherwise(doc),
    )
    weather = message(
        S.bronze_weather(spark, sf_dir), F.lit(WEATHER), F.col("city_id"), sent,
        F.when((F.col("weather_icon") == "A") & (F.col("pressure_hpa") == 1005), F.lit(None)).otherwise(doc),
    )
    blank = F.when(F.col("sensor_type") == "error", F.lit(" ")).otherwise(F.col("sensor_id"))
    trial = F.when(F.col("sensor_type") == "signup", F.lit(UNROUTED)).otherwise(F.lit(SENSOR))
    fields = [blank.alias(c) if c == "sensor_id" else F.col(c) for c in BRONZE_SENSOR.fieldNames()]
    sensor = message(
        S.bronze_sensor(spark, sf_dir), trial, F.col("sensor_id"), F.unix_micros(iso_to_ts("reading_ts")), F.to_json(F.struct(*fields))
    )
    return air.unionByName(weather).unionByName(sensor)


# Records of a file of messages. A micro-batch takes a file a core, so that a
# batch, which is kept parsed until all its tables are written, does not grow with the feed.
FILE_RECORDS = 500_000


def files_at_once(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def routed(spark: SparkSession, sf_dir: str) -> tuple[dict[str, Route], str]:
    root = scratch_path(spark, "routes")
    messages = messages_of(spark, sf_dir)
    messages.write.option("maxRecordsPerFile", FILE_RECORDS).option("compression", "zstd").parquet(f"{root}/messages")
    routes = {
        AIR: Route(BRONZE_AIR, f"{root}/air", "station_id"),
        WEATHER: Route(BRONZE_WEATHER, f"{root}/weather", "city_id"),
        SENSOR: Route(BRONZE_SENSOR, f"{root}/sensor", "sensor_id"),
    }
    stream = file_stream(spark, f"{root}/messages", messages.schema, max_files_per_trigger=files_at_once(spark))
    start_routes(stream, routes, f"{root}/chk", f"{root}/quarantine", trigger=ONCE).awaitTermination()
    return routes, f"{root}/quarantine"


CTES["messages"] = (("bronze_air", "bronze_weather", "bronze_sensor"), f"""
SELECT '{AIR}' AS topic, epoch(CAST(ingested_at AS TIMESTAMP))::BIGINT AS sent, station_id AS key, station_id AS id,
       reading_date || ' ' || reading_time AS reading_time, pm25_value AS measure,
       CASE WHEN aqi_param = 'R' AND reading_time = '07:00' THEN 'malformed' END AS reason
FROM bronze_air
UNION ALL
SELECT '{WEATHER}', epoch(CAST(ingested_at AS TIMESTAMP))::BIGINT, CAST(city_id AS VARCHAR), CAST(city_id AS VARCHAR),
       CAST(reading_ts AS VARCHAR), temp_c, CASE WHEN weather_icon = 'A' AND pressure_hpa = 1005 THEN 'no value' END
FROM bronze_weather
UNION ALL
SELECT CASE WHEN sensor_type = 'signup' THEN '{UNROUTED}' ELSE '{SENSOR}' END,
       epoch_us(strptime(reading_ts, '%Y-%m-%dT%H:%M:%S.%fZ')), sensor_id, sensor_id, reading_ts, value,
       CASE sensor_type WHEN 'signup' THEN 'no route' WHEN 'error' THEN 'missing id' END
FROM bronze_sensor""")


@register("topic_routes", with_ctes(("messages",), """
SELECT topic, CAST(sent % 3 AS INTEGER) AS partition, sent AS "offset", key, id, reading_time, measure
FROM messages WHERE reason IS NULL"""))
def q_topic_routes(spark, sf_dir):
    """Three topics in one stream, each in its own table with the message's place."""
    routes, _ = routed(spark, sf_dir)
    place = ["topic", "partition", "offset", "key"]
    tables = {
        AIR: (F.col("station_id"), F.concat_ws(" ", "reading_date", "reading_time"), F.col("pm25_value")),
        WEATHER: (F.col("city_id").cast("string"), F.col("reading_ts").cast("string"), F.col("temp_c")),
        SENSOR: (F.col("sensor_id"), F.col("reading_ts"), F.col("value")),
    }
    parts = [
        spark.read.parquet(routes[t].path).select(*place, i.alias("id"), at.alias("reading_time"), x.alias("measure"))
        for t, (i, at, x) in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("quarantine_reasons", with_ctes(("messages",), """
SELECT topic, CAST(sent % 3 AS INTEGER) AS partition, sent AS "offset", key, reason FROM messages WHERE reason IS NOT NULL"""))
def q_quarantine_reasons(spark, sf_dir):
    """Each rejected message with its place and reason."""
    return spark.read.parquet(routed(spark, sf_dir)[1]).select("topic", "partition", "offset", "key", "reason")


# --- windows that close -----------------------------------------------------------------

# Readings of this type arrive one slice late; all but the newest of a slice are then behind the watermark.
LATE_TYPE = "error"
DELAY_HOURS = 6


def closed_windows(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Store and checkpoint of an append-mode hot path over a replay in time order."""
    root = scratch_path(spark, "closed")
    events = time_slices(S.table(spark, sf_dir, "events"), F.col("ts"), SLICES)
    late = F.when(F.col("event_type") == LATE_TYPE, F.col(SLICE) + 1).otherwise(F.col(SLICE))

    def start():
        stream = file_stream(spark, f"{root}/events", events.drop(SLICE).schema)
        readings = S.sensor_messages(stream).withColumn("reading_ts_utc", iso_to_ts("reading_ts"))
        return start_hot_path(readings, f"{root}/store", f"{root}/chk", output_mode="append", trigger=ONCE, partition_grain="day",
                              watermark=f"{DELAY_HOURS} hours", duration=HOT_DURATION, sigma=S.EVENT_SIGMA, decimals=False)

    feed(events.withColumn(SLICE, late), SLICES + 1, f"{root}/events", start)
    return f"{root}/store", f"{root}/chk"


CTES["delivered"] = (("silver_sensor",), f"""
SELECT s.*, date_trunc('hour', reading_ts_utc) + INTERVAL 1 HOUR AS closes,
       (epoch_us(reading_ts_utc) - lo) * {SLICES} // (hi - lo + 1) + (sensor_type IS NOT DISTINCT FROM '{LATE_TYPE}')::INT AS slice
FROM silver_sensor s, (SELECT min(epoch_us(reading_ts_utc)) AS lo, max(epoch_us(reading_ts_utc)) AS hi FROM silver_sensor)""")
CTES["watermarks"] = (("delivered",), f"""
SELECT slice, (max(max(epoch_us(reading_ts_utc))) OVER (ORDER BY slice) // 1000 - {DELAY_HOURS * 3_600_000}) * 1000 AS after
FROM delivered GROUP BY slice""")
CTES["timely"] = (("delivered", "watermarks"), """
SELECT d.* FROM delivered d LEFT JOIN watermarks w ON w.slice = d.slice - 1 WHERE w.after IS NULL OR epoch_us(closes) > w.after""")
CTES["timely_hours"] = (("timely",), windows_sql("hour", "timely"))


@register("closed_windows", with_ctes(("timely_hours", "watermarks"), """
SELECT * FROM timely_hours WHERE epoch_us(window_end) <= (SELECT max(after) FROM watermarks)"""))
def q_closed_windows(spark, sf_dir):
    """T-2: each window is emitted once, when the watermark has passed its end; later rows are dropped."""
    return spark.read.parquet(closed_windows(spark, sf_dir)[0]).select(*WINDOW_COLUMNS)


@register("state_left", with_ctes(("timely_hours", "watermarks"), """
SELECT sensor_id, window_start, window_end FROM timely_hours WHERE epoch_us(window_end) > (SELECT max(after) FROM watermarks)"""))
def q_state_left(spark, sf_dir):
    """T-6: the windows still in state after the run; all others were evicted."""
    key = state_rows(spark, closed_windows(spark, sf_dir)[1]).select("key.*")
    sensor, window = key.columns
    return key.select(F.col(sensor).alias("sensor_id"), F.col(window)["start"].alias("window_start"), F.col(window)["end"].alias("window_end"))
