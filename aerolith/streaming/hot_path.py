"""Hot path: one-minute per-sensor aggregates in an epoch-appended store.

``readings -> withWatermark -> groupBy(sensor, window) -> update mode ->
foreachBatch(append epoch)``. Each trigger emits the windows whose aggregate
changed; late rows within the watermark merge into their window (readers take
the row of the newest epoch), rows later than the watermark are dropped and
the window's state is evicted. The checkpoint holds source offsets and the
state store, so a restarted query resumes without loss or double counting. A
retried epoch replaces its own folders; a store is marked with the query that
writes it and refuses another. Rows carry a time-to-live: readers leave out
what is past it, and the writer deletes whole hours that can hold nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolith.functions.constants import FLUSH_INTERVAL, SENSOR_SIGMA, TTL_HOURS, WINDOW_DURATION
from aerolith.operators.windows import window_aggregates
from aerolith.sinks import append_epoch, checkpoint_id, claim, expire_partitions, partition_values, with_ttl

STORE_KEYS = ("sensor_id", "window_start")
# Store partitions by window time: hours in live operation, so that readers of
# the last minutes prune to one or two folders an epoch and expiry deletes whole
# hours; days for a replay whose single batch spans many days.
STORE_PARTITION = "window_part"
GRAINS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}
PYTHON_GRAINS = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d"}


def hot_aggregates(
    readings: DataFrame,
    ts_col: str = "reading_ts_utc",
    watermark: str = "2 minutes",
    duration: str = WINDOW_DURATION,
    sigma: Mapping[str, float] = SENSOR_SIGMA,
    decimals: bool = True,
) -> DataFrame:
    """Streaming (or batch) window aggregates with an event-time watermark.

    Readings lacking a value or target stay in their window (``invalid_count``);
    the aggregates ignore their NULLs, so they never block a window's output.
    """
    if readings.isStreaming:
        readings = readings.withWatermark(ts_col, watermark)
    return window_aggregates(readings, ts_col=ts_col, duration=duration, sigma=sigma, decimals=decimals)


def store_batch(
    store_path: str,
    ttl_hours: int = TTL_HOURS,
    partition_grain: str = "hour",
    checkpoint: str | None = None,
    expire_every: int = 0,
):
    """``foreachBatch`` function: stamp ``updated_at``/``ttl`` and append the epoch.

    One action on the batch, so the stateful plan runs once per trigger. With
    ``checkpoint``, the store is claimed for its query. Every ``expire_every``
    epochs, partitions whose windows lie ``ttl_hours`` or more (and one whole
    partition) before the newest stored one are deleted: in live operation,
    where windows are written as they happen, all their rows are past their
    time-to-live.
    """
    fmt = GRAINS[partition_grain]

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if checkpoint:
            claim(spark, store_path, checkpoint_id(spark, checkpoint))
        rows = with_ttl(batch, ttl_hours).withColumn(STORE_PARTITION, F.date_format("window_start", fmt))
        append_epoch(rows, store_path, epoch_id, STORE_KEYS, STORE_PARTITION)
        if expire_every and epoch_id % expire_every == expire_every - 1:
            stored = partition_values(spark, store_path, STORE_PARTITION)
            span = timedelta(hours=ttl_hours) + (timedelta(days=1) if partition_grain == "day" else timedelta(hours=1))
            if stored:
                oldest = datetime.strptime(stored[-1], PYTHON_GRAINS[partition_grain]) - span
                expire_partitions(spark, store_path, STORE_PARTITION, oldest.strftime(PYTHON_GRAINS[partition_grain]))

    return run


def start_hot_path(
    readings: DataFrame,
    store_path: str,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
    partition_grain: str = "hour",
    expire_every: int = 0,
    **kwargs,
) -> StreamingQuery:
    """Start the hot-path query. ``output_mode="append"`` emits each window
    once, after the watermark passes its end (closed windows only).
    ``expire_every`` epochs (0: never, as in replays) old partitions are deleted."""
    aggs = hot_aggregates(readings, **kwargs)
    writer = (
        aggs.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store_batch(store_path, partition_grain=partition_grain, checkpoint=checkpoint, expire_every=expire_every))
    )
    writer = writer.trigger(**(trigger or {"processingTime": FLUSH_INTERVAL}))
    return writer.start()
