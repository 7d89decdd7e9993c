"""Bronze ingest: JSON messages of several topics -> typed tables, one pass a micro-batch.

One streaming query reads all topics. Each message is parsed once, with its
topic's declared schema; the parsed batch is kept while it is written to its
topics' tables and to quarantine. Rows land under ``date``/``hour`` of
processing time and an ``epoch`` folder that a retried micro-batch replaces,
so a batch interrupted between its writes and its commit lands once. With
``resends``, message ids are remembered in the query's state for a span of
event time: a message sent again does not land again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from aerolith.functions.clean import non_blank
from aerolith.functions.json import CORRUPT
from aerolith.session import scratch_path
from aerolith.sinks import checkpoint_id, delete_path

PARTITIONS = ("date", "hour", "epoch")
PROVENANCE = ("topic", "partition", "offset", "key", "timestamp")
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


@dataclass(frozen=True)
class Route:
    """Where a topic's records go. A record whose ``id_col`` is NULL or blank is rejected."""

    schema: StructType
    path: str
    id_col: str | None = None


@dataclass(frozen=True)
class Resends:
    """Messages equal in ``keys`` within ``delay`` of ``event_time`` are one message."""

    keys: Sequence[str]
    event_time: str
    delay: str


def landing_columns(df: DataFrame) -> DataFrame:
    """Landing ``date`` and ``hour``. In a streaming plan the clock is that of
    the planned batch, so a retry lands in the same folders."""
    now = F.current_timestamp()
    return df.withColumns({"date": F.date_format(now, "yyyy-MM-dd"), "hour": F.date_format(now, "HH")})


def without_resends(messages: DataFrame, resends: Resends) -> DataFrame:
    """First message of each id. State per id is dropped once the watermark has
    passed its time by ``delay``; older messages are late and dropped as such."""
    return messages.withWatermark(resends.event_time, resends.delay).dropDuplicatesWithinWatermark(list(resends.keys))


def _doc(k: int) -> str:
    return f"__doc{k}"


def parse_routes(messages: DataFrame, routes: dict[str | None, Route]) -> DataFrame:
    """Provenance columns, one document struct per route (NULL for other topics'
    messages), the raw text of rejects and the ``reason`` of rejection.

    Reasons: ``no route`` (unknown topic), ``no value``, ``malformed``
    (not JSON, or a field of another type than declared), ``missing id``.
    A route without topic takes every message.
    """
    value = F.col("value").cast("string")
    docs, reason = [], F.when(F.lit(False), F.lit(""))
    known: Column = F.lit(False)
    for k, (topic, route) in enumerate(routes.items()):
        mine = F.lit(True) if topic is None else F.coalesce(F.col("topic") == F.lit(topic), F.lit(False))
        known = known | mine
        schema = StructType([*route.schema.fields, StructField(CORRUPT, StringType())])
        docs.append(F.from_json(F.when(mine, value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias(_doc(k)))
        bad = F.col(_doc(k)).isNull() | F.col(f"{_doc(k)}.{CORRUPT}").isNotNull()
        reason = reason.when(mine & F.col("raw").isNull(), "no value").when(mine & bad, "malformed")
        if route.id_col:
            reason = reason.when(mine & ~non_blank(f"{_doc(k)}.{route.id_col}"), "missing id")
    reason = F.when(~F.col("__known"), F.lit("no route")).otherwise(reason)
    kept = [c for c in PROVENANCE if c in messages.columns]
    return messages.select(*kept, value.alias("raw"), known.alias("__known"), *docs).withColumn("reason", reason).drop("__known")


def _land(rows: DataFrame, path: str, epoch: str, partitions: Sequence[str]) -> None:
    out = rows.withColumn("epoch", F.lit(epoch))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def land_batch(routes: dict[str | None, Route], checkpoint: str, quarantine: str | None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: every table and quarantine written from one kept batch.

    The parsed batch is kept in files of the shared scratch folder, the text of
    rejects only: all others are in their documents. Kept by ``persist`` it is
    read back from disk through one object stream, which holds a hundred column
    batches of ten thousand messages for each task.
    """

    def run(batch: DataFrame, epoch_id: int) -> None:
        # Epochs of another checkpoint have other names: a fresh start replaces nothing.
        epoch = f"{checkpoint_id(batch.sparkSession, checkpoint)[:8]}-{epoch_id:012d}"
        kept = [c for c in PROVENANCE if c in batch.columns]
        spark = batch.sparkSession
        kept_at = scratch_path(spark, "batch")
        try:
            text = F.when(F.col("reason").isNotNull(), F.col("raw"))
            batch.withColumn("raw", text).write.option("compression", "zstd").parquet(kept_at)
            parsed = spark.read.schema(batch.schema).parquet(kept_at)
            for k, (topic, route) in enumerate(routes.items()):
                good = parsed.where(F.col(f"{_doc(k)}").isNotNull() & F.col("reason").isNull())
                fields = [F.col(f"{_doc(k)}.{f.name}").alias(f.name) for f in route.schema.fields]
                extra = [c for c in kept if c not in route.schema.fieldNames()]
                _land(good.select(*fields, *extra, "date", "hour"), route.path, epoch, PARTITIONS)
            if quarantine:
                rejects = parsed.where(F.col("reason").isNotNull()).select(*kept, "raw", "reason", "date", "hour")
                by_topic = ["topic"] if "topic" in kept else []
                _land(rejects, quarantine, epoch, [*by_topic, *PARTITIONS])
        finally:
            delete_path(spark, kept_at)

    return run


def start_routes(
    messages: DataFrame,
    routes: dict[str | None, Route],
    checkpoint: str,
    quarantine: str | None = None,
    resends: Resends | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the one landing query of all ``routes`` (topic -> :class:`Route`).

    Tables keep topic, partition, offset, key and timestamp of each message
    where the source has them. Quarantine holds the raw text with a reason,
    by topic.
    """
    if resends:
        messages = without_resends(messages, resends)
    parsed = landing_columns(parse_routes(messages, routes))
    writer = parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land_batch(routes, checkpoint, quarantine))
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def start_ingest(
    messages: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    topic: str | None = None,
    id_col: str | None = None,
    resends: Resends | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the landing query of one topic (of all messages, without ``topic``)."""
    if topic is not None and "topic" in messages.columns:
        messages = messages.filter(F.col("topic") == F.lit(topic))
    return start_routes(messages, {None: Route(schema, path, id_col)}, checkpoint, quarantine_path, resends, trigger)
