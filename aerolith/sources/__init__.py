"""Batch and streaming readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV with an explicit schema; returns ``(rows, malformed)``, both scans of the files.

    PERMISSIVE mode keeps bad lines in a corrupt-record column. A line is
    tested by the columns that a query reads, so both sides read all of them:
    a projection of good columns cannot make a bad line good.
    """
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    parsed = (
        spark.read.schema(full)
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    never = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.fieldNames()])) < 0  # reads every column
    bad = F.col(CORRUPT).isNotNull() | never
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet (optionally hive-partitioned); a declared schema avoids
    per-file inference drift."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def kafka_options(
    servers: str,
    topics: Sequence[str],
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> dict[str, str]:
    """Reader options of a subscription. ``earliest`` reads what the topics hold,
    ``latest`` only what comes; either counts for the first start alone, after
    which the checkpoint has the offsets."""
    if starting not in ("earliest", "latest") and not starting.startswith("{"):
        raise ValueError("starting is earliest, latest or offsets as JSON")
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out | options


def kafka_stream(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Kafka subscription (needs the ``spark-sql-kafka`` package on the
    classpath; options as in :func:`kafka_options`). Offsets live in the query
    checkpoint, so restarts resume exactly where the last committed batch ended."""
    df = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options)).load()
    return df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "partition", "offset", "timestamp")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """File-source stream (new files under ``path`` are new data)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)
