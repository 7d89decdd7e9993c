"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolith.session import free_shuffles, scratch_path  # noqa: F401 - operators take both from here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage and lets several consumers read one computation; lost
    executors cost a re-read of shared files, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a :func:`saved` table that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.saved_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def byte_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column as its UTF-8 bytes (no decoding)."""
    return batch.column(name).cast(pa.binary())


def row_chunks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows regrouped so that ``column`` holds about ``most_bytes`` per chunk.

    A single row larger than that is a chunk of its own: rows are never cut.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for k, n in enumerate(lengths):
            if size and size + n > most_bytes:
                if k > start:
                    held.append(batch.slice(start, k - start))
                yield _joined(held)
                held, size, start = [], 0, k
            size += n
        if len(lengths) > start:
            held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    whole = pa.Table.from_batches(parts).combine_chunks()
    return whole.to_batches()[0]


def mapped(df: DataFrame, each: Callable[[pa.RecordBatch], dict], schema: str, column: str, most_bytes: int) -> DataFrame:
    """``mapInArrow`` over chunks of about ``most_bytes`` of ``column``; ``each`` returns columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, column, most_bytes):
            if chunk.num_rows:
                yield pa.RecordBatch.from_pydict(each(chunk))

    return df.mapInArrow(run, schema)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks (functions travel by value, their globals do not stay)."""
    return sys.modules.setdefault("_aerolith_worker_cache", types.ModuleType("_aerolith_worker_cache")).__dict__.setdefault(name, {})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def running_sums(sizes: Column, step: int = 256) -> Column:
    """Sum of all earlier elements, for each element of an array of numbers: by blocks, so that long arrays stay cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)

    def placed(r: Column) -> Column:
        last = F.floor((F.size(r) - 1) / step)
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: total(F.slice(r, (b * step + 1).cast("int"), F.lit(step))))

        def at(sums: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                block = F.floor(i / step).cast("int")
                return total(F.slice(sums, F.lit(1), block)) + total(F.slice(r, block * step + 1, i % step))

            return F.transform(r, one)

        return let(blocks, at)

    return let(sizes, placed)
