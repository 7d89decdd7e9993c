"""Replay of a table as a stream: slice after slice, the query stopped and resumed between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolith.sinks import materialize

SLICE = "slice"


def time_slices(df: DataFrame, time: Column, n: int) -> DataFrame:
    """``df`` with ``slice`` 0..n-1: equal spans of time between the first and the last row."""
    us = F.unix_micros(time.cast("timestamp"))
    lo, hi = (df.agg(f(us).alias("t")).scalar() for f in (F.min, F.max))
    rows = df.withColumns({"__us": us, "__lo": lo, "__hi": hi})
    return rows.withColumn(SLICE, F.expr(f"cast((__us - __lo) * {n} div (__hi - __lo + 1) as int)")).drop("__us", "__lo", "__hi")


def feed(slices: DataFrame, n: int, folder: str, start: Callable[[], StreamingQuery]) -> None:
    """Append slices 0..n-1 of ``slices`` one by one to the stream's ``folder``.

    After each, ``start`` resumes the query from its checkpoint (with an
    ``availableNow`` trigger) and it runs until it has read the slice.
    """
    rows = materialize(slices, "slices")
    for k in range(n):
        rows.where(F.col(SLICE) == k).drop(SLICE).write.mode("append").parquet(folder)
        query = start()
        query.awaitTermination()


def state_rows(spark, checkpoint: str, operator: int = 0) -> DataFrame:
    """Rows of a streaming operator's state after the last committed batch: (partition_id, key, value)."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
