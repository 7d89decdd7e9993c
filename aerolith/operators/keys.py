"""Surrogate keys.

``dense_keys`` numbers rows 1..n (plus an offset) in the order of a unique
natural key without a single-partition window: the frame is range-partitioned
and sorted, each row gets its position inside its partition from
``monotonically_increasing_id`` (partition index in the upper bits, position in
the lower 33), per-partition row counts are aggregated (one row per partition,
a bound set by the partition count, not the data), turned into running offsets
and broadcast back. Result equals ``row_number() OVER (ORDER BY nk)``.

The id-stamped frame is written once to the shared scratch folder and both the
counts and the keyed rows read that copy: the input is computed once, and ids
are fixed on disk, so a stage retried after an executor loss cannot renumber.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ID = "__mid"
_PID = "__pid"
_POS = "__pos"
_OFF = "__off"
_LOW_BITS = 33


def dense_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    key_col: str,
    start: int | Column = 0,
    num_partitions: int | None = None,
    key_type: str = "int",
) -> DataFrame:
    """Append ``key_col`` = start + row number in ``order_cols`` order.

    ``order_cols`` must be unique per row (a natural key) so that the numbering
    is deterministic and re-computation after an executor loss gives the same
    keys. ``start`` may be a literal or a scalar-subquery column (e.g. the
    current maximum key of a dimension).
    """
    from aerolith.sinks import materialize

    order = [F.col(c).asc_nulls_first() for c in order_cols]
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stamped = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(_ID, F.monotonically_increasing_id()),
        "dense-keys",
    )
    ranked = stamped.withColumns(
        {
            _PID: F.shiftright(F.col(_ID), _LOW_BITS),
            _POS: F.col(_ID).bitwiseAND(F.lit((1 << _LOW_BITS) - 1)),
        }
    )
    # One row per non-empty partition: bounded by the partition count.
    counts = ranked.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (
            F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))
        ).alias(_OFF),
    ).fillna({_OFF: 0})
    start_col = start if isinstance(start, Column) else F.lit(start)
    keyed = ranked.join(F.broadcast(offsets), _PID, "left").withColumn(
        key_col, (start_col + F.col(_OFF) + F.col(_POS) + F.lit(1)).cast(key_type)
    )
    return keyed.drop(_ID, _PID, _POS, _OFF)


def hash_key(cols: Sequence[str | Column]) -> Column:
    """Stable 64-bit key from a natural key (same input -> same key on re-run)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def wide_key(cols: Sequence[str | Column]) -> Column:
    """Stable 128-bit key from a natural key, as 32 hex digits.

    64 bits meet their first collisions at some 10^10 rows; 128 do not at any
    number of rows a table holds. Two hashes of differently salted input.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    half = lambda *salt: F.lower(F.lpad(F.hex(F.xxhash64(*salt, *parts)), 16, "0"))
    return F.concat(half(), half(F.lit("second half")))


def run_key() -> Column:
    """Unique per run, not stable across runs (``monotonically_increasing_id + 1``)."""
    return F.monotonically_increasing_id() + F.lit(1)


def duplicate_keys(df: DataFrame, key_col: str) -> DataFrame:
    """Keys that occur more than once (empty when the key is unique)."""
    return df.groupBy(key_col).count().filter(F.col("count") > 1)
