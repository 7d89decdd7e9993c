"""Dimension lookups with a checked broadcast.

A dimension side is broadcast only when the optimizer's size estimate for it
(file sizes for scans, upper-bound propagation through filters and aggregates)
is below a limit. Above the limit the join is left to Spark: a sort-merge or
shuffled-hash join on the key, which AQE may still turn into a broadcast at
run time from the real shuffle sizes, and whose skewed partitions AQE splits.

Files are packed: a few megabytes of them may hold millions of rows, which the
driver and every executor would keep unpacked. The rows of a dimension that is
read from files are therefore counted, and it is broadcast by its size in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_BYTES, FIELD_BYTES, TEXT_BYTES = 48, 8, 24  # in memory: a row and its place in a hash table, a field, a value of variable length
COUNTED_FROM = 1024  # rows are counted in files of this part of the limit or more


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes (None if unavailable)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("aerolith.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_LIMIT


def _read_only(df: DataFrame) -> bool:
    """Whether ``df`` is a scan of files, at most with columns chosen and rows filtered: counting it computes nothing else."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().apply(0)
    return plan.children().isEmpty() and bool(df.inputFiles())


def memory_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` in a broadcast hash table. Counts them."""
    fixed = (NumericType, BooleanType, DateType, TimestampType)
    return df.count() * (ROW_BYTES + sum(FIELD_BYTES + (0 if isinstance(f.dataType, fixed) else TEXT_BYTES) for f in df.schema))


def _unpacked_beyond(dim: DataFrame, size: int, bound: int) -> bool:
    """Whether files of ``size`` bytes, within ``bound``, hold more than ``bound`` bytes of rows."""
    return bound / COUNTED_FROM < size <= bound and _read_only(dim) and memory_bytes(dim) > bound


def fits_broadcast(dim: DataFrame, limit: int | None = None) -> bool:
    """Whether ``dim`` is within ``limit`` bytes, by the optimizer's estimate and, where it is read from files, in memory."""
    size = estimated_bytes(dim)
    bound = broadcast_limit(dim) if limit is None else limit
    return size is not None and size <= bound and not _unpacked_beyond(dim, size, bound)


def maybe_broadcast(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """``broadcast(dim)`` if it is within ``limit`` bytes. Files that hold more rows than that are
    not left to Spark's own choice, which goes by the size of the files."""
    size = estimated_bytes(dim)
    bound = broadcast_limit(dim) if limit is None else limit
    if size is None or size > bound:
        return dim
    return dim.hint("merge") if _unpacked_beyond(dim, size, bound) else F.broadcast(dim)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "left",
    limit: int | None = None,
) -> DataFrame:
    """Fact-to-dimension join with a size-checked broadcast of ``dim``."""
    return fact.join(maybe_broadcast(dim, limit), on, how)
