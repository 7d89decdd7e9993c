"""Latest-record-per-key de-duplication.

Both strategies reduce duplicates *before* the shuffle, so a key holding a
third of all rows ships one row per map task instead of a third of the data
to one reducer:

* ``window`` (default): ``row_number() OVER (PARTITION BY keys ORDER BY
  order DESC, rest DESC) = 1``; Spark plans a partial ``WindowGroupLimit``
  (per-partition top-1) below the exchange and a final one above it;
* ``agg``: ``max(struct(order..., rest...))`` per key, a partial + final
  aggregate. Struct ordering compares fields left to right with NULL lowest.

Either way the pick is ``order DESC NULLS LAST`` followed by every remaining
column as a total tie-break, so the chosen row is deterministic and both
strategies return the same rows.

Where keys mostly come once, :func:`latest_of_repeated` first finds those that
do not, from hashes of the keys alone; rows of all others are not moved at all.
Where a key has many rows, :func:`latest_by_time` sorts its newest only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.joins import broadcast_limit, fits_broadcast

_PICK = "__pick"
_HASH = "__key_hash"
MOST_BITS, LEAST_BITS = 256, 8  # bits of the packed set of hashes for each hash


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    method: str = "window",
) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order`` (then the greatest
    remaining columns as tie-break). Output columns and order equal the input's.

    ``method="agg"`` gives the aggregate form with the same pick.
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc_nulls_last() for c in order + rest]
        )
        return (
            df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .drop("__rn")
        )
    if method != "agg":
        raise ValueError(f"unknown method {method!r}")
    fields = order + rest
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in fields])).alias(_PICK))
    return picked.select(
        *[F.col(c) for c in keys], *[F.col(f"{_PICK}.{c}").alias(c) for c in fields]
    ).select(*df.columns)


def latest_by_time(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The rows of ``latest_per_key(df, keys, [time])``, sorting only those of each key's greatest ``time``.

    The greatest times are a hash aggregate of two narrow columns, written
    down and told to all tasks. With too many keys for a broadcast, all rows
    are sorted as in :func:`latest_per_key`. ``df`` is read twice and has to
    give the same rows each time.
    """
    from aerolith.sinks import materialize

    newest = materialize(df.groupBy(*keys).agg(F.max(time).alias(time)), "newest-times")
    if not fits_broadcast(newest):
        return latest_per_key(df, keys, [time])
    same = reduce(and_, [df[c].eqNullSafe(newest[c]) for c in (*keys, time)])
    return latest_per_key(df.join(F.broadcast(newest), same, "left_semi"), keys, [time])


def hash_packs(hashes: DataFrame, bits: int) -> DataFrame:
    """(pack, words): the set of the hashes' low bits, ``bits`` (a power of two) in all, 64 words of 64 bits a row."""
    at = F.col(_HASH).bitwiseAND(F.lit(bits - 1))
    word = F.shiftright(at, 6).alias("word")
    words = hashes.groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({_HASH} & 63 as int))")).alias("ones"))
    held = F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(63).cast("int"), "ones")))
    packs = words.groupBy(F.shiftright("word", 6).alias("pack")).agg(held.alias("held"))
    return packs.select("pack", F.expr("transform(sequence(0, 63), i -> coalesce(try_element_at(held, i), 0L))").alias("words"))


def latest_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of :func:`latest_per_key`, sorting and shuffling only those whose key may come again.

    A first pass over the keys alone counts their 64-bit hashes. Hashes met
    several times are written down, and the set of their low bits is told to
    all tasks, packed, so that it takes a few bytes a hash: rows outside of it
    are the only ones of their key and pass as they are (keys that merely
    share the bits are told apart later). With too many hashes for a
    broadcast, all rows are sorted as in :func:`latest_per_key`. ``df`` is
    read several times and has to give the same rows each time.
    """
    from aerolith.sinks import materialize

    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    counted = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counted.where("n > 1").select(_HASH), "repeated-keys")
    n, most = repeated.count(), broadcast_limit(df) * 8 // 2  # half of the limit: packs are copied as the table of them is built
    bits = max(4096, 1 << (n * MOST_BITS).bit_length())
    while bits > most and bits // 2 >= n * LEAST_BITS:
        bits //= 2
    if bits > most:
        return latest_per_key(df, keys, order)
    at = F.col(_HASH).bitwiseAND(F.lit(bits - 1))
    packs = F.broadcast(materialize(hash_packs(repeated, bits), "key-packs"))
    bit = F.getbit(F.element_at("words", (F.shiftright(at, 6).bitwiseAND(63) + 1).cast("int")), at.bitwiseAND(63).cast("int"))
    met = (F.shiftright(at, 12) == F.col("pack")) & (bit == 1)
    once = hashed.join(packs, met, "left_anti")
    again = hashed.join(packs, met, "left_semi")
    return once.drop(_HASH).unionByName(latest_per_key(again.drop(_HASH), keys, order))
