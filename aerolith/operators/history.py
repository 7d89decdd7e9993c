"""Type-2 history from readings in one pass, and point-in-time lookup without a range join."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.constants import FAR_FUTURE
from aerolith.operators.keys import dense_keys
from aerolith.operators.scd2 import CURRENT, EFFECTIVE, EXPIRY, with_validity

VERSION = "version_no"


def daily_states(readings: DataFrame, natural_key: str, attributes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(key, day, attributes): what a key's last reading of each day said.

    An aggregate with a partial step: a key holding a third of all readings
    leaves each task as one row a day.
    """
    pick = F.max(F.struct(*order, *[c for c in attributes if c not in order])).alias("__pick")
    days = readings.where(F.col(order[0]).isNotNull()).groupBy(natural_key, F.to_date(order[0]).alias("__day")).agg(pick)
    return days.select(natural_key, "__day", *[F.col(f"__pick.{c}").alias(c) for c in attributes])


def history(
    readings: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    order: Sequence[str],
    surrogate: str,
    type1: Sequence[str] = (),
    far_future: date = FAR_FUTURE,
) -> DataFrame:
    """All versions of every key, from all its readings, without a merge per day.

    The day-by-day merge keeps, for each key and day, the last reading
    (greatest ``order``, the event time first; then the greatest attributes),
    and starts a version on each day on which a ``tracked`` attribute differs,
    NULL-safe, from the day before. Here the days are compared with ``lag``,
    those that start a version are kept, and ``lead`` gives each its expiry.
    The windows see one row per key and day. ``type1`` attributes carry their
    latest value on all versions. ``version_no`` counts a key's versions,
    ``surrogate`` is dense over (key, effective date). Readings without event
    time have no place in the history and are left out; a NULL key is a key
    like any other.
    """
    attrs = [*tracked, *type1]
    days = daily_states(readings, natural_key, attrs, order)
    by_day = Window.partitionBy(natural_key).orderBy("__day")
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag(F.struct(*[F.col(c) for c in tracked])).over(by_day)
    starts = before.isNull() | ~before.eqNullSafe(F.struct(*[F.col(c) for c in tracked]))
    days = days.withColumns({c: F.last(c).over(whole) for c in type1}).withColumn("__starts", starts).where("__starts")
    expiry = F.lead("__day").over(by_day)
    versions = days.select(
        natural_key,
        *attrs,
        F.col("__day").alias(EFFECTIVE),
        F.coalesce(expiry, F.lit(far_future)).alias(EXPIRY),
        expiry.isNull().alias(CURRENT),
        F.row_number().over(by_day).alias(VERSION),
    )
    keyed = dense_keys(versions, [natural_key, EFFECTIVE], surrogate)
    return keyed.select(natural_key, *attrs, surrogate, EFFECTIVE, EXPIRY, CURRENT, VERSION)


def carry_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    event_date: str | Column,
    columns: Sequence[str],
    open_first: bool = True,
    bucket: str = "month",
) -> DataFrame:
    """Point-in-time lookup by carrying versions forward: the version with ``valid_from <= d < expiry_date``.

    Facts and versions are put on one time line per key, cut into ``bucket``s
    (``day``, ``month``, ...), and the last version before each fact is taken
    by a window. A bucket starts with a head: the version valid on its first
    day, from a time line of versions and bucket starts alone. So a key with a
    third of all facts spreads over as many tasks as it has buckets, each fact
    is shuffled once, and no pair of fact and version is formed. Facts without
    key or date get NULLs and stay where they are.
    """
    d = F.to_date(F.col(event_date) if isinstance(event_date, str) else event_date)
    shape = with_validity(dim, dim_key, open_first).select(
        F.col(dim_key).alias("__k"),
        F.coalesce("valid_from", F.to_date(F.lit("0001-01-01"))).alias("__t"),
        F.struct(F.col(EXPIRY).alias("__until"), *columns).alias("__v"),
    )
    versions = shape.where(F.col("__k").isNotNull())
    rows = fact.select(F.struct("*").alias("__f"), F.col(fact_key).alias("__k"), d.alias("__t"))
    placed = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    facts = rows.where(placed).withColumn("__b", F.trunc("__t", bucket) if bucket != "day" else F.col("__t"))

    none = F.lit(None).cast(versions.schema["__v"].dataType)
    starts = facts.select("__k", "__b").distinct().select("__k", F.col("__b").alias("__t"), none.alias("__v"), F.lit(1).alias("__kind"))
    line = versions.withColumn("__kind", F.lit(0)).unionByName(starts)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last("__v", ignorenulls=True).over(so_far(Window.partitionBy("__k").orderBy("__t", "__kind")))
    heads = line.withColumn("__v", carried).where("__kind = 1").withColumn("__b", F.col("__t"))

    inner = versions.withColumn("__b", F.trunc("__t", bucket) if bucket != "day" else F.col("__t"))
    no_fact = F.lit(None).cast(rows.schema["__f"].dataType).alias("__f")
    every = (
        heads.select("__k", "__b", "__t", "__v", no_fact, F.lit(0).alias("__kind"))
        .unionByName(inner.select("__k", "__b", "__t", "__v", no_fact, F.lit(1).alias("__kind")))
        .unionByName(facts.select("__k", "__b", "__t", none.alias("__v"), "__f", F.lit(2).alias("__kind")))
    )
    last = F.last("__v", ignorenulls=True).over(so_far(Window.partitionBy("__k", "__b").orderBy("__t", "__kind")))
    found = every.withColumn("__v", last).where("__kind = 2").select("__f", "__t", "__v")
    found = found.unionByName(rows.where(~placed).select("__f", "__t", none.alias("__v")))
    valid = F.col("__v.__until") > F.col("__t")
    return found.select("__f.*", *[F.when(valid, F.col(f"__v.{c}")).alias(c) for c in columns])
