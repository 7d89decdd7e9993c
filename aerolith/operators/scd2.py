"""Type-2 slowly changing dimensions: first load, merge, point-in-time lookup.

The merge is one full-outer join between the current versions and the
incoming snapshot on the natural key; each joined row is classified as
new / changed / unchanged / missing, and the output is
``history ∪ kept-or-closed current ∪ inserted``. New versions get dense keys
continuing after the existing maximum (a scalar subquery, not a driver round
trip). A change on the day the current version took effect updates that
version in place, so no zero-length versions are produced.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.clean import any_changed
from aerolith.functions.constants import FAR_FUTURE
from aerolith.operators.dedup import latest_by_time
from aerolith.operators.joins import maybe_broadcast
from aerolith.operators.keys import dense_keys
from aerolith.sinks import materialize

EFFECTIVE = "effective_date"
EXPIRY = "expiry_date"
CURRENT = "is_current"
SCD_COLUMNS = (EFFECTIVE, EXPIRY, CURRENT)


def _d(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return F.to_date(value)
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def snapshot(
    readings: DataFrame,
    natural_key: str,
    attributes: Sequence[str],
    event_time: str,
) -> DataFrame:
    """Latest attribute values per natural key, by event time (ties broken by
    the attribute values), as the incoming side of a merge."""
    cols = [natural_key, *attributes]
    latest = latest_by_time(readings.select(*cols, event_time), [natural_key], event_time)
    return latest.select(*cols)


def first_load(
    incoming: DataFrame,
    natural_key: str,
    surrogate: str,
    as_of: date | str | Column,
    far_future: date = FAR_FUTURE,
) -> DataFrame:
    """All rows become current versions with dense keys 1..n in key order."""
    keyed = dense_keys(incoming, [natural_key], surrogate)
    return keyed.select(
        *incoming.columns,
        surrogate,
        _d(as_of).alias(EFFECTIVE),
        F.lit(far_future).alias(EXPIRY),
        F.lit(True).alias(CURRENT),
    )


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate: str,
    as_of: date | str | Column,
    type1: Sequence[str] = (),
    close_missing: bool = False,
    far_future: date = FAR_FUTURE,
    one_row_per_key: bool = False,
) -> DataFrame:
    """SCD2 merge of ``incoming`` (one row per natural key) into ``existing``.

    * new key -> insert a current version;
    * a ``tracked`` attribute differs (NULL-safe) -> close the current version
      (``expiry_date = as_of``, ``is_current = false``) and insert a new one;
    * unchanged -> keep; ``type1`` attributes are overwritten in place;
    * key absent from ``incoming`` -> keep (or close when ``close_missing``).
    The classified join is written once to the scratch folder. Re-running
    with the same snapshot changes nothing. A NULL key is a key
    like any other (NULL-safe join). Two incoming rows of one key, or a change
    dated before the current version took effect, fail the load;
    ``one_row_per_key`` tells that ``incoming`` (a :func:`snapshot`, say)
    cannot hold two, which saves the check's window.
    """
    as_of_c = _d(as_of)
    attrs = [c for c in incoming.columns if c != natural_key]
    out_cols = existing.columns
    is_cur = F.coalesce(F.col(CURRENT), F.lit(False))
    history = existing.filter(~is_cur)
    current = existing.filter(is_cur)

    cur = current.select(F.lit(True).alias("c__here"), *[F.col(c).alias(f"c_{c}") for c in out_cols])
    inc = incoming.select(
        (F.lit(True) if one_row_per_key else F.count(F.lit(1)).over(Window.partitionBy(natural_key)) == 1).alias("i__here"),
        *[F.col(c).alias(f"i_{c}") for c in incoming.columns],
    )
    j = cur.join(inc, F.col(f"c_{natural_key}").eqNullSafe(F.col(f"i_{natural_key}")), "full_outer")

    has_cur = F.col("c__here").isNotNull()
    twice = F.raise_error(F.concat(F.lit("two incoming rows of key "), F.col(f"i_{natural_key}").cast("string")))
    has_inc = F.when(F.col("i__here") == F.lit(False), twice.cast("boolean")).otherwise(F.col("i__here").isNotNull())
    differs = any_changed((f"i_{a}", f"c_{a}") for a in tracked)
    back_dated = F.raise_error(F.concat(F.lit("change dated before the current version of key "), F.col(f"c_{natural_key}").cast("string")))
    changed = F.when(
        has_cur & has_inc & differs & (F.col(f"c_{EFFECTIVE}") > as_of_c), back_dated.cast("boolean")
    ).otherwise(has_cur & has_inc & differs)
    same_day = F.col(f"c_{EFFECTIVE}") == as_of_c
    j = j.withColumns(
        {
            "__changed": changed,
            "__same_day": F.coalesce(same_day, F.lit(False)),
            "__has_cur": has_cur,
            "__has_inc": has_inc,
        }
    )
    j = materialize(j, "scd2-classified")  # one join for the kept and the inserted versions

    # Current versions kept, closed, updated in place (same day) or type-1 refreshed.
    in_place = F.col("__changed") & F.col("__same_day")
    close = (F.col("__changed") & ~F.col("__same_day")) | (
        F.lit(close_missing) & ~F.col("__has_inc")
    )
    kept_cols = []
    for c in out_cols:
        src = F.col(f"c_{c}")
        if c in attrs:
            take_new = in_place | (F.lit(c in type1) & F.col("__has_inc"))
            src = F.when(take_new, F.col(f"i_{c}")).otherwise(src)
        elif c == EXPIRY:
            src = F.when(close, as_of_c).otherwise(src)
        elif c == CURRENT:
            src = F.when(close, F.lit(False)).otherwise(src)
        kept_cols.append(src.alias(c))
    kept = j.filter(F.col("__has_cur")).select(*kept_cols)

    # New versions: new keys, and changes not on the current version's first day.
    inserts = j.filter(
        (F.col("__has_inc") & ~F.col("__has_cur")) | (F.col("__changed") & ~F.col("__same_day"))
    ).select(*[F.col(f"i_{c}").alias(c) for c in incoming.columns])
    max_key = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("m")).scalar()
    inserted = dense_keys(inserts, [natural_key], surrogate, start=max_key).select(
        *incoming.columns,
        surrogate,
        as_of_c.alias(EFFECTIVE),
        F.lit(far_future).alias(EXPIRY),
        F.lit(True).alias(CURRENT),
    )
    return history.unionByName(kept).unionByName(inserted, allowMissingColumns=True).select(*out_cols)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CURRENT) == F.lit(True))


def with_validity(dim: DataFrame, natural_key: str, open_first: bool = True) -> DataFrame:
    """Add ``valid_from``: the effective date, or NULL (open to the left) for a
    key's first version so that facts older than the first load still match."""
    if not open_first:
        return dim.withColumn("valid_from", F.col(EFFECTIVE))
    first = F.min(EFFECTIVE).over(Window.partitionBy(natural_key))
    return dim.withColumn("valid_from", F.when(F.col(EFFECTIVE) != first, F.col(EFFECTIVE)))


def asof_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    event_date: str | Column,
    columns: Sequence[str],
    open_first: bool = True,
    how: str = "left",
) -> DataFrame:
    """Point-in-time lookup: the version with ``valid_from <= d < expiry_date``.

    The join is an equi-join on the natural key with a range predicate, so
    Spark plans it as a (checked) broadcast or a sort-merge join on the key;
    versions never overlap, hence at most one match per fact row.
    """
    d = F.to_date(F.col(event_date) if isinstance(event_date, str) else event_date)
    versions = with_validity(dim, dim_key, open_first).select(
        F.col(dim_key).alias("__vk"),
        F.col("valid_from").alias("__vf"),
        F.col(EXPIRY).alias("__vt"),
        *columns,
    )
    fact = fact.withColumn("__d", d)
    cond = (
        (F.col(fact_key) == F.col("__vk"))
        & (F.col("__vf").isNull() | (F.col("__d") >= F.col("__vf")))
        & (F.col("__d") < F.col("__vt"))
    )
    return fact.join(maybe_broadcast(versions), cond, how).drop("__vk", "__vf", "__vt", "__d")
