"""Cleaning and scalar measure expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.constants import ANOMALY_SIGMA, DEFAULT_SIGMA, UNKNOWN


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sentinel_to_null(col: str | Column) -> Column:
    """Negative values are missing-data sentinels (-1, -999, ...) -> NULL."""
    c = _c(col)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def null_sentinels(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply :func:`sentinel_to_null` to those of ``columns`` the frame has."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: sentinel_to_null(c) for c in present}) if present else df


def parse_double(col: str | Column) -> Column:
    """Text -> double; unparseable or negative -> NULL."""
    return sentinel_to_null(_c(col).try_cast("double"))


def parse_int(col: str | Column) -> Column:
    """Text -> int; unparseable (including ``"12.0"``) or negative -> NULL."""
    return sentinel_to_null(_c(col).try_cast("int"))


def deviation(value: str | Column, target: str | Column, digits: int | None = 4) -> Column:
    d = _c(value) - _c(target)
    return F.round(d, digits) if digits is not None else d


def sigma_lookup(
    type_col: str | Column,
    sigma: Mapping[str, float],
    default: float = DEFAULT_SIGMA,
) -> Column:
    """sigma(type) from a literal map; unknown types get ``default``."""
    pairs = []
    for k, v in sigma.items():
        pairs += [F.lit(k), F.lit(float(v))]
    m = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(m, _c(type_col)), F.lit(float(default)))


def beyond_sigma(
    value: str | Column,
    target: str | Column,
    sigma: Column,
    k: float = ANOMALY_SIGMA,
) -> Column:
    """Anomaly test ``|value - target| > k * sigma`` (strict)."""
    return F.abs(_c(value) - _c(target)) > F.lit(float(k)) * sigma


def decimal4(col: str | Column) -> Column:
    return F.round(_c(col), 4).cast("decimal(18,4)")


def or_unknown(col: str | Column) -> Column:
    return F.coalesce(_c(col), F.lit(UNKNOWN))


def non_blank(col: str | Column) -> Column:
    """Key present: not NULL and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (F.trim(c) != "")


def any_changed(pairs: Iterable[tuple[str | Column, str | Column]]) -> Column:
    """Null-safe 'some attribute differs' over (new, old) column pairs."""
    cond = F.lit(False)
    for new, old in pairs:
        cond = cond | ~_c(new).eqNullSafe(_c(old))
    return cond
