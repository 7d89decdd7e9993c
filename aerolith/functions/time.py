"""Timestamp and calendar expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.constants import SOURCE_TIMEZONE


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_strings_to_utc(
    date_col: str | Column, time_col: str | Column, tz: str = SOURCE_TIMEZONE
) -> Column:
    """``yyyy-MM-dd`` + ``HH:mm`` local strings -> UTC timestamp.

    ``try_to_timestamp`` yields NULL for unparseable text instead of failing
    the job under ANSI mode.
    """
    text = F.concat(_c(date_col), F.lit(" "), _c(time_col), F.lit(":00"))
    local = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.to_utc_timestamp(local, tz)


def utc_to_local(ts: str | Column, tz: str = SOURCE_TIMEZONE) -> Column:
    """UTC timestamp -> wall clock of ``tz`` (presentation only)."""
    return F.from_utc_timestamp(_c(ts), tz)


def epoch_seconds_to_ts(col: str | Column) -> Column:
    return F.timestamp_seconds(_c(col))


def iso_to_ts(col: str | Column) -> Column:
    """ISO-8601 text with ``Z`` or ``+hh:mm`` offset -> timestamp (NULL if bad)."""
    return F.try_to_timestamp(_c(col))


def date_key(ts: str | Column) -> Column:
    """Smart date key ``yyyyMMdd`` as int (arithmetic, no string formatting)."""
    t = _c(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """Calendar attributes of a DATE column; ISO weekday 1=Monday..7=Sunday."""
    d = _c(day)
    iso_dow = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": iso_dow,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": iso_dow >= 6,
    }
