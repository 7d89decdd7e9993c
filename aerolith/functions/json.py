"""JSON payload expressions: parse with a declared schema, serialise rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def parse_payload(
    df: DataFrame,
    value_col: str,
    schema: StructType,
    out: str = "payload",
) -> DataFrame:
    """Parse a JSON text column with ``schema``; keep the raw text of bad rows.

    A malformed document gives a *non-null* struct whose fields are NULL except
    ``_corrupt_record``, so callers must test that field, not the struct.

    The struct comes out of a one-element array: the optimizer copies a plain
    column's expression into every filter on it, and each copy parses (and
    makes, where it is computed) the document again.
    """
    with_corrupt = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    parsed = F.from_json(
        F.col(value_col).cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return df.select(*[c for c in df.columns if c != out], F.explode(F.array(parsed)).alias(out))


def is_malformed(payload: str = "payload") -> Column:
    return F.col(f"{payload}.{CORRUPT}").isNotNull() | F.col(payload).isNull()


def json_field(col: str | Column, path: str, type_name: str) -> Column:
    """Scalar at a JSON path, cast safely (NULL when absent or not castable)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, path).try_cast(type_name)


def to_json_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Row -> ``(key, value)`` with the whole row as JSON text in ``value``."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    if key_col is None:
        return df.select(F.lit(None).cast("string").alias("key"), value)
    return df.select(F.col(key_col).cast("string").alias("key"), value)
