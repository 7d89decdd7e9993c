"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import json
import math
import sys
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from aerolith.plans.registry import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
# Whole cold paths write thousands of daily folders: their parts are tested in test_plans_pipeline.
SLOW = {"cold_path_second_run"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_documented():
    assert set(ORACLE) == set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["station_name_en", "area_en", "avg_pm25", "max_pm25", "hourly_readings"]
    assert 0 < df.count() <= 10


def _duck_type(dt):
    from pyspark.sql import types as T

    simple = {T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
              T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP"}
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return simple.get(type(dt), dt.simpleString())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: _duck_type(f.dataType) for f in df.schema.fields} == types
    cur = duck.execute(ORACLE[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)
