import random

from pyspark.sql import functions as F

from aerolith.operators.dedup import latest_by_time, latest_of_repeated, latest_per_key
from aerolith.operators.keys import dense_keys, duplicate_keys


def _rows():
    return [
        ("s1", "2026-01-01", "10:00", "2026-01-01T10:05:00", 1.0),
        ("s1", "2026-01-01", "10:00", "2026-01-01T10:09:00", 2.0),  # later ingest wins
        ("s2", "2026-01-01", "10:00", "2026-01-01T10:05:00", 3.0),
        ("s2", "2026-01-01", "10:00", "2026-01-01T10:05:00", 4.0),  # tie -> greater value
        ("s3", "2026-01-01", "10:00", None, 5.0),
        ("s3", "2026-01-01", "10:00", "2026-01-01T10:01:00", 0.5),  # null ingest loses
        (None, "2026-01-01", "10:00", None, 6.0),                   # null key part is a key
    ]


def test_latest_per_key_both_methods(spark):
    df = spark.createDataFrame(_rows(), "k string, d string, t string, ing string, v double")
    for m in ("window", "agg"):
        out = {(r.k): r.v for r in latest_per_key(df, ["k", "d", "t"], ["ing"], method=m).collect()}
        assert out == {"s1": 2.0, "s2": 4.0, "s3": 0.5, None: 6.0}, m


def test_latest_per_key_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", rnd.randint(0, 1000), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, ts int, v double").repartition(8)
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    want = {}
    for k, ts, v in rows:
        if k not in want or (ts, v) > want[k]:
            want[k] = (ts, v)
    assert got == want


def test_window_dedup_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    # partial WindowGroupLimit sits under the exchange (map-side top-1)
    head, _, tail = plan.partition("Exchange")
    assert "WindowGroupLimit" in head and "WindowGroupLimit" in tail


def test_dense_keys_partition_invariant(spark):
    names = [f"n{i:04d}" for i in range(500)]
    rnd = random.Random(1)
    rnd.shuffle(names)
    base = spark.createDataFrame([(n,) for n in names], "name string")
    expected = {n: i + 1 for i, n in enumerate(sorted(names))}
    for parts in (1, 4, 16):
        out = dense_keys(base.repartition(parts), ["name"], "k", num_partitions=parts)
        got = {r.name: r.k for r in out.collect()}
        assert got == expected, parts
        assert duplicate_keys(out, "k").count() == 0


def test_dense_keys_offset_and_scalar_start(spark):
    base = spark.createDataFrame([("b",), ("a",), ("c",)], "n string")
    start = spark.createDataFrame([(10,), (41,)], "m int").agg(F.max("m")).scalar()
    got = sorted((r.n, r.k) for r in dense_keys(base, ["n"], "k", start=start).collect())
    assert got == [("a", 42), ("b", 43), ("c", 44)]
    empty = base.filter("false")
    assert dense_keys(empty, ["n"], "k").count() == 0


def test_type1_members_keep_their_keys(spark):
    from aerolith.operators import dims

    first = spark.createDataFrame([("B",), ("C",)], "area_en string")
    v1 = dims.dim_region(first)
    v2 = dims.dim_region(spark.createDataFrame([("A",), ("C",)], "area_en string"), known=v1)
    assert {r.region_name: r.region_key for r in v2.collect()} == {"B": 1, "C": 2, "A": 3}


def test_one_instant_is_one_reading(spark):
    from aerolith.operators.silver import silver_sensor, unparsed_times

    rows = [("s", "2026-01-01T00:00:00Z"), ("s", "2026-01-01T07:00:00+07:00"), ("s", "bad"), ("s", "worse")]
    df = spark.createDataFrame(rows, "sensor_id string, reading_ts string").selectExpr(
        "*", "'t' AS sensor_type", "'z' AS zone_id", "'u' AS unit", "1.0D AS value", "1.0D AS target", "false AS is_anomaly")
    assert silver_sensor(df).count() == 3
    assert unparsed_times(df).count() == 2


def test_condition_without_description_is_found(spark):
    from aerolith.operators import dims, facts

    df = spark.range(2).selectExpr(
        "20260101 AS date_key", "id AS city_id", "'c' AS city_name", "1.0D AS temp_c", "1.0D AS feels_like_c", "1 AS pressure_hpa",
        "1 AS humidity_pct", "1.0D AS wind_speed_ms", "1 AS wind_deg", "1 AS visibility_m", "'Rain' AS weather_main",
        "if(id = 0, 'light', null) AS weather_desc", "timestamp'2026-01-01 00:00:00' AS reading_ts_utc", "date'2026-01-01' AS reading_date")
    fct = facts.fct_weather_hourly(df, dims.dim_weather_condition(df))
    assert sorted(r.weather_condition_key for r in fct.collect()) == [1, 2]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_of_repeated_equals_window_pick(spark):
    df = spark.createDataFrame(_rows() * 2 + [("s4", "2026-01-01", "10:00", "x", None)], "k string, d string, t string, ing string, v double")
    want = sorted(map(str, latest_per_key(df, ["k", "d", "t"], ["ing"]).collect()))
    assert sorted(map(str, latest_of_repeated(df, ["k", "d", "t"], ["ing"]).collect())) == want
    spark.conf.set("aerolith.broadcast.maxBytes", "1")  # too many repeated keys to broadcast
    try:
        assert sorted(map(str, latest_of_repeated(df, ["k", "d", "t"], ["ing"]).collect())) == want
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")


def test_silver_moves_only_rows_of_repeated_keys(spark):
    from aerolith.operators.silver import silver_weather

    df = spark.range(50).selectExpr("id AS city_id", "0L AS reading_ts", "'2026-01-01T00:00:00Z' AS ingested_at", "id AS temp_c")
    silver = silver_weather(df)
    once, again = _plan(silver).split("Window [", 1)
    assert "LeftAnti" in once and "Exchange hashpartitioning" not in once and "LeftSemi" in again
    assert silver.count() == 50


def test_supplier_places_are_broadcast_by_their_own_size(spark, tmp_path):
    from aerolith.plans import standins as S

    spark.sql("SELECT 1L AS l_suppkey, 1L AS l_orderkey, 1 AS l_linenumber, 1.0D AS l_quantity, 1.0D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, "
              "'R' AS l_returnflag, DATE'1995-01-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS s_suppkey, 'S' AS s_name, 1 AS s_nationkey, 1.0D AS s_acctbal FROM range(9)").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name, 1 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.conf.set("aerolith.broadcast.maxBytes", "20000")  # each table is below, the product of both above
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bronze = S.bronze_air(spark, str(tmp_path))
        assert "SortMergeJoin" not in _plan(bronze)
        assert [(r.station_id, r.area_en) for r in bronze.collect()] == [("1", "N")]
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_sorts_only_each_keys_newest_rows(spark):
    from datetime import datetime

    from aerolith.operators.scd2 import snapshot

    rnd = random.Random(3)
    rows = [(rnd.choice([None, "a", "b", "c", "d"]), rnd.choice([None, *range(5)]), rnd.choice([None, 1.0, float("nan")]), k % 4) for k in range(400)]
    rows = [(k, t if t is None or k == "d" else datetime(2026, 1, 1 + t), v, x) for k, t, v, x in rows if k != "d"] + [("d", None, 2.0, 1), ("d", None, 2.0, 1), ("d", None, None, 3)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double, x int").repartition(5)
    for attributes in (["v", "x"], ["x"]):
        wanted = latest_per_key(df.select("k", *attributes, "t"), ["k"], ["t"]).drop("t")
        found = snapshot(df, "k", attributes, "t")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())) and found.count() == 5
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan.partition("WindowGroupLimit")[2]


def test_latest_by_time_without_broadcast(spark):
    df = spark.range(60).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    spark.conf.set("aerolith.broadcast.maxBytes", "1")
    try:
        found = latest_by_time(df, ["k"], "t")
        assert {(r.k, r.t) for r in found.collect()} == {(t % 7, t) for t in range(53, 60)}
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")


def test_files_with_many_rows_are_not_broadcast(spark, tmp_path):
    from aerolith.operators.joins import estimated_bytes, lookup

    spark.range(50_000).selectExpr("id AS k", "'a rather long name of the same kind' AS name").coalesce(1).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    fact = spark.createDataFrame([(1, 7), (2, 60_000), (3, None)], "id long, k long")
    spark.conf.set("aerolith.broadcast.maxBytes", "1000000")  # the file is smaller, its rows take several megabytes
    try:
        assert estimated_bytes(dim) < 1_000_000
        found = lookup(fact, dim, "k")
        assert "BroadcastHashJoin" not in _plan(found)
        assert sorted((r.id, r.name) for r in found.collect() if r.name) == [(1, "a rather long name of the same kind")] and found.count() == 3
        assert "BroadcastHashJoin" in _plan(lookup(fact, dim.where("k < 100"), "k"))
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")


def test_repeated_hashes_are_told_packed(spark):
    df = spark.range(60_000).selectExpr("id % 40000 AS k", "id AS ing", "cast(id % 7 AS string) AS v")  # 20,000 keys come twice
    want = latest_per_key(df, ["k"], ["ing"]).agg(*[F.sum(c) for c in ("k", "ing", "v")], F.count("*")).first()
    spark.conf.set("aerolith.broadcast.maxBytes", "100000")  # their hashes take 160,000 bytes as they are
    try:
        found = latest_of_repeated(df, ["k"], ["ing"])
        assert "LeftAnti" in _plan(found)
        assert found.agg(*[F.sum(c) for c in ("k", "ing", "v")], F.count("*")).first() == want
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")
