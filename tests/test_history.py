import os
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from aerolith.operators import history as H, incremental, scd2
from aerolith.operators.silver import silver_air

SCHEMA = "k string, color string, size int, note string, t timestamp"
DAY = date(2026, 1, 1)


def readings(rng, keys="abc", days=12):
    rows = []
    for k in [*keys, None]:
        for n in range(days):
            for _ in range(rng.randrange(3)):
                at = datetime(2026, 1, 1) + timedelta(days=n, seconds=rng.randrange(86_400))
                rows.append((k, rng.choice(["red", "blue", None]), rng.choice([1, 1, 2]), f"n{rng.randrange(5)}", at))
    return rows


def plain(rows, key):
    return sorted(([(v is None, str(v)) for v in (getattr(r, c) for c in key)] for r in rows))


def test_history_equals_a_merge_a_day(spark):
    rows = readings(random.Random(4))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    dim = None
    for n in range(12):
        as_of = DAY + timedelta(days=n)
        seen = [r for r in rows if r[4].date() == as_of]
        if not seen:
            continue
        snap = scd2.snapshot(spark.createDataFrame(seen, SCHEMA), "k", ["color", "size"], "t")
        dim = scd2.first_load(snap, "k", "sk", as_of) if dim is None else scd2.merge(dim, snap, "k", ["color", "size"], "sk", as_of)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    found = H.history(df, "k", ["color", "size"], ["t"], "sk").collect()
    columns = ["k", "color", "size", "effective_date", "expiry_date", "is_current"]
    assert plain(found, columns) == plain(dim.collect(), columns)
    assert sorted(r.sk for r in found) == list(range(1, len(found) + 1))


def test_history_type1_order_and_undated_readings(spark):
    t = datetime(2026, 1, 1, 9)
    rows = [
        ("a", "red", 1, "first", t),
        ("a", "red", 2, "same day, later", t + timedelta(hours=1)),
        ("a", "red", 2, "unchanged", t + timedelta(days=1)),
        ("a", "blue", 2, "last", t + timedelta(days=5)),
        ("a", "green", 9, "undated", None),
        ("b", None, None, None, None),
    ]
    found = H.history(spark.createDataFrame(rows, SCHEMA), "k", ["color", "size"], ["t"], "sk", type1=["note"]).orderBy("sk").collect()
    got = [(r.k, r.color, r.size, r.note, r.effective_date, r.expiry_date, r.is_current, r.version_no) for r in found]
    assert got == [
        ("a", "red", 2, "last", DAY, date(2026, 1, 6), False, 1),
        ("a", "blue", 2, "last", date(2026, 1, 6), date(9999, 12, 31), True, 2),
    ]
    assert H.history(spark.createDataFrame([], SCHEMA), "k", ["color"], ["t"], "sk").collect() == []


def test_carry_lookup_equals_the_range_join(spark):
    rng = random.Random(8)
    dim = H.history(spark.createDataFrame(readings(rng), SCHEMA), "k", ["color", "size"], ["t"], "sk")
    closed = dim.where("k = 'c'").limit(0)
    dim = spark.createDataFrame(dim.unionByName(closed).collect(), dim.schema)
    # one key's last version is closed without a successor
    dim = dim.withColumn("expiry_date", F.when((F.col("k") == "b") & F.col("is_current"), F.lit(date(2026, 1, 20))).otherwise(F.col("expiry_date")))
    facts = [(rng.choice(["a", "a", "a", "b", "zz", None]), rng.choice([None, *[datetime(2025, 12, 1) + timedelta(days=d) for d in range(90)]]), i) for i in range(300)]
    fact = spark.createDataFrame(facts, "id string, at timestamp, n int").repartition(4)
    wanted = scd2.asof_lookup(fact, dim, "id", "k", "at", ["sk", "color"]).orderBy("n").collect()
    for bucket in ("day", "month", "year"):
        found = H.carry_lookup(fact, dim, "id", "k", "at", ["sk", "color"], bucket=bucket)
        assert found.columns == ["id", "at", "n", "sk", "color"]
        assert found.orderBy("n").collect() == wanted
    shut = scd2.asof_lookup(fact, dim, "id", "k", "at", ["sk"], open_first=False).orderBy("n").collect()
    assert H.carry_lookup(fact, dim, "id", "k", "at", ["sk"], open_first=False).orderBy("n").collect() == shut
    assert sum(r.sk is None for r in shut) > sum(r.sk is None for r in wanted)


def test_no_plan_step_joins_facts_with_versions(spark):
    dim = H.history(spark.createDataFrame(readings(random.Random(1)), SCHEMA), "k", ["color"], ["t"], "sk")
    fact = spark.createDataFrame([("a", datetime(2026, 1, 3))], "id string, at timestamp")
    plan = H.carry_lookup(fact, spark.createDataFrame(dim.collect(), dim.schema), "id", "k", "at", ["sk"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# --- incremental loads ----------------------------------------------------------------------

AIR = "station_id string, area_en string, reading_date string, reading_time string, pm25_value double, lat string, lon string, aqi_param string, ingested_at string"


def air(day, hour, value, sent, station="s1", param="PM25"):
    return (station, "north", day, f"{hour:02d}:00", value, "1.5", "2", param, f"2026-06-01T00:00:{sent:02d}Z")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_two_loads_equal_one_and_leave_other_months_alone(spark, tmp):
    first = [air("2026-01-10", 9, 10.0, 1), air("2026-01-10", 10, 30.0, 1), air("2026-02-03", 9, 5.0, 1), air("2026-02-03", 9, 6.0, 2), air("bad", 9, 1.0, 1)]
    second = [air("2026-02-03", 9, 7.0, 3), air("2026-02-03", 10, -1.0, 3, param="O3"), air("2026-03-01", 1, 8.0, 3), air("2026-02-03", 9, 99.0, 0)]
    silver, states = os.path.join(tmp, "silver"), os.path.join(tmp, "states")
    frame = lambda rows: spark.createDataFrame(rows, AIR)
    for load, months in ((first, ["2026-01", "2026-02"]), (second, ["2026-02"]), ([], [])):
        before = files(tmp)
        touched = incremental.load_silver_air(spark, frame(load), silver)
        assert touched == months  # 2026-03-01 01:00 in Bangkok is still February in UTC
        if touched:
            incremental.load_daily_states(spark, silver, states, touched, 6.5)
        kept = {f: t for f, t in before.items() if not any(f"load_part={m}" in f for m in touched)}
        assert kept.items() <= files(tmp).items()
    whole = silver_air(frame(first + second)).where("reading_ts_utc IS NOT NULL")
    rows = incremental.silver_rows(spark, silver).select(*whole.columns)
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect()))

    direct = incremental.finish_states(incremental.daily_states(whole, 6.5), ["reading_date", "station_id"])
    stored = incremental.finish_states(spark.read.parquet(states), ["reading_date", "station_id"])
    assert sorted(map(str, direct.collect())) == sorted(map(str, stored.collect()))
    by_day = {r.reading_date: r for r in stored.collect()}
    feb = by_day[date(2026, 2, 3)]
    assert (feb.avg_pm25, feb.max_pm25, feb.hours_exceeding_threshold, feb.dominant_aqi_param) == (7.0, 7.0, 1, "O3")


def test_states_of_any_split_add_up(spark):
    rng = random.Random(3)
    rows = [air(f"2026-01-{rng.randrange(1, 4):02d}", rng.randrange(7, 24), rng.choice([None, 1.0, 9.0, 4.0]), 1, rng.choice("xy"), rng.choice(["A", "B", None])) for _ in range(200)]
    silver = silver_air(spark.createDataFrame(rows, AIR))
    parts = [incremental.daily_states(silver.where(F.pmod(F.xxhash64("reading_ts_utc"), F.lit(3)) == k), 4.0) for k in range(3)]
    merged = incremental.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    grain = ["reading_date", "station_id"]
    shown = lambda s: sorted(str([v for v in r]) for r in incremental.finish_states(s, grain).collect())
    assert shown(merged) == shown(incremental.daily_states(silver, 4.0))


def test_first_load_makes_its_rows_once_and_sets_nothing_aside(spark, tmp, monkeypatch):
    made, real = [], incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda df, name: made.append(name) or real(df, name))
    silver = os.path.join(tmp, "silver")
    for names in (["load"], ["load", "upsert"]):
        made.clear()
        incremental.load_silver_air(spark, spark.createDataFrame([air("2026-01-10", 9, 10.0, 1)], AIR), silver)
        assert made == names
    assert incremental.silver_rows(spark, silver).count() == 1


def test_what_a_load_sets_aside_is_deleted(spark, tmp):
    import os

    from aerolith.operators.incremental import upsert_partitions
    from aerolith.session import scratch_root

    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    for load in ([("a", 1, "p"), ("b", 1, "p")], [("a", 2, "p"), ("c", 2, "q")]):
        new = spark.createDataFrame(load, "k string, at int, part string")
        upsert_partitions(spark, new, f"{tmp}/t", ["k", "part"], ["at"], "part")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/t").collect()) == [("a", 2, "p"), ("b", 1, "p"), ("c", 2, "q")]
    assert not [f for f in set(os.listdir(root)) - before if f.startswith(("load-", "upsert-"))]


def test_daily_summary_deals_states_once(spark):
    from aerolith.operators.incremental import daily_states, daily_summary

    rows = [("2026-01-01", 20260101, s, a, p, v) for s in "ab" for a, p, v in (("x", "O3", 1.0), ("x", "O3", 3.0), (None, "CO", None), ("y", None, 5.0))]
    silver = spark.createDataFrame(rows, "d string, date_key int, station_id string, area_en string, aqi_param string, pm25_value double")
    silver = silver.selectExpr("cast(d AS date) AS reading_date", "* except (d)")
    stations = spark.sql("SELECT 'a' AS station_id, 1 AS station_key, true AS is_current")
    regions = spark.sql("SELECT 'x' AS region_name, 7 AS region_key")
    found = daily_summary(daily_states(silver), stations, regions)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # one makes the states
    got = {(r.station_key, r.region_key): (r.avg_pm25, r.max_pm25, r.dominant_aqi_param) for r in found.collect()}
    # readings without a known region, or station, are a group each
    assert got == {(1, 7): (2.0, 3.0, "O3"), (1, None): (5.0, 5.0, "CO"), (None, 7): (2.0, 3.0, "O3"), (None, None): (5.0, 5.0, "CO")}
