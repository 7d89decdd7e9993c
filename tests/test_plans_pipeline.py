from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from aerolith import sinks
from aerolith.operators.joins import estimated_bytes, lookup
from aerolith.plans import standins as S
from aerolith.plans.registry import QUERIES

# These return the scan of what a run wrote; their stages are the other queries' and the operators' tests.
STREAMING_OR_IO = {"hot_windows_stream", "bronze_ingest", "csv_roundtrip", "cold_path", "load_report", "cold_path_second_run", "ingest_resent",
                   "topic_routes", "quarantine_reasons", "closed_windows", "state_left", "hot_cold_delta"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING_OR_IO))
def test_no_python_udf_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan


def test_small_dimension_is_broadcast(spark):
    li = S.table(spark, SF_SMALL, "lineitem")
    places = S.supplier_places(spark, SF_SMALL)
    assert estimated_bytes(places) < 64 * 1024 * 1024
    j = lookup(li, places, li.l_suppkey == places.s_suppkey)
    assert "BroadcastHashJoin" in _plan(j)


def test_oversized_side_is_not_broadcast(spark):
    li = S.table(spark, SF_SMALL, "lineitem")
    other = S.table(spark, SF_SMALL, "orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = lookup(li, other, li.l_orderkey == other.o_orderkey, limit=1)
        plan = j._jdf.queryExecution().sparkPlan().toString()  # before AQE re-planning
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    df = S.table(spark, SF_SMALL, "orders").filter(F.col("o_orderdate") < F.lit(date(1997, 1, 1))).select("o_custkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_partition_pruning_on_reading_date(spark, tmp):
    from aerolith import sinks

    df = spark.range(30).select(F.date_add(F.lit(date(2026, 1, 1)), F.col("id").cast("int")).alias("reading_date"), "id")
    sinks.write_partitioned(df, tmp + "/t")
    q = spark.read.parquet(tmp + "/t").filter(F.col("reading_date") >= F.lit(date(2026, 1, 25)))
    assert "PartitionFilters: [isnotnull(reading_date" in _plan(q)
    assert q.count() == 6


def test_cold_path_rerun_is_stable(spark, tmp):
    from aerolith.plans.pipeline import run_cold_path
    from aerolith.sinks import read_latest, versions

    # One year of readings keeps the number of daily partitions (files) small;
    # the registered cold_path query runs the same pipeline over whole tables.
    year = F.col("reading_date").startswith("1996")
    air = S.bronze_air(spark, SF_SMALL).filter(year)
    weather = S.bronze_weather(spark, SF_SMALL).filter(F.year(F.timestamp_seconds("reading_ts")) == 1996)
    sensor = S.bronze_sensor(spark, SF_SMALL).filter(F.col("reading_ts") < F.lit("2024-01-08"))
    args = (air, weather, sensor)
    r1 = run_cold_path(spark, *args, tmp + "/wh", date(2026, 1, 1), (date(1995, 12, 1), date(1997, 1, 31)))
    c1 = dict(r1.counts)
    r2 = run_cold_path(spark, *args, tmp + "/wh", date(2026, 1, 2), (date(1995, 12, 1), date(1997, 1, 31)))
    assert r2.counts == c1
    assert set(r1.duplicate_keys.values()) == {0} and len(c1) == 15
    # the calendar of these years lacks the sensors' days, and nothing else is missing
    assert {(t, c) for t, cols in r1.missing.items() for c, n in cols.items() if n} == {(t, "calendar_key") for t in ("fct_sensor_reading", "fct_sensor_anomaly_event")}
    assert c1["fct_air_quality_hourly"] == c1["silver_air"]
    assert c1["fct_weather_hourly"] == c1["silver_weather"]
    assert c1["fct_sensor_reading"] == c1["silver_sensor"]
    # re-running the SCD2 loads with the same snapshot adds a version but no rows
    assert versions(spark, r2.path("gold/dim_station")) == [1, 2]
    st = read_latest(spark, r2.path("gold/dim_station"))
    assert st.count() == st.filter("is_current").count() == st.select("station_id").distinct().count()
    fa = spark.read.parquet(r2.path("gold/fct_air_quality_hourly"))
    assert fa.filter(F.col("station_key").isNull()).count() == 0
    assert fa.select("air_quality_key").distinct().count() == fa.count()

    # a third run on changed input: a reload of half the stations leaves none of the other half behind
    half = air.filter(F.col("station_id").cast("int") % 2 == 0)
    r3 = run_cold_path(spark, half, weather, sensor, tmp + "/wh", date(2026, 1, 3), (date(1995, 12, 1), date(1997, 1, 31)))
    assert r3.counts["silver_air"] == spark.read.parquet(r3.path("silver/air_quality")).count() < c1["silver_air"]
    regions = read_latest(spark, r3.path("gold/dim_region"))
    assert regions.count() == regions.select("region_key").distinct().count() == c1["dim_region"]


def test_newest_days_are_pruned_by_the_calendar(spark):
    from aerolith.plans.registry import partitioned_fct_sensor
    from aerolith.plans import marts

    fact, dim_date, newest, zone, _ = partitioned_fct_sensor(spark, SF_SMALL)
    plan = _plan(marts.b6_zone_anomaly_rates(fact, zone, as_of=newest, dim_date=dim_date))
    assert "dynamicpruning#" in plan and "PartitionFilters: [" in plan


def test_bucketed_star_has_no_exchange_of_the_fact(spark):
    from aerolith.plans.layout import bucketed_star

    keyed, _ = bucketed_star(spark, SF_SMALL)
    plan = _plan(keyed)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_gaps_are_reached(spark):
    """The registered queries over inputs with gaps meet each gap."""
    regions = QUERIES["regions_with_gaps"](spark, SF_SMALL).collect()
    assert sum(r.readings for r in regions if r.region_key is None) > 0 and sum(r.readings - r.measured for r in regions) > 0
    untyped = QUERIES["hot_windows_untyped"](spark, SF_SMALL)
    assert untyped.where("sensor_type = 'unknown'").count() > 0 and untyped.where("zone_id = 'unknown'").count() > 0
    assert QUERIES["holiday_readings"](spark, SF_SMALL).where("is_thai_holiday").count() > 0
    delta = QUERIES["hot_cold_delta"](spark, SF_SMALL).first()
    assert delta.delta > 0 and delta.mismatched_windows > 0
    assert QUERIES["scd2_all_cases"](spark, SF_SMALL).count() == 4


def test_load_report_counts_what_has_no_member(spark, tmp):
    from aerolith.plans.pipeline import run_cold_path

    month = F.col("reading_date").startswith("1996-05")
    air = S.bronze_air(spark, SF_SMALL).filter(month)
    air = air.withColumn("area_en", F.when(F.col("station_id") != "3", F.col("area_en")))
    weather = S.bronze_weather(spark, SF_SMALL).filter(F.date_format(F.timestamp_seconds("reading_ts"), "yyyy-MM") == "1996-05")
    sensor = S.bronze_sensor(spark, SF_SMALL).filter(F.col("reading_ts") < F.lit("2024-01-02"))
    res = run_cold_path(spark, air, weather, sensor, tmp + "/wh", date(2026, 1, 1), (date(1996, 5, 1), date(1996, 5, 20)))
    missing = res.missing["fct_air_quality_hourly"]
    fact = spark.read.parquet(res.path("gold/fct_air_quality_hourly"))
    assert missing["station_key"] == 0 and missing["region_key"] == fact.filter("region_key IS NULL").count() > 0
    assert missing["calendar_key"] == fact.filter("date_key > 19960520 OR date_key < 19960501").count() > 0
    assert "calendar_key" not in fact.columns
    report = {(r.table_name, r.column_name): (r.row_count, r.missing) for r in res.report(spark).collect()}
    assert report["fct_sensor_reading", "calendar_key"] == (res.counts["silver_sensor"],) * 2
    assert len(res.counts) == 15


def test_key_report_writes_down_only_what_keys_are_made_from(spark, monkeypatch):
    from aerolith.plans import registry, reports

    kept, keys = {}, {}
    store = registry.materialize
    report = reports.fact_key_report

    def noted(df, name):
        kept[name] = set(df.columns)
        return store(df, name)

    def told(keyed):
        keys.update({name: df.schema[0].dataType.simpleString() for name, df in keyed.items()})
        return report(keyed)

    monkeypatch.setattr(registry, "materialize", noted)
    monkeypatch.setattr(reports, "materialize", noted)
    monkeypatch.setattr(reports, "fact_key_report", told)
    rows = QUERIES["fact_keys_unique"](spark, SF_SMALL).collect()
    assert len(rows) == 5 and all(r.row_count == r.distinct_keys > 0 and r.null_keys == 0 for r in rows)
    assert not {"pm10_value", "ingested_at"} & kept["silver-air"] and kept["silver-weather"] == set(reports.KEYED_WEATHER)
    assert set(keys.values()) == {"binary"}


def test_facts_are_written_where_silver_lies(spark, tmp, monkeypatch):
    from aerolith.plans.pipeline import run_cold_path

    days = F.col("reading_date").between("1996-05-01", "1996-05-10")
    air = S.bronze_air(spark, SF_SMALL).filter(days)
    weather = S.bronze_weather(spark, SF_SMALL).filter(F.to_date(F.timestamp_seconds("reading_ts")).between("1996-05-01", "1996-05-10"))
    sensor = S.bronze_sensor(spark, SF_SMALL).filter(F.col("reading_ts") < F.lit("2024-01-03"))
    facts = {"air_quality_key": "fct_air_quality_hourly", "weather_hourly_key": "fct_weather_hourly", "sensor_reading_key": "fct_sensor_reading"}
    dealt, deal = set(), sinks.rebalanced

    def noted(df, cols=()):
        dealt.update(df.columns)
        return deal(df, cols)

    monkeypatch.setattr(sinks, "rebalanced", noted)

    def rows(root):
        dealt.clear()
        res = run_cold_path(spark, air, weather, sensor, root, date(2026, 1, 1), (date(1996, 5, 1), date(1996, 5, 20)))
        return res, {t: sorted(map(str, spark.read.parquet(res.path(f"gold/{t}")).collect())) for t in facts.values()}

    res, found = rows(tmp + "/a")
    assert not set(facts) & dealt and "daily_summary_key" in dealt and all(found.values())
    folders = Path(res.path("gold/fct_air_quality_hourly")).glob("reading_date=*")
    assert all(len(list(f.glob("*.parquet"))) <= len(list(Path(res.path("silver/air_quality"), f.name).glob("*.parquet"))) for f in folders)
    spark.conf.set("aerolith.broadcast.maxBytes", "1")
    try:  # lookups that shuffle the readings: the facts are dealt by date again
        assert rows(tmp + "/b")[1] == found and set(facts) <= dealt
    finally:
        spark.conf.unset("aerolith.broadcast.maxBytes")
