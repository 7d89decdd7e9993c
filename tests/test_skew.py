"""A key holding a third of the rows: joins split by AQE, aggregates combined map side."""

from pyspark.sql import functions as F

from aerolith.operators.dedup import latest_per_key
from aerolith.operators.joins import lookup
from aerolith.operators.windows import window_aggregates

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "aerolith.broadcast.maxBytes": "0",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _facts(spark, n=30000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("ts"),
        (F.col("id") % 13).cast("double").alias("v"),
    )


def test_skewed_lookup_is_split_and_correct(spark):
    facts = _facts(spark)
    dim = spark.range(0, 998).select(F.col("id").alias("k"), (F.col("id") * 10).alias("dk"))

    def run():
        j = lookup(facts, dim, "k", "left")
        total = j.agg(F.count(F.lit(1)).alias("n"), F.sum("dk").alias("s")).first()
        j.collect()  # runs the frame's own query execution; its adaptive plan is now final
        final = j._jdf.queryExecution().executedPlan().toString()
        return total, final

    total, final = _with_conf(spark, SKEW_CONF, run)
    want = facts.join(dim, "k", "left").agg(F.count(F.lit(1)).alias("n"), F.sum("dk").alias("s")).first()
    assert (total.n, total.s) == (want.n, want.s) == (30000, total.s)
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final


def test_hot_key_dedup_and_windows_match_brute_force(spark):
    facts = _facts(spark, 9000).withColumn("sensor_id", F.col("k").cast("string"))
    latest = {r.k: r.ts for r in latest_per_key(facts.select("k", "ts", "v"), ["k"], ["ts"]).collect()}
    brute = {r.k: r.m for r in facts.groupBy("k").agg(F.max("ts").alias("m")).collect()}
    assert latest == brute
    readings = facts.select(
        "sensor_id",
        F.timestamp_seconds(F.col("ts") % 600).alias("reading_ts_utc"),
        F.lit("flow").alias("sensor_type"), F.lit("Z01").alias("zone_id"),
        "v", F.lit(0.0).alias("target"), F.lit(False).alias("is_anomaly"),
    ).withColumnRenamed("v", "value")
    w = window_aggregates(readings)
    hot = w.filter(F.col("sensor_id") == "0").agg(F.sum("reading_count")).first()[0]
    assert hot == 3000
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # combined map side before the shuffle
