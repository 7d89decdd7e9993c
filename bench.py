"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is materialised with the ``noop`` sink (full execution, no driver
collection) after one warm-up pass of the same plan; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "silver_air",          # sentinels + latest-per-slot dedup + local->UTC (W1, C3)
    "dedup_latest",        # latest-per-key over lineitem (W1)
    "fct_hourly",          # star join: Silver -> station/region keys (C13)
    "fct_daily_summary",   # daily aggregate with mode (C14)
    "top10",               # Q1 over the derived star
    "scd2_merge",          # SCD2 merge of two snapshots (C11)
    "asof_lookup",         # point-in-time SCD2 lookup (J9)
    "hot_windows",         # 1-minute windowed aggregate, batch (T-1/A8)
    "hot_windows_stream",  # same, Structured Streaming + keyed upsert (C18)
    "b3_air_weather_corr",  # pre-aggregated correlation join (B3)
)


def main() -> None:
    from aerolith.plans.registry import QUERIES
    from aerolith.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    names = sys.argv[1:] or list(HEADLINE)
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
