"""Summarise executed physical plans of headline queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
For each query: wall time of a noop execution and the operators that matter
at scale (scans and their pushed filters / read schemas, join strategies,
partial vs final aggregation, WindowGroupLimit, exchanges, reuse).
"""

from __future__ import annotations

import re
import sys
import time

sys.path.insert(0, ".")

QUERIES = ("silver_air", "fct_hourly", "fct_daily_summary", "top10", "scd2_merge", "asof_lookup",
           "hot_windows", "b3_air_weather_corr", "b6_zone_anomaly_7d", "live_kpis")


def summarise(plan: str) -> dict:
    ops = {
        "scans": len(re.findall(r"FileScan parquet|Scan parquet", plan)),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "partial aggregates": len(re.findall(r"functions=\[partial_", plan)),
        "WindowGroupLimit": plan.count("WindowGroupLimit"),
        "TakeOrderedAndProject": plan.count("TakeOrderedAndProject"),
        "reused": len(re.findall(r"Reused", plan)),
        "python UDF": len(re.findall(r"BatchEvalPython|ArrowEvalPython|InPandas", plan)),
    }
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    return ops, pushed


def main() -> None:
    from aerolith.plans.registry import QUERIES as Q
    from aerolith.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    out = ["# Executed plans of the headline queries", "",
           f"Generated by `python tools/plan_report.py {sf}` (local[8], AQE on, after a warm-up).",
           "Counts are taken from the final adaptive plan after execution. Silver is written once per",
           "chain (see README), so fact and mart plans scan the written Silver table; their times exclude",
           "that write, which `bench.py` includes.", ""]
    Q["silver_air"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    for name in QUERIES:
        df = Q[name](spark, sf)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        dt = time.time() - t0
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops, pushed = summarise(plan)
        out.append(f"## {name} ({dt:.2f}s)")
        out.append("")
        out.append("| " + " | ".join(ops) + " |")
        out.append("|" + "---|" * len(ops))
        out.append("| " + " | ".join(str(v) for v in ops.values()) + " |")
        if pushed:
            out.append("")
            out.append("Pushed filters: " + "; ".join(f"`{p}`" for p in pushed))
        out.append("")
        print(name, ops, flush=True)
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
