import math
import random

from aerolith.llm import topk


def slow(rows, k=20, every=20):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            q = [math.floor(64 * c) for c in v]
            good[i] = min(good.get(i, q), q)
    out = []
    for i in good:
        if i % every == 0:
            score = sorted((-sum(a * b for a, b in zip(good[i], v)), j) for j, v in good.items() if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(score[:k])]
    return out


def test_matches_brute_force(spark, same_rows):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(6)]) for k in range(400)]
    rows += [(k, rows[0][1]) for k in range(400, 520)]  # a third of equal vectors: ties
    rows += [(600, None), (601, [float("nan")] * 6), (602, [1.0, None]), (603, [float("inf"), 0.0]), (None, [1.0] * 6), (640, [0.5]), (660, []), rows[5]]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, v string, score string").repartition(3)
    as_float = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    for size in (2048, 32):
        same_rows(topk.top_k(df, block_rows=size, pivots=8).collect(), slow(as_float))


def test_few_candidates_large_numbers_and_empty_table(spark, same_rows):
    rows = [(0, [1e6, -3e7]), (20, [2e7, 5e7]), (3, [0.1, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    same_rows(topk.top_k(df).collect(), slow(rows))
    assert topk.top_k(df.limit(0)).collect() == []


def test_no_table_of_vectors_is_broadcast(spark, same_rows):
    rows = [(k, [0.5, 0.25]) for k in range(200)]  # their files are tiny, their rows are not
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3, block_rows=16)
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    same_rows(found.collect(), slow(rows, k=3))
