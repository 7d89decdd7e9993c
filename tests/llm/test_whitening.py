import numpy as np
import pytest

from aerolith.llm import whitening
from aerolith.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, x string, weight string, n string, whitened string"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "w", "n", "z") for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, most=32):
    """Whitening of all rows, copies included, without grouping."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    gap = n * x - total
    c = gap.astype(float) / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    order = [k for k in np.argsort(e)[::-1] if e[k] > e.max() * len(e) * 2.3e-16][:most]
    return (gap * gap).sum(axis=1), c @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(cov)


def check(found, vectors, most=32):
    deviation, z, explained = brute(vectors, most)
    assert [r["vec_id"] for r in found] == [i for i, _ in vectors]
    got = np.array([r["whitened"] for r in found])
    sign = np.sign((got * z).sum(axis=0))
    assert np.allclose(got, z * sign, atol=1e-8)
    assert [int(r["deviation"]) for r in found] == deviation.tolist()
    assert np.allclose(found[0]["explained"], explained, rtol=1e-10)
    assert {r["n"] for r in found} == {len(vectors)} and found[0]["identity_error"] < 1e-9


def test_like_brute_force_with_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    scales = np.array([3, 2, 1.5, 1, 0.7, 0.5])
    vectors = [(i, (rng.normal(size=6) * scales).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[5][1]) for i in range(150)] + [(450 + i, vectors[i][1]) for i in range(20)]
    found = whitening.whiten(rows_of(spark, vectors), heavy_share=10)
    check(sorted(found.collect(), key=lambda r: r["vec_id"]), vectors)


def test_unusable_vectors_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(30)]
    good += [good[3], (None, good[4][1])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]), (94, [1.0, float("inf"), 0.0]), (95, [1.0, 2.0])]
    found = whitening.whiten(rows_of(spark, good + bad)).collect()
    first = lambda x: (x[0] is None, x[0])
    good.sort(key=first)
    check(sorted(found, key=first), good)


def test_no_variance_no_rows_and_far_values(spark):
    assert whitening.whiten(rows_of(spark, [])).collect() == []
    same = whitening.whiten(rows_of(spark, [(i, [0.5, 0.25]) for i in range(4)])).collect()
    assert len(same) == 4 and all(r["whitened"] == [] and r["deviation"] == 0 and r["identity_error"] == 0 for r in same)
    far = whitening.whiten(rows_of(spark, [(0, [1e30, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 3.0])])).collect()
    assert len(far) == 3


def test_registered_query(spark):
    from aerolith.llm.common import table

    found = QUERIES["op13_embedding_whitening"](spark, SMALL).toPandas()
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, SMALL, "embeddings").orderBy("vec_id").collect()]
    deviation, z, explained = brute(vectors)
    assert len(found) == 32 * len(vectors) and set(found["component"]) == set(range(1, 33))
    got = found.sort_values(["vec_id", "component"])
    wide = got["whitened"].to_numpy().reshape(len(vectors), 32)
    assert np.allclose(wide, z * np.sign((wide * z).sum(axis=0)), atol=1e-7)
    assert got["deviation"].tolist()[::32] == deviation.tolist()
    assert got["explained"].tolist()[:32] == pytest.approx(explained.tolist(), rel=1e-9)
    assert got["identity_error"].max() < 1e-9 and str(got["deviation"].dtype) == "int64"
