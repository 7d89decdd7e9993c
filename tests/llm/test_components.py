import random

import pytest

from aerolith.llm.components import components


def roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("edges", [
    [(k, k + 1) for k in range(40)],
    [(0, k) for k in range(1, 60)] + [(100, 101), (101, 100), (5, 5)],
    [],
    [(random.Random(k).randrange(80), random.Random(k + 1000).randrange(80)) for k in range(50)],
])
def test_smallest_node_of_each_component(spark, edges):
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "x long, y long")
    found = {r["node"]: r["root"] for r in components(df, "x", "y").collect()}
    wanted = roots([e for e in edges if e[0] != e[1]])
    assert found == {n: r for n, r in wanted.items() if n != r}
