"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolith.llm.common import discard, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round. ``edges`` holds (u, v) with u > v.

    Each node's smallest neighbour is an aggregate (partial before the
    shuffle) joined back to the edges, so that a node with very many edges is
    never gathered in one place.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:  # every larger neighbour is linked to the node's smallest neighbour
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours are linked to the smallest
        out = joined.select("u", F.col("m").alias("v")).unionByName(joined.select(F.col("v").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge but the roots themselves; root is the component's smallest node.

    Rounds go on until the edges stay as they are (stars around the roots).
    Each round is a table in the shared scratch folder, which replaces the one
    before. Null ends and loops
    are ignored; no edges give no rows.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = saved(now.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, old = tuple(state), now
        now = saved(_star(_star(now, True), False), "edges")
        discard(old)
