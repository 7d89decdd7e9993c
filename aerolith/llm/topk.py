"""Exact top-k inner products through a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from aerolith.llm.common import saved

SLACK = 1e-6  # relative rounding allowed to distances; bounds are only ever widened by it
NONE = np.iinfo(np.int64).min


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    out = np.zeros((len(column), width), np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def narrow(most: int) -> str:
    """The smallest integer type that holds components up to ``most``."""
    return next(t for t in ("<i1", "<i2", "<i4", "<i8") if most <= np.iinfo(t).max)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floats where they are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Space:
    """Vectors on a sphere: one more component makes all lengths equal, so that the largest inner product is the smallest distance."""

    def __init__(self, pivots: np.ndarray, longest: float):
        self.longest = longest  # squared length of the longest vector
        self.pivots = self.lifted(pivots)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(0, self.longest - (x * x).sum(axis=1)))
        return np.concatenate((x, rest[:, None]), axis=1)

    def to_pivots(self, x: np.ndarray) -> np.ndarray:
        """Distances of lifted rows to the pivots."""
        squares = (x * x).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)[None, :] - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(0, squares))

    def query(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate((q.astype(np.float64), np.zeros((len(q), 1))), axis=1)

    def best_scores(self, q: np.ndarray, pivot: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """(queries x annuli) upper bound of any inner product in the annulus between ``near`` and ``far`` of a pivot."""
        d = self.to_pivots(self.query(q))[:, pivot]
        gap = np.maximum(0, np.maximum(near[None, :] - d, d - far[None, :]) - SLACK * (d + far[None, :] + 1))
        squares = (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
        bound = (squares + self.longest - gap * gap) / 2
        return bound + SLACK * (squares + self.longest + 1)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first rows of the sample."""
    chosen, x = [0], sample.astype(np.float64)
    gap = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, row index, score) of the ``k`` best rows of each query; ties to smaller ids, the query's own id left out."""
    order = np.argsort(ids, kind="stable")
    score = _products(queries, rows[order])
    own = query_ids[:, None] == ids[order][None, :]
    score[own] = NONE
    k_ = min(k, score.shape[1])
    least = np.partition(score, score.shape[1] - k_, axis=1)[:, score.shape[1] - k_]
    q, r = np.nonzero((score >= least[:, None]) & (score > NONE))
    s = score[q, r]
    by = np.lexsort((r, -s, q))
    q, r, s = q[by], r[by], s[by]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k_], order[r[place < k_]], s[place < k_]


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): integer components floor(scale * x); rows without id, vectors null or with null or non-finite components are left out.

    Of rows with the same id the smallest vector stays, so repeated rows count once.
    """
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def build_index(rows: DataFrame, space: Space, width: int, block_rows: int, kind: str) -> DataFrame:
    """(block, pivot, near, far, n, ids, rows): blocks of an annulus around the nearest pivot, at most ``block_rows`` rows each.

    Rows are range-partitioned by pivot, distance and id; many equal vectors
    spread over as many blocks as they need.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = space.to_pivots(space.lifted(_matrix(batch.column("v"), width)))
            pivot = d.argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot), pa.array(d[np.arange(len(d)), pivot]), batch.column("vec_id"), batch.column("v")], ["pivot", "d", "vec_id", "v"]
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0

        def block(rows_: pa.Table) -> pa.RecordBatch:
            nonlocal count
            count += 1
            d = rows_.column("d").to_numpy()
            v = _matrix(rows_.column("v").combine_chunks(), width)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + count]),
                    pa.array([rows_.column("pivot")[0].as_py()], pa.int32()),
                    pa.array([d.min()]),
                    pa.array([d.max()]),
                    pa.array([len(d)], pa.int64()),
                    pa.array([rows_.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                    pa.array([v.astype(kind).tobytes()], pa.binary()),
                ],
                ["block", "pivot", "near", "far", "n", "ids", "rows"],
            )

        held: list[pa.Table] = []
        for batch in batches:
            pivots = batch.column("pivot").to_numpy()
            cuts = [0, *(np.flatnonzero(pivots[1:] != pivots[:-1]) + 1).tolist(), len(pivots)]
            for a, b in zip(cuts, cuts[1:]):
                new = pa.Table.from_batches([batch.slice(a, b - a)])
                if held and held[0].column("pivot")[0] != new.column("pivot")[0]:
                    yield block(pa.concat_tables(held))
                    held = []
                while new.num_rows:
                    room = block_rows - sum(t.num_rows for t in held)
                    held.append(new.slice(0, room))
                    new = new.slice(room)
                    if sum(t.num_rows for t in held) == block_rows:
                        yield block(pa.concat_tables(held))
                        held = []
        if held and held[0].num_rows:
            yield block(pa.concat_tables(held))

    keyed = rows.mapInArrow(key, "pivot int, d double, vec_id long, v array<long>")
    ranged = keyed.repartitionByRange("pivot", "d", "vec_id").sortWithinPartitions("pivot", "d", "vec_id")
    return ranged.mapInArrow(cut, "block long, pivot int, near double, far double, n long, ids binary, rows binary")


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    query_every: int = 20,
    scale: int = 64,
    pivots: int = 64,
    sample_rows: int = 4096,
    block_rows: int = 2048,
    most_blocks: int = 1 << 18,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query, exactly.

    Queries are the rows whose id is divisible by ``query_every``; candidates
    all rows but the query's own. Each query first searches the annuli with
    the best bounds until they hold ``k`` candidates, which gives it a
    ``k``-th score; then all annuli whose triangle-inequality bound reaches
    that score, and no others. Pairs of annulus and query travel as ids; the
    vectors of a lot of queries go to an annulus once. Equal scores
    are kept in reach, so ties go to the smaller id. Pivots come from at most
    ``sample_rows`` rows; every row is indexed. The table of annuli (one row a
    block) is shared with all tasks; blocks grow so that there are at most
    ``most_blocks`` and one a pivot and partition besides.

    Null or non-finite vectors take no part; shorter vectors count as filled
    with zeros; repeated rows count once. Components that ``scale`` takes
    beyond 64 bits become the largest number of 64 bits, and scores are sums
    of 64 bits. Fewer than ``k`` candidates give fewer rows; an empty table none.
    """
    spark = vectors.sparkSession
    rows = saved(quantized(vectors, id_col, vector_col, scale), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    largest = F.aggregate("v", F.lit(0).cast("long"), lambda s, c: F.greatest(s, c, -1 - c))
    n, width, longest, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max(length), F.max(largest)).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], out)
    width = max(1, width)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow().column("v").combine_chunks()
    space = Space(choose_pivots(_matrix(sample, width), pivots), float(longest))
    size = max(block_rows, -(-n // most_blocks))
    kind = narrow(most)
    index = saved(build_index(rows, space, width, size, kind), "annuli")
    annuli = index.select("block", "pivot", "near", "far", "n").orderBy("block").toPandas()
    shared = spark.sparkContext.broadcast(tuple(annuli[c].to_numpy() for c in ("block", "pivot", "near", "far", "n")))
    lots = max(1, n // query_every // 256)
    lot = F.pmod(F.xxhash64("query_id"), F.lit(lots)).alias("lot")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), width).astype(kind)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in v], pa.binary())], ["query_id", "q"])

    queries = rows.where(F.col("vec_id") % query_every == 0).mapInArrow(packed, "query_id long, q binary")
    queries = saved(queries.select("query_id", "q", lot), "queries")
    vectors_of = queries.groupBy("lot").agg(F.collect_list(F.struct("query_id", "q")).alias("members"))

    def unpacked(rows_: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(rows_), kind).reshape(len(rows_), width).astype(np.int64)

    def plan(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, pivot, near, far, held = shared.value
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    bound = space.best_scores(unpacked(batch.column("q").to_pylist()), pivot, near, far)
                    top = bound.argmax(axis=1)
                    seed = np.zeros(bound.shape, bool)
                    seed[np.arange(len(top)), top] = True
                    for i in np.flatnonzero(held[top] <= k).tolist():  # too few rows, itself perhaps among them: the next annuli
                        by = np.argsort(-bound[i], kind="stable")
                        seed[i, by[: int(np.searchsorted(np.cumsum(held[by]), k + 1)) + 1]] = True
                    if first:
                        q, b = np.nonzero(seed)
                    else:
                        least = batch.column("least").to_numpy(zero_copy_only=False)
                        reach = bound >= np.where(np.isnan(least), -np.inf, least)[:, None]
                        q, b = np.nonzero(reach & ~seed)  # those are searched already
                    part = batch.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays([pa.array(blocks[b]), part.column("query_id"), part.column("lot")], ["block", "query_id", "lot"])

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                data = np.frombuffer(row["rows"], kind).reshape(len(ids), width).astype(np.int64)
                asked = set(row["asked"])
                mine = [x for x in row["members"] if x["query_id"] in asked]
                query_ids = np.array([x["query_id"] for x in mine], np.int64)
                q, r, s = best_of(unpacked([x["q"] for x in mine]), query_ids, data, ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(ids[r]), pa.array(s)], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(pairs: DataFrame) -> DataFrame:
        """Queries meet a block in lots of a few hundred; each lot reads the block once.

        Neither the vectors nor the blocks may be broadcast: Spark would go by the size of
        their files, which says nothing of the rows in them where vectors repeat.
        """
        asked = pairs.groupBy("block", "lot").agg(F.collect_list("query_id").alias("asked"))
        wanted = F.filter("members", lambda m: F.array_contains("asked", m["query_id"])).alias("members")
        met = asked.join(vectors_of.hint("merge"), "lot").select("block", "asked", wanted)
        hits = met.join(index.select("block", "ids", "rows").hint("merge"), "block").select("ids", "rows", "asked", "members")
        return hits.mapInArrow(search, "query_id long, vec_id long, score long")

    pair = "block long, query_id long, lot long"
    seeds = saved(searched(queries.mapInArrow(plan(True), pair)), "seeds")
    kept = seeds.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    bounded = queries.join(kept.select("query_id", F.col("score").cast("double").alias("least")).hint("merge"), "query_id", "left")
    more = searched(bounded.mapInArrow(plan(False), pair))
    ranked = seeds.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
