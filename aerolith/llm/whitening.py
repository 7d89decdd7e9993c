"""Embedding whitening from the weighted covariance of the distinct vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import saved

LARGEST = 1 << 62  # grid values beyond this are set to it


def grid_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float, shift: int) -> DataFrame:
    """(id, x): every component c of a usable vector as the whole number floor(scale * c) + shift."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            good = (sizes > 0) & (bad[ends[1:]] == bad[ends[:-1]])
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(scale * values[np.repeat(good, sizes)]), -LARGEST, LARGEST).astype(np.int64)
            x = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes[good]))), pa.int32()), pa.array(whole + shift))
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(good)), x], ["id", "x"])

    source = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, x array<bigint>")


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def exact(a: np.ndarray, most: int) -> np.ndarray:
    """``a`` as machine integers if results up to ``most`` fit, else as Python's."""
    return a if most < 1 << 62 else a.astype(object)


def weighted_sums(vectors: DataFrame, name: str, kind: str) -> list:
    """Sum of weight * vector per dimension, by one partial sum a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x, w = _matrix(batch, name), batch.column("weight").to_numpy()
                if x.dtype == np.int64:
                    x = exact(x, int(max(abs(int(x.min())), abs(int(x.max())))) * int(w.sum()))
                part = (x * w[:, None]).sum(axis=0)
                part = part.astype(object) if part.dtype != np.float64 else part
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"pos": np.arange(len(total), dtype=np.int32), "part": [str(v) for v in total.tolist()]})

    parts = vectors.select(name, "weight").mapInArrow(run, "pos int, part string")
    found = parts.groupBy("pos").agg(F.sum(F.col("part").cast(kind)).alias("total")).orderBy("pos").collect()
    return [r["total"] for r in found]


def centred_covariance(vectors: DataFrame, name: str, n: int, whole: list[int], rest: np.ndarray) -> np.ndarray:
    """Weighted covariance (divisor ``n``) about ``whole + rest``: a centred matrix product a task, summed by entry.

    What reaches the driver is one number per pair of dimensions, whatever the number of rows.
    """
    base = np.array(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                c = (_matrix(batch, name) - base).astype(np.float64) - rest
                part = (c * batch.column("weight").to_numpy()[:, None]).T @ c
                total = part if total is None else total + part
        if total is not None:
            d = len(total)
            yield pa.RecordBatch.from_pydict({"i": np.arange(d, dtype=np.int32), "part": pa.ListArray.from_arrays(np.arange(0, d * d + 1, d, dtype=np.int32), total.ravel())})

    parts = vectors.select(name, "weight").mapInArrow(run, "i int, part array<double>").select("i", F.posexplode("part").alias("j", "value"))
    out = np.zeros((len(rest), len(rest)))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        out[i, j] = value / n
    return out


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 32,
    scale: float = 64.0,
    shift: int = 1_000_000,
    heavy_share: int = 1000,
) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for every usable vector.

    Components go to a grid of whole numbers, x = floor(scale * c) + shift.
    Equal x are grouped, their count is the weight of the fit, so a vector
    that very many rows share is summed, multiplied and whitened once.
    ``whitened`` are the projections of x minus the mean on the unit
    eigenvectors of the covariance, each over the root of its eigenvalue, by
    falling eigenvalue; ``explained`` the eigenvalues over their total;
    ``deviation`` the exact sum of (n * x - sum)^2 (decimal);
    ``identity_error`` the largest absolute entry of the whitened vectors'
    own covariance minus the identity, measured on the data.

    The rows get their vector's result by a join. Vectors with at least one
    row in ``heavy_share`` (so at most ``heavy_share`` vectors) are broadcast,
    all others are joined by a shuffle.

    Vectors that are null, empty or hold null or non-finite entries take no
    part; nor do those of another length than the most frequent one (of
    equally frequent lengths the smallest). Components without variance (up
    to rounding) are left out, so equal vectors alone give empty lists.
    Repeated rows and null ids come out as often as they go in. Other
    columns are ignored. No rows give no rows.
    """
    spark = rows.sparkSession
    keyed = saved(grid_vectors(rows, id_col, vector_col, scale, shift), "grid")
    sizes = keyed.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    out = "id {}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    out = out.format(keyed.schema["id"].dataType.simpleString())
    if sizes is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    d, n = sizes["d"], sizes["n"]
    keyed = keyed.where(F.size("x") == d)
    distinct = saved(keyed.groupBy("x").agg(F.count("*").alias("weight")), "distinct-vectors")

    total = [int(s) for s in weighted_sums(distinct, "x", "decimal(38,0)")]
    whole = [s // n for s in total]
    left = [s - m * n for s, m in zip(total, whole)]  # the mean is whole + left / n
    rest = np.array([r / n for r in left])
    covariance = centred_covariance(distinct, "x", n, whole, rest)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    order = order[values[order] > max(values.max(), 0.0) * d * np.finfo(float).eps][:components]
    project = vectors[:, order] / np.sqrt(values[order])
    explained = (values[order] / np.trace(covariance)).tolist() if len(order) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k = np.array(whole), project.shape[1]
        for batch in batches:
            y = _matrix(batch, "x") - base
            far = (int(np.abs(y).max(initial=0)) + 1) * n
            gap = exact(y, d * far * far)
            gap = gap * n - np.array(left, dtype=gap.dtype)
            z = (y.astype(np.float64) - rest) @ project
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"),
                    batch.column("weight"),
                    pa.array([str(v) for v in (gap * gap).sum(axis=1).tolist()]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(z) * k + 1, k) if k else np.zeros(len(z) + 1), pa.int32()), pa.array(z.ravel())),
                ],
                ["x", "weight", "deviation", "whitened"],
            )

    done = saved(distinct.mapInArrow(run, "x array<bigint>, weight long, deviation string, whitened array<double>"), "whitened")
    error = 0.0
    if len(order):
        mean = np.array(weighted_sums(done, "whitened", "double")) / n
        error = float(np.abs(centred_covariance(done, "whitened", n, [0] * len(order), mean) - np.eye(len(order))).max())

    heavy = (F.col("weight") > 1) & (F.col("weight") * heavy_share >= n)
    few = F.broadcast(done.where(heavy))
    found = keyed.join(few, "x").unionByName(keyed.join(few.select("x"), "x", "left_anti").join(done.where(~heavy), "x"))
    return found.select(
        F.col("id").alias(id_col),
        F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"),
        "whitened",
        _doubles(explained).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<double>")
