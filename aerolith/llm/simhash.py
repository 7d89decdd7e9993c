"""SimHash near-duplicates through vantage-point trees in Hamming space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from aerolith.llm.common import byte_column, saved
from aerolith.llm.components import components

FULL = (1 << 64) - 1


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """64-bit SimHash of word shingles; a text without words has fingerprint zero."""
    words = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())),
        np.uint64,
        len(words) - k + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[at : at + (1 << 15)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in byte_column(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, "doc_id long, fp long")


# --- routing: a vantage-point tree over a bounded sample -------------------


def segment_masks(segments: int) -> list[int]:
    """64 bits cut into ``segments`` runs of nearly equal length."""
    cuts = [round(64 * k / segments) for k in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _distance(x: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((x ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)


def build_router(sample: np.ndarray, mask: int, radius: int, max_bits: int, leaf: int):
    """Nested (mask, vantage, threshold, radius, inner, outer) nodes; a leaf is None.

    A node splits at the median Hamming distance to a vantage point under the
    segment's mask, where linked fingerprints lie within ``radius``. What the
    segment cannot split (equal there) is split by the distance of all 64
    bits, within ``max_bits``.
    """
    if len(sample) <= leaf:
        return None
    for m, r in ((mask, radius), (FULL, max_bits)):
        for vantage in sample[:: max(1, len(sample) // 4)][:4].tolist():
            d = _distance(sample, vantage, m)
            for t in sorted({int(np.median(d)) - 1, int(np.median(d))}):
                inner, outer = d <= t + r, d > t - r
                if max(inner.sum(), outer.sum()) <= 0.8 * len(sample):
                    return (m, vantage, t, r, build_router(sample[inner], mask, radius, max_bits, leaf), build_router(sample[outer], mask, radius, max_bits, leaf))
    return None


def route(x: np.ndarray, node, rows: np.ndarray | None = None, path: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of x). Rows within the radius of a border go to both sides."""
    rows = np.arange(len(x)) if rows is None else rows
    if node is None:
        yield path, rows
        return
    mask, vantage, t, r, inner, outer = node
    d = _distance(x[rows], vantage, mask)
    yield from route(x, inner, rows[d <= t + r], 2 * path)
    yield from route(x, outer, rows[d > t - r], 2 * path + 1)


# --- exact pairs inside a shard ---------------------------------------------


class Links:
    """Union-find over array indices, by whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.root[i], self.root[j]
            open_ = i != j
            i, j = i[open_], j[open_]
            np.minimum.at(self.root, np.maximum(i, j), np.minimum(i, j))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _blocks(fps: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int, links: Links, step: int = 1024) -> None:
    for p in range(0, len(a), step):
        for q in range(0, len(b), step):
            x, y = a[p : p + step], b[q : q + step]
            i, j = np.nonzero(np.bitwise_count(fps[x][:, None] ^ fps[y][None, :]) <= bits)
            links.add(x[i], y[j])


def _across(fps: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int, links: Links) -> None:
    """Links between two sides: by a vantage point only rows whose distances to it differ by ``bits`` at most can be linked."""
    if not len(a) or not len(b):
        return
    if len(a) * len(b) <= 1 << 20:
        _blocks(fps, a, b, bits, links)
        return
    da, db = (_distance(fps[s], int(fps[a[0]]), FULL) for s in (a, b))
    order = np.argsort(db, kind="stable")
    b, db = b[order], db[order]
    for d in np.unique(da).tolist():
        lo, hi = np.searchsorted(db, [d - bits, d + bits + 1])
        _blocks(fps, a[da == d], b[lo:hi], bits, links)


def shard_links(fps: np.ndarray, bits: int, leaf: int = 512) -> np.ndarray:
    """Root index of every fingerprint, linked within ``bits``, by a vantage-point tree over the shard."""
    links = Links(len(fps))
    todo = [np.arange(len(fps))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            _blocks(fps, rows, rows, bits, links)
            continue
        d = _distance(fps[rows], int(fps[rows[0]]), FULL)
        t = int(np.median(d))
        inner, outer = rows[d <= t], rows[d > t]
        if not len(outer) or not len(inner):
            _blocks(fps, rows, rows, bits, links)
            continue
        todo += [inner, outer]
        _across(fps, rows[(d <= t) & (d > t - bits)], rows[(d > t) & (d <= t + bits)], bits, links)
    return links.root


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    segments: int = 5,
    shard_rows: int = 512,
    sample_rows: int = 20_000,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked at ``max_bits`` or fewer differing bits.

    Equal fingerprints are folded first (smallest doc_id), so copies cost one
    row. Distinct ones are partitioned by a vantage-point tree per bit
    segment: of two fingerprints within ``max_bits`` some segment differs by
    at most ``max_bits // segments`` bits, which is the radius of that tree;
    rows nearer to a border go to both sides. With more segments than
    ``max_bits`` the radius is zero and every fingerprint goes to one shard a
    segment; ``segments=1`` is the plain tree. The trees come from at most
    ``sample_rows`` fingerprints; all rows are routed. Each shard finds its
    exact links with its own tree and returns one link per fingerprint, and
    components join them.

    Null or empty text: fingerprint zero, linked like any other. Repeated
    rows come out as often as they go in. A row without id keeps its
    fingerprint, has a null component and links nothing. Other columns of
    ``docs`` are ignored. No documents give no rows.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    found = fps.join(component_table(fps, max_bits, segments, shard_rows, sample_rows), "fp", "left")
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def component_table(fps: DataFrame, max_bits: int, segments: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """(fp, component_id) of distinct fingerprints."""
    heads = saved(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("head")), "heads")
    n = heads.count()
    sample = heads.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    leaf = max(4, shard_rows * len(sample) // max(1, n))
    masks = segment_masks(segments)
    trees = [build_router(sample, m, max_bits // segments, max_bits, leaf) for m in masks]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            for k, tree in enumerate(trees):
                for path, rows in route(x, tree):
                    if len(rows):
                        part = batch.take(pa.array(rows))
                        shard = pa.array([f"{k}:{path}"] * len(rows))
                        yield pa.RecordBatch.from_arrays([shard, part.column("fp"), part.column("head")], ["shard", "fp", "head"])

    def link(shard: pa.Table) -> pa.Table:
        heads_ = shard.column("head").to_numpy()
        root = shard_links(shard.column("fp").to_numpy().view(np.uint64), max_bits)
        far = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": heads_[far], "b": heads_[root[far]]})

    dealt = heads.mapInArrow(deal, "shard string, fp long, head long")
    edges = dealt.groupBy("shard").applyInArrow(link, "a long, b long")
    roots = components(edges, "a", "b")
    return heads.join(roots, heads["head"] == roots["node"], "left").select("fp", F.coalesce("root", "head").alias("component_id"))


def _with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in byte_column(batch, text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, **parameters) -> DataFrame:
    """``docs`` with the document of smallest id of each component; rows without id stay.

    Where one id has several texts, those stay that belong to a component of
    which the id is the smallest; the others are copies of something that is
    kept. Rows equal in id and text are reduced to one (any of them: they may
    differ in other columns).
    """
    found = saved(near_duplicates(docs, id_col, text_col, shingle, **parameters).where("doc_id IS NOT NULL"), "groups")
    own = F.col("doc_id") == F.col("component_id")
    status = found.groupBy("doc_id").agg(F.max(own).alias("some"), F.min(own).alias("all")).where("some")
    known = docs.where(F.col(id_col).isNotNull())
    kept = known.join(status.where("all").select(F.col("doc_id").alias(id_col)), id_col, "left_semi")
    mixed = status.where("NOT all").select("doc_id")
    if not mixed.isEmpty():  # ids of several texts, not all of them kept
        fp = "_simhash_fp"
        texts = _with_fingerprint(known.join(mixed.select(F.col("doc_id").alias(id_col)), id_col, "left_semi"), text_col, fp, shingle)
        good = found.where(own).select(F.col("doc_id").alias(id_col), F.conv("fingerprint", 16, -10).cast("long").alias(fp)).distinct()
        kept = kept.unionByName(texts.join(good, [id_col, fp], "left_semi").select(docs.columns))
    return kept.dropDuplicates([id_col, text_col]).select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
