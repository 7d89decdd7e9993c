"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aerolith.llm.common import row_chunks, worker_cache

UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Lower-case code point of each code point, zero for all but letters."""
    cache = worker_cache("letters")
    if not cache:
        lower = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
                low = s.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        cache["lower"] = lower
    return cache["lower"]


def ranked_grams(texts: list[str | None], top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, gram, rank, count) of the ``top`` most frequent n-grams of each text; all of them if ``top`` is 0.

    N-grams of one to three letters; zero stands for the white space (or other
    characters) around words. A gram is three code points of 21 bits. More
    frequent grams rank first, ties by code points.
    """
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    cp = np.frombuffer(b"\0\0\0\0".join(raw) + b"\0\0\0\0", "<u4")
    doc = np.repeat(np.arange(len(raw)), [len(r) // 4 + 1 for r in raw])
    cp = _letters()[cp]
    keep = cp > 0
    keep[1:] |= cp[:-1] > 0  # one boundary after each word
    cp, doc = cp[keep], doc[keep]
    if not len(cp):
        return (np.zeros(0, np.int64),) * 4
    points, a = np.unique(cp, return_inverse=True)
    size = len(points) + 2
    a = a.astype(np.int64) + 1  # zero: nothing; the boundary is points[0] == 0, code 1
    b = np.append(a[1:], 1)
    c = np.append(b[1:], 1)
    # A word's first gram follows a boundary: the boundary before the first word of a document is the one that ended the last.
    word = a > 1
    first = np.append(True, ~word[:-1]) & word
    base = doc * size**3
    grams = [
        (base + a * size**2)[word],  # x
        (base + a * size**2 + b * size)[word],  # xy and x_
        (base + a * size**2 + b * size + c)[word & (b > 1)],  # xyz and xy_
        (base + size**2 + a * size)[first],  # _x
        (base + size**2 + a * size + b)[first],  # _xy and _x_
    ]
    keys = np.concatenate(grams)
    keys.sort()
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    count = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    of = keys // size**3
    most = int(count.max()) + 1
    order = np.argsort(of * most + (most - count), kind="stable")
    of, keys, count = of[order], keys[order], count[order]
    start = np.searchsorted(of, np.arange(len(raw)))
    rank = np.arange(len(of)) - start[of]
    if top:
        chosen = rank < top
        of, keys, count, rank = of[chosen], keys[chosen], count[chosen], rank[chosen]
    at = [(keys // size**p) % size for p in (2, 1, 0)]
    code = np.append(np.uint64(0), points.astype(np.uint64) + 1)  # 1 for the boundary, 0 for nothing
    x, y, z = (code[np.minimum(v, len(code) - 1)] for v in at)
    return of, (x << np.uint64(42) | y << np.uint64(21) | z).astype(np.int64), rank, count


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 300, rows_per_language: int = 5_000, order_col: str = "doc_id") -> dict[str, list[int]]:
    """The ``top`` n-grams of each language in order of rank.

    Learnt from about ``rows_per_language`` labelled texts a language at most
    (chosen by a hash of ``order_col``): a classifier needs no more. Counts
    are summed per task before the shuffle; the driver gets ``top`` rows a
    language.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(order_col).alias("k"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    share = {r["lang"]: min(1.0, rows_per_language / r["count"]) for r in rows.groupBy("lang").count().collect()}
    if not share:
        return {}
    limit = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    rows = rows.where(F.pmod(F.xxhash64("k"), F.lit(1_000_003)) < limit * 1_000_003).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, "text", 1 << 20):
            langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
            for lang in sorted(set(langs)):
                doc, gram, _, count = ranked_grams([t for t, x in zip(texts, langs) if x == lang], 0)
                grams, at = np.unique(gram, return_inverse=True)
                total = np.bincount(at, weights=count).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(total)], ["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).orderBy("lang", "rank").collect()
    profiles: dict[str, list[int]] = {}
    for r in ranked:
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def distances(texts: list[str | None], profiles: dict[str, list[int]], top: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) share of the largest possible out-of-place distance, and whether a text has letters."""
    names = sorted(profiles)
    known = np.unique(np.array([g for n in names for g in profiles[n]], np.int64))
    place = np.full((len(known) + 1, len(names)), -1, np.int64)  # the last row: in no profile
    for k, n in enumerate(names):
        place[np.searchsorted(known, profiles[n]), k] = np.arange(len(profiles[n]))
    doc, gram, rank, _ = ranked_grams(texts, top)
    at = np.searchsorted(known, gram)
    at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != gram)] = len(known)
    where = place[at]
    out = np.where(where < 0, top, np.abs(where - rank[:, None]))
    total = np.stack([np.bincount(doc, weights=out[:, k], minlength=len(texts)) for k in range(len(names))], axis=1)
    n = np.bincount(doc, minlength=len(texts))
    return total / np.maximum(1, n * top)[:, None], n > 0


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", top: int = 300) -> DataFrame:
    """``docs`` with the language of the nearest profile and a score (1 less the nearest distance, as a share of the largest).

    Whole texts count. Null text, text without letters and an empty set of
    profiles give ``und`` with score 0. Ties go to the first language by name.
    Input columns of the two new names are replaced.
    """
    names = sorted(profiles)
    other = [c for c in docs.columns if c.lower() not in (lang_col.lower(), score_col.lower())]
    schema = docs.select(other).schema.add(lang_col, "string").add(score_col, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, text_col, 1 << 20):
            lang, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if names:
                far, has = distances(part.column(text_col).to_pylist(), profiles, top)
                best = far.argmin(axis=1)
                lang = [names[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
                score = np.where(has, 1 - far[np.arange(len(far)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score)], [*part.schema.names, lang_col, score_col])

    return docs.select(other).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Documents never learnt from: crc32 of the id's text divisible by five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
