"""Exact substring deduplication: longest previous factors by smaller positions in the suffix order of sharded texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from aerolith.llm.common import byte_column, row_chunks, saved

MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _words(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position as one number (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)]
    return np.ascontiguousarray(view).view(f"{order}u8").ravel()


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` elements from each position (shorter at the end)."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.concatenate((np.minimum(out[:-step], out[step:]), out[-step:])) if len(out) > step else out
        have += step
    return out


class Shards:
    """How windows of ``length`` bytes are dealt to ``buckets`` shards: by the smallest hash of the pieces inside.

    Equal windows hold equal pieces, hence meet in one shard. Neighbouring
    windows mostly share the smallest piece, so runs of windows travel as one
    segment of text.
    """

    def __init__(self, length: int, buckets: int):
        if length < 16:
            raise ValueError("repeats shorter than 16 bytes cannot be sharded")
        self.length, self.buckets, self.piece = length, buckets, 8 * min(3, length // 16)

    def pieces(self, data: np.ndarray) -> np.ndarray:
        """Hash of the piece at each position."""
        v = _words(data, "<")
        h = v * MIX[0]
        for k in range(8, self.piece, 8):
            h ^= h >> np.uint64(32)
            h = (h + np.concatenate((v[k:], np.zeros(min(k, len(v)), np.uint64)))) * MIX[k // 8]
        return h ^ (h >> np.uint64(32))

    def dealt(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, tag of 31 bits) of keys."""
        mixed = key * MIX[1]
        mixed ^= mixed >> np.uint64(31)
        mixed *= MIX[2]
        return ((mixed & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets)).astype(np.int64), (mixed >> np.uint64(33)).astype(np.int64)

    def split(self, h: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(run, first window, last window, bucket): runs cut and dealt by the three smallest and two largest piece hashes.

        For keys that very many texts share: what stands around the common
        piece tells their windows apart, unless it fills nearly the window.
        """
        width = self.length - self.piece + 1
        places = sorted({0, min(1, width - 1), min(2, width - 1), max(0, width - 2), width - 1})
        size = last - first + 1
        of = np.repeat(np.arange(len(first)), size)
        at = np.arange(len(of)) + np.repeat(first - (np.cumsum(size) - size), size)
        key = np.zeros(len(at), np.uint64)
        for a in range(0, len(at), 1 << 17):
            inside = np.partition(h[at[a : a + (1 << 17), None] + np.arange(width)], places, axis=1)
            for k in places:
                part = key[a : a + len(inside)]
                key[a : a + len(inside)] = (part ^ (part >> np.uint64(29)) ^ inside[:, k]) * MIX[0]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (of[1:] != of[:-1]))) if len(of) else [])
        stop = np.append(new[1:], len(of))[: len(new)] - 1
        return of[new], at[new], at[stop], self.dealt(key[new])[0]

    def runs(self, data: np.ndarray, sizes: np.ndarray, free: np.ndarray):
        """(doc, first window, last window, bucket, tag) of each run of windows with one key; texts marked free have none."""
        key = _least(self.pieces(data), self.length - self.piece + 1)
        ends = np.cumsum(sizes)
        count = np.where(free, 0, np.maximum(0, sizes - self.length + 1))
        doc = np.repeat(np.arange(len(sizes)), count)
        at = np.arange(len(doc)) + np.repeat((ends - sizes) - (np.cumsum(count) - count), count)
        key = key[at]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))) if len(key) else [])
        last = np.append(new[1:], len(key))[: len(new)] - 1
        return doc[new], at[new], at[last], *self.dealt(key[new])


def packed(ids: list[int | None], texts: list[bytes | None]) -> bytes:
    """Texts of a pack as one compressed binary."""
    return pa.compress(b"".join(t or b"" for t in texts), "zstd", asbytes=True)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, sizes, ids, free) of a pack."""
    sizes = np.array(row["sizes"], np.int64)
    free = np.array([x is None for x in row["ids"]], bool)
    ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
    total = int(sizes.sum())
    data = np.frombuffer(pa.decompress(row["data"], total, "zstd", asbytes=True) if total else b"", np.uint8)
    return data, sizes, ids, free


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its indices in order)."""
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0))) if len(order) else []
    for a, b in zip(first, [*first[1:], len(order)]):
        yield int(bucket[order[a]]), order[a:b]


class Segments:
    """Distinct segments of a pack whose keys other documents share, in order of bucket and first appearance."""

    def __init__(self, shards: Shards, row: dict):
        self.data, self.sizes, self.ids, self.free = _open(row)
        doc, first, last, bucket, tag = shards.runs(self.data, self.sizes, self.free)
        known = [(np.int64(s["bucket"]) << 32) | np.frombuffer(s["tags"], "<u4").astype(np.int64) for s in row["shared"] or []]
        known = np.concatenate(known) if known else np.empty(0, np.int64)
        key = bucket << 31 | tag
        chosen = np.flatnonzero(np.isin(key, known >> 1))
        hot = chosen[np.isin(key[chosen], known[known & 1 == 1] >> 1)]
        if len(hot):
            plain = np.setdiff1d(chosen, hot, assume_unique=True)
            run, a, b, dealt = shards.split(shards.pieces(self.data), first[hot], last[hot])
            doc, first, last, bucket = (np.concatenate(x) for x in ((doc[plain], doc[hot[run]]), (first[plain], a), (last[plain], b), (bucket[plain], dealt)))
        else:
            doc, first, last, bucket = doc[chosen], first[chosen], last[chosen], bucket[chosen]
        order = np.argsort(bucket, kind="stable")
        self.doc, self.first, self.bucket = self.ids[doc[order]], first[order], bucket[order]
        raw = self.data.tobytes()
        number: dict[tuple[int, bytes], int] = {}
        stop = last[order] + shards.length
        of = [number.setdefault((k, raw[a:b]), len(number)) for k, a, b in zip(self.bucket.tolist(), self.first.tolist(), stop.tolist())]
        self.of = np.array(of, np.int64)
        self.texts = [t for _, t in number]
        self.segment_bucket = np.array([k for k, _ in number], np.int64)
        self.least = np.full(len(number), np.iinfo(np.int64).max)
        self.most = np.full(len(number), np.iinfo(np.int64).min)
        np.minimum.at(self.least, self.of, self.doc)
        np.maximum.at(self.most, self.of, self.doc)


def _suffix_order(v: np.ndarray, at: np.ndarray, steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``at`` in the order of their first bytes, and for each place the first place with equal ones.

    Eight bytes at a time; only what is still tied is sorted further.
    """
    value = v[at + steps[0]]
    order = np.argsort(value)
    value, places, group = value[order], np.arange(len(order)), np.zeros(len(order), np.int64)
    head = places.copy()
    for k in range(1, len(steps) + 1):
        if not len(places):
            break
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
        group = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        places, group = places[tied], group[tied]
        if k == len(steps):  # what is left is equal in all bytes
            head[places] = group
            break
        rows = order[places]
        value = v[at[rows] + steps[k]]
        by = np.lexsort((value, group))
        order[places], value = rows[by], value[by]
    return order, head


def previous_smaller(value: np.ndarray, head: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it, from ``head`` on, with a smaller value; -1 if there is none.

    Every place follows its neighbour's pointer while that is not smaller:
    what a pointer skips is not smaller than its owner either. All places
    step at once, so skipped stretches double.
    """
    prev = np.arange(len(value)) - 1
    prev[prev < head] = -1
    open_ = np.flatnonzero(prev >= 0)
    while len(open_):
        open_ = open_[value[prev[open_]] >= value[open_]]
        prev[open_] = prev[prev[open_]]
        open_ = open_[prev[open_] >= 0]
    return prev


def earliest_sources(texts: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(an earlier document that holds it, or its own, for each window of each text; windows of each text).

    ``docs`` is each text's own smallest document, the position that counts.
    A suffix's longest previous factor is the longer of what it has in common
    with the previous and with the next smaller position in suffix order.
    Lengths beyond ``length`` decide nothing, so the order goes by that many
    bytes and the factors are capped there: one reaches the cap just when a
    smaller position stands among the neighbours that are equal so far.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    count = sizes - length + 1
    of = np.repeat(np.arange(len(texts)), count)
    at = np.arange(len(of)) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(count) - count), count)
    v = _words(data, ">").astype(np.uint64)
    order, head = _suffix_order(v, at, [*range(0, length - 7, 8), length - 8])
    position, n = docs[of[order]], len(order)
    ends = np.flatnonzero(np.append(head[1:] != head[:-1], True)) if n else head
    tail = np.repeat(ends, np.diff(ends, prepend=-1))
    before = previous_smaller(position, head)
    after = n - 1 - previous_smaller(position[::-1], n - 1 - tail[::-1])[::-1]  # n: none
    match = np.where(before >= 0, before, np.where(after < n, after, np.arange(n)))
    source = np.empty(n, np.int64)
    source[order] = position[match]
    return source, count


def source_runs(source: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(runs of each text, first window, last window, source): runs of windows of one text with one source."""
    ends = np.cumsum(count)
    new = np.concatenate(([True], source[1:] != source[:-1])) if len(source) else np.empty(0, bool)
    new[(ends - count)[count > 0]] = True
    first = np.flatnonzero(new)
    text = np.searchsorted(ends, first, side="right")
    last = np.append(first[1:], len(source))[: len(first)] - 1
    return np.bincount(text, minlength=len(count)), first - (ends - count)[text], last - (ends - count)[text], source[first]


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    pack_bytes: int = 4 << 20,
    bucket_bytes: int = 8 << 20,
    hot_packs: int = 256,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without the bytes covered by ``length``-byte strings of a document with smaller id.

    Matches lie within documents and are judged on the input. The texts are
    packed (a few MB a row). Every window of ``length`` bytes belongs to the
    shard of its smallest piece hash. First only 31-bit tags of these hashes
    travel, once per pack: those of a single document cannot match. Segments
    of the others travel once per pack and distinct content. Each shard sorts
    the suffixes of its distinct segments and computes their longest previous
    factors, capped at ``length``; it tells each pack which windows have an
    earlier source. So a
    passage or copy that fills a third of the corpus is one entry a pack in
    its shard; keys that more than ``hot_packs`` packs hold (a common line with
    different text around it) are dealt by more keys, so they fill no
    one shard. Shards grow in number with the input (``bucket_bytes`` of
    text each).

    Null text counts as empty. Documents of equal id are no source for each
    other; a row without id is kept whole and is no source. Repeated rows come
    out as often as they go in. An empty table gives no rows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for chunk in row_chunks(batches, "text", pack_bytes):
            texts, ids = byte_column(chunk, "text").to_pylist(), chunk.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + count]),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t or b"") for t in texts]], pa.list_(pa.int64())),
                    pa.array([packed(ids, texts)], pa.binary()),
                ],
                ["pack", "ids", "sizes", "data"],
            )
            count += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packs = saved(rows.mapInArrow(pack, "pack long, ids array<long>, sizes array<long>, data binary"), "packs")
    total = packs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    shards = Shards(length, max(1, -(-total // bucket_bytes)))

    def tags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each key once per pack, with a mark if two documents of the pack hold it."""
        for batch in batches:
            for row in batch.to_pylist():
                data, sizes, ids, free = _open(row)
                doc, _, _, bucket, tag = shards.runs(data, sizes, free)
                key = bucket << 31 | tag
                order = np.lexsort((ids[doc], key))
                key, of = key[order], ids[doc][order]
                first = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0))) if len(key) else np.empty(0, np.int64)
                last = np.append(first[1:], len(key)) - 1 if len(key) else first
                entry = ((key[first] & 0x7FFFFFFF) << 1 | (of[first] != of[last])).astype("<u4")
                buckets, blobs = [], []
                for b, at in _split(key[first] >> 31):
                    buckets.append(b)
                    blobs.append(entry[at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), pa.array([row["pack"]] * len(buckets), pa.int64()), pa.array(blobs, pa.binary())],
                    ["bucket", "pack", "tags"],
                )

    def shared(group: pa.Table) -> pa.Table:
        """Keys of two documents or more, told to each pack that has them."""
        blobs = [np.frombuffer(x, "<u4") for x in group.column("tags").to_pylist()]
        entry = np.concatenate(blobs)
        tag, back, count = np.unique(entry >> 1, return_inverse=True, return_counts=True)
        several = count > 1
        several[back[(entry & 1) == 1]] = True
        cuts = np.cumsum([len(b) for b in blobs])[:-1]
        told = np.split(several[back], cuts)
        marked = np.split(((entry >> 1) << 1) | (count > hot_packs)[back].astype(np.uint32), cuts)
        out = [b[t].astype("<u4").tobytes() for b, t in zip(marked, told)]
        return pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "tags": pa.array(out, pa.binary())}).filter(
            pa.array([bool(t.any()) for t in told])
        )

    tagged = packs.mapInArrow(tags, "bucket long, pack long, tags binary").groupBy("bucket").applyInArrow(shared, "pack long, bucket long, tags binary")
    tagged = saved(tagged, "shared").groupBy("pack").agg(F.collect_list(F.struct("bucket", "tags")).alias("shared"))
    with_tags = packs.join(tagged, "pack", "left")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Segments(shards, row)
                for b, at in _split(s.segment_bucket):
                    texts = [s.texts[k] for k in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([b]),
                            pa.array([row["pack"]]),
                            pa.array([np.array([len(t) for t in texts], "<i8").tobytes()], pa.binary()),
                            pa.array([np.stack((s.least[at], s.most[at])).astype("<i8").tobytes()], pa.binary()),
                            pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary()),
                        ],
                        ["bucket", "pack", "sizes", "docs", "texts"],
                    )

    def sources(group: pa.Table) -> pa.Table:
        """Windows of each pack's segments with a source in a document before the pack's last one that holds the segment."""
        number: dict[bytes, int] = {}
        each = []
        for row in group.to_pylist():
            sizes = np.frombuffer(row["sizes"], "<i8")
            least, most = np.frombuffer(row["docs"], "<i8").reshape(2, -1)
            raw = pa.decompress(row["texts"], int(sizes.sum()), "zstd", asbytes=True)
            cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
            each.append((row, np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(cuts, cuts[1:])], np.int64), least, most))
        docs_ = np.full(len(number), np.iinfo(np.int64).max)
        for _, of, least, _ in each:
            np.minimum.at(docs_, of, least)
        runs, first, last, source = source_runs(*earliest_sources(list(number), docs_, shards.length))
        begin = np.cumsum(runs) - runs
        out = {"pack": [], "bucket": [], "found": []}
        for row, of, _, most in each:
            n = runs[of]
            segment = np.repeat(np.arange(len(of)), n)
            run = np.arange(len(segment)) + np.repeat(begin[of] - (np.cumsum(n) - n), n)
            told = source[run] < most[segment]
            segment, run = segment[told], run[told]
            if len(run):
                out["pack"].append(row["pack"])
                out["bucket"].append(row["bucket"])
                out["found"].append(np.stack((segment, first[run], last[run], source[run])).astype("<i8").tobytes())
        return pa.table(out, pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("found", pa.binary())]))

    schema = "bucket long, pack long, sizes binary, docs binary, texts binary"
    told = with_tags.mapInArrow(segments, schema).groupBy("bucket").applyInArrow(sources, "pack long, bucket long, found binary")
    told = saved(told, "sources").groupBy("pack").agg(F.collect_list(F.struct("bucket", "found")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _cut(Segments(shards, row), row, shards.length)

    final = with_tags.join(told, "pack", "left")
    return final.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _cut(s: Segments, row: dict, length: int) -> pa.RecordBatch:
    """The pack's documents without the windows that have a source in an earlier document."""
    marks = np.zeros(len(s.data) + 1, np.int64)
    base = {b: int(at[0]) for b, at in _split(s.segment_bucket)}
    parts = []
    for f in row["found"] or []:
        part = np.frombuffer(f["found"], "<i8").reshape(4, -1).copy()
        part[0] += base[f["bucket"]]
        parts.append(part)
    if parts:
        segment, first, last, source = np.concatenate(parts, axis=1)
        order = np.argsort(segment, kind="stable")
        segment, first, last, source = segment[order], first[order], last[order], source[order]
        lo, hi = np.searchsorted(segment, s.of), np.searchsorted(segment, s.of, side="right")
        run = np.repeat(np.arange(len(s.of)), hi - lo)
        k = np.arange(len(run)) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
        earlier = source[k] < s.doc[run]
        run, k = run[earlier], k[earlier]
        np.add.at(marks, s.first[run] + first[k], 1)
        np.add.at(marks, s.first[run] + last[k] + length, -1)
    gone = np.cumsum(marks[:-1]) > 0
    ends = np.cumsum(s.sizes)
    total = np.concatenate(([0], np.cumsum(gone)))
    starts = gone & np.concatenate(([True], ~gone[:-1])) if len(gone) else gone
    new = (ends - s.sizes)[s.sizes > 0]
    starts[new] = gone[new]  # a span never goes on into the next document
    begun = np.concatenate(([0], np.cumsum(starts)))
    removed = total[ends] - total[ends - s.sizes]
    raw = s.data.tobytes()
    kept = [
        raw[b - n : b] if not r else s.data[b - n : b][~gone[b - n : b]].tobytes()
        for b, n, r in zip(ends.tolist(), s.sizes.tolist(), removed.tolist())
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None if f else x for x, f in zip(s.ids.tolist(), s.free.tolist())], pa.int64()),
            pa.array(s.sizes),
            pa.array(removed),
            pa.array(begun[ends] - begun[ends - s.sizes]),
            pa.array(kept, pa.binary()),
        ],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )
