"""Cross-tokenizer alignment: the token ends of two tokenizers merged by merge-path partitioning."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolith.llm.common import row_chunks, saved, worker_cache

BATCH_BYTES = 512 << 10  # text handed to the tokenizers at once


# --- tokenizers -------------------------------------------------------------


@dataclass(frozen=True)
class Source:
    """A tokenizer file as it travels to the tasks. ``encode`` gives tokens of a blank and the text."""

    kind: str
    data: bytes

    def load(self) -> Tokens:
        return {"byte_level": ByteLevel, "sentence_piece": SentencePiece}[self.kind](self.data)


def byte_level(path: str) -> Source:
    """A byte-level BPE of the ``tokenizers`` library (JSON file)."""
    with open(path, "rb") as f:
        return Source("byte_level", f.read())


def sentence_piece(path: str) -> Source:
    """A SentencePiece model that puts a blank before the text itself."""
    with open(path, "rb") as f:
        return Source("sentence_piece", f.read())


def _printable_bytes() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where printable, else the next from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class Tokens:
    """Ids of texts, and the bytes of each id."""

    def set_bytes(self, token_bytes: list[bytes]) -> None:
        self.token_bytes = pa.array(token_bytes, pa.large_binary())
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def arrays(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Ids of all texts, how many each has, and whether its token bytes are those of a blank and the text."""
        found = self.encode(texts)
        counts = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter((i for x in found for i in x), np.int32, int(counts.sum()))
        joined = self.token_bytes.take(pa.array(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2]).cast("B") if len(ids) else b""
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return ids, counts, [data[a:b] == b" " + t.encode() for t, a, b in zip(texts, cuts, cuts[1:])]


# Fixed value: how byte-level BPE files without a pattern of their own split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below this code point (Latin, Greek, Cyrillic) the libraries' Unicode tables agree, whatever their versions.
BEYOND_STABLE = re.compile("[^\u0000-\u052d]")


def plain_encoding(spec: dict, token_bytes: list[bytes]):
    """A ``tiktoken`` encoding of a byte-level BPE file, four times as fast; none unless the file is plain.

    Plain: no normalizer, the standard split, and merges in the order of their
    tokens' ids, so that ids serve as ranks.
    """
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [spec.get("normalizer"), split.get("add_prefix_space"), *[model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")]]
    if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("use_regex") is False or any(odd):
        return None
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    single = [i for name, i in vocabulary.items() if len(name) == 1]
    if merged != sorted(set(merged)) or len(single) != 256 or max(single) > merged[0]:
        return None
    import tiktoken

    ranks = {token_bytes[i]: i for i in [*single, *merged]}
    return tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class ByteLevel(Tokens):
    def __init__(self, data: bytes, plain: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(data.decode())
        self.model.encode_special_tokens = True  # their strings are plain text
        of = _printable_bytes()
        names = self.model.get_vocab()
        table = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            table[i] = bytes(of[c] for c in name if c in of)
        self.set_bytes(table)
        self.plain = plain_encoding(json.loads(data), table) if plain else None

    def encode(self, texts: list[str]) -> list:
        found = [self.plain.encode_ordinary(" " + t) if self.plain and (t.isascii() or not BEYOND_STABLE.search(t)) else None for t in texts]
        rest = [k for k, x in enumerate(found) if x is None]
        for k, e in zip(rest, self.model.encode_batch_fast([" " + texts[k] for k in rest], add_special_tokens=False)):
            found[k] = e.ids
        return found


class SentencePiece(Tokens):
    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        raw = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
        self.set_bytes([bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(pieces, raw)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _loaded(a: Source, b: Source) -> tuple[Tokens, Tokens]:
    kept = worker_cache("alignment")
    for source in (a, b):
        if source not in kept:
            kept[source] = source.load()
    return kept[a], kept[b]


# --- the merge ----------------------------------------------------------------


def merge_path(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where every ``step``-th diagonal crosses the merge path of two sorted arrays: after i of a and j of b.

    All diagonals are searched at once. Of equal ends a's comes first.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        open_ = low < high
        mid = (low + high) // 2
        goes = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.maximum(diagonal - mid - 1, 0)])
        low, high = np.where(goes, mid + 1, low), np.where(open_ & ~goes, mid, high)
    return low, diagonal - low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """(link_a, link_b, cut_a, cut_b) of one piece of the path, from its own ends and one neighbour.

    Each end of the union of both arrays closes exactly one pair of
    overlapping tokens. An end of both is counted with a's token, and cuts
    the groups.
    """
    ends_a, ends_b = a[i0:i1], b[j0:j1]
    i, ja = np.arange(i0, i1), j0 + np.searchsorted(ends_b, ends_a)
    j, after = np.arange(j0, j1), i0 + np.searchsorted(ends_a, ends_b, side="right")
    twin = (after > 0) & (a[after - 1] == ends_b)
    cut = b[ja] == ends_a
    return np.concatenate((i, after[~twin])), np.concatenate((ja, j[~twin])), i[cut], ja[cut]


def overlaps(a: np.ndarray, b: np.ndarray, step: int = 1 << 18) -> Iterator[tuple]:
    """The pieces of the merge, of ``step`` ends each; independent of one another."""
    i, j = (x.tolist() for x in merge_path(a, b, step))
    for k in range(len(i) - 1):
        yield piece_overlaps(a, b, i[k], i[k + 1], j[k], j[k + 1])


class GroupTexts:
    """Writes groups as ``a1,a2|b1;a3|b2,b3`` by taking ready-made strings of each id and its separator."""

    def __init__(self, ids: int):
        self.ids = ids
        self.strings = pa.array([f"{i}{sep}" for sep in (",", "|", ";", "") for i in range(ids)], pa.large_string())

    def write(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, ends: np.ndarray) -> pa.Array:
        """One string a document. cut_a, cut_b: last tokens of each group; ends: groups up to each document's end."""
        last = np.zeros(len(cut_a), bool)
        last[ends[ends > 0] - 1] = True  # a document's last group
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        before_b, through_a = np.concatenate(([0], cut_b[:-1] + 1)) if len(cut_b) else cut_b, cut_a + 1
        codes = np.empty(len(a) + len(b), np.int32)
        code_a, code_b = a.astype(np.int32), b.astype(np.int32)
        code_a[cut_a] += self.ids
        code_b[cut_b] += np.where(last, 3 * self.ids, 2 * self.ids).astype(np.int32)
        codes[np.arange(len(a)) + np.repeat(before_b, size_a)] = code_a
        codes[np.arange(len(b)) + np.repeat(through_a, size_b)] = code_b
        joined = self.strings.take(pa.array(codes))
        tokens = np.concatenate(([0], np.concatenate(([0], cut_a + 1))[ends] + np.concatenate(([0], cut_b + 1))[ends]))
        if not len(codes):
            return pa.array([""] * len(ends))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[tokens]
        data = joined.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer((offsets - offsets[0]).astype(np.int64)), data).cast(pa.string())


# --- one lot of documents -------------------------------------------------------

LOT = "lot long, row int, id long, n_a long, n_b long, n_groups long, groups string, pairs array<bigint>, held array<int>, docs array<int>, times array<int>"


def encode_lot(texts: list[str | None], a: Tokens, b: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, tokens per text) of both tokenizers; texts that either does not give back byte for byte have none."""
    parts: list[tuple] = []
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to] or "") <= BATCH_BYTES):
            size += len(texts[to] or "")
            to += 1
        part = [t or "" for t in texts[at:to]]
        (ids_a, n_a, ok_a), (ids_b, n_b, ok_b) = a.arrays(part), b.arrays(part)
        good = np.array([bool(t) and x and y for t, x, y in zip(part, ok_a, ok_b)], bool)
        parts.append((ids_a[np.repeat(good, n_a)], n_a * good, ids_b[np.repeat(good, n_b)], n_b * good))
        at = to
    ids_a, n_a, ids_b, n_b = (np.concatenate(x) for x in zip(*parts))
    return [(ids_a, n_a), (ids_b, n_b)]


def align_lot(texts: list[str | None], a: Tokens, b: Tokens, writer: GroupTexts, run_tokens: int = 1 << 20) -> Iterator[tuple]:
    """First (n_a, n_b, pairs, held, docs, times), then (n_groups, groups) of consecutive runs of the lot's texts.

    The texts' token ends follow each other in one byte range, so the merge
    path cuts equal work whatever the texts' lengths. ``pairs`` are the
    distinct id pairs a * size of b's vocabulary + b, ``held`` by how many
    texts, ``docs`` and ``times`` those texts and their link counts, pair by pair.
    """
    (ids_a, n_a), (ids_b, n_b) = encode_lot(texts, a, b)
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    doc_of = np.repeat(np.arange(len(texts)), n_a)
    n_docs, wide = len(texts), len(b.lengths)
    keys, cuts_a, cuts_b = [], [], []
    for link_a, link_b, cut_a, cut_b in overlaps(ends_a, ends_b):
        key = (ids_a[link_a].astype(np.int64) * wide + ids_b[link_b]) * n_docs + doc_of[link_a]
        keys.append(np.unique(key, return_counts=True))
        cuts_a.append(cut_a)
        cuts_b.append(cut_b)
    empty = np.empty(0, np.int64)
    cut_a, cut_b = (np.concatenate([empty, *x]).astype(np.int64) for x in (cuts_a, cuts_b))  # groups across pieces close here
    key, times = (np.concatenate([empty, *x]).astype(np.int64) for x in (zip(*keys) if keys else ((), ())))
    key, back = np.unique(key, return_inverse=True)
    times = np.bincount(back, weights=times, minlength=len(key)).astype(np.int64)  # a lot's counts are far below 2^53
    pairs, held = np.unique(key // n_docs if n_docs else key, return_counts=True)
    yield n_a, n_b, pairs, held, (key % n_docs if n_docs else key).astype(np.int32), times.astype(np.int32)

    last_a = np.cumsum(n_a)
    groups = np.searchsorted(cut_a, last_a)  # groups up to the end of each text
    at, size = 0, n_a + n_b
    done = np.concatenate(([0], np.cumsum(size)))
    while at < n_docs:
        to = max(at + 1, int(np.searchsorted(done, done[at] + run_tokens, side="right")) - 1)
        g0, g1 = (int(groups[at - 1]) if at else 0), int(groups[to - 1])
        a0, b0 = (int(cut_a[g0 - 1]) + 1, int(cut_b[g0 - 1]) + 1) if g0 else (0, 0)
        a1, b1 = (int(cut_a[g1 - 1]) + 1, int(cut_b[g1 - 1]) + 1) if g1 else (0, 0)
        here = groups[at:to] - g0
        yield np.diff(here, prepend=0), writer.write(ids_a[a0:a1], ids_b[b0:b1], cut_a[g0:g1] - a0, cut_b[g0:g1] - b0, here)
        at = to


def aligned_lots(docs: DataFrame, a: Source, b: Source, lot_bytes: int) -> DataFrame:
    """Rows of each lot of about ``lot_bytes`` of text: one for each document, and one with the lot's id pairs."""
    shared = docs.sparkSession.sparkContext.broadcast((a, b))  # the tokenizer files, a few MB

    def rows(columns: dict, n: int) -> pa.RecordBatch:
        kinds = {"lot": pa.int64(), "row": pa.int32(), "id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups": pa.string(), "pairs": pa.list_(pa.int64()), "held": pa.list_(pa.int32()), "docs": pa.list_(pa.int32()), "times": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([x if isinstance(x := columns.get(c), pa.Array) else pa.nulls(n, t) if x is None else pa.array(x, t) for c, t in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _loaded(*shared.value)
        writer = worker_cache("alignment").setdefault("writer", GroupTexts(max(len(one.lengths), len(two.lengths))))
        lot = TaskContext.get().partitionId() << 32
        for chunk in row_chunks(batches, "text", lot_bytes):
            if not chunk.num_rows:
                continue
            lot += 1
            parts = align_lot(chunk.column("text").to_pylist(), one, two, writer)
            n_a, n_b, *matrix = next(parts)
            yield rows({"lot": [lot]} | {c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for c, x in zip(("pairs", "held", "docs", "times"), (matrix[0], matrix[1].astype(np.int32), *matrix[2:]))}, 1)
            at = 0
            for n_groups, groups in parts:
                to = at + len(n_groups)
                yield rows({"lot": [lot] * (to - at), "row": np.arange(at, to), "id": chunk.column("id").slice(at, to - at), "n_a": n_a[at:to], "n_b": n_b[at:to], "n_groups": n_groups, "groups": groups}, to - at)
                at = to

    return docs.mapInArrow(run, LOT)


# --- the corpus -------------------------------------------------------------------


def pair_counts(lots: DataFrame, wide: int) -> tuple[DataFrame, DataFrame]:
    """(lot, k, pair) of each lot's pairs, and (pair, n, best): documents that hold the pair, and whether its A id has no higher count."""
    pairs = lots.where("pairs IS NOT NULL").select("lot", F.posexplode(F.arrays_zip("pairs", "held")).alias("k", "x"))
    pairs = pairs.select("lot", "k", F.col("x.pairs").alias("pair"), F.col("x.held").cast("long").alias("held"))
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {wide}L"))  # an A id has as many pairs at most as B has ids
    return pairs.drop("held"), counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a lot with their sums over links."""
    rows = left.filter(pa.compute.is_valid(left.column("row")))
    matrix = left.filter(pa.compute.is_valid(left.column("pairs")))
    flat = lambda c: np.concatenate([np.empty(0, np.int64), *(x.values.to_numpy() for x in matrix.column(c) if x.values is not None)]).astype(np.int64)
    held, docs, times = flat("held"), flat("docs"), flat("times")
    order = np.argsort(right.column("k").to_numpy())
    n, best = right.column("n").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order] if len(order) else np.empty(0, bool)
    size = rows.num_rows
    sums = {c: np.zeros(size, np.int64) for c in ("n_links", "n_best", "count_sum")}
    np.add.at(sums["n_links"], docs, times)
    np.add.at(sums["n_best"], docs, times * np.repeat(best.astype(np.int64), held))
    np.add.at(sums["count_sum"], docs, times * np.repeat(n.astype(np.int64), held))
    at = rows.column("row").to_numpy()
    return pa.table({c: rows.column(c) for c in ("id", "n_a", "n_b", "n_groups")} | {c: x[at] for c, x in sums.items()} | {"groups": rows.column("groups")})


def align(
    docs: DataFrame,
    a: Source,
    b: Source,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: Callable[[Column], Column] = lambda groups: groups,
    lot_bytes: int = 8 << 20,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): two tokenizers' tokens of each text aligned by their bytes.

    A text with a blank before it is encoded by both. Where tokens of both end
    at the same byte the text is cut into groups, written
    ``a1,a2|b1;a3|b2,b3`` (ids). A link is an overlapping pair of tokens. The
    count of an id pair is the number of documents of the whole corpus that
    hold it linked; ``n_best`` counts a document's links whose pair has the
    highest count of all pairs of its A id (ties included), ``count_sum`` adds
    up the counts of its links.

    Documents are encoded in lots. A lot's token ends are two sorted arrays;
    binary searches on the diagonals of their merge cut it into pieces of
    equal work and bounded memory. A lot keeps its distinct id pairs with the
    documents that hold them: only those pairs are shuffled for the counts,
    and return to the lot. ``keep_groups`` is applied to the groups before
    they are stored (a digest, say, where their text is not needed).

    Null or empty texts, and those whose tokens of either side do not join to
    the bytes of blank and text, have no tokens: zeros and empty groups.
    Strings of special tokens are plain text. Every row is a document:
    repeated rows and rows without id come out, and count, as often as they
    go in. Other columns are ignored; no rows give no rows.
    """
    wide = len(b.load().lengths)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    lots = saved(aligned_lots(source, a, b, lot_bytes).withColumn("groups", keep_groups(F.col("groups"))), "lots")
    pairs, counts = pair_counts(lots, wide)
    stats = pairs.join(counts, "pair").select(F.col("lot").alias("of_lot"), "k", "n", "best")
    out = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    found = lots.groupBy("lot").cogroup(stats.groupBy("of_lot")).applyInArrow(_score, out)
    return found.withColumnRenamed("id", id_col)
