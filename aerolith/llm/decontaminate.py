"""Benchmark decontamination: an FM-index over the words of each shard of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from aerolith.llm.common import byte_column, row_chunks, saved

# --- words -------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)  # of lower-cased bytes; those of code points beyond ASCII all belong to words
IS_WORD[0x00:0x30] = IS_WORD[0x3A:0x61] = IS_WORD[0x7B:0x80] = False
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    inside = np.concatenate(([False], IS_WORD[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _powers(n: int, odd: int) -> np.ndarray:
    """The first ``n`` powers of a multiplier modulo 2**64."""
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, odd, np.uint64))))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two polynomial hashes of 64 bits of each word, as one record."""
    out = np.empty(len(starts), "u8,u8")
    for name, odd in zip(out.dtype.names, ODD):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data) + 1, odd)[:-1], out=total[1:])
        out[name] = (total[ends] - total[starts]) * _powers(len(data) + 1, pow(odd, -1, 1 << 64))[starts]
    return out


# --- index -------------------------------------------------------------------


class FMIndex:
    """Suffix order, wavelet tree of the preceding words and sampled positions of one sequence.

    ``text`` holds word ids from 1; zeros separate runs and match nothing.
    """

    def __init__(self, text: np.ndarray, sample: int = 8):
        n = len(text)
        stops = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(stops)
        rank[stops] = np.arange(len(stops))  # each separator a symbol of its own: no comparison goes beyond it
        step = 1
        order = np.argsort(rank, kind="stable")
        while n:
            key = rank * (n + len(stops) + int(text.max(initial=0)) + 2)
            key[: max(0, n - step)] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            step *= 2
        self.n = n
        before = text[order - 1] if n else text
        self.levels = max(1, int(text.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        row = before.copy()
        for bit in range(self.levels - 1, -1, -1):  # wavelet tree by levels, from the highest bit
            on = (row >> bit & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(on))))
            self.zeros.append(int(n - on.sum()))
            row = np.concatenate((row[~on], row[on]))
        self.first = np.searchsorted(np.sort(text), np.arange(int(text.max(initial=0)) + 2))
        self.before = before
        starts_run = np.zeros(n, bool)
        starts_run[0:1] = True
        starts_run[stops[stops + 1 < n] + 1] = True
        keep = (order % sample == 0) | starts_run[order]  # a walk ends before it leaves its run
        self.sampled = keep
        self.at = np.cumsum(keep) - 1
        self.positions = order[keep]

    def rank(self, word: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Occurrences of each word among the first ``to`` preceding words."""
        start, to = np.zeros_like(to), to.copy()
        for k, bit in enumerate(range(self.levels - 1, -1, -1)):
            on, ones = (word >> bit & 1).astype(bool), self.ones[k]
            start = np.where(on, self.zeros[k] + ones[start], start - ones[start])
            to = np.where(on, self.zeros[k] + ones[to], to - ones[to])
        return to - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of every occurrence of phrases (rows of equal length)."""
        alive = np.flatnonzero((phrases < len(self.first) - 1).all(axis=1))
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), self.n)
        for k in range(phrases.shape[1] - 1, -1, -1):  # backward
            word = phrases[alive, k]
            lo, hi = (self.first[word] + self.rank(word, x) for x in (lo, hi))
            some = hi > lo
            alive, lo, hi = alive[some], lo[some], hi[some]
        of = np.repeat(alive, hi - lo)
        row = np.arange(len(of)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        return of, self.locate(row)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Position of each row of the suffix order, by steps to the next sampled one."""
        out, steps, open_ = np.empty(len(row), np.int64), 0, np.arange(len(row))
        row = row.copy()
        while len(open_):
            done = self.sampled[row]
            out[open_[done]] = self.positions[self.at[row[done]]] + steps
            open_, row = open_[~done], row[~done]
            word = self.before[row]
            row = self.first[word] + self.rank(word, row)
            steps += 1
        return out


class Phrases:
    """The windows of benchmark items: distinct word sequences, by length, and the items they belong to."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            data = LOWER[np.frombuffer(text, np.uint8)]
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(*(x.tolist() for x in word_spans(data)))]
            for k in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[k : k + window]), set()).add(item)
        self.vocabulary = sorted({w for p in found for w in p})
        data = np.frombuffer(b" ".join(self.vocabulary), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in self.vocabulary], dtype=np.int64) - 1
        hashes = word_hashes(data, ends - [len(w) for w in self.vocabulary], ends) if found else np.empty(0, "u8,u8")
        self.order = np.argsort(hashes["f0"])
        self.hashes = hashes[self.order]
        code = {w: k + 1 for k, w in enumerate(self.vocabulary)}
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(p) for p in found}):
            rows = [p for p in found if len(p) == length]
            self.by_length[length] = (np.array([[code[w] for w in p] for p in rows]), [sorted(found[p]) for p in rows])

    def codes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Word ids; zero for words of no item."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(len(starts), np.int64)
        h = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes["f0"], h["f0"]), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at] + 1, 0)


def scan(texts: list[bytes | None], phrases: Phrases):
    """Words of a shard of texts and those inside an occurrence of a window.

    Returns the shard's bytes, text of each word, word starts, word ends, hit
    flags, and the set of items found in each text. Occurrences never cross
    texts. Words that no item holds end a run; runs shorter than every window
    cannot match and are left out of the index.
    """
    raw = b"\n".join(t or b"" for t in texts)
    data = LOWER[np.frombuffer(raw, np.uint8)]
    starts, ends = word_spans(data)
    size = np.array([len(t or b"") + 1 for t in texts], np.int64)
    of = np.searchsorted(np.cumsum(size), starts, side="right")
    code = phrases.codes(data, starts, ends)
    hit = np.zeros(len(starts), bool)
    items: dict[int, set[str]] = {}
    if not phrases.by_length or not code.any():
        return raw, of, starts, ends, hit, items
    cut = np.concatenate(([True], (code[1:] == 0) | (code[:-1] == 0) | (of[1:] != of[:-1])))
    first = np.flatnonzero(cut)
    length = np.diff(np.append(first, len(code)))
    run = np.repeat(np.where((code[first] > 0) & (length >= min(phrases.by_length)), length, 0), length) > 0
    place = np.flatnonzero(run)
    if not len(place):
        return raw, of, starts, ends, hit, items
    gap = np.flatnonzero(cut[place])  # a separator before each run
    text, where = np.insert(code[place], gap, 0), np.insert(place, gap, -1)
    index = FMIndex(text)
    marks = np.zeros(len(starts) + 1, np.int64)
    for size_, (rows, owners) in phrases.by_length.items():
        which, at = index.search(rows)
        at = where[at]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + size_, -1)
        pairs = np.unique(of[at] * len(rows) + which)
        for doc, k in zip((pairs // len(rows)).tolist(), (pairs % len(rows)).tolist()):
            items.setdefault(doc, set()).update(owners[k])
    hit = np.cumsum(marks[:-1]) > 0
    return raw, of, starts, ends, hit, items


def phrase_lots(items: DataFrame, id_col: str, text_col: str, window: int, most_bytes: int) -> list:
    """Functions that make the broadcast phrases of each lot of the benchmark, of about ``most_bytes`` of text.

    A benchmark larger than that is dealt into lots by a hash of its items;
    the driver holds the windows of one lot at a time.
    """
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    lots = max(1, -(-size // most_bytes))

    def lot(k: int):
        mine = rows if lots == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(lots)) == k)
        found = sorted((r["item"], bytes(r["text"])) for r in mine.collect())
        return items.sparkSession.sparkContext.broadcast(Phrases(found, window))

    return [lambda k=k: lot(k) for k in range(lots)]


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = 10,
    shard_bytes: int = 2 << 20,
    most_bytes: int = 4 << 20,
) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids): words inside any occurrence of an item's window, and the items met (sorted as strings).

    One pass without a shuffle: each shard of about ``shard_bytes`` of whole
    texts gets its FM-index, all windows are searched in it backwards, hits
    are located by sampled positions. The test phrases are broadcast in lots
    of about ``most_bytes`` of text; each further lot is another pass over the
    texts with the words hit so far. Null texts have no words,
    items without id or text take no part, an empty benchmark hits nothing.
    Repeated rows come out as often as they go in.
    """
    lots = phrase_lots(items, item_col, "text", window, most_bytes)
    state = "n_words long, n_hit long, item_ids array<string>, runs array<int>"
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.lit(None).cast("array<string>").alias("item_ids"), F.lit(None).cast("array<int>").alias("runs"),
    )

    def one_pass(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in row_chunks(batches, "text", shard_bytes):
                _, of, _, _, hit, met = scan(byte_column(part, "text").to_pylist(), shared.value)
                n = part.num_rows
                n_words = np.bincount(of, minlength=n)
                start = np.cumsum(n_words) - n_words
                for k, runs in enumerate(part.column("runs").to_pylist()):  # words that earlier lots hit
                    for a, b in zip((runs or [])[::2], (runs or [])[1::2]):
                        hit[start[k] + a : start[k] + b] = True
                known = part.column("item_ids").to_pylist()
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_words": pa.array(n_words),
                    "n_hit": pa.array(np.bincount(of[hit], minlength=n)),
                    "item_ids": pa.array([sorted({*(known[k] or ()), *met.get(k, ())}) for k in range(n)], pa.list_(pa.string())),
                }
                if not last:
                    runs = []
                    for a, size in zip(start.tolist(), n_words.tolist()):
                        runs.append(np.flatnonzero(np.diff(np.concatenate(([0], hit[a : a + size].astype(np.int8), [0])))).tolist())
                    columns |= {"runs": pa.array(runs, pa.list_(pa.int32())), "text": part.column("text")}
                yield pa.RecordBatch.from_pydict(columns)

        return run

    for k, lot in enumerate(lots):
        last = k == len(lots) - 1
        schema = "doc_id long, n_words long, n_hit long, item_ids array<string>" if last else f"doc_id long, {state}, text string"
        found = found.mapInArrow(one_pass(lot(), last), schema)
        if not last:
            found = saved(found, "overlaps")
    return found


def remove_overlaps(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = 10,
    shard_bytes: int = 2 << 20,
    most_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` without the merged spans of benchmark words (first to last hit word of each), as long as any is found.

    A cut leaves one line break. Other texts stay as they are, byte for byte;
    null stays null. Every row is kept, also one that is left empty. A
    benchmark of several lots takes a pass a lot, until none finds anything.
    """
    lots = phrase_lots(items, item_col, "text", window, most_bytes)
    if len(lots) == 1:
        return docs.mapInArrow(_remover(lots[0](), text_col, shard_bytes, None), docs.schema)
    cut = "_overlap_cut"
    schema = T.StructType([*docs.schema.fields, T.StructField(cut, T.BooleanType())])
    while True:
        changed = False
        for lot in lots:
            done = saved(docs.mapInArrow(_remover(lot(), text_col, shard_bytes, cut), schema), "clean")
            changed |= bool(done.agg(F.max(cut)).first()[0])
            docs = done.drop(cut)
        if not changed:
            return docs


def _remover(shared, text_col: str, shard_bytes: int, flag: str | None):
    """Cuts the windows of one lot out of every text; ``flag`` names a column that says where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, text_col, shard_bytes):
            texts = byte_column(part, text_col).to_pylist()
            todo, touched = list(range(len(texts))), [False] * len(texts)
            while todo:
                raw, of, starts, ends, hit, _ = scan([texts[k] for k in todo], shared.value)
                base = np.cumsum([0] + [len(texts[k] or b"") + 1 for k in todo])
                linked = hit[1:] & hit[:-1] & (of[1:] == of[:-1])
                first = np.flatnonzero(hit & ~np.append(False, linked)[: len(hit)])
                last = np.flatnonzero(hit & ~np.append(linked, False)[: len(hit)])
                cuts: dict[int, list[tuple[int, int]]] = {}
                for a, b in zip(first.tolist(), last.tolist()):
                    cuts.setdefault(int(of[a]), []).append((int(starts[a]), int(ends[b])))
                again = []
                for k, spans in cuts.items():
                    text, at, end = b"", int(base[k]), int(base[k + 1]) - 1
                    for a, b in spans:
                        text += raw[at:a] + b"\n"
                        at = b
                    texts[todo[k]] = text + raw[at:end]
                    touched[todo[k]] = True
                    again.append(todo[k])
                todo = again
            clean = pa.array([None if t is None else t.decode() for t in texts], pa.string())
            columns = [clean if n == text_col else c for n, c in zip(part.schema.names, part.columns)]
            names = list(part.schema.names)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(touched)] if flag else columns, [*names, flag] if flag else names)

    return run
