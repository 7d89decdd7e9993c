"""Near-duplicate paragraphs: MinHash bands, exact Jaccard similarity, removals by components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from aerolith.llm.common import byte_column, free_shuffles, row_chunks, saved
from aerolith.llm.components import components
from aerolith.llm.decontaminate import LOWER, word_hashes
from aerolith.llm.ngram_join import Bounds, group_pairs, star_pairs

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[list(b".!?:;")] = True
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
LINE, BLOCK = 0, 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


class Lines:
    """Lines and words of a few texts, with hashes of the words and of their shingles."""

    def __init__(self, texts: list[bytes | None], shingle: int, min_words: int):
        data = LOWER[np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)]
        inside = np.concatenate(([False], ~IS_SPACE[data], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        breaks = np.flatnonzero(data == 10)
        self.shingle = shingle
        self.first = np.concatenate(([0], np.searchsorted(starts, breaks)))  # first word of each line
        self.count = np.diff(self.first)
        text_ends = np.cumsum([len(t or b"") + 1 for t in texts])
        self.text_first = np.searchsorted(breaks, text_ends - 1) + 1  # lines up to the end of each text
        some = self.count > 0
        whole = np.zeros(len(self.count), bool)  # a sentence with a shingle: a paragraph of its own
        if len(ends):
            whole = some & (self.count >= max(shingle, min_words)) & ENDS_SENTENCE[data[ends[np.maximum(self.first[1:], 1) - 1] - 1]]
        self.parts = np.concatenate(([0], np.cumsum(some & ~whole)))  # lines before each that are not
        words = word_hashes(data, starts, ends)
        one = _mixed(words["f0"])
        total = np.zeros(max(0, len(one) - shingle + 1), np.uint64)
        for k in range(shingle):
            total = (total + one[k : k + len(total)]) * MIX[0]
        self.shingles = _mixed(total)  # of the words from each on
        self.raw = np.ascontiguousarray(words).view(np.uint8).tobytes()

    def starts_of_blocks(self) -> np.ndarray:
        """Lines with words that follow a blank line or the start of a text."""
        line = np.flatnonzero(self.count)
        if not len(line):
            return line
        of = np.searchsorted(self.text_first, line, side="right")
        return line[np.concatenate(([True], (np.diff(line) > 1) | (np.diff(of) > 0)))]


class Paragraphs:
    """Lines (or blocks: runs of lines between blank ones) of at least ``min_words`` words.

    ``row`` is the text, ``line`` the first line in it, ``size`` the number of
    lines and ``block`` the first line of the block around it; ``key`` is a
    128-bit digest of the kind and the lower-cased words (ASCII letters and
    white space), however they are wrapped; ``shingles`` of paragraph p are
    ``hashes[cuts[p]:cuts[p + 1]]``, none if it is shorter than a shingle.
    ``near`` tells which are compared for near copies: all with a shingle, but
    blocks made of lines that are compared themselves.
    """

    def __init__(self, lines: Lines, min_words: int, kind: int):
        heads, line = lines.starts_of_blocks(), np.flatnonzero(lines.count)
        last = line
        if kind == BLOCK and len(line):
            line, last = heads, line[np.append(np.searchsorted(line, heads[1:]), len(line)) - 1]
        first = lines.first
        n = first[last + 1] - first[line]
        enough = n >= max(min_words, 1)
        line, last, n = line[enough], last[enough], n[enough]
        self.kind, self.size = kind, last - line + 1
        sizes = np.maximum(n - lines.shingle + 1, 0)
        self.near = (sizes > 0) & ((self.size == 1) | (lines.parts[last + 1] > lines.parts[line]))
        self.cuts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(self.cuts[-1]) + np.repeat(first[line] - self.cuts[:-1], sizes)
        self.hashes = lines.shingles[at] if len(at) else np.empty(0, np.uint64)
        self.row = np.searchsorted(lines.text_first, line, side="right")
        base = np.concatenate(([0], lines.text_first))[self.row]
        self.line = line - base
        self.block = (heads[np.searchsorted(heads, line, side="right") - 1] if len(line) else line) - base
        mark = bytes([kind])
        self.key = [xxhash.xxh128_digest(mark + lines.raw[16 * x : 16 * (x + m)]) for x, m in zip(first[line].tolist(), n.tolist())]

    def bands(self, which: np.ndarray, bands: int, rows: int) -> np.ndarray:
        """One number for the ``rows`` smallest hashes of each band, for the paragraphs ``which``."""
        out = np.zeros((len(which), bands), np.uint64)
        if len(which):
            sizes = np.diff(self.cuts)[which]
            cuts = np.cumsum(sizes) - sizes
            hashes = self.hashes[np.arange(sizes.sum()) + np.repeat(self.cuts[which] - cuts, sizes)]
            seeds = _mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * MIX[0])
            for k, seed in enumerate(seeds):
                least = np.minimum.reduceat(_mixed(hashes ^ seed), cuts)
                out[:, k // rows] = _mixed((out[:, k // rows] + least) * MIX[0] + np.uint64(2 * (k // rows) + self.kind))
        return out.view(np.int64)


def sign(docs: DataFrame, min_words: int, shingle: int, bands: int, rows: int) -> DataFrame:
    """(kind, key, u, doc_id, line, block, bands) of every line and block; bands where it may be compared, once a key and task.

    ``u`` is the first half of the key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for part in row_chunks(batches, "text", 4 << 20):
            lines = Lines(byte_column(part, "text").to_pylist(), shingle, min_words)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for kind in (BLOCK, LINE):
                p = Paragraphs(lines, min_words, kind)
                which = []
                for k in np.flatnonzero(p.near).tolist():
                    if p.key[k] not in met:
                        met.add(p.key[k])
                        which.append(k)
                if len(met) > 1_000_000:
                    met.clear()
                offsets = np.zeros(len(p.key) + 1, np.int32)
                offsets[np.array(which, np.int64) + 1] = bands
                valid = np.zeros(len(p.key), bool)
                valid[which] = True
                listed = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets), pa.int32()), pa.array(p.bands(np.array(which, np.int64), bands, rows).ravel()), mask=pa.array(~valid))
                raw = b"".join(p.key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(p.key), kind, np.int32)),
                        pa.array(p.key, pa.binary()),
                        pa.array(np.ascontiguousarray(np.frombuffer(raw, "<i8").reshape(-1, 2)[:, 0])),
                        pa.array(ids[p.row]),
                        pa.array(p.line.astype(np.int32)),
                        pa.array(p.block.astype(np.int32)),
                        listed,
                    ],
                    ["kind", "key", "u", "doc_id", "line", "block", "bands"],
                )

    return docs.mapInArrow(run, "kind int, key binary, u long, doc_id long, line int, block int, bands array<bigint>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, min_words: int, shingle: int) -> DataFrame:
    """(u, key, shingles) of the ``wanted`` paragraphs (doc_id, line, key, u), made anew from the texts that hold them."""
    per_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line", "key", "u")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, "text", 1 << 20):
            lines = Lines(byte_column(part, "text").to_pylist(), shingle, min_words)
            place = {}
            for kind in (BLOCK, LINE):
                p = Paragraphs(lines, min_words, kind)
                place |= {(r, x, k): (p, i) for i, (r, x, k) in enumerate(zip(p.row.tolist(), p.line.tolist(), p.key))}
            out = {"u": [], "key": [], "shingles": []}
            for r, list_ in enumerate(part.column("wanted").to_pylist()):
                for w in list_:
                    p, i = place.get((r, w["line"], w["key"]), (None, 0))
                    if p:  # else another row with the same id
                        out["u"].append(w["u"])
                        out["key"].append(w["key"])
                        own = p.hashes[p.cuts[i] : p.cuts[i + 1]] ^ (MIX[2] * np.uint64(p.kind))  # lines and blocks have none in common
                        out["shingles"].append(np.unique(own.view(np.int64)))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("u", pa.int64()), ("key", pa.binary()), ("shingles", pa.list_(pa.int64()))]))

    texts = docs.join(per_doc, "doc_id").select("text", "wanted")
    return texts.mapInArrow(run, "u long, key binary, shingles array<bigint>").dropDuplicates(["key"])


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, key_a, key_b) of the pairs (a, b) of u whose shingle sets are similar enough."""
    both = pairs.join(sets.toDF("a", "key_a", "sa"), "a").join(sets.toDF("b", "key_b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= F.lit(float(threshold)) * (F.size("sa") + F.size("sb") - common)).select("a", "b", "key_a", "key_b")


def postings_of(sets: DataFrame, bounds: Bounds) -> DataFrame:
    """(token, sid, size, rest) of the shared shingles in each set's prefix, those of few sets first.

    Shingles of a single set come before all others and meet nothing: only
    their number counts.
    """
    tokens = sets.select("u", F.explode("shingles").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    listed = tokens.join(shared, "token").groupBy("u").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("t"))
    sized = sets.select("u", F.size("shingles").cast("long").alias("size")).distinct().join(listed, "u")
    alone = F.col("size") - F.size("t")
    prefix = F.col("size") - bounds.least_column(F.col("size")) + 1
    first = F.slice("t", F.lit(1), F.greatest(F.lit(0), prefix - alone).cast("int"))
    rows = sized.select("u", "size", alone.alias("alone"), F.posexplode(first).alias("pos", "x"))
    return rows.select(F.col("x.token").alias("token"), F.col("u").alias("sid"), "size", (F.col("size") - F.col("alone") - F.col("pos")).alias("rest"))


def near_copies(docs: DataFrame, signed: DataFrame, min_words: int, shingle: int, threshold: float) -> DataFrame:
    """(key_a, key_b): links that join all paragraphs with a band in common and Jaccard similarity of ``threshold`` or more.

    Paragraphs that collide in a band with another one are candidates; their
    shingle sets are made anew. Which of them to compare, exact bounds on the
    overlap say (see :mod:`aerolith.llm.ngram_join`): each with the best hub
    of its shingles first, then only between what these links have not joined.
    So neither a group of near copies nor one of many unlike edits of one
    paragraph, whose bands collide all the same, costs all its pairs.
    """
    dealt = signed.where("bands IS NOT NULL").select("u", F.explode("bands").alias("band"))
    several = dealt.groupBy("band").agg(F.min("u").alias("least"), F.max("u").alias("most")).where("least <> most").select("band")
    seen = dealt.join(several, "band").select("u").distinct()
    heads = signed.where("bands IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "line")).alias("h"), F.first("u").alias("u"))
    wanted = saved(heads.join(seen, "u").select(F.col("h.doc_id").alias("doc_id"), F.col("h.line").alias("line"), "key", "u"), "wanted")
    free_shuffles(docs.sparkSession)
    sets = saved(shingle_sets(docs, wanted, min_words, shingle), "sets")
    free_shuffles(docs.sparkSession)

    bounds = Bounds(int(100 * threshold))
    postings = saved(postings_of(sets, bounds), "postings")
    free_shuffles(docs.sparkSession)
    first = saved(verified(star_pairs(postings, bounds, one=True), sets, threshold), "links")
    joined = components(first, "a", "b").toDF("sid", "root")
    placed = postings.join(joined, "sid", "left").select("token", "sid", "size", "rest", F.coalesce("root", "sid").alias("grp"))
    mixed = placed.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("token")
    members = saved(placed.join(mixed, "token"), "members")
    second = verified(group_pairs(members, bounds), sets, threshold)
    return saved(first.unionByName(second).select("key_a", "key_b"), "links")


def removals(met: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, line, kind, key, keep_doc) of every occurrence but the first of each component, by doc_id and line.

    Links count between paragraphs that occur in ``met``.
    """
    heads = saved(met.groupBy("key").agg(F.min(F.struct("doc_id", "line")).alias("head"), F.count("*").alias("n")), "heads")
    here = heads.select("key")
    links = links.join(here.withColumnRenamed("key", "key_a"), "key_a", "left_semi").join(here.withColumnRenamed("key", "key_b"), "key_b", "left_semi")
    roots = components(links, "key_a", "key_b")
    rooted = heads.join(roots, heads["key"] == roots["node"], "left").select("key", "head", "n", F.coalesce("root", "key").alias("root"))
    keep = rooted.groupBy("root").agg(F.min("head").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    told = rooted.join(keep, "root").select("key", "keep")
    gone = met.join(told, "key").where((F.col("doc_id") != F.col("keep.doc_id")) | (F.col("line") != F.col("keep.line")))
    return saved(gone.select("doc_id", "line", "kind", "key", F.col("keep.doc_id").alias("keep_doc")), "gone")


def remove_repeated_paragraphs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    shingle: int = 5,
    threshold: float = 0.8,
    bands: int = 12,
    rows: int = 3,
) -> DataFrame:
    """(doc_id, n_paragraphs, n_removed, sources, kept): texts without paragraphs that repeat, exactly or nearly, one met earlier.

    Paragraphs are first the blocks between blank lines, so that wrapped text
    meets however it is wrapped, then in what is left the lines; both of at
    least ``min_words`` words. Equal ones (by lower-cased words) are folded
    first, which is all for those shorter than a shingle. MinHash bands (12
    of 3 rows: a pair of similarity 0.8 meets with probability 0.9998) find
    candidates; exact Jaccard similarity of 5-word shingles, 0.8 or more,
    verifies them; each component keeps its first paragraph by doc_id and
    line. Blocks made of lines that each end a sentence and hold a shingle go
    only if equal: their lines are paragraphs and are compared one by one.
    ``n_paragraphs`` counts blocks of several lines, removed single ones and
    lines left to compare; ``sources`` lists the documents that held the kept
    paragraph when one was removed (its lines may repeat yet earlier ones).

    One pass signs lines and blocks together; what travels are keys and
    places. Texts are shuffled twice, to the places of candidates and to
    those of the cuts.

    Null text counts as empty; a row without id is kept whole and is no
    source. Repeated rows of one id share the decision. An empty table gives
    no rows.
    """
    rows_ = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows_.where("doc_id IS NOT NULL AND text IS NOT NULL")
    signed = saved(sign(known, min_words, shingle, bands, rows), "signed")
    links = near_copies(known, signed, min_words, shingle, threshold)
    free_shuffles(docs.sparkSession)

    places = signed.drop("bands", "u")
    gone_blocks = removals(places.where(F.col("kind") == BLOCK), links)
    inside = gone_blocks.select("doc_id", F.col("line").alias("block")).distinct()
    lines = saved(places.where(F.col("kind") == LINE).join(inside, ["doc_id", "block"], "left_anti"), "lines-left")
    gone = gone_blocks.unionByName(removals(lines, links))
    free_shuffles(docs.sparkSession)

    per_doc = gone.groupBy("doc_id").agg(
        F.collect_set(F.struct("kind", "line", "key")).alias("gone"), F.array_sort(F.collect_set("keep_doc")).alias("sources")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, "text", 4 << 20):
            texts = byte_column(part, "text").to_pylist()
            parsed = Lines(texts, shingle, min_words)
            blocks, own = Paragraphs(parsed, min_words, BLOCK), Paragraphs(parsed, min_words, LINE)
            drop = [{(g["kind"], g["line"], g["key"]) for g in d or []} for d in part.column("gone").to_pylist()]
            n, removed = [0] * len(texts), [0] * len(texts)
            out: list[set[int]] = [set() for _ in texts]
            for r, x, k, m in zip(blocks.row.tolist(), blocks.line.tolist(), blocks.key, blocks.size.tolist()):
                hit = (BLOCK, x, k) in drop[r]
                n[r] += m > 1 or hit
                if hit:
                    removed[r] += 1
                    out[r].update(range(x, x + m))
            for r, x, k in zip(own.row.tolist(), own.line.tolist(), own.key):
                if x not in out[r]:
                    n[r] += 1
                    if (LINE, x, k) in drop[r]:
                        removed[r] += 1
                        out[r].add(x)
            kept = [(t or b"").decode() for t in texts]
            kept = ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in o) if o else t for t, o in zip(kept, out)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), part.column("sources"), pa.array(kept, pa.string())],
                ["doc_id", "n_paragraphs", "n_removed", "sources", "kept"],
            )

    none = F.array().cast("array<long>")
    joined = rows_.join(per_doc, "doc_id", "left").select("doc_id", "text", F.coalesce("sources", none).alias("sources"), "gone")
    return joined.mapInArrow(cut, "doc_id long, n_paragraphs long, n_removed long, sources array<long>, kept string")
