"""N-gram Jaccard join: groups of similar documents, a token-group matrix, and only qualifying groups opened."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import byte_column, discard, saved, worker_cache
from aerolith.llm.components import components

# 64-bit multipliers of a polynomial over word hashes and of its final mixing (splitmix64); fixed values.
POLYNOMIAL, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, none give an empty set."""
    words = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.int64)
    known = worker_cache("ngram-words").setdefault("words", _WordHashes())
    w = np.array([known[x] for x in words], np.uint64)
    k = min(shingle, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(POLYNOMIAL) + w[i : i + n]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_A)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_B)
    return np.unique((h ^ (h >> np.uint64(31))).view(np.int64))


class Bounds:
    """Sizes and overlaps that a similarity of ``percent`` per cent asks for, as whole numbers.

    Sets of a and b tokens that are linked share at least percent * (a + b) /
    (100 + percent). A prefix holds the first tokens of a set in one order of
    all tokens; ``rest`` is what a set has left from a token on, itself
    included. The first token that two sets share leaves room for no more
    common ones than either rest.
    """

    def __init__(self, percent: int):
        self.percent = percent

    def least(self, size):
        """Smallest overlap with, and smallest size of, any partner."""
        return (size * self.percent + 99) // 100

    def prefix(self, size):
        return size - self.least(size) + 1

    def least_column(self, size: Column) -> Column:
        return F.floor((size * self.percent + 99) / 100)

    def reaches(self, size: Column, other_size: Column, rest: Column, other_rest: Column) -> Column:
        """Whether sets whose first common token has these rests can be linked."""
        return self.percent * (size + other_size) <= (100 + self.percent) * F.least(rest, other_rest)


def _counter(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The counter of each token."""
    return (tokens.view(np.uint64) >> np.uint64(17)).astype(np.int64) & ((1 << bits) - 1)


def token_levels(docs: DataFrame, shingle: int, bits: int, pieces: int = 64, salts: int = 32) -> np.ndarray:
    """How frequent tokens are, by 2**bits counters over all documents: zero for what may be rare, else a logarithm.

    Levels only order the tokens of the prefixes (rare ones first); any order
    gives the same links. The table has a fixed size, whatever the corpus:
    tokens that share a counter blur each other, so the level is that of the
    count beyond what chance gives a counter. Each task sends its counters in
    ``pieces``, which are added up in two steps.
    """
    n = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n, np.int32)
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in byte_column(batch, "text")]
            if sets:
                at, times = np.unique(_counter(np.concatenate(sets), bits), return_counts=True)
                held[at] += times.astype(np.int32)
        salt = TaskContext.get().partitionId() % salts
        for k, part in enumerate(np.split(held, pieces)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"piece": pa.array([k], pa.int32()), "salt": pa.array([salt], pa.int32()), "held": pa.array([_packed(part)], pa.binary())})

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(n // pieces, np.int64)
        for part in group.column("held").to_pylist():
            total += _unpacked(part, n // pieces)
        return pa.table({"piece": group.column("piece").slice(0, 1), "salt": pa.array([0], pa.int32()), "held": pa.array([_packed(total)], pa.binary())})

    schema = "piece int, salt int, held binary"
    parts = docs.select("text").mapInArrow(count, schema).groupBy("piece", "salt").applyInArrow(added, schema)
    found = parts.groupBy("piece").applyInArrow(added, schema).select("piece", "held").collect()  # of a fixed size, compressed
    chance = sum(int(_unpacked(row["held"], n // pieces).sum()) for row in found) / n
    levels = np.zeros(n, np.uint8)
    for row in found:
        beyond = np.maximum(0, _unpacked(row["held"], n // pieces) - chance - 4 * np.sqrt(chance) - 1)
        levels[row["piece"] * (n // pieces) : (row["piece"] + 1) * (n // pieces)] = np.minimum(255, np.ceil(8 * np.log2(1 + beyond)))
    return levels


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype("<i8").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), "<i8")


def prefix_tokens(tokens: np.ndarray, levels: np.ndarray, bounds: Bounds) -> np.ndarray:
    """The set's first tokens, those of the least level first, then by hash."""
    level = levels[_counter(tokens, len(levels).bit_length() - 1)]
    return tokens[np.argsort(level, kind="stable")[: int(bounds.prefix(len(tokens)))]]


def document_sets(docs: DataFrame, shingle: int, levels: np.ndarray, bounds: Bounds) -> DataFrame:
    """(id, size, digest, prefix): the shingle set of each row by its size, 128-bit digest and prefix tokens."""
    order = docs.sparkSession.sparkContext.broadcast(levels)  # a byte a counter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in byte_column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([prefix_tokens(s, order.value, bounds) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "size", "digest", "prefix"],
            )

    return docs.mapInArrow(run, "id long, size long, digest binary, prefix array<bigint>")


def set_tokens(docs: DataFrame, needed: DataFrame, shingle: int, broadcast_rows: int) -> DataFrame:
    """(sid, tokens) of the ``needed`` sets, made anew from the text of one document that holds each.

    Up to ``broadcast_rows`` rows of ``needed`` (40 bytes each) are broadcast, more are joined by a shuffle.
    """
    few = needed.count() <= broadcast_rows
    texts = docs.join(F.broadcast(needed) if few else needed, docs["id"] == needed["head"]).select("sid", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in byte_column(batch, "text")]
            same = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, batch.column("digest").to_pylist())]
            keep = pa.array(same, pa.bool_())  # an id may belong to several texts
            yield pa.RecordBatch.from_arrays([batch.column("sid").filter(keep), pa.array([s for s, ok in zip(sets, same) if ok], pa.list_(pa.int64()))], ["sid", "tokens"])

    return texts.mapInArrow(run, "sid long, tokens array<bigint>").dropDuplicates(["sid"])


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, shingle: int, percent: int, broadcast_rows: int) -> DataFrame:
    """Those (a, b) whose whole sets are similar enough."""
    pairs = saved(pairs, "pairs")
    sids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    needed = saved(sids.join(sets.select("sid", "head", "digest"), "sid"), "needed")
    tokens = saved(set_tokens(docs, needed, shingle, broadcast_rows), "tokens")
    both = pairs.join(tokens.toDF("a", "ta"), "a").join(tokens.toDF("b", "tb"), "b")
    common = F.size(F.array_intersect("ta", "tb")).cast("long")
    return both.where(100 * common >= percent * (F.size("ta") + F.size("tb") - common)).select("a", "b")


def star_pairs(postings: DataFrame, bounds: Bounds, one: bool = False) -> DataFrame:
    """(a, b): each set with the hubs of its tokens, where they can be linked. A few pairs a set.

    A token's hub is the set with the fewest tokens before it (then the
    smallest id): of an original and its edited copies, the original, which
    is near to all of them though they may not be near to each other. Hubs
    only make the groups; what they miss is found between groups. ``one``
    takes the hub of most of a set's tokens alone.
    """
    best = F.min(F.struct((F.col("size") - F.col("rest")).alias("pos"), "sid", "size", "rest")).alias("hub")
    hubs = postings.groupBy("token").agg(best).select(
        "token", F.col("hub.sid").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.rest").alias("hub_rest")
    )
    met = postings.join(hubs, "token").where(F.col("sid") != F.col("hub"))
    met = met.where(bounds.reaches(F.col("size"), F.col("hub_size"), F.col("rest"), F.col("hub_rest")))
    if one:
        met = met.groupBy("sid", "hub").count().groupBy("sid").agg(F.max(F.struct("count", "hub"))["hub"].alias("hub"))
    return met.select(F.least("hub", "sid").alias("a"), F.greatest("hub", "sid").alias("b")).distinct()


def group_pairs(members: DataFrame, bounds: Bounds) -> DataFrame:
    """(a, b): sets of different groups that may be linked.

    ``members``: (token, sid, size, rest, grp) of tokens that several groups
    hold. The token-group matrix has a row for each token of a group's union,
    with the smallest size and the largest rest of the members that hold it.
    They bound the overlap of a query set with any of those members; only
    groups that reach the bound are opened, by the tokens they share with the
    query. A group of one member needs no opening.
    """
    matrix = members.groupBy("token", F.col("grp").alias("other")).agg(
        F.min("size").alias("low"), F.max("rest").alias("most"), F.min("sid").alias("first"), F.max("sid").alias("last")
    )
    size = F.col("size")
    met = members.join(matrix, "token").where(
        (F.col("grp") < F.col("other")) & bounds.reaches(size, F.greatest("low", bounds.least_column(size)), F.col("rest"), F.col("most"))
    )
    bound = saved(met.groupBy("sid", "other").agg(F.min("first").alias("first"), F.max("last").alias("last")), "qualified")
    single = bound.where("first = last").select(F.col("sid").alias("a"), F.col("first").alias("b"))

    queries = bound.where("first < last").select("sid", "other").join(members.select("sid", "size", "rest", "token"), "sid")
    inside = members.select("token", F.col("grp").alias("other"), F.col("sid").alias("b"), F.col("size").alias("b_size"), F.col("rest").alias("b_rest"))
    opened = queries.join(inside, ["token", "other"]).where(bounds.reaches(size, F.col("b_size"), F.col("rest"), F.col("b_rest")))
    return single.unionByName(opened.select(F.col("sid").alias("a"), "b").distinct())


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bits: int = 24,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """(id, n_shingles, component_id): documents linked where 100 * intersection >= percent * union of their shingle sets.

    Equal sets are folded first, so copies cost one row. Then:

    1. Counters of a fixed size (``2**bits``) over all documents say how
       frequent tokens are. Every set's prefix tokens, rare ones first, are
       dealt by token. Each set is checked against the hubs of its tokens;
       what is really similar forms the groups.
    2. The token-group matrix has one row for each token and group that holds
       it: the group's union of prefix tokens, without its members. A set
       meets the groups other than its own; a group is opened only if the
       bound on the set's overlap with its members reaches what a link needs.
       Pairs within a group need no check: the group is connected.
    3. Candidates are verified on their whole sets, made anew from the texts,
       and all links are joined to components.

    The result does not depend on the counters: the prefix bound holds in any
    order of the tokens. Shingles are compared by 64-bit hashes, sets by
    128-bit digests. A token that many *groups* hold in their prefix is
    compared between each two of them.

    Null or blank texts have no shingles and link with nothing. Rows of
    equal id are documents of their own. A row without id keeps its
    n_shingles, has a null component and links nothing. Repeated rows come
    out as often as they go in; other columns are ignored; no rows give no rows.
    """
    bounds = Bounds(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = saved(document_sets(docs, shingle, token_levels(docs, shingle, bits), bounds), "document-sets")
    known = docs.where("id IS NOT NULL")
    folded = rows.where("id IS NOT NULL AND size > 0").groupBy("digest").agg(F.min("id").alias("head"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    sets = saved(folded.withColumn("sid", F.monotonically_increasing_id()), "sets")
    texts, rows = rows, saved(rows.drop("prefix"), "document-sizes")
    discard(texts)

    postings = sets.select("sid", "size", F.posexplode("prefix").alias("pos", "token"))
    postings = postings.select("token", "sid", "size", (F.col("size") - F.col("pos")).alias("rest"))
    several = postings.groupBy("token").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).where("first < last").select("token")
    shared = saved(postings.join(several, "token"), "postings")

    check = lambda pairs: saved(verified(pairs, known, sets, shingle, percent, broadcast_rows), "links")
    stars = check(star_pairs(shared, bounds))
    groups = components(stars, "a", "b").toDF("sid", "root")
    placed = shared.join(groups, "sid", "left").select("token", "sid", "size", "rest", F.coalesce("root", "sid").alias("grp"))
    mixed = placed.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("token")
    members = saved(placed.join(mixed, "token"), "members")
    links = stars.unionByName(check(group_pairs(members, bounds)))

    roots = components(links, "a", "b").toDF("sid", "root")
    labelled = sets.select("sid", "digest", "head").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    heads = labelled.groupBy("root").agg(F.min("head").alias("component_id"))
    classes = labelled.join(heads, "root").select("digest", "component_id")
    found = rows.select("id", "size", "digest").join(classes, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(len(w), 5) - 1) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (
  SELECT x, y FROM met m JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * m.n >= 80 * (p.n + q.n - m.n)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least_id AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM words w JOIN least_id ON x = w.doc_id LEFT JOIN sizes s ON s.doc_id = w.doc_id
"""
