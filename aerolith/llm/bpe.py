"""Byte-level BPE encoding and decoding by DuckDB queries inside Spark tasks."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from aerolith.llm.common import row_chunks, worker_cache

# One list of token ids per unfinished word. A round opens the lists into
# token-position rows, joins each pair of neighbours with the merge table,
# takes the word's lowest rank (leftmost first) and contracts that pair; words
# without a mergeable pair come out as done.
CONTRACT = """
WITH RECURSIVE step(word, ids, done) AS (
  SELECT word, list(id ORDER BY pos), false FROM tokens GROUP BY word
  UNION ALL
  SELECT word, ids, done FROM (
    WITH pairs AS (
      SELECT word, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, generate_subscripts(ids[2:], 1) AS pos
      FROM step WHERE NOT done
    ), best AS (
      SELECT word, min(m.id::BIGINT << 6 | pos) AS low FROM pairs JOIN merges m USING (l, r) GROUP BY word
    )
    SELECT s.word, low IS NULL AS done,
           CASE WHEN low IS NULL THEN ids
                ELSE ids[:(low & 63) - 1] || [(low >> 6)::INT] || ids[(low & 63) + 2:] END AS ids
    FROM step s LEFT JOIN best USING (word) WHERE NOT s.done
  )
), ready AS (SELECT word, ids FROM step WHERE done)
SELECT word, generate_subscripts(ids, 1) AS pos, unnest(ids) AS id FROM ready ORDER BY word, pos
"""

# Long words: a round contracts every occurrence of the lowest pair (of a
# chain of overlapping ones each second, from the left), unless a new pair
# would rank lower, in which case only the leftmost. The leftmost-first order
# would take the same pairs one after another.
CONTRACT_LONG = """
WITH RECURSIVE step(word, pos, id, done) AS (
  SELECT word, pos, id, false FROM tokens
  UNION ALL
  SELECT word, pos, id, done FROM (
    WITH pairs AS (
      SELECT word, pos, id, row_number() OVER w AS n, lag(id) OVER w AS before, lead(id) OVER w AS nid,
             lead(id, 2) OVER w AS after
      FROM step WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)
    ), ranked AS (
      SELECT p.*, m.id AS merged, min(m.id) OVER (PARTITION BY word) AS low
      FROM pairs p LEFT JOIN merges m ON m.l = p.id AND m.r = p.nid
    ), islands AS (
      SELECT *, n - row_number() OVER (PARTITION BY word, merged IS NOT DISTINCT FROM low ORDER BY n) AS island
      FROM ranked
    ), odd AS (
      SELECT *, coalesce(merged = low, false)
             AND row_number() OVER (PARTITION BY word, merged IS NOT DISTINCT FROM low, island ORDER BY n) % 2 = 1 AS chosen
      FROM islands
    ), seen AS (
      SELECT o.*, lag(chosen, 2, false) OVER w AS left_done, lag(chosen, 1, false) OVER w AS gone
      FROM odd o WINDOW w AS (PARTITION BY word ORDER BY n)
    ), risky AS (
      SELECT s.*, min(n) FILTER (s.chosen) OVER (PARTITION BY s.word) AS first,
             coalesce(bool_or(s.chosen AND (a.id < s.low OR b.id < s.low)) OVER (PARTITION BY s.word), false) AS risk
      FROM seen s
      LEFT JOIN merges a ON s.chosen AND a.l = CASE WHEN s.left_done THEN s.low ELSE s.before END AND a.r = s.low
      LEFT JOIN merges b ON s.chosen AND b.l = s.low AND b.r = s.after
    )
    SELECT word, pos, CASE WHEN chosen AND (NOT risk OR n = first) THEN low ELSE id END AS id, low IS NULL AS done
    FROM risky WHERE NOT (gone AND (NOT risk OR n = first + 1))
  )
) SELECT word, pos, id FROM step WHERE done ORDER BY word, pos
"""

DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS decoded FROM ids JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file (base64 token and rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


# --- pieces of a text -----------------------------------------------------

SPACE, LETTER, DIGIT, OTHER = range(4)


def _class_table() -> np.ndarray:
    cache = worker_cache("classes")
    if not cache:
        table = np.full(0x110000, OTHER, np.uint8)
        points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", DIGIT)):
            for m in regex.finditer(pattern, points):
                table[np.frombuffer(m[0].encode("utf-32-le"), "<u4")] = kind
        cache["kind"] = table
    return cache["kind"]


def pieces(text: str) -> list[str]:
    """The matches of the 50k vocabulary's split pattern, by whole-array steps.

    A piece starts where the class of characters changes. The last white
    space character before a word is a piece of its own or, if it is a blank,
    joins the word. A contraction ends after its letters.
    """
    if not text:
        return []
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _class_table()[cp]
    n = len(cp)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    after = np.flatnonzero(new[1:] & (kind[:-1] == SPACE)) + 1  # starts that follow white space
    joins = after[cp[after - 1] == 32]
    new[after - 1] = True
    new[joins] = False
    for at in np.flatnonzero(new & (cp == 39)).tolist():
        tail = text[at + 1 : at + 3]
        size = 2 if tail[:1] in ("s", "t", "m", "d") and tail else 3 if tail in ("re", "ve", "ll") else 0
        if size and kind[at + 1] == LETTER:
            new[at + 1] = False
            if at + size < n and not (kind[at + size] == SPACE):
                new[at + size] = True
    cuts = np.flatnonzero(new).tolist()
    cuts.append(n)
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


class Coder:
    """One task's encoder and decoder: a DuckDB connection with merge table and vocabulary, and the words met so far."""

    LONG = 60

    def __init__(self, ranks: dict[bytes, int], memory: str = "400MB", words_per_query: int = 20_000, remembered: int = 250_000):
        self.ranks, self.words_per_query, self.remembered = ranks, words_per_query, remembered
        self.known: dict[str, bytes] = {}  # ids of a word
        self.older: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})  # nothing on local disks
        merges = [
            (ranks[t[:i]], ranks[t[i:]], rank)
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        l, r, i = (pa.array(x, pa.int32()) for x in zip(*merges)) if merges else (pa.array([], pa.int32()),) * 3
        merge_rows = pa.table({"l": l, "r": r, "id": i})  # noqa: F841  read by the next statement
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        pieces_ = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "piece": [t.decode("latin-1") for t in ranks]})  # noqa: F841
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM pieces_")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def _learn(self, words: Iterable[str]) -> None:
        """Contracts new words to ids and remembers them."""
        todo = []
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if raw in self.ranks:
                self.known[word] = np.int32(self.ranks[raw]).tobytes()
            else:
                todo.append((word, raw))
        short = [x for x in todo if len(x[1]) <= self.LONG]
        for at in range(0, len(short), self.words_per_query):
            self._contract(short[at : at + self.words_per_query], CONTRACT)
        long = [x for x in todo if len(x[1]) > self.LONG]
        while long:
            size = np.cumsum([len(x[1]) for x in long])
            n = max(1, int(np.searchsorted(size, 200_000)))
            self._contract(long[:n], CONTRACT_LONG)
            long = long[n:]

    def _contract(self, words: list[tuple[str, bytes]], query: str) -> None:
        lengths = np.array([len(raw) for _, raw in words])
        ids = self.byte_id[np.frombuffer(b"".join(raw for _, raw in words), np.uint8)]
        ends = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = np.arange(len(ids)) - np.repeat(ends - lengths, lengths)
        self.con.register("tokens", pa.table({"word": word, "pos": pos, "id": ids}))
        found = self.con.sql(query).to_arrow_table()
        self.con.unregister("tokens")
        of, ids = found.column("word").to_numpy(), found.column("id").to_numpy().astype("<i4")
        data, cuts = ids.tobytes(), (4 * np.searchsorted(of, np.arange(len(words) + 1))).tolist()
        for (name, _), a, b in zip(words, cuts, cuts[1:]):
            self.known[name] = data[a:b]

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Token ids of each text."""
        split = [pieces(t) for t in texts]
        fresh = set().union(*split) - self.known.keys()
        for word in fresh & self.older.keys():
            self.known[word] = self.older[word]
        self._learn(sorted(fresh - self.known.keys()))
        rows = [b"".join([self.known[w] for w in words]) for words in split]
        if len(self.known) > self.remembered:  # words not met again are forgotten and learnt anew
            self.known, self.older = {}, self.known
        offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in rows])))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4")))

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """Bytes of each list of ids, by ordered aggregation."""
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        out = [b""] * len(lengths)
        ends = np.cumsum(lengths)
        flat = pc.list_flatten(ids).to_numpy()
        at = 0
        while at < len(lengths):  # about a million ids a query
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000)))
            first = int(ends[at - 1]) if at else 0
            part = flat[first : ends[to - 1]]
            doc = np.repeat(np.arange(at, to, dtype=np.int32), lengths[at:to])
            self.con.register("ids", pa.table({"doc": doc, "pos": np.arange(len(part), dtype=np.int32), "id": part}))
            found = self.con.sql(DECODE).to_arrow_table()
            self.con.unregister("ids")
            for k, text in zip(found.column("doc").to_pylist(), found.column("decoded").to_pylist()):
                out[k] = text.encode("latin-1")
            at = to
        return out


@contextmanager
def _coder(ranks: dict[bytes, int], keep: str | None = None) -> Iterator[Coder]:
    """A task's coder. Its memory goes with the task, unless ``keep`` names it for the worker's next task."""
    kept = worker_cache("bpe")
    coder = kept.pop(keep, None) or Coder(ranks)
    try:
        yield coder
    finally:
        if keep:
            kept[keep] = coder
        else:
            coder.con.close()
            coder.known.clear()
            coder.older.clear()


def _shared(df: DataFrame, vocabulary: str):
    """The vocabulary as a broadcast (a few MB, fixed by the file)."""
    return df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", chunk_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with the token ids of ``text_col`` in ``ids_col`` (an input column of that name is replaced).

    Each task cuts its texts into pieces, contracts the distinct new pieces
    with one recursive DuckDB query a few ten thousand words and looks the
    rest up. Null text has no ids. No special tokens. Split by the Unicode
    tables of the ``regex`` package.
    """
    shared = _shared(docs, vocabulary)
    other = [c for c in docs.columns if c.lower() != ids_col.lower()]
    schema = docs.select(other).schema.add(ids_col, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _coder(shared.value) as coder:
            for part in row_chunks(batches, text_col, chunk_bytes):
                ids = coder.encode([t or "" for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, ids_col])

    return docs.select(other).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids in ``bytes_col`` (an input column of that name is replaced); null ids have none."""
    shared = _shared(df, vocabulary)
    other = [c for c in df.columns if c.lower() != bytes_col.lower()]
    schema = df.select(other).schema.add(bytes_col, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _coder(shared.value) as coder:
            for part in batches:
                raw = pa.array(coder.decode(part.column(ids_col)), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, raw], [*part.schema.names, bytes_col])

    return df.select(other).mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, keep: bool = False) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_text, decoded, same): encodes every text and decodes its ids again in the same task.

    ``keep``: words learnt by a task serve the worker's next one (more memory, less work).
    ``ids_text`` is the decimal ids joined by one blank, ``same`` whether the
    decoded bytes are those of the text. Null text counts as
    empty; repeated rows come out as often as they go in.
    """
    shared = _shared(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _coder(shared.value, vocabulary if keep else None) as coder:
            for part in row_chunks(batches, "text", chunk_bytes):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = coder.encode(texts)
                decoded = coder.decode(ids)
                decimal = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        ids,
                        pc.list_value_length(ids).cast(pa.int64()),
                        pc.binary_join(decimal, " "),
                        pa.array(decoded, pa.binary()),
                        pa.array([t.encode() == d for t, d in zip(texts, decoded)]),
                    ],
                    ["doc_id", "ids", "n_tokens", "ids_text", "decoded", "same"],
                )

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, ids_text string, decoded binary, same boolean")
