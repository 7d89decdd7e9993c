"""Registered queries against their DuckDB oracles, and the pipeline against a plain version of its stages."""

import base64
import hashlib
import re

import duckdb
import pytest
import tiktoken
import xxhash
from conftest_llm import SMALL
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from aerolith.llm import queries

TABLES = ("documents", "embeddings", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, duck, name, same_rows):
    found = queries.QUERIES[name](spark, SMALL)
    wanted = duck.sql(queries.ORACLE[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    order = found.columns
    place = [wanted.columns.index(c) for c in order]
    rows = [tuple(r[k] for k in place) for r in wanted.fetchall()]
    same_rows(found.collect(), rows)
    assert rows


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


# --- registered queries without SQL ----------------------------------------------------


def rows_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_registered_op4_like_brute_force(spark, same_rows):
    from test_paragraphs import slow_registered

    found = queries.QUERIES["op4_paragraph_dedup"](spark, SMALL).collect()
    wanted = [(i, n, gone, sources, sha(kept.encode())) for i, n, gone, sources, kept in slow_registered(rows_of(spark))]
    same_rows([(*r[:3], ",".join(map(str, r["sources"])), r["kept_sha256"]) for r in found], wanted)


def test_registered_op5_like_the_library(spark, same_rows):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = []
    for i, t in rows_of(spark):
        ids = library.encode_ordinary(t or "")
        wanted.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    same_rows(queries.QUERIES["op5_byte_bpe"](spark, SMALL).collect(), wanted)


def test_registered_op10_like_brute_force(spark, same_rows):
    from test_simhash import slow_components

    same_rows(queries.QUERIES["op10_simhash"](spark, SMALL).collect(), slow_components(rows_of(spark)))


# --- pipeline -----------------------------------------------------------------------

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_fingerprint(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows):
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    keep, seen = set(), set()
    for i, f in sorted(fps):
        if i in seen:
            continue
        keep.add(i)
        todo = [f]
        seen.add(i)
        while todo:
            x = todo.pop()
            for j, g in fps:
                if j not in seen and (x ^ g).bit_count() <= 4:
                    seen.add(j)
                    todo.append(g)
    return keep


def hits(text, windows):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))


def test_pipeline_stages_one_by_one(spark):
    import public_tokenizers

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [(9001, "", "en", "s", 0), (9002, None, "en", "s", 0), (9003, "1234 5678", "en", "s", 9)]
    secret = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    extra += [(9004, f"the and of in a quiet place token = {secret} was left", "en", "only", 60)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    stage = dict(corpus_pipeline.STAGES)

    named = stage["language_id"](spark, docs, SMALL)
    rows = named.collect()
    assert named.columns == docs.columns
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()} - {9001, 9002, 9003}

    single = stage["simhash_near_dedup"](spark, named, SMALL)
    assert {r["doc_id"] for r in single.collect()} == plain_groups(rows)

    clean = stage["benchmark_decontamination"](spark, single, SMALL)
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", r["text"].translate(LOWER))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    after = {r["doc_id"]: r for r in clean.collect()}
    assert not any(hits(r["text"], windows) for r in after.values())
    for i, text in before.items():
        if not hits(text, windows):
            assert after[i]["text"] == text
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())

    masked = stage["secret_scan"](spark, clean, SMALL)
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert set(text) == set(after) and masked.columns == docs.columns
    assert secret not in text[9004] and "[SECRET]" in text[9004]
    assert all(t == after[i]["text"] or "[SECRET]" in t for i, t in text.items())

    coded = stage["byte_level_bpe"](spark, masked, SMALL).collect()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r["doc_id"]: r["ids"] for r in coded} == {i: library.encode_ordinary(t) for i, t in text.items()}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in coded)


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.where(~F.col("round_trip")).count() == 0
    assert 0 < found.count() <= spark.read.parquet(f"{SMALL}/documents.parquet").count()
