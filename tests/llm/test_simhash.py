import random

import numpy as np
import xxhash
from conftest_llm import as_docs, prose

from aerolith.llm import simhash


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    rows = [(i, slow_fingerprint(t)) for i, t in rows]
    known = [(i, f) for i, f in rows if i is not None]
    out = []
    for i, f in rows:
        seen, todo = {f}, [f]
        while todo:
            x = todo.pop()
            for _, g in known:
                if g not in seen and (x ^ g).bit_count() <= 4:
                    seen.add(g)
                    todo.append(g)
        out.append((i, f"{f:016x}", None if i is None else min(j for j, g in known if g in seen)))
    return out


def test_matches_brute_force(hard_docs, hard_rows, same_rows):
    same_rows(simhash.near_duplicates(hard_docs).collect(), slow_components(hard_rows))


def test_tree_with_overlapping_borders_finds_the_same(hard_docs, hard_rows, same_rows):
    found = simhash.near_duplicates(hard_docs, segments=1, shard_rows=4)
    same_rows(found.collect(), slow_components(hard_rows))


def test_shard_links_equal_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))) for b in rng.choice(base, 900)]
    fps = np.concatenate((base, np.array(flips, np.uint64)))
    small = simhash.shard_links(fps, 4, leaf=16)
    whole = simhash.shard_links(fps, 4, leaf=10_000)
    assert (small == whole).all()


def test_empty_table_and_one_of_each_group(spark, hard_docs, hard_rows):
    assert simhash.near_duplicates(hard_docs.limit(0)).collect() == []
    kept = simhash.keep_one(hard_docs)
    assert kept.columns == hard_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({c for i, _, c in slow_components(hard_rows) if i is not None})
    assert as_docs(spark, [(1, None), (2, "")]).count() == 2


def test_an_id_of_several_texts_keeps_those_of_its_own(spark):
    rng = random.Random(2)
    shared, lone, other = (prose(rng, 80) for _ in range(3))
    rows = [(5, shared), (3, shared), (5, lone), (5, lone), (9, other), (9, shared), (7, None), (None, shared), (8, "")]
    kept = simhash.keep_one(as_docs(spark, rows))
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(3, shared), (5, lone), (9, other), (7, None), (None, shared)], key=str)
