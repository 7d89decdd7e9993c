import random
import re

import numpy as np
import pytest
from conftest_llm import as_docs, prose

from aerolith.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    out = []
    for i, text in rows:
        w = words(text)
        hit, met = [False] * len(w), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if (found := wins.get(tuple(w[k : k + size]))) is not None:
                    met |= found
                    hit[k : k + size] = [True] * size
        out.append((i, len(w), sum(hit), sorted(met)))
    return out


@pytest.fixture()
def case(spark, hard_rows):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.choice([3, 9, 10, 11, 40]))) for k in range(12)] + [(50, None), (51, ""), (None, prose(rng, 12)), (3, prose(rng, 15))]
    items += [(60, "Aa, bb! aa BB aa bb aa bb aa bb aa bb aa bb")]
    rows = hard_rows + [(200 + k, f"{prose(rng, 20)}. {t}\n{prose(rng, 20)}") for k, (_, t) in enumerate(items)]
    rows += [(300, "aa bb " * 3000), (301, items[3][1].upper().replace(" ", "--"))]
    return rows, items, spark.createDataFrame(items, "item_id long, text string")


def test_hits_match_brute_force(spark, case, same_rows):
    rows, items, bench = case
    for shard in (1 << 22, 2000):
        found = d.find_overlaps(as_docs(spark, rows), bench, shard_bytes=shard).collect()
        same_rows([(*r[:3], ",".join(r[3])) for r in found], [(*r[:3], ",".join(r[3])) for r in slow(rows, items)])


def test_removal_leaves_no_hit_and_clean_texts_alone(spark, case):
    rows, items, bench = case
    docs = as_docs(spark, rows)
    clean = d.remove_overlaps(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    out = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert all(hit == 0 for _, _, hit, _ in slow(out, items))
    hits = {i for i, _, hit, _ in slow(rows, items) if hit}
    assert sorted((i, t or "") for i, t in out if i is not None and i not in hits) == sorted((i, t or "") for i, t in rows if i is not None and i not in hits)


def test_empty_tables(spark, case):
    rows, _, bench = case
    docs = as_docs(spark, rows[:5])
    assert d.find_overlaps(docs.limit(0), bench).collect() == []
    assert d.find_overlaps(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_a_benchmark_in_lots_finds_and_removes_the_same(spark, case, same_rows):
    rows, items, bench = case
    docs = as_docs(spark, rows)
    assert len(d.phrase_lots(bench, "item_id", "text", 10, 200)) > 2
    found = d.find_overlaps(docs, bench, most_bytes=200)
    assert found.columns == ["doc_id", "n_words", "n_hit", "item_ids"]
    same_rows([(*r[:3], ",".join(r[3])) for r in found.collect()], [(*r[:3], ",".join(r[3])) for r in slow(rows, items)])
    clean = d.remove_overlaps(docs, bench, most_bytes=200)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert all(hit == 0 for _, _, hit, _ in slow([(r["doc_id"], r["text"]) for r in clean.collect()], items))


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 4, 500)
    index = d.FMIndex(text)
    phrases = rng.integers(1, 5, (200, 3))
    which, at = index.search(phrases)
    found = sorted(zip(which.tolist(), at.tolist()))
    assert found == sorted((p, k) for p in range(200) for k in range(498) if (text[k : k + 3] == phrases[p]).all())
