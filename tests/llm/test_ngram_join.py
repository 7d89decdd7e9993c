import random

import pytest
from conftest_llm import as_docs, prose

from aerolith.llm import ngram_join


def brute(rows, shingle=5, percent=80):
    """Every pair of rows compared by its shingle strings."""
    sets = []
    for _, text in rows:
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        k = min(shingle, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    usable = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for i in usable:
        for j in usable:
            if j < i:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    least = {}
    for i in usable:
        least[find(i)] = min(rows[i][0], least.get(find(i), rows[i][0]))
    return [(d, len(sets[i]), None if d is None else least[find(i)] if i in set(usable) else d) for i, (d, _) in enumerate(rows)]


def changed(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [f"new{rng.randrange(999)}"]
    return " ".join(words)


def near_rows(rng, n=150):
    """Families around the threshold: chains of small changes, a passage and a line that many unrelated texts share."""
    rows, passage, line = [], prose(rng, 60), prose(rng, 8)
    bases = [prose(rng, rng.randrange(3, 200)) for _ in range(8)]
    for i in range(n):
        kind = rng.randrange(5)
        if kind < 3:
            b = rng.randrange(len(bases))
            text = changed(rng, bases[b], rng.randrange(0, 5))
            if kind == 0:
                bases[b] = text
        elif kind == 3:
            text = f"{prose(rng, rng.randrange(1, 40))} {passage}"
        else:
            text = f"{line} {prose(rng, rng.randrange(0, 9))} {line}"
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_like_all_pairs(spark, same_rows, seed):
    rng = random.Random(seed)
    rows = near_rows(rng)
    found = ngram_join.similar_documents(as_docs(spark, rows), bits=(24, 12, 6)[seed - 1], broadcast_rows=(1000, 0, 0)[seed - 1])
    same_rows(found.collect(), brute(rows))


def test_hard_texts(hard_docs, hard_rows, same_rows):
    same_rows(ngram_join.similar_documents(hard_docs).collect(), brute(hard_rows))


def test_no_rows(hard_docs):
    assert ngram_join.similar_documents(hard_docs.limit(0)).collect() == []


def test_one_id_of_several_texts_and_other_thresholds(spark, same_rows):
    rng = random.Random(9)
    rows = near_rows(rng, 60)
    rows += [(3, rows[10][1]), (11, rows[10][1]), (3, prose(rng, 30))]
    for shingle, percent in ((5, 80), (2, 55), (1, 100)):
        found = ngram_join.similar_documents(as_docs(spark, rows), shingle=shingle, percent=percent)
        same_rows(found.collect(), brute(rows, shingle, percent))


def test_linked_sets_always_meet():
    """The bound that the candidates rest on, over all sizes of small sets and all places of their first common token."""
    for percent in (50, 80, 95, 100):
        bounds = ngram_join.Bounds(percent)
        for a in range(1, 25):
            for b in range(a, 25):
                for common in range(1, a + 1):
                    if 100 * common >= percent * (a + b - common):
                        for i in range(a - common + 1):  # tokens of either set before the first common one
                            for j in range(b - common + 1):
                                assert i < bounds.prefix(a) and j < bounds.prefix(b)
                                assert percent * (a + b) <= (100 + percent) * min(a - i, b - j)


def test_levels_tell_frequent_tokens(spark):
    rng = random.Random(6)
    passage = prose(rng, 30)
    words = [f"w{k}" for k in range(5000)]
    rows = [(k, f"{prose(rng, 40, words)} {passage if k % 2 else ''}") for k in range(200)]
    levels = ngram_join.token_levels(as_docs(spark, rows).select("text"), 5, 16, pieces=4, salts=2)
    level = lambda text: levels[ngram_join._counter(ngram_join.shingle_set(text.encode()), 16)]
    assert levels.shape == (1 << 16,) and level(passage).min() > 40
    assert (level(rows[0][1]) == 0).mean() > 0.9
