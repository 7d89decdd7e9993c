import random

import numpy as np
import pytest
from conftest_llm import as_docs

from aerolith.llm import repeats


def slow(rows, length=50):
    first, out = {}, []
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - length + 1) if i is not None else ():
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1) if i is not None else ():
            if first[b[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("pack,bucket,hot", [(4 << 20, 8 << 20, 64), (3000, 2000, 64), (1000, 2000, 1)])
def test_matches_brute_force(spark, hard_rows, same_rows, pack, bucket, hot):
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(4)]
    pick = lambda: rng.choice([rng.choice(parts), rng.choice("xyzé") * rng.randrange(80), parts[0][5:58]])
    rows = [(i, "".join(pick() for _ in range(rng.randrange(6)))) for i in range(120)]
    rows += [(None, parts[0]), (5, parts[1]), (5, parts[1]), (300, None), (301, ""), (302, "a" * 5000), (303, "a" * 7000 + "b")]
    rows += hard_rows
    found = repeats.remove_repeats(as_docs(spark, rows), pack_bytes=pack, bucket_bytes=bucket, hot_packs=hot).collect()
    same_rows(found, slow(rows))


def test_short_texts_alone(spark, same_rows):
    rows = [(1, "short"), (2, "short"), (3, None)]
    same_rows(repeats.remove_repeats(as_docs(spark, rows)).collect(), slow(rows))


def test_other_length_and_empty_table(spark, same_rows):
    rows = [(1, "0123456789abcdefghij"), (2, "xx0123456789abcdefghijyy"), (3, "9abcdefghij0123456789")]
    same_rows(repeats.remove_repeats(as_docs(spark, rows), length=16).collect(), slow(rows, 16))
    assert repeats.remove_repeats(as_docs(spark, rows).limit(0)).collect() == []
    with pytest.raises(ValueError):
        repeats.Shards(8, 4)


def test_smaller_positions():
    rng = np.random.default_rng(1)
    for _ in range(300):
        value = rng.integers(0, 6, rng.integers(1, 30))
        head = np.zeros(len(value), int)
        for c in np.sort(rng.integers(0, len(value), 3)).tolist():
            head[c:] = c
        wanted = [max((j for j in range(head[i], i) if value[j] < value[i]), default=-1) for i in range(len(value))]
        assert repeats.previous_smaller(value, head).tolist() == wanted


def test_a_common_line_fills_no_one_shard():
    """Texts around one line of 30 bytes: dealt by the line's piece alone they meet in one bucket, by more keys in many."""
    rng = random.Random(4)
    shards = repeats.Shards(50, 64)
    line = b"this line stands in every text"
    word = lambda n: bytes(rng.choice(b"abcdefghij") for _ in range(n))
    texts = [word(40) + line + word(40) for _ in range(300)]
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([110] * 300)
    doc, first, last, bucket, _ = shards.runs(data, sizes, np.zeros(300, bool))
    _, hot = max((np.count_nonzero(bucket == b), b) for b in set(bucket.tolist()))
    mine = bucket == hot
    run, a, b, dealt = shards.split(shards.pieces(data), first[mine], last[mine])
    assert np.bincount(dealt, minlength=64).max() < 0.1 * len(dealt)
    size = lambda x, y: int((y - x + 1).sum())
    assert size(a, b) == size(first[mine], last[mine])
