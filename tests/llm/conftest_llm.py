import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score string, fp string, row string"


def as_docs(spark, rows, parts=3):
    """(doc_id, text) rows as documents, with more columns whose names clash with internal ones."""
    full = [(i, t, "en", f"src{k % 4}", len(t or ""), "k", "s", "f", "r") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def prose(rng, n, words=None):
    words = words or [f"{a}{b}" for a in ("the", "an", "wor", "li", "ga", "té") for b in ("ra", "st", "mo", "né", "ing")]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Null id, null and empty texts, repeated rows, equal texts, a long text, control characters."""
    rng = random.Random(5)
    base = prose(rng, 300)
    near = base.split(" ")
    near[10] = "changed"
    rows = [(i, prose(rng, rng.randrange(1, 120))) for i in range(40)]
    rows += [(100, base), (101, base), (102, " ".join(near)), (7, rows[7][1]), (103, None), (104, ""), (105, "\n\n \t"), (None, base)]
    rows += [(106, prose(rng, 30_000)), (107, "\x00a\x1fb ÀÉ \U0001f600 日本"), (108, "x"), (108, "x")]
    return rows


@pytest.fixture()
def hard_docs(spark, hard_rows):
    return as_docs(spark, hard_rows)


def key(row):
    return tuple((v is None, str(type(v)), v if not isinstance(v, (bytes, bytearray)) else bytes(v)) for v in row)


def same_rows(found, wanted):
    plain = lambda rows: sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows), key=key)
    assert plain(found) == plain(wanted)
