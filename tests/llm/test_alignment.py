import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from aerolith.llm import alignment
from aerolith.llm.queries import QUERIES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = alignment.byte_level(A_PATH), alignment.sentence_piece(B_PATH)


def token_bytes():
    """Per-character decoding of both vocabularies, apart from the library's tables."""
    tok, sp = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    tok.encode_special_tokens = True
    odd, code = {}, 256
    for byte in range(256):
        if chr(byte).isprintable() and not chr(byte).isspace() and byte != 0xAD:
            odd[chr(byte)] = byte
        else:
            odd[chr(code)] = byte
            code += 1

    def a(text):
        return [(i, bytes(odd[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]

    def b(text):
        out = []
        for i in sp.encode(text):
            p = sp.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
        return out

    return a, b


ENCODE_A, ENCODE_B = token_bytes()


def one_text(text):
    """(a ids, b ids, links, groups) by a token-by-token walk over all pairs."""
    a, b = (ENCODE_A(text), ENCODE_B(text)) if text else ([], [])
    want = b" " + (text or "").encode()
    if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return [], [], [], ""
    spans = lambda side: [(i, sum(len(x) for _, x in side[:k]), sum(len(x) for _, x in side[: k + 1])) for k, (i, _) in enumerate(side)]
    sa, sb = spans(a), spans(b)
    links = [(i, j) for i, p, q in sa for j, r, s in sb if p < s and r < q]
    ends = sorted({q for _, _, q in sa} & {s for _, _, s in sb})
    groups, start = [], 0
    for e in ends:
        groups.append(",".join(str(i) for i, p, q in sa if p >= start and q <= e) + "|" + ",".join(str(j) for j, r, s in sb if r >= start and s <= e))
        start = e
    return [i for i, _ in a], [j for j, _ in b], links, ";".join(groups)


def brute(rows):
    found = [one_text(t) for _, t in rows]
    counts = Counter(p for _, _, links, _ in found for p in set(links))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    return [
        (d, len(a), len(b), groups.count(";") + bool(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), groups)
        for (d, _), (a, b, links, groups) in zip(rows, found)
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), unique=True), st.lists(st.integers(1, 60), unique=True), st.integers(1, 9))
def test_pieces_of_any_size_give_the_walk(a, b, step):
    a, b = (np.array(sorted({*x, 61})) for x in (a, b))
    parts = list(alignment.overlaps(a, b, step))
    assert all(len(p[0]) <= step for p in parts) and len(parts) == -(-(len(a) + len(b)) // step)
    start = lambda x: [0, *x[:-1].tolist()]
    links = {(i, j) for i in range(len(a)) for j in range(len(b)) if start(a)[i] < b[j] and start(b)[j] < a[i]}
    found = [(i, j) for p in parts for i, j in zip(p[0].tolist(), p[1].tolist())]
    assert len(found) == len(links) and set(found) == links
    cuts = [(i, j) for p in parts for i, j in zip(p[2].tolist(), p[3].tolist())]
    assert cuts == [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]


HARD = [
    "the cat's  hat", "<|endoftext|> and <s></s> <unk>", "a▁b", "日本語 été \U0001f600!", " lead", "trail ", "\n\n\t x", "x", "", None, "\x00\x01", "a" * 300, " " * 40, " 　", "é ﬁ",
]


@pytest.mark.parametrize("lot_bytes", [1, 300, 1 << 20])
def test_like_brute_force(spark, same_rows, lot_bytes):
    from conftest_llm import as_docs, prose

    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100 + i, prose(rng, rng.randrange(1, 30))) for i in range(30)]
    rows += [(None, "the cat's  hat"), (3, "again"), (3, "again")]
    same_rows(alignment.align(as_docs(spark, rows), A, B, lot_bytes=lot_bytes).collect(), brute(rows))


def test_long_and_repeated_texts_and_small_runs(spark, hard_docs, hard_rows):
    found = alignment.align(hard_docs, A, B, lot_bytes=4000).collect()
    assert len(found) == len(hard_rows)
    for row in found:
        if row["groups"]:
            sides = [g.split("|") for g in row["groups"].split(";")]
            assert len(sides) == row["n_groups"]
            assert sum(len(x.split(",")) for x, _ in sides) == row["n_a"] and sum(len(y.split(",")) for _, y in sides) == row["n_b"]
    texts = [t for d, t in hard_rows if d in (100, 106)]
    one, two = A.load(), B.load()
    writer = alignment.GroupTexts(60_000)
    whole, small = (list(alignment.align_lot(texts, one, two, writer, run_tokens=n)) for n in (1 << 20, 10))
    assert [g for _, gs in whole[1:] for g in gs.to_pylist()] == [g for _, gs in small[1:] for g in gs.to_pylist()] == [one_text(texts[0])[3], whole[1][1][1].as_py()]


def test_no_rows_and_registered_query(spark, hard_docs):
    assert alignment.align(hard_docs.limit(0), A, B).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = [(r["doc_id"], r["text"]) for r in docs.where("length(text) < 300").collect()]
    whole = {r["doc_id"]: r for r in QUERIES["op11_cross_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert len(whole) == docs.count() and sum(len(r["groups_sha256"]) == 64 for r in whole.values()) > 0
    for d, t in short:
        a, b, links, groups = one_text(t)
        r = whole[d]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), groups.count(";") + bool(groups), len(links))
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
