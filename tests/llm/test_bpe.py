import random

import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

from aerolith.llm import bpe
from aerolith.llm.queries import vocabulary_path

RANKS = bpe.read_ranks(vocabulary_path())
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = regex.compile(public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\x0b\x1c\x85\xa0''strelvmdST1a½éx.,! 日"), max_size=40))
def test_pieces_match_the_pattern(text):
    assert bpe.pieces(text) == SPLIT.findall(text)


def test_words_of_any_length_match_the_library():
    rng = random.Random(4)
    texts = ["", " ", "the cat's", "a" * 700, "abcab" * 60, " " * 90 + "x", "=" * 200 + "-" * 77]
    texts += ["".join(rng.choice(a) for _ in range(rng.randrange(1, 160))) for a in ("ab", "the", "inga", "estr", "aeiouth", "日本é") for _ in range(25)]
    coder = bpe.Coder(RANKS, words_per_query=50, remembered=20)
    for _ in range(2):
        ids = coder.encode(texts)
        assert ids.to_pylist() == [TIKTOKEN.encode_ordinary(t) for t in texts]
        back = coder.decode(ids)
        assert back == [t.encode() for t in texts]
    assert coder.decode(pa.array([[], *ids.to_pylist()], pa.list_(pa.int32()))) == [b"", *back]


def test_decoding_goes_by_the_ids_alone():
    coder = bpe.Coder(RANKS)
    ids = [[RANKS[b"a"], RANKS[b" the"], RANKS[bytes([0xC3])], RANKS[bytes([0xA9])]], [], [RANKS[b"the"]] * 3]
    assert coder.decode(pa.array(ids, pa.list_(pa.int32()))) == ["a theé".encode(), b"", b"thethethe"]


def test_hard_texts_round_trip(hard_docs, hard_rows, same_rows):
    found = bpe.round_trip(hard_docs, vocabulary_path()).select("doc_id", "n_tokens", "ids_text", "decoded").collect()
    ids = [TIKTOKEN.encode_ordinary(t or "") for _, t in hard_rows]
    same_rows(found, [(i, len(x), " ".join(map(str, x)), (t or "").encode()) for (i, t), x in zip(hard_rows, ids)])


def test_encode_and_decode_columns(hard_docs):
    coded = bpe.encode(hard_docs.withColumnRenamed("row", "ids"), vocabulary_path())
    back = bpe.decode(coded, vocabulary_path())
    assert back.where("decoded <> cast(coalesce(text, '') AS binary)").count() == 0
    assert back.columns == [*[c for c in hard_docs.columns if c != "row"], "ids", "decoded"]
    assert bpe.round_trip(hard_docs.limit(0), vocabulary_path()).collect() == []
