from collections import Counter

from pyspark.sql import functions as F

from aerolith.llm import langid
from aerolith.llm.queries import op7_language_id


def slow_ranks(text, top):
    low = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
    word = "".join(c if o.isalpha() else " " for c, o in zip(low, text or "")).split()
    grams = Counter()
    for w in word:
        padded = " " + w + " "
        for n in (1, 2, 3):
            grams.update(padded[k : k + n] for k in range(len(padded) - n + 1) if padded[k : k + n] != " ")
    code = lambda g: [1 if c == " " else ord(c) + 1 for c in g] + [0] * (3 - len(g))
    return sorted(grams, key=lambda g: (-grams[g], code(g)))[:top]


def pack(gram):
    c = [1 if x == " " else ord(x) + 1 for x in gram] + [0] * (3 - len(gram))
    return c[0] << 42 | c[1] << 21 | c[2]


def test_ranked_grams_match_brute_force(hard_rows):
    texts = [t for _, t in hard_rows]
    doc, gram, rank, _ = langid.ranked_grams(texts, 50)
    for k, text in enumerate(texts):
        assert [g for d, g in zip(doc, gram) if d == k] == [pack(g) for g in slow_ranks(text, 50)]
    assert (rank < 50).all()


def test_out_of_place_distance_matches_brute_force():
    texts = ["the cat and the dog", "le chat et le chien", None, "123", "the"]
    profiles = {n: [pack(g) for g in slow_ranks(t, 40)] for n, t in (("en", "the cat sat on the mat and ran"), ("fr", "le chat est sur la table"))}
    far, has = langid.distances(texts, profiles, 40)
    for t, row, h in zip(texts, far, has):
        mine = slow_ranks(t, 40)
        assert h == bool(mine)
        for name, d in zip(sorted(profiles), row):
            place = {g: k for k, g in enumerate(profiles[name])}
            total = sum(abs(place[pack(g)] - k) if pack(g) in place else 40 for k, g in enumerate(mine))
            assert abs(d - total / max(1, len(mine) * 40)) < 1e-12


def test_held_out_accuracy(spark):
    found = op7_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()
    assert rows[0] > 0.97
    assert found.where("score < 0 OR score > 1").count() == 0


def test_hard_texts_and_empty_table(hard_docs):
    profiles = langid.fit(hard_docs)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(hard_docs, profiles).collect()}
    assert found[103] == found[104] == found[105] == ("und", 0.0)
    assert found[100] == found[101] and found[100][0] == "en"
    assert langid.fit(hard_docs.limit(0)) == {}
    assert langid.identify(hard_docs, {}).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(hard_docs, profiles).count() == hard_docs.count()
