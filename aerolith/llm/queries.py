"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith.llm import alignment, bpe, chat, decontaminate, langid, licenses, ngram_join, paragraphs, repeats, secrets, simhash, topk, whitening
from aerolith.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    where = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["template"].cast("string"), m["first_word"].cast("string")))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return found.select("doc_id", "n_matches", "licenses", best.alias("containment"), F.array_join(F.array_sort(where), ",").alias("matches"), "best_licenses")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = paragraphs.remove_repeated_paragraphs(table(spark, sf_dir, "documents"), min_words=1)
    return clean.select("doc_id", "n_paragraphs", "n_removed", "sources", F.sha2("kept", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path(), keep=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe_rows(spark))
    plain = rows.withColumn("content", chat.text_parts(F.col("text")))
    made = chat.read_back(chat.format_chats(plain))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    formatted = made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    # the same turns as content of several parts, with attachments
    rich = chat.format_chats(rows.withColumn("content", chat.illustrated_parts(F.col("text")))).select(
        F.col("conv_id").alias("of"), F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens",
        F.array_join(F.transform("attachments", lambda a: F.concat_ws(":", a["type"], a["ref"])), ",").alias("attachment_refs"),
        F.length("formatted").cast("long").alias("illustrated_chars"),
    )
    return formatted.join(rich, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.fit(docs.where(~langid.held_out()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), langid.held_out().alias("held_out"), "text")
    return langid.identify(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = alignment.byte_level(vocabulary_path(BYTE_TOKENIZER)), alignment.sentence_piece(vocabulary_path(PIECE_TOKENIZER))
    found = alignment.align(table(spark, sf_dir, "documents"), a, b, keep_groups=lambda g: F.when(g == "", g).otherwise(F.sha2(g, 256)))
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("*", F.posexplode("whitened").alias("k", "value"))
    return each.select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"),
        F.col("value").alias("whitened"), F.get("explained", F.col("k")).alias("explained"), "identity_error",
    )


ORACLE_OP9 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, list_slice(w, i, i + least(len(w), 10) - 1) AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item_words WHERE len(w) > 0)),
starts AS (
  SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
  FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
met AS (
  SELECT s.doc_id, s.i, s.size, x.item_id
  FROM (SELECT doc_id, i, size, list_slice(w, i, i + size - 1) AS phrase FROM starts) s JOIN windows x ON x.phrase = s.phrase),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM met) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_OP8 = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, k, substring(h, 2 * k + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 49))) AS k FROM raw)),
later AS (
  SELECT doc_id, k FROM windows JOIN (SELECT s, min(doc_id) AS first FROM windows GROUP BY s) USING (s) WHERE first < doc_id),
marked AS (
  SELECT doc_id, k, coalesce(k > lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 50, true) AS new FROM later),
numbered AS (
  SELECT doc_id, k, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY k) AS span FROM marked),
spans AS (SELECT doc_id, span, min(k) AS a, max(k) + 50 AS z FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
  UNION ALL SELECT doc_id, max(z), 1000000000 FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a, z) AS h FROM gaps JOIN raw USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, (len(raw.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, raw.h))) AS kept_sha256
FROM raw LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_topk": op3_topk,
    "op4_paragraph_dedup": op4_paragraph_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_chat_format": op6_chat_format,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE = {
    "op1_license_scan": licenses.oracle(),
    "op2_secret_scan": secrets.oracle(),
    "op3_topk": topk.ORACLE,
    "op6_chat_format": chat.oracle(),
    "op8_suffix_dedup": ORACLE_OP8,
    "op9_decontamination": ORACLE_OP9,
    "op12_ngram_jaccard": ngram_join.ORACLE,
}
