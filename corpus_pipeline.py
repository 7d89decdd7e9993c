"""A corpus pipeline over ``documents``: each stage calls one operator of ``aerolith.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith.llm import bpe, decontaminate, langid, secrets, simhash
from aerolith.llm.common import saved, table
from aerolith.llm.queries import vocabulary_path

MIN_LANGUAGE_SCORE = 0.1  # below it a text resembles no language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    profiles = langid.fit(docs.where(~langid.held_out()))
    lang, score = "_lang_pred", "_lang_score"
    found = langid.identify(docs, profiles, lang_col=lang, score_col=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id."""
    return simhash.keep_one(docs).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document with no text left goes."""
    clean = decontaminate.remove_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return _counted(clean).where(F.col("text").rlike(r"\S"))


def secret_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; every document stays."""
    return _counted(secrets.redact_live(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    coded = bpe.round_trip(docs, vocabulary_path())
    return coded.select("doc_id", "ids", "n_tokens", F.col("same").alias("round_trip"))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secret_values),
    ("byte_level_bpe", tokens),
]

# No stage's method has a SQL form as a whole (profiles, SimHash, BPE); tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
