"""The operators of this package as queries over the given tables, with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certiscope.llm import (chat, collocations, fingerprint, language, lexical_search, line_dedup, minhash, mixing, packing, pii, quality, token_count,
                            url_filter)

PACK_TOKENIZER = "word_bpe_49k.json"
COUNT_MODEL = "piece_bpe_32k.model"
#: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(_table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    counts = [pii.count_of("spans", kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_MODEL))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), threshold=10, top=2000)


def line_dedup_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_minhash_near_dedup": near_dedup,
    "op2_url_filter_cascade": url_verdicts,
    "op3_multiset_fingerprint": fingerprints,
    "op4_mixture_packing": packed,
    "op5_language_id": language_id,
    "op6_source_mixing": mixed,
    "op7_chat_perspectives": chat_perspectives,
    "op8_personal_data": personal_data,
    "op9_quality_outliers": quality_outliers,
    "op10_unigram_token_count": unigram_counts,
    "op11_collocations": phrase_collocations,
    "op12_line_dedup": line_dedup_digest,
    "op13_lexical_search": lexical_ranking,
}
