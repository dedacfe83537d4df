"""From raw documents to training sequences: five stages over the table ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certiscope.llm import language, minhash, mixing, packing, pii
from certiscope.session import stored

TOKENIZER = "word_bpe_49k.json"
NEAR_PERCENT = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets lang to the language found in the text; documents without one go.

    The model learns from the documents that carry a language.
    """
    docs = docs.select(*COLUMNS)
    model = language.train(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")))
    found = language.predict(docs, model, list(COLUMNS)).where(F.col("lang_pred") != language.UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    docs = docs.select(*COLUMNS)
    gone = minhash.near_duplicates(docs, NEAR_PERCENT).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind; n_chars follows the text."""
    found = pii.find_spans(docs.select(*COLUMNS), out="pii_spans")
    clean = found.withColumn("text", pii.redacted(F.col("text"), F.col("pii_spans")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come closer to equal shares."""
    docs = docs.select(*COLUMNS)
    drawn = mixing.mix(docs).where("sampled").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mixing", sample_mixture),
    ("mixture_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language model and the token ids are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None
