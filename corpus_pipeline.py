"""The corpus pipeline: five operators in a row, each working on all that the one before kept.

Every stage is (spark, docs, sf_dir) -> DataFrame; run() writes each one's result as Parquet into the
shared folder of the session and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.decontam import decontaminate
from sedimenta.llm.near_dedup import deduplicate
from sedimenta.llm.pii import replace_entities
from sedimenta.llm.sp_sampling import sample_encodings
from sedimenta.llm.store import Scratch, temporary
from sedimenta.llm.toxicity import reject_toxic

#: Key of the surrogates; a real run passes its own secret.
PII_KEY = "corpus-pipeline"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    Null and empty texts have no hits and stay; repeated rows are judged alike; an empty table stays empty;
    without labels of both classes a base lexicon decides.
    """
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity of 0.8 or more) one document stays, that of the least id.

    Null, empty and blank texts are copies of nothing and stay, as do rows without an id; of repeated rows one stays.
    """
    return deduplicate(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null and empty texts contain nothing and stay; null and empty items are in nothing; an empty benchmark
    or table changes nothing; repeated rows are judged alike.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; n_chars is that of the new text.

    Null texts stay null with their n_chars, empty ones stay empty; repeated rows are changed alike.
    """
    out = replace_entities(docs, PII_KEY)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each text, as piece ids with their inclusion scores, and the text that the ids decode to.

    A row for each document and sample, of the columns doc_id, sample, n_tokens, log_prob, inclusion, ids and
    text; lang, source and n_chars end here. Null and empty texts have one sample without ids; repeated rows
    have equal samples; an empty table gives an empty result.
    """
    return sample_encodings(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, decode_to="text")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. What a stage wrote on its way is deleted once its result is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before = docs
        with temporary(spark):
            docs = scratch.save(stage(spark, docs, sf_dir))
        if hasattr(before, "_scratch_path"):
            scratch.drop(before)
    return docs
