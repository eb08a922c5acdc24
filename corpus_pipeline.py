"""The corpus pipeline: stages over the documents table, each a DataFrame in and out.

Language identification sets ``lang`` and lets documents without a language go;
near-dedup keeps one document of each group; decontamination lets documents go
that hold a window of a benchmark item; secret scans redact; the last stage
encodes. Each stage works on all rows that the one before kept, and every stage
but the last returns the columns it was given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalendria.llm import decontamination, language_id, near_copies, secrets, sentencepiece_codec
from kalendria.llm.support import staged
from kalendria.session import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.keep_identified(docs, language_id.fit_languages(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_copies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return sentencepiece_codec.encode_pieces(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode),
]

#: SQL can express neither the fitted model nor the automaton; tests hold a run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs
