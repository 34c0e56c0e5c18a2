"""A corpus pipeline over ``documents``: each stage reads what the one before it has written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gritstone.llm import bpe, copies, decontamination, language, secrets
from gritstone.llm.store import stored

VOCABULARY = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; ``lang`` becomes the language found."""
    return language.accepted_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return copies.one_of_each_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked, and ``n_chars`` follows."""
    return secrets.without_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, the token ids and their number, and the text that they decode to."""
    return bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("bpe", tokenize),
]

#: Trained likelihoods, components and byte-pair merges have no SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
