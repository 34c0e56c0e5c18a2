"""The queries of this subpackage, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gritstone.llm import (
    bpe, decontamination, fim, htmltext, language, licenses, neighbours, paragraphs, secrets, sharding, simhash, substrings, whitening)

VOCABULARY = "word_bpe_49k.json"
SHARDS = 16
SEED = 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_hypergeometric_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.hypergeometric_shuffle(docs, SHARDS, SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents").select("doc_id", "text")).drop("kept")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text")))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.of_documents(table(spark, folder, "documents")).drop("key")


def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    return language.of_pages(table(spark, folder, "pages"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = htmltext.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, folder, "documents")).drop("row")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY)))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(table(spark, folder, "embeddings").select("vec_id", "embedding"), "vec_id")


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents").select("doc_id", "text"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, folder, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hypergeometric_sharding": op1_hypergeometric_sharding,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_language_id": op4_language_id,
    "page_languages": page_languages,
    "op5_html_extraction": op5_html_extraction,
    "op6_paragraph_dedup": op6_paragraph_dedup,
    "op7_simhash": op7_simhash,
    "op8_neighbours": op8_neighbours,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_license_scan": op12_license_scan,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES: dict[str, str] = {
    "op9_decontamination": decontamination.ORACLE_SQL,
    "op12_license_scan": licenses.ORACLE_SQL,
    "op13_fill_in_middle": fim.ORACLE_SQL,
}
