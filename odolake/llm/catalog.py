"""The queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.llm import (
    best_fit_packing, centroids, decontamination, exact_dedup, html_extraction, line_dedup, merkle, ngram_join,
    quality_classifier, quality_rules, sharding, token_files, toxicity,
)
from odolake.llm.common import table
from odolake.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text of every document, with what went and where it stood first."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "text", "n_lines", "n_removed", F.array_join(
        F.transform("sources", lambda x: x.cast("string")), ",").alias("sources"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return best_fit_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_classifier.score(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "copy_of", "n_copies")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontamination.contained(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files.read(spark, token_files.write(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row verified against the manifest; of a fifth of the ids the text comes back in lower case."""
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(altered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return merkle.prove(docs, found={"text": text})


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), hash_all=True)


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_line_dedup, op3_toxicity, op4_html_extraction, op5_quality_rules, op6_best_fit_packing,
    op7_quality_classifier, op8_ngram_join, op9_decontamination, op10_token_files, op11_centroids,
    op12_merkle_manifest, op13_exact_dedup,
)}
