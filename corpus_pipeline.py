"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from odolake.llm import best_fit_packing, decontamination, line_dedup, ngram_join, quality_rules
from odolake.llm.common import staged, table

ORACLE_SQL = None  # the near-duplicate join and the packing have no SQL; tests compare with brute force


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier."""
    return line_dedup.without_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return best_fit_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules), ("line_dedup", lines), ("ngram_join", near), ("decontamination", leaks),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet that the next one reads.

    Documents with a missing or empty text, or of few words, go in the first stage. Repeated rows and equal texts are
    one group of near copies, of which one document stays; ties go by the id. Very long documents are
    read whole and cut into pieces at the end. An empty table gives no piece. Further columns of ``documents``
    travel along up to the last stage and have no influence.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
