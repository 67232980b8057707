"""Labelled rows to learn from, and the split that keeps some aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import staged

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept aside: its id's checksum falls into fold 0. So are missing ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``d, t, y`` of about ``max_rows`` labelled documents (all if there are fewer) outside the fold kept aside.

    The choice goes by a hash of the id, and equal texts are taken once. A document with several
    labels counts as the higher one.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("d")).agg(F.max(label).cast("int").alias("y"))
    share = min(1.0, max_rows / max(1, known.count()))
    parts = 1 << 20
    known = known.where(F.pmod(F.xxhash64(F.lit(3), "d"), F.lit(parts)) < int(share * parts))
    rows = docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # the sample has about max_rows short rows, however large the tables are
    sample = rows.join(F.broadcast(known), "d").select("d", "t", "y")
    return staged(sample.dropDuplicates(["t"]), f"sample-{label}")  # copies are no further evidence
