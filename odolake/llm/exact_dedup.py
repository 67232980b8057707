"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then the whole text.

Each step reads more of a text and looks only at what the step before left together:

1. Lengths in bytes are counted; a text whose length nobody shares has no copy.
2. Among the others, pairs of length and hash of the first ``PREFIX`` characters are counted.
3. Only the texts of pairs met more than once are hashed whole (SHA-256), and groups are formed
   by length and that hash.

Counts are combined before they are shuffled, so a text that a third of the rows share is one
row per task. Steps 1 and 2 move numbers only. In step 3 the pairs find their texts by a join that
Catalyst broadcasts while the pairs are few; beyond that it shuffles by the pair, and the adaptive
skew join splits the rows of a hot one. Groups of one never enter the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import hidden, once, staged

PREFIX = 64  # characters


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _size(text: str) -> Column:
    return F.octet_length(_text(text)).cast("bigint")


def _beginning(text: str, prefix: int) -> Column:
    return F.xxhash64(F.substring(_text(text), 1, prefix))


def repeated_beginnings(docs: DataFrame, text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """``size, beginning`` of the groups that two texts or more share after the first two steps."""
    lean = staged(docs.select(_size(text).alias("size"), _beginning(text, prefix).alias("beginning")), "sizes")
    met_again = F.col("n") > 1
    sizes = staged(lean.groupBy("size").agg(F.count("*").alias("n")).where(met_again).select("size"), "sizes-again")
    alike = lean.join(sizes, "size", "left_semi").groupBy("size", "beginning").agg(F.count("*").alias("n"))
    return staged(alike.where(met_again).select("size", "beginning"), "beginnings-again")


def hashed_rows(docs: DataFrame, id_col: str, text: str, prefix: int, hash_all: bool) -> DataFrame:
    """``d, n, size, digest, alike`` of every row: id, a number of its own, bytes, SHA-256, and whether step 3 looks at it.

    ``digest`` is null where it is not ``alike``, unless ``hash_all`` asks for it.
    """
    pairs = repeated_beginnings(docs, text, prefix).withColumn("alike", F.lit(True))
    whole = F.sha2(_text(text).cast("binary"), 256)
    rows = docs.select(
        F.col(id_col).alias("d"), F.monotonically_increasing_id().alias("n"), _size(text).alias("size"),
        _beginning(text, prefix).alias("beginning"),
        # a report on all rows needs every checksum, and then no text has to travel with its row
        once(whole).alias("digest") if hash_all else F.col(text).alias("body"))
    rows = rows.join(pairs, ["size", "beginning"], "left").withColumn("alike", F.col("alike").isNotNull())
    if not hash_all:
        whole = F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256)
        rows = rows.withColumn("digest", F.when(F.col("alike"), whole))
    return staged(rows.select("d", "n", "size", "digest", "alike"), "hashed")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: int = PREFIX,
               hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id, group_size, kept`` and ``text_sha256``.

    Texts are equal when they are identical; a missing text counts as an empty one. Of equal texts the
    row with the largest id stays, a missing id being smaller than any other; of rows that also share
    the id one stays. ``text_sha256`` is null for a text that was not read whole, unless ``hash_all``.
    Very long texts are read whole where they have to be. An empty table gives an empty result.
    """
    rows = hashed_rows(docs, id_col, text, prefix, hash_all)
    alike = rows.where("alike")
    groups = alike.groupBy("size", "digest").agg(
        F.max(F.struct("d", "n")).alias("best"), F.count("*").alias("many")).where(F.col("many") > 1)
    found = alike.join(staged(groups, "groups"), ["size", "digest"], "left")
    alone = rows.where(~F.col("alike")).withColumn("best", F.struct("d", "n")).withColumn("many", F.lit(None).cast("bigint"))
    every = found.select("d", "n", "digest", "best", "many").unionByName(alone.select("d", "n", "digest", "best", "many"))
    several = F.col("many").isNotNull()
    return every.select(
        F.col("d").alias(id_col), F.when(several, F.col("best.d")).otherwise(F.col("d")).alias("keep_id"),
        F.coalesce("many", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(several, F.col("best.n") == F.col("n")).otherwise(True).alias("kept"),
        F.col("digest").alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """``docs`` without the rows that ``duplicates`` does not keep; ids that several rows share keep a row per text.

    Rows that share id and text become one. Missing texts count as empty, so of rows without a text one stays.
    """
    size, beginning, number, digest, alike = (
        hidden(docs, f"x_{c}") for c in ("size", "beginning", "number", "digest", "alike"))
    pairs = repeated_beginnings(docs, text, prefix).toDF(size, beginning).withColumn(alike, F.lit(True))
    rows = docs.withColumns({size: _size(text), beginning: _beginning(text, prefix),
                             number: F.monotonically_increasing_id()}).join(pairs, [size, beginning], "left")
    rows = staged(rows.withColumn(digest, F.when(F.col(alike), F.sha2(_text(text).cast("binary"), 256))), "marked")
    several = rows.where(F.col(alike))
    best = several.groupBy(size, digest).agg(F.max(F.struct(id_col, number)).alias(alike))
    best = staged(best.select(size, digest, F.col(alike)[number].alias(number)), "best")
    stay = several.join(best, [size, digest, number], "left_semi")
    return rows.where(F.col(alike).isNull()).select(*docs.columns).unionByName(stay.select(*docs.columns))
