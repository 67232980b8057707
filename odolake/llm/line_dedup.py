"""Removal of repeated runs of lines by winnowing.

A document is the sequence of its lines with a word; a line's identity is the hash of its
trimmed text. A *run* is a stretch of consecutive lines with ``min_words`` words or more. A
line goes if it lies in a run that occurs earlier too: in a document before this one, or
further up in the same document. Documents are ordered by id (missing ids first), then by
the hash of the text.

1. Windows. From every line, the shortest stretch with ``min_words`` words to its right and
   to its left. The smallest line hash of a window is selected as its fingerprint, so every
   shared run holds a shared fingerprint: this is the guarantee of winnowing, with the
   window measured in words, so that one long line is a window of its own. A window is no more
   than its two ends and its fingerprint here.
2. Join. Fingerprints that stand in one place only end here.
3. Extension. From the place of a repeated fingerprint the lines of its window are hashed to the left and to
   the right, and joined with the earliest place where that fingerprint has the same lines on both
   sides. One row per fingerprint and sides is the other end of the join, so a line that
   occurs in millions of documents links to one place and never to all pairs.
4. Deletion. Every run is the union of its windows to the right and to the left, so the
   lines of windows that occur earlier are exactly the lines of repeated runs: linked windows that
   touch or overlap are one match, extended as far as it goes.

All steps are DataFrame expressions; arrays never leave their document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from odolake.llm.common import WORD_GAP, WORD_GAP_CHARS, hidden, once, staged, text_key

MIN_WORDS = 50
_HIGH = 1 << 32


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(WORD_GAP_CHARS))


def line_table(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Per document with a line: id, key, and number ``r``, hash ``h`` and words ``w`` of its lines with a word."""
    numbered = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x, i: F.struct(_trim(x).alias("x"), i.alias("i")))
    out = docs.select(F.col(id_col).alias("d"), text_key(F.col(text)).alias("t"),
                      once(F.filter(numbered, lambda s: s["x"] != "")).alias("lines"))
    return out.where(F.size("lines") > 0).select(
        "d", "t", once(F.col("lines.i")).alias("r"),
        F.transform("lines", lambda s: F.xxhash64(s["x"])).alias("h"),
        F.transform("lines", lambda s: F.size(F.split(s["x"], WORD_GAP))).alias("w"),
    )


def _reach(words: Column, min_words: int) -> Column:
    """How many of the first ``words`` it takes to have ``min_words``; 0 if they are too few."""
    # the sum so far in the low part, the lines so far in the high part
    both = F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, x: F.when(
        acc % _HIGH < min_words, acc + x + _HIGH).otherwise(acc))
    return F.when(both % _HIGH >= min_words, (both / _HIGH).cast("int")).otherwise(0)


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """One row per window: document, places of its first line, last line and fingerprint among the lines, fingerprint."""
    span = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    at = lambda k: F.get(F.col("w"), k)

    def right(i: Column) -> Column:
        n = F.when(at(i) >= min_words, 1).otherwise(_reach(F.slice("w", i + 1, F.lit(min_words)), min_words))
        return span(F.when(n > 0, i), i + n - 1)

    def left(j: Column) -> Column:
        behind = F.slice("w", F.greatest(j - min_words + 2, F.lit(1)), F.least(F.lit(min_words), j + 1))
        n = F.when(at(j) >= min_words, 1).otherwise(_reach(F.reverse(behind), min_words))
        return span(F.when(n > 0, j - n + 1), j)

    every = F.sequence(F.lit(0), F.size("w") - 1)
    spans = F.array_distinct(F.filter(
        F.concat(F.transform(every, right), F.transform(every, left)), lambda s: s["a"].isNotNull()))
    out = lines.withColumn("spans", once(spans)).withColumn("span", F.explode("spans")).select(
        "d", "t", F.col("span.a").alias("a"), F.col("span.b").alias("b"),
        F.slice("h", F.col("span.a") + 1, F.col("span.b") - F.col("span.a") + 1).alias("h"))
    least = F.array_min("h")
    return out.select("d", "t", "a", "b", (F.col("a") + F.array_position("h", least) - 1).cast("int").alias("m"),
                      least.alias("finger"))


def extended(guarded: DataFrame, lines: DataFrame) -> DataFrame:
    """Windows ``d, t, a, b, m, finger`` with hashes of the lines on both sides of the fingerprint; ends as line numbers."""
    per = guarded.groupBy(F.col("d").alias("gd"), F.col("t").alias("gt")).agg(  # no more than two entries per line
        F.collect_set(F.struct("a", "b", "m", "finger")).alias("spans"))
    both = lines.join(per, lines["d"].eqNullSafe(per["gd"]) & (lines["t"] == per["gt"]))
    line = lambda k: F.get(F.col("r"), k)

    def reach(s: Column) -> Column:
        return F.struct(
            line(s["a"]).alias("a"), line(s["b"]).alias("b"), s["finger"].alias("finger"),
            F.xxhash64(F.slice("h", s["a"] + 1, s["m"] - s["a"])).alias("left"),
            F.xxhash64(F.slice("h", s["m"] + 2, s["b"] - s["m"])).alias("right"))

    return both.select("d", "t", F.inline(F.transform("spans", reach)))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans ``a..b`` of lines that occur earlier: ``d, t`` (document), ``a, b, source``."""
    lines = staged(line_table(docs, id_col, text).dropDuplicates(["d", "t"]), "lines")
    rows = staged(windows(lines, min_words), "windows")
    places = rows.select("finger", F.xxhash64("d", "t", "m").alias("place"))
    often = places.groupBy("finger").agg(
        F.min("place").alias("lo"), F.max("place").alias("hi")).where(F.col("lo") != F.col("hi")).select("finger")
    found = staged(extended(rows.join(often, "finger", "left_semi"), lines), "extended")
    place = F.struct("d", "t", "a")
    match = ["finger", "left", "right"]
    first = found.groupBy(*match).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(F.col("first") != F.col("last")).select(*match, "first")
    met = found.join(first, match).where(F.col("first") < place)
    return met.select("d", "t", "a", "b", F.col("first.d").alias("source"))


def removals(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document that loses lines: ``d, t``, its ``islands`` of lines to remove, in order, and their ``sources``."""
    spans = repeated_spans(docs, min_words, id_col, text).distinct()
    mine = W.partitionBy("d", "t").orderBy("a", "b")
    behind = F.max("b").over(mine.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("new", F.coalesce(F.col("a") > behind + 1, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(mine.rowsBetween(W.unboundedPreceding, W.currentRow)))
    merged = islands.groupBy("d", "t", "island").agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.collect_set("source").alias("sources"))
    return merged.groupBy("d", "t").agg(  # no more entries than the document has lines
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("islands"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"))


def _with_word(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: _trim(x) != "")).cast("bigint")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` freed of repeated runs, and ``n_lines, n_removed, sources`` added.

    ``n_lines`` counts lines with a word. Lines without one go if they stand inside a removed
    run. A text that loses nothing is returned as it is, a missing one stays missing; one that
    loses everything becomes empty. ``sources`` are the ids of the documents that had the
    lines first. Rows with the same id and text count as one document and share its result;
    columns of these names in ``docs`` are replaced. An empty table gives an empty result.
    """
    names = {part: hidden(docs, f"l_{part}") for part in ("d", "t", "islands", "sources")}
    gone = removals(docs, min_words, id_col, text)
    gone = gone.select(*[F.col(c).alias(names[c]) for c in names])
    key, n_lines = hidden(docs, "l_key"), hidden(docs, "l_lines")
    keyed = docs.withColumn(key, text_key(F.col(text)))
    out = keyed.join(gone, (keyed[key] == gone[names["t"]]) & keyed[id_col].eqNullSafe(gone[names["d"]]), "left")
    lines, islands = F.split(F.col(text), "\n"), F.col(names["islands"])

    def between(k: Column) -> Column:
        """The lines after island ``k - 1`` and before island ``k``."""
        after = F.when(k == 0, F.lit(0)).otherwise(F.get(islands, k - 1)["b"] + 1)
        end = F.when(k == F.size(islands), F.size(lines)).otherwise(F.get(islands, k)["a"])
        return F.slice(lines, after + 1, end - after)

    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size(islands)), between))
    touched = islands.isNotNull()
    own = [c for c in docs.columns if c not in (text, "n_lines", "n_removed", "sources")]
    out = out.select(
        *own, once(F.when(touched, F.array_join(left, "\n")).otherwise(F.col(text))).alias(text), touched.alias(key),
        F.coalesce(_with_word(F.col(text)), F.lit(0).cast("bigint")).alias(n_lines),
        F.coalesce(F.col(names["sources"]), F.array().cast(gone.schema[names["sources"]].dataType)).alias("sources"))
    n_left = F.when(F.col(key), _with_word(F.col(text))).otherwise(F.col(n_lines))
    return out.select(
        *own, text, F.col(n_lines).alias("n_lines"), once(F.col(n_lines) - n_left).alias("n_removed"), "sources")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` in their own columns with cleaned texts; a document that lost all its words goes.

    Missing and empty texts lose nothing and stay. Rows that share id and text have one fate.
    """
    aside = {c: hidden(docs, f"l_own_{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(c).alias(aside[c]) for c in docs.columns])
    out = dedup_lines(inner, min_words, aside[id_col], aside[text])
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return out.select(*[F.col(aside[c]).alias(c) for c in docs.columns])
