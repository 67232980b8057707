"""Heuristic quality rules as a short-circuit cascade, ordered by rejections per cost.

Everything is a DataFrame expression. The rules run as one lazy CASE: a document that an earlier rule rejects
never reaches a later one. ``keep_good`` puts all rules into it, the base rules too, and each
rule computes what it needs inside its own branch, so the costly counts are made only for documents that
the rules before left. ``assess`` reports counts of every document; they are made anyway there, and the
cascade orders the other rules.

A sample tells what each rule costs and rejects. The cost is the time of the rule's own work per document:
the shortest of several runs over the sample, less the same run without the rule. Rules are ordered by
rejections per second, counting at each place only the documents that the rules before it left; a rule
that gains less than ``CLEARLY`` times as much as another goes by the order in which they are listed, so
small differences of a measurement do not change the plan.

The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import WORD_GAP, WORD_GAP_CHARS, hidden, once, staged

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 2000  # rows that cost and selectivity are estimated on
COPIES, RUNS = 2, 3  # how often a run takes the sample, and runs per rule
CLEARLY = 2.0


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a boolean Column from the text and the counts by name."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _upper(c: Callable[[str], Column]) -> Column:
    text = c("text")
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    upper = F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    return upper * 2 > letters


def _stutter(c: Callable[[str], Column]) -> Column:
    def repeats(hashes: Column) -> Column:
        return F.size(F.filter(hashes, lambda h, i: (i > 0) & (h == F.get(hashes, i - 1))))

    return _bound(c("hashes"), repeats) * 10 > c("n_words") * 4


RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda c: c("n_symbols") * 10 > c("n_words") * 3),
    Rule("word_length", lambda c: (c("word_chars") > c("n_words") * 15) | (c("word_chars") < c("n_words") * 2)),
    Rule("duplicate_lines", lambda c: c("n_dup_lines") * 10 > c("n_lines") * 4),
    Rule("stutter", _stutter),
    Rule("upper_case", _upper),
)

# the base rules as members of the cascade
BASE_RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda c: c("n_words") < MIN_WORDS),
    Rule("repeats", lambda c: c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT),
)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_PARTS = (*_COUNTS, "text", "hashes")


def _doubled(hashes: Column, size: int) -> Column:
    """Hashes of windows of twice ``size`` words from those of ``size`` words."""
    def double(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - size, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(h, i + size)))

    return _bound(hashes, double)


def _covered(windows: Column) -> Column:
    """How many words the windows cover that occur twice or more."""

    def positions(s: Column) -> Column:
        def repeated(k: Column) -> Column:
            mine = F.get(s, k)["h"]
            before = F.coalesce(F.get(s, k - 1)["h"] == mine, F.lit(False))
            return before | F.coalesce(F.get(s, k + 1)["h"] == mine, F.lit(False))

        hits = F.filter(F.sequence(F.lit(0), F.size(s) - 1), repeated)
        return F.sort_array(F.transform(hits, lambda k: F.get(s, k)["i"]))

    def length(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _bound(_bound(ordered, positions), length)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WORD_GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def _line_counts(text: Column) -> Column:
    """Lines with a word, and how many of them are different."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_GAP_CHARS)) != "")
    return _bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))


def _n_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _fours(hashes: Column) -> Column:
    return _doubled(_doubled(hashes, 1), 2)


def _n_repeat_words(fours: Column) -> Column:
    """From the hashes of all windows of four words; without a repeated one there is none of eight."""
    eights = lambda f: F.when(F.size(F.array_distinct(w := _doubled(f, 4))) < F.size(w), _covered(w))
    return F.when(F.size(F.array_distinct(fours)) < F.size(fours), F.coalesce(eights(fours), F.lit(0))).otherwise(
        F.lit(0)).cast("bigint")


def in_place(text: Column, words: Column) -> Callable[[str], Column]:
    """Every count by name as an expression of its own, so a branch that is not taken computes nothing."""
    counts = {
        "text": text, "hashes": _hashes(words), "n_words": F.size(words).cast("bigint"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"), "n_symbols": _n_symbols(text),
        "n_dup_lines": _bound(_line_counts(text), lambda x: x["n"] - x["d"]), "n_lines": _line_counts(text)["n"],
        "n_repeat_words": _bound(_fours(_hashes(words)), _n_repeat_words),
    }
    return counts.__getitem__


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the counts and helper columns; also their names (free of clashes).

    A missing text counts as an empty one. Words are runs without blanks; a line counts as a
    repeat if it has a word and equals an earlier line of the document.
    """
    name = {}
    for part in (*_PARTS, "words", "windows", "lines"):
        name[part] = hidden(docs, f"q_{part}")
    n = name
    out = docs.withColumn(n["text"], once(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn(n["words"], once(_words(F.col(n["text"]))))
    out = out.select(
        *docs.columns, n["text"],
        F.size(n["words"]).cast("bigint").alias(n["n_words"]),
        once(_hashes(F.col(n["words"]))).alias(n["hashes"]),
        F.char_length(F.array_join(n["words"], "")).cast("bigint").alias(n["word_chars"]),
        _n_symbols(F.col(n["text"])).alias(n["n_symbols"]), _line_counts(F.col(n["text"])).alias(n["lines"]),
    )
    out = out.select(
        *[c for c in out.columns if c != n["lines"]],
        (F.col(n["lines"])["n"] - F.col(n["lines"])["d"]).cast("bigint").alias(n["n_dup_lines"]),
        F.col(n["lines"])["n"].cast("bigint").alias(n["n_lines"]),
        once(_fours(F.col(n["hashes"]))).alias(n["windows"]),
    )
    kept = [c for c in out.columns if c != n["windows"]]
    repeats = once(_n_repeat_words(F.col(n["windows"])))
    return out.select(*kept, repeats.alias(n["n_repeat_words"])), {p: n[p] for p in _PARTS}


def base_failed(c: Callable[[str], Column]) -> Column:
    return (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT)


def ordered(rules: Sequence[Rule], cost: Sequence[float], seen: Sequence[tuple[tuple[bool, ...], int]]) -> list[Rule]:
    """Rules by rejections per cost; ``seen`` counts the documents by the rules that reject them."""
    left, order, rest = list(range(len(rules))), [], list(seen)
    while left:
        gain = {i: sum(n for flags, n in rest if flags[i]) / max(cost[i], 1e-9) for i in left}
        most = max(gain.values())
        best = next(i for i in left if gain[i] * CLEARLY >= most)
        order.append(rules[best])
        left.remove(best)
        rest = [(flags, n) for flags, n in rest if not flags[best]]
    return order


def _seconds(rows: DataFrame, flag: Column) -> float:
    began = time.perf_counter()
    rows.select(flag).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def cascade_order(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text"
) -> list[Rule]:
    """The rules by rejections per second of their own work on a sample of about ``sample_rows`` documents."""
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    sample = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).sample(share, seed=7)
    rows = staged(sample.withColumn("words", _words(F.col("text"))), "rule-sample")
    parts = in_place(F.col("text"), F.col("words"))
    flags = [r.rejects(parts).alias(f"r{i}") for i, r in enumerate(rules)]
    seen = rows.select(*flags).groupBy(*[f"r{i}" for i in range(len(rules))]).count().collect()
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    read = (F.octet_length("text") + F.size("words") + F.col("copy")) < 0  # all that a run does besides the rule
    tried = [read, *[read | f for f in flags]]
    best = [min(_seconds(many, t.alias("r")) for _ in range(RUNS)) for t in tried]
    return ordered(rules, [t - best[0] for t in best[1:]],
                   [(tuple(bool(r[f"r{i}"]) for i in range(len(rules))), r["count"]) for r in seen])


def assess(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Every row stays, also repeated ones; columns of ``docs`` with these names are replaced.
    An empty or missing text has no words and fails. ``rules`` fixes an order; by default
    it comes from a sample.
    """
    order = cascade_order(docs, text=text) if rules is None else rules
    out, names = measured(docs, text)
    get = lambda part: F.col(names[part])
    verdict = F.when(base_failed(get), False)
    for rule in order:
        verdict = verdict.when(rule.rejects(get), False)
    results = {p: get(p) for p in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    results |= {"base_failed": base_failed(get), "kept": verdict.otherwise(True)}
    own = [F.col(c) for c in docs.columns if c not in results]
    return out.select(*own, *[v.alias(k) for k, v in results.items()])


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """The documents that pass all rules, the base rules too, with their own columns only.

    A missing or empty text has no words and goes; repeated rows have one fate. Nothing is counted for a document
    beyond what the rules that it reaches look at.
    """
    order = cascade_order(docs, (*BASE_RULES, *RULES), text=text) if rules is None else rules
    whole, words = hidden(docs, "q_text"), hidden(docs, "q_words")
    rows = docs.withColumn(whole, once(F.coalesce(F.col(text), F.lit("")))).withColumn(words, once(_words(F.col(whole))))
    parts = in_place(F.col(whole), F.col(words))
    verdict = F.when(order[0].rejects(parts), False)
    for rule in order[1:]:
        verdict = verdict.when(rule.rejects(parts), False)
    return rows.where(verdict.otherwise(True)).select(*docs.columns)
