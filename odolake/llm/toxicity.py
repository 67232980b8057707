"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding undoes disguises: compatibility forms, letters of other scripts that look Latin, and
digits or signs that stand for letters inside a word. The lexicon (words and word
beginnings, each with its log odds) and the exception phrases (a match next to a word that
makes it harmless) come from labelled rows. A document's weights are summed, the strongest
match of each word counting; matches beyond the first are counted as well, as a word that is
harmless now and then seldom comes back. Both are normalised by a power of the length and turned
into a probability by a logistic curve fitted on the same rows. A lexicon is bounded: the
``MAX_TERMS`` terms with the most evidence and the ``MAX_PHRASES`` phrases met most often.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import staged
from odolake.llm.labelled import held_out, training_sample

MAX_ROWS = 20_000  # labelled rows that are learnt from
MAX_TERMS = 5_000
MIN_DOCS = 5  # toxic documents that must hold a term
MIN_EVIDENCE = 30.0  # log-likelihood ratio of a term, at any size of the sample
CHANCE = 0.01  # terms that may pass by chance, of all that are tested
MIN_WEIGHT = 1.0
BEGINNINGS = (4, 5, 6)
MAX_PHRASES = 5_000
POWERS = (0.0, 0.25, 0.5, 0.75, 1.0)

# fixed values: letters that look like Latin ones, and signs that stand for letters
LOOK_ALIKES = str.maketrans(
    "аеорсухіјѕԁһкмтвнгпαβεικνορτυχωɡɑ",
    "aeopcyxijsdhkmtbhrnabeiknoptuxwga",
)
SIGNS = str.maketrans("013457@$!|", "oieastasii")

_WORD = re.compile(r"[^\W_]+")
_DISGUISED = re.compile(r"(?=[\w@$!|]*[^\W\d_])(?=[\w@$!|]*[0134578@$!|][^\W_])[\w@$!|]*[^\W_]")
_MAYBE = re.compile(r"[013457@$!|][^\W\d_]|[^\W\d_][013457@$|]")


def fold(text: str) -> str:
    """Lower case with disguised letters undone."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(LOOK_ALIKES)
    else:
        text = text.lower()
    if _MAYBE.search(text):
        text = _DISGUISED.sub(lambda m: m[0].translate(SIGNS), text)
    return text


@dataclass
class Lexicon:
    """``words`` and ``beginnings`` with weights, exception phrases, and the curve."""

    words: dict[str, float]
    beginnings: dict[str, float]
    phrases: set[str] = field(default_factory=set)
    power: float = 0.0
    bias: float = -4.0
    slope: float = 1.0
    repeat: float = 0.0

    def automaton(self):
        """The matcher, or None for an empty lexicon; built once per worker."""
        if not (self.words or self.beginnings):
            return None
        import ahocorasick

        a = ahocorasick.Automaton()
        for term in {*self.words, *self.beginnings}:
            a.add_word(term, term)
        a.make_automaton()
        return a

    def hits(self, folded: str, automaton) -> dict[int, tuple[float, int]]:
        """Start of each word that matches -> its strongest weight and its end."""
        found: dict[int, tuple[float, int]] = {}
        if automaton is None:
            return found
        n = len(folded)
        for last, term in automaton.iter(folded):
            a = last - len(term) + 1
            if a and folded[a - 1].isalnum():
                continue
            weight = self.beginnings.get(term, 0.0)
            if term in self.words and (last + 1 == n or not folded[last + 1].isalnum()):
                weight = max(weight, self.words[term])
            if weight > found.get(a, (0.0, 0))[0]:
                end = last + 1
                while end < n and folded[end].isalnum():
                    end += 1
                found[a] = (weight, end)
        return found

    def around(self, folded: str, a: int, b: int) -> list[str]:
        """The phrases of a matched word with its neighbours."""
        word, out, n = folded[a:b], [], len(folded)
        last = a
        while last and not folded[last - 1].isalnum():
            last -= 1
        first = last
        while first and folded[first - 1].isalnum():
            first -= 1
        if first < last:
            out.append(f"{folded[first:last]} {word}")
        first = b
        while first < n and not folded[first].isalnum():
            first += 1
        last = first
        while last < n and folded[last].isalnum():
            last += 1
        if first < last:
            out.append(f"{word} {folded[first:last]}")
        return out

    def weigh(self, text: str, automaton) -> tuple[float, int, int]:
        """Sum of the weights, number of matches and number of words of a text."""
        folded = fold(text)
        total, n = 0.0, 0
        for a, (weight, b) in self.hits(folded, automaton).items():
            if self.phrases and not self.phrases.isdisjoint(self.around(folded, a, b)):
                continue
            total, n = total + weight, n + 1
        return total, n, len(text.split())

    def score(self, total: float, matches: int, words: int) -> float:
        x = self.bias + (self.slope * total + self.repeat * max(0, matches - 1)) / max(1, words) ** self.power
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _terms(text: str) -> set[str]:
    """``=word`` and ``beginning`` of a folded text."""
    words = set(_WORD.findall(text))
    out = {w[:k] for w in words for k in BEGINNINGS if len(w) >= k}
    out.update(f"={w}" for w in words if len(w) > 2)
    return out


def _counted(sample: DataFrame, features) -> DataFrame:
    """``term, pos, neg``: documents of each label per feature, combined in the task first."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for frame in frames:
            for text, y in zip(frame["t"], frame["y"]):
                seen[int(y)].update(features(text))
        terms = list({*seen[0], *seen[1]})
        yield pd.DataFrame({"term": pd.Series(terms, dtype=object), "pos": [seen[1][t] for t in terms],
                            "neg": [seen[0][t] for t in terms]}).astype({"pos": "int64", "neg": "int64"})

    parts = sample.mapInPandas(count, "term string, pos long, neg long")
    return parts.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _curve(y: np.ndarray, *inputs: np.ndarray) -> tuple[float, ...]:
    """Bias, slopes and loss of a logistic curve, slightly regularised, by Newton steps."""
    design = np.stack([np.ones_like(inputs[0]), *inputs], 1)
    w, ridge = np.zeros(design.shape[1]), 0.01 * np.eye(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.01 * w
        w = w - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, gradient)
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return *map(float, w), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def bar(tested: int) -> float:
    """The evidence a term needs: by chance the ratio is a squared normal value, and it is tried ``tested`` times."""
    return max(MIN_EVIDENCE, NormalDist().inv_cdf(CHANCE / max(1, tested) / 2) ** 2)


def learn(sample: DataFrame) -> Lexicon:
    """A lexicon from ``t, y``; with only one label in the sample it is empty."""
    of = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    pos_all, neg_all = of.get(1, 0), of.get(0, 0)
    if not pos_all or not neg_all:
        return Lexicon({}, {}, bias=4.0 if pos_all else -4.0)
    counts = staged(_counted(sample, lambda t: _terms(fold(t))).where(F.col("pos") >= MIN_DOCS), "terms")
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    weight = F.log(pos / F.lit(pos_all + 1.0)) - F.log(neg / F.lit(neg_all + 1.0))
    n, base = F.col("pos") + F.col("neg"), pos_all / (pos_all + neg_all)
    evidence = 2 * (F.col("pos") * F.log(F.greatest(F.col("pos"), F.lit(1)) / (n * base))
                    + F.col("neg") * F.log(F.greatest(F.col("neg"), F.lit(1)) / (n * (1 - base))))
    best = counts.select("term", weight.alias("w"), evidence.alias("e")).where(
        (F.col("w") >= MIN_WEIGHT) & (F.col("e") >= bar(counts.count())))
    terms = [(r.term, r.w) for r in best.orderBy(F.desc("e"), "term").limit(MAX_TERMS).collect()]
    lexicon = Lexicon({t[1:]: w for t, w in terms if t[0] == "="}, {t: w for t, w in terms if t[0] != "="})

    def phrases(text: str) -> set[str]:
        folded, automaton = fold(text), _automaton(lexicon)
        return {p for a, (_, b) in lexicon.hits(folded, automaton).items() for p in lexicon.around(folded, a, b)}

    harmless = _counted(sample, phrases).where((F.col("neg") >= 3) & (F.col("neg") > 9 * F.col("pos")))
    lexicon.phrases = {r.term for r in harmless.orderBy(F.desc("neg"), "term").limit(MAX_PHRASES).collect()}
    weighed = _weighed(sample.select("d", "t", "y"), lexicon, "y int").select("y", "total", "matches", "words").toPandas()
    y, total = weighed["y"].to_numpy(float), weighed["total"].to_numpy(float)
    more, words = np.maximum(0.0, weighed["matches"].to_numpy(float) - 1), np.maximum(1, weighed["words"].to_numpy(float))
    fits = [(*_curve(y, total / words**p, more / words**p), p) for p in POWERS]
    lexicon.bias, lexicon.slope, lexicon.repeat, _, lexicon.power = min(fits, key=lambda f: f[3])
    return lexicon


_built: dict[int, tuple] = {}


def _automaton(lexicon: Lexicon):
    if id(lexicon) not in _built:
        _built[id(lexicon)] = (lexicon, lexicon.automaton())
    return _built[id(lexicon)][1]


def _weighed(rows: DataFrame, lexicon: Lexicon, extra: str = "") -> DataFrame:
    """``d`` (and ``extra`` columns), ``total, matches, words, score`` of ``rows(d, t)``."""
    kept = [c.split()[0] for c in extra.split(",") if c]

    def weigh(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in frames:
            got = [lexicon.weigh(t, automaton) for t in frame["t"]]
            out = frame[["d", *kept]].copy()
            out["total"], out["matches"], out["words"] = [[g[k] for g in got] for k in range(3)]
            out["score"] = [lexicon.score(*g) for g in got]
            yield out

    fields = ", ".join([f"d {rows.schema['d'].dataType.simpleString()}", *([extra] if extra else [])])
    return rows.mapInPandas(weigh, f"{fields}, total double, matches long, words long, score double")


def score(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS, id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out, score, predicted, n_matches``.

    Learns from at most about ``max_rows`` labelled documents outside the fold kept aside. A
    missing text is an empty one; without labels every document gets the same low score.
    Other columns of ``docs`` are neither read nor returned.
    """
    lexicon = learn(training_sample(docs, labels, label, max_rows, id_col, text))
    rows = docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return _weighed(rows, lexicon).select(
        F.col("d").alias(id_col), held_out(F.col("d")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("matches").alias("n_matches"))
