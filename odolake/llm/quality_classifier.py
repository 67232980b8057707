"""Quality by naive Bayes support vectors over n-gram indicators.

Features are indicators of hashed n-grams: words, word pairs, three-byte pieces, and the
shapes of repetition (a word pair that says the same word twice, a window of words that
came before). Each indicator is scaled by the log ratio of its smoothed class counts; a
linear hinge-loss model is then fitted by dual coordinate descent. The sample is dealt into
blocks of bounded size, one task fits each, and the models are averaged. A logistic curve,
fitted on rows that no block saw, turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.labelled import held_out, training_sample
from odolake.llm.toxicity import _curve
from odolake.llm.words import chunks, mix, shingles, word_hashes

MAX_ROWS = 16_000  # labelled rows that are learnt from
BLOCK_ROWS = 4_000  # of these, in one task
BITS = 18
COST = 1.0
EPOCHS = 12
SMOOTHING = 1.0
_SHIFT = np.uint64(64 - BITS)


def features(texts: list[str]) -> Iterator[np.ndarray]:
    """The indices of each text's indicators, sorted and each once."""
    for a, b in chunks(texts):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts[a:b]]
        words, of = word_hashes(texts[a:b])
        edges = np.searchsorted(of, np.arange(b - a + 1))
        seen = np.zeros(1 << BITS, bool)
        for k, data in enumerate(raw):
            w = words[edges[k]:edges[k + 1]]
            out = [mix(w + np.uint64(11))]
            if len(w) > 1:
                out.append(mix(mix(w[:-1]) + w[1:]))
                out.append(_share(2, int((w[:-1] == w[1:]).sum()), len(w)))
                grams, _ = shingles(w, np.zeros(len(w), np.int64), 4)
                out.append(_share(3, len(grams) - len(np.unique(grams)), len(grams)))
            if len(data) > 2:
                c = np.frombuffer(data, np.uint8).astype(np.uint64)
                out.append(mix((c[:-2] << np.uint64(16)) | (c[1:-1] << np.uint64(8)) | c[2:] | np.uint64(1 << 32)))
            seen[(np.concatenate(out) >> _SHIFT).astype(np.int64)] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found.astype(np.int32)


def _share(kind: int, part: int, whole: int) -> np.ndarray:
    """Indicators that the share of repetition reaches certain steps."""
    steps = [s for s in (0, 2, 5, 10, 20, 35, 50, 75) if part * 100 > s * whole]
    return mix(np.array([kind * 1000 + s for s in steps], np.uint64)) if steps else np.zeros(0, np.uint64)


def fit(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights of all indicators, class log-count ratios included."""
    sign = np.where(y > 0, 1.0, -1.0)
    size = 1 << BITS
    pos, neg = np.full(size, SMOOTHING), np.full(size, SMOOTHING)
    for x, s in zip(rows, sign):
        (pos if s > 0 else neg)[x] += 1
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    weights, alpha = np.zeros(size), np.zeros(len(rows))
    scaled = [ratio[x] / np.sqrt(max(1, len(x))) for x in rows]
    norm = np.array([float(v @ v) for v in scaled])
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            x, v = rows[k], scaled[k]
            if norm[k] == 0:
                continue
            gradient = sign[k] * float(weights[x] @ v) - 1
            step = min(max(alpha[k] - gradient / norm[k], 0.0), COST) - alpha[k]
            if step:
                alpha[k] += step
                weights[x] += step * sign[k] * v
    return (weights * ratio).astype(np.float32)


def margin(weights: np.ndarray, x: np.ndarray) -> float:
    return float(weights[x].sum()) / max(1, len(x)) ** 0.5


def learn(sample: DataFrame) -> tuple[np.ndarray, float, float]:
    """Weights, bias and slope from ``d, t, y``; with one label only, a constant."""
    of = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if not of.get(0) or not of.get(1):
        return np.zeros(1 << BITS, np.float32), 4.0 if of.get(1) else -4.0, 0.0
    blocks = max(1, round(sum(of.values()) / BLOCK_ROWS))
    aside = F.pmod(F.xxhash64(F.lit(5), "d"), F.lit(10)) == 0
    block = F.when(aside, -1).otherwise(F.pmod(F.xxhash64(F.lit(6), "d"), F.lit(blocks)).cast("int"))

    def index(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"block": frame["block"], "y": frame["y"],
                                "x": [x.tobytes() for x in features(list(frame["t"]))]})

    def fit_block(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["block"].iat[0] < 0:
            return pd.DataFrame({"block": frame["block"], "y": frame["y"], "x": frame["x"]})
        rows = [np.frombuffer(x, np.int32) for x in frame["x"]]
        y = frame["y"].to_numpy()
        weights = fit(rows, y) if 0 < y.sum() < len(y) else np.zeros(1 << BITS, np.float32)
        return pd.DataFrame({"block": [int(frame["block"].iat[0])], "y": [0], "x": [weights.tobytes()]})

    indexed = sample.withColumn("block", block).mapInPandas(index, "block int, y int, x binary")
    fitted = indexed.groupBy("block").applyInPandas(fit_block, "block int, y int, x binary").toPandas()
    models = [np.frombuffer(x, np.float32) for x in fitted.loc[fitted["block"] >= 0, "x"]]
    weights = np.mean(models, axis=0, dtype=np.float64).astype(np.float32)
    kept = fitted[fitted["block"] < 0]  # a tenth of the sample
    y = kept["y"].to_numpy(float)
    m = np.array([margin(weights, np.frombuffer(x, np.int32)) for x in kept["x"]])
    if not 0 < y.sum() < len(y):
        return weights, 0.0, 1.0
    bias, slope, _ = _curve(y, m)
    return weights, bias, slope


def score(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, id_col: str = "doc_id",
    text: str = "text", threshold: float = 0.3,
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out, score, predicted``.

    Learns from at most about ``max_rows`` labelled documents outside the fold kept aside. A
    missing text is an empty one and gets the score of a text without n-grams; without
    labels every document gets the same score. Other columns are neither read nor returned.
    """
    weights, bias, slope = learn(training_sample(docs, labels, label, max_rows, id_col, text))
    model = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size
    kind = docs.schema[id_col].dataType.simpleString()

    def rate(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            m = np.array([margin(model.value, x) for x in features(list(frame["t"]))])
            yield pd.DataFrame({"d": frame["d"], "score": 1 / (1 + np.exp(-np.clip(bias + slope * m, -30, 30)))})

    rows = docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInPandas(rate, f"d {kind}, score double").select(
        F.col("d").alias(id_col), held_out(F.col("d")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
