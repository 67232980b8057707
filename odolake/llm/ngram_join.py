"""Near duplicates by the Jaccard similarity of word n-grams: MinHash banding, then exact checks.

1. Equal texts are one node; only nodes are compared.
2. Every node gets a MinHash signature, cut into bands. The number of bands and of rows in
   a band follow from the recall wanted at the threshold (``choose_bands``).
3. Nodes that share a band hash meet in a bucket. A bucket with more than ``BLOCK`` nodes is
   dealt into blocks, and pairs of blocks meet, so no task holds more than two blocks.
4. A pair counts in the first band it shares only. A light pass over the band hashes finds
   the nodes that have such a pair in a bucket; only those travel there with their n-grams.
5. In a block all pairs are compared on their full n-gram sets. What leaves it is a number
   of links and one root per node, never a row per pair.
6. Components over the roots give the class.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import hidden, runs, sorted_groups, staged, text_key
from odolake.llm.components import components
from odolake.llm.words import chunks, mix, shingles, word_hashes

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999  # of pairs exactly at the threshold; more similar ones are found more surely
MAX_HASHES = 80
BLOCK = 384
COLUMNS = 4096  # n-grams that are compared at once


def choose_bands(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most selective bands that reach the recall with so many hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def _signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``d, node, bands`` per row of ``docs(d, node, t)``; no bands for a text without words."""
    seeds = np.random.default_rng(11).integers(0, 1 << 63, size=(bands * rows, 2), dtype=np.uint64) | np.uint64(1)

    def sign(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t.lower() for t in frame["t"]]
            out: list = [None] * len(texts)
            for a, b in chunks(texts):
                grams, of = shingles(*word_hashes(texts[a:b]), n)
                if not len(grams):
                    continue
                starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                lows = np.empty((bands * rows, len(starts)), np.uint64)
                for k, (s, m) in enumerate(seeds):
                    h = (grams ^ s) * m
                    lows[k] = np.minimum.reduceat(h ^ (h >> np.uint64(31)), starts)
                parts = np.empty((bands, len(starts)), np.uint64)
                for k in range(bands):
                    h = np.full(len(starts), k + 1, np.uint64)
                    for low in lows[k * rows:(k + 1) * rows]:
                        h = mix(h ^ low)
                    parts[k] = h
                parts = np.ascontiguousarray(parts.T)
                for number, part in zip(of[starts], parts):
                    out[a + number] = part.tobytes()
            yield pd.DataFrame({"d": frame["d"], "node": frame["node"], "bands": out})

    kind = docs.schema["d"].dataType.simpleString()
    return docs.mapInPandas(sign, f"d {kind}, node long, bands binary")


def _buckets(nodes: DataFrame, bands: int) -> DataFrame:
    """``key, node, band, lo, hi, side`` for every bucket with two nodes or more, large ones in pairs of blocks."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("bands"), k * 8 + 1, F.lit(8))))
    hits = nodes.where(F.col("bands").isNotNull()).select("node", F.posexplode(hashes).alias("band", "bucket"))
    sizes = hits.groupBy("bucket").agg(F.count("*").alias("m")).where(F.col("m") > 1)
    met = hits.join(sizes, "bucket")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    met = met.withColumn("n", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    return met.select(F.xxhash64("bucket", lo, hi).alias("key"), "node", "band",
                      (lo == hi).alias("alone"), (F.col("mine") == lo).alias("left"))


def _new_pairs(hashes: np.ndarray, band: int, alone: bool, left: np.ndarray) -> np.ndarray:
    """Which pairs of a block share this band and none before it, above the diagonal."""
    pairs = np.ones((len(hashes), len(hashes)), bool) if alone else left[:, None] != left[None, :]
    pairs &= np.triu(np.ones_like(pairs), 1)
    for k in range(band):
        pairs &= hashes[:, None, k] != hashes[None, :, k]
    return pairs & (hashes[:, None, band] == hashes[None, :, band])


def _block(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The nodes of a block, each once, and its new pairs."""
    if len(group) > 1:
        group = group.drop_duplicates("node")
    hashes = np.stack([np.frombuffer(b, np.uint64) for b in group["bands"]])
    return group, _new_pairs(hashes, int(group["band"].iat[0]), bool(group["alone"].iat[0]), group["left"].to_numpy())


def _needed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = []
    for group in runs(frames, "key"):
        group, pairs = _block(group)
        wanted = pairs.any(0) | pairs.any(1)
        if wanted.any():
            held.append(group[wanted])
        if len(held) >= 500:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each pair of sets shares."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[gram] > 1
    owner, gram = owner[shared], gram[shared]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    column = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1]))) if len(gram) else gram
    out = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        x, y = np.searchsorted(column, [a, a + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[x:y], column[x:y] - a] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _checker(similarity: float):
    def check(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for group in runs(frames, "key"):
            group, pairs = _block(group)
            sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
            sizes = np.array([len(s) for s in sets])
            both = shared_counts(sets)
            links = pairs & (both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9)
            if not links.any():
                continue
            nodes = group["node"].to_numpy()
            root = np.arange(len(nodes))
            while True:  # the smallest place in reach
                near = np.where(links | links.T, root[None, :], len(nodes)).min(1)
                lower = np.minimum(root, near)
                lower = lower[lower]
                if (lower == root).all():
                    break
                root = lower
            count = links.sum(0) + links.sum(1)
            linked = count > 0
            held.append(pd.DataFrame({"node": nodes[linked], "links": count[linked], "root": nodes[root[linked]]}))
            if len(held) >= 500:
                yield pd.concat(held)
                held = []
        if held:
            yield pd.concat(held)

    return check


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``n_links``, ``copy_of`` and ``n_copies``.

    ``class_id`` is the smallest id of the group that links connect, ``copy_of`` the smallest
    of the equal texts, ``n_copies`` their number, and ``n_links`` how many different texts
    have a similarity of ``similarity`` or more to this one. N-grams are taken over
    lower-cased words; a text with fewer words is one n-gram of all of them, and one without
    words links to nothing. A missing text is a text of its own kind. Missing ids come last.
    ``text_key`` names a text and ``class_key`` the text that stands for the group.
    """
    bands, rows = choose_bands(similarity, recall)
    named = docs.select(F.col(id_col).alias("d"), text_key(F.col(text)).alias("node"),
                        F.coalesce(F.col(text), F.lit("")).alias("t"))
    signed = staged(_signatures(named, words, bands, rows), "signatures")
    nodes = staged(signed.groupBy("node").agg(
        F.min("d").alias("rep"), F.count("*").alias("n"), F.max("bands").alias("bands")), "nodes")
    hits = staged(_buckets(nodes, bands), "buckets")
    hits = hits.join(nodes.select("node", "rep", "bands"), "node")
    layout = "key long, node long, band int, alone boolean, left boolean"
    kind = docs.schema[id_col].dataType.simpleString()
    needed = staged(sorted_groups(hits, "key").mapInPandas(
        _needed, f"node long, key long, band int, alone boolean, left boolean, rep {kind}, bands binary"), "needed")
    wanted = needed.select("node", "rep").distinct()

    def grams(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t.lower() for t in frame["t"]]
            for a, b in chunks(texts):
                found, of = shingles(*word_hashes(texts[a:b]), words)
                edges = np.searchsorted(of, np.arange(b - a + 1))
                yield pd.DataFrame({"node": frame["node"].iloc[a:b], "grams": [
                    np.unique(found[x:y]).tobytes() for x, y in zip(edges, edges[1:])]})

    same = (named["node"] == wanted["node"]) & named["d"].eqNullSafe(wanted["rep"])
    sets = named.join(wanted, same, "left_semi").select("node", "t").mapInPandas(grams, "node long, grams binary")
    filled = needed.drop("rep").join(sets, "node")
    checked = staged(sorted_groups(filled, "key").mapInPandas(
        _checker(similarity), "node long, links long, root long"), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = roots.join(nodes.select("node", "rep"), "node").select("node", "root", "rep")
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("first")
    lowest = roots.groupBy("root").agg(first)
    found = roots.join(lowest, "root").join(links, "node").select("node", "first", "n_links")
    info = nodes.select("node", "rep", "n").join(found, "node", "left").select(
        "node", F.when(F.col("first").isNull(), F.col("rep")).otherwise(F.col("first.rep")).alias("class_id"),
        F.coalesce("first.node", "node").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("rep").alias("copy_of"), F.col("n").alias("n_copies"))
    return signed.select("d", "node").join(info, "node").select(
        F.col("d").alias(id_col), "class_id", "n_links", "copy_of", "n_copies", F.col("node").alias("text_key"), "class_key")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of every group: a row with the group's smallest id."""
    found = near_duplicates(docs, id_col=id_col, text=text)
    first = (F.col("text_key") == F.col("class_key")) & F.col(id_col).eqNullSafe(F.col("copy_of"))
    stays = found.where(first).groupBy("text_key", id_col).agg(F.count("*").alias("rows"))
    mark = {c: hidden(docs, f"n_{c}") for c in ("key", "id", "rows")}
    stays = staged(stays.select(F.col("text_key").alias(mark["key"]), F.col(id_col).alias(mark["id"]),
                                F.col("rows").alias(mark["rows"])), "stays")
    same = (text_key(F.col(text)) == F.col(mark["key"])) & F.col(id_col).eqNullSafe(F.col(mark["id"]))
    kept = docs.join(stays, same)
    alone = kept.where(F.col(mark["rows"]) == 1)
    again = kept.where(F.col(mark["rows"]) > 1).dropDuplicates([mark["key"]])  # rows that repeat id and text
    return alone.unionByName(again).select(*docs.columns)
