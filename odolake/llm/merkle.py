"""A Merkle manifest of a dataset: a hash tree per group and one over the groups, stored in van Emde Boas order.

Every row is a leaf. Leaves of a group stand in the order of their ids; while several nodes remain, every
``FAN`` consecutive ones become their hash. What remains of each group is again a leaf of the tree over all
groups, in the order of the group names. A tree is kept in *blocks*: aligned subtrees of ``BLOCK_FOLDS``
folds, so a block has at most ``FAN ** BLOCK_FOLDS`` leaves, however large the group is. The roots of the
blocks are the leaves of the blocks of the next level, until one block is left.

Inside a block nodes lie in van Emde Boas order: the subtree is split at half its height, its upper half
stored first and then each lower half, all by the same rule. A path from a leaf to the root then touches
few stretches of the block whatever the size of a cache line is. ``addresses`` computes the places by
arithmetic alone, also where the last run or the last subtree is not full, and no place is left empty. The
same addresses serve construction and the look-up of siblings.

Ranks come from a sort by ranges and prefix sums over its partitions, so a group with a third of all
rows is cut into blocks like any other. Blocks are rows of staged tables; the driver holds nothing but
one count per level.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import runs, sorted_groups, staged
from odolake.llm.sharding import numbered

FAN = 16
BLOCK_FOLDS = 3
WIDTH = 32  # bytes of a digest
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_BLOCK = "tree LONG, block LONG, leaves LONG, folds INT, nodes BINARY, root BINARY"


# --- the layout ------------------------------------------------------------------

def count_at(leaves: int, up: int) -> int:
    """Nodes that ``leaves`` leaves have ``up`` folds above them."""
    return -(-leaves // FAN ** up)


def size(leaves: int, folds: int) -> int:
    """Nodes of a subtree with so many leaves."""
    return sum(count_at(leaves, up) for up in range(folds + 1))


@lru_cache(maxsize=256)
def addresses(leaves: int, folds: int, up: int) -> np.ndarray:
    """Places of the nodes ``up`` folds above the leaves, left to right, in the order described above.

    The subtree has ``folds + 1`` rows of nodes. Its upper half are the top ``(folds + 1) // 2`` rows; below
    each of the nodes of the next row hangs a lower half. Only the last of these may not be full.
    """
    if folds == 0:
        return np.zeros(1, np.int64)
    below = folds - (folds + 1) // 2  # folds of a lower half
    upper_leaves, upper_folds = count_at(leaves, below + 1), folds - below - 1
    if up > below:
        return addresses(upper_leaves, upper_folds, up - below - 1)
    start, parts = size(upper_leaves, upper_folds), count_at(leaves, below)
    full = FAN ** below
    each = size(full, below)
    last = leaves - (parts - 1) * full
    inner, rest = addresses(full, below, up), addresses(last, below, up)
    whole = (np.arange(parts - 1, dtype=np.int64)[:, None] * each + inner[None, :]).reshape(-1)
    return start + np.concatenate([whole, (parts - 1) * each + rest])


def folds_of(leaves: int, most: int = 64) -> int:
    """Folds until one node is left."""
    folds = 0
    while count_at(leaves, folds) > 1 and folds < most:
        folds += 1
    return folds


def fold(row: np.ndarray) -> np.ndarray:
    """The nodes above a row of nodes: hash of the hex digests of every ``FAN`` consecutive ones."""
    text = row.tobytes().hex().encode()
    run = FAN * WIDTH * 2
    out = b"".join(sha256(text[a:a + run]).digest() for a in range(0, len(text), run))
    return np.frombuffer(out, np.uint8).reshape(-1, WIDTH)


def built(leaves: np.ndarray, folds: int) -> np.ndarray:
    """The nodes of a block over ``leaves`` (n x 32 bytes), each at its address."""
    n = len(leaves)
    out, row = np.empty((size(n, folds), WIDTH), np.uint8), leaves
    for up in range(folds + 1):
        row = fold(row) if up else row
        out[addresses(n, folds, up)] = row
    return out


def siblings(nodes: np.ndarray, leaves: int, folds: int, up: int, at: int) -> tuple[str, str]:
    """Hex digests to the left and to the right of the node ``at`` in its run, ``up`` folds above the leaves."""
    first = at - at % FAN
    places = addresses(leaves, folds, up)[first:first + FAN]
    run = nodes[places]
    return run[:at - first].tobytes().hex(), run[at - first + 1:].tobytes().hex()


def paths(nodes: np.ndarray, leaves: int, folds: int) -> list[list[tuple[str, str]]]:
    """For every leaf of a block the siblings on each row up to the block's root."""
    out: list[list[tuple[str, str]]] = [[] for _ in range(leaves)]
    for up in range(folds):
        texts = nodes[addresses(leaves, folds, up)].tobytes().hex()
        step, wide = FAN ** up, WIDTH * 2
        n = len(texts) // wide
        pairs = []
        for at in range(n):
            first = at - at % FAN
            pairs.append((texts[first * wide:at * wide], texts[(at + 1) * wide:min(first + FAN, n) * wide]))
        for leaf in range(leaves):
            out[leaf].append(pairs[leaf // step])
    return out


def climbed(digest: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf leads to with the given siblings."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


# --- the trees as tables ---------------------------------------------------------

def _array(digests: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, WIDTH)


def _blocks(leaves: DataFrame, sizes: DataFrame, block_folds: int) -> DataFrame:
    """Blocks over ``tree, at, digest``; ``sizes`` has the number of leaves ``n`` of each tree."""
    full = FAN ** block_folds
    keyed = leaves.join(sizes, "tree").select(
        "tree", F.expr(f"at div {full}").alias("block"), "at", "digest", "n").withColumn(
        "key", F.xxhash64("tree", "block"))

    def build(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for near in runs(frames, "key"):  # a block; more than one only where hashes collide
            for (tree, block), rows in near.groupby(["tree", "block"]):
                rows = rows.sort_values("at")
                alone = int(rows["n"].iat[0]) <= full
                folds = folds_of(len(rows)) if alone else block_folds
                nodes = built(_array(rows["digest"]), folds)
                root = nodes[addresses(len(rows), folds, folds)[0]].tobytes()
                yield pd.DataFrame({"tree": [tree], "block": [block], "leaves": [len(rows)], "folds": [folds],
                                    "nodes": [nodes.tobytes()], "root": [root]})

    return sorted_groups(keyed, "key").mapInPandas(build, _BLOCK)


def trees(leaves: DataFrame, block_folds: int = BLOCK_FOLDS) -> list[DataFrame]:
    """The levels of blocks over all trees of ``leaves(tree, at, digest)``, lowest first, as staged tables."""
    levels = []
    while True:
        sizes = staged(leaves.groupBy("tree").agg(F.count("*").alias("n")), "tree-sizes")
        blocks = staged(_blocks(leaves, sizes, block_folds), "tree-blocks")
        levels.append(blocks)
        open_trees = sizes.where(F.col("n") > FAN ** block_folds).select("tree")
        leaves = blocks.join(open_trees, "tree", "left_semi").select(
            "tree", F.col("block").alias("at"), F.col("root").alias("digest"))
        if leaves.isEmpty():
            return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """``tree, root``: the root of the only block of a tree at its highest level."""
    every = [b.select("tree", F.lit(k).alias("level"), "root") for k, b in enumerate(levels)]
    both = every[0]
    for one in every[1:]:
        both = both.unionByName(one)
    return both.groupBy("tree").agg(F.max_by("root", "level").alias("root"))


_ABOVE = "tree LONG, at LONG, lefts ARRAY<STRING>, rights ARRAY<STRING>"


def _with_context(blocks: DataFrame, above: DataFrame, keep: list[str]) -> DataFrame:
    """Blocks beside the siblings on the way from their root to the top."""
    above = above.withColumnRenamed("at", "block")
    return blocks.join(above, ["tree", "block"]).select(*keep, "lefts", "rights")


def _descended(blocks: DataFrame, above: DataFrame, block_folds: int) -> DataFrame:
    """For every leaf of the blocks the siblings from it to the top; ``above`` has those of the blocks' roots."""

    def descend(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples():
                nodes = np.frombuffer(b.nodes, np.uint8).reshape(-1, WIDTH)
                found = paths(nodes, b.leaves, b.folds)
                first = b.block * FAN ** block_folds
                for a in range(0, b.leaves, 256):
                    part = found[a:a + 256]
                    yield pd.DataFrame({
                        "tree": b.tree, "at": np.arange(first + a, first + a + len(part)),
                        "lefts": [[*[x for x, _ in p], *b.lefts] for p in part],
                        "rights": [[*[x for _, x in p], *b.rights] for p in part]})

    wide = _with_context(blocks, above, ["tree", "block", "leaves", "folds", "nodes"])
    return staged(wide.mapInPandas(descend, _ABOVE), "siblings")


def contexts(levels: list[DataFrame], tops: DataFrame, block_folds: int = BLOCK_FOLDS) -> DataFrame:
    """Siblings from the roots of the lowest blocks to the top; ``tops`` has those of the whole trees."""
    above = None
    for blocks in reversed(levels):
        alone = blocks.groupBy("tree").agg(F.count("*").alias("n"), F.max("block").alias("at")).where(F.col("n") == 1)
        start = tops.join(alone, "tree").select("tree", "at", "lefts", "rights")
        known = start if above is None else above.unionByName(start)  # a tree has one block at its highest level only
        if blocks is levels[0]:
            return known
        above = _descended(blocks, known, block_folds)
    raise ValueError("no levels")


# --- the manifest ----------------------------------------------------------------

def leaf(columns: Iterable[Column]) -> Column:
    """Hex digest of a row's values, each with its length in bytes; ``-`` where one is missing."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def manifest(docs: DataFrame, columns: Iterable[str] = LEAF_COLUMNS, id_col: str = "doc_id", group: str = "source",
             found: dict[str, Column] | None = None, block_folds: int = BLOCK_FOLDS
             ) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Leaves with their places, the blocks of the group trees, and those of the tree over the groups.

    ``found`` gives what a column holds when the rows are verified; without it they are unchanged.
    """
    own = leaf([F.col(c) for c in columns])
    seen = leaf([(found or {}).get(c, F.col(c)) for c in columns]) if found else own
    rows = staged(docs.select(
        F.col(id_col).alias("d"), F.col(group).alias("g"), F.unhex(own).alias("digest"), F.unhex(seen).alias("found")), "leaves")
    rows = numbered(rows, ["g", "d", "digest"], "number")
    rows = staged(rows, "leaves-in-order")
    starts = rows.groupBy("g").agg(F.min("number").alias("start"))
    starts = staged(numbered(starts, ["g"], "tree"), "groups")
    placed = staged(rows.join(starts, rows["g"].eqNullSafe(starts["g"])).select(
        "d", "tree", (F.col("number") - F.col("start")).alias("at"), "digest", "found"), "places")
    levels = trees(placed.select("tree", "at", "digest"), block_folds)
    subroots = staged(roots(levels), "subroots")
    leaves = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.col("root").alias("digest"))
    top = trees(staged(leaves, "group-leaves"), block_folds)
    return placed, levels, top


_PROOF = "d STRING, leaf STRING, subroot STRING, root STRING, proof_sha256 STRING, folded_root STRING"


def prove(docs: DataFrame, columns: Iterable[str] = LEAF_COLUMNS, id_col: str = "doc_id", group: str = "source",
          found: dict[str, Column] | None = None, block_folds: int = BLOCK_FOLDS) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``proof_sha256`` is the hash of all siblings from the leaf to the root. ``folded_root`` is recomputed
    from the leaf as it is ``found`` and the stored siblings; ``verified`` tells whether it is the root.
    Missing ids come first in their group and a missing group is the first; rows with the same id
    stand in the order of their digests, and repeated rows are leaves of their own. Empty texts, and very
    long ones, are leaves like any other. An empty table has no tree and gives an empty result. Columns of
    ``docs`` that are not named have no influence.
    """
    placed, levels, top = manifest(docs, columns, id_col, group, found, block_folds)
    no_one = F.array().cast("array<string>")
    whole = top[-1].select("tree").distinct().select("tree", no_one.alias("lefts"), no_one.alias("rights"))
    groups = _descended(top[0], contexts(top, whole, block_folds), block_folds)
    tops = groups.select(F.col("at").alias("tree"), "lefts", "rights")
    blocks = _with_context(levels[0], contexts(levels, tops, block_folds), ["tree", "block", "leaves", "folds", "nodes"])
    ends = roots(levels).withColumnRenamed("root", "subroot")
    root = roots(top).first()
    root = root.root.hex() if root else ""
    blocks = staged(blocks.join(ends, "tree"), "lowest-blocks")
    full = FAN ** block_folds
    mine = placed.withColumn("block", F.expr(f"at div {full}")).select(
        "tree", "block", "at", F.col("d").cast("string").alias("d"), "found")

    def proofs(keys: tuple, rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=["d", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
        b = block.iloc[0]
        nodes = np.frombuffer(b["nodes"], np.uint8).reshape(-1, WIDTH)
        leaves, folds = int(b["leaves"]), int(b["folds"])
        inner, beyond = paths(nodes, leaves, folds), list(zip(b["lefts"], b["rights"]))
        upper = "".join(x + y for x, y in beyond).encode()
        digests = nodes[addresses(leaves, folds, 0)]
        rows = rows.sort_values("at")
        proof, folded = [], []
        for k, digest in zip((rows["at"] % full).tolist(), rows["found"]):
            proof.append(sha256("".join(x + y for x, y in inner[k]).encode() + upper).hexdigest())
            folded.append(climbed(climbed(digest.hex(), inner[k]), beyond))
        return pd.DataFrame({
            "d": rows["d"], "leaf": [x.tobytes().hex() for x in digests], "subroot": b["subroot"].hex(), "root": root,
            "proof_sha256": proof, "folded_root": folded})

    out = mine.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(proofs, _PROOF)
    kind = docs.schema[id_col].dataType
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumn("d", F.col("d").cast(kind)) \
        .withColumnRenamed("d", id_col)
