"""Exact dedup, the Merkle manifest and clustering around centroids."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odolake.llm import centroids, exact_dedup, merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact dedup --------------------------------------------------------------

COPIES = [
    (1, "same"), (2, "same"), (3, None), (4, ""), (5, "Same"), (6, "same "), (7, "x" * 64 + "a"), (8, "x" * 64 + "b"),
    (9, "x" * 64 + "a"), (None, "same"), (None, "lonely"), (10, "ten"), (10, "ten"), (10, "other"), (11, "z" * 300_000),
    (12, "z" * 300_000), (13, "y" + "z" * 299_999), (14, "ähnlich"), (15, "ähnlich"), (16, "\U0001F600")]


def frame(spark, rows):
    docs = spark.createDataFrame([(d, t, k, "n") for k, (d, t) in enumerate(rows)],
                                 "doc_id BIGINT, text STRING, size BIGINT, beginning STRING")
    return docs.withColumns({c: F.lit("own") for c in ("digest", "alike", "x_size", "number")})  # names the operator uses too


def by_hand(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = Counter()
    for text, ids in groups.items():
        best = max(ids, key=lambda d: (d is not None, d or 0))
        stays = True
        for d in sorted(ids, key=lambda d: d != best):
            out[d, best, len(ids), stays, sha(text)] += 1
            stays = False
    return out


@pytest.mark.parametrize("rows", [COPIES, [], [(1, "a")], [(None, None)] * 3])
def test_exact_dedup(spark, rows):
    docs = frame(spark, rows)
    out = exact_dedup.duplicates(docs, hash_all=True).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out) == by_hand(rows)
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter(
        (d, t) for t, d in {(t or ""): max((x for x, y in rows if (y or "") == (t or "")), key=lambda x: (x is not None, x or 0))
                            for _, t in rows}.items())


def test_only_groups_that_survive_are_read_whole(spark):
    out = {r.doc_id: r for r in exact_dedup.duplicates(frame(spark, COPIES[:3] + COPIES[4:9])).collect()}
    whole = {d for d, r in out.items() if r.text_sha256 is not None}
    assert whole == {1, 2, 7, 8, 9}  # 5 shares a length only, 3 and 6 not even that; 8 shares the beginning
    assert not out[7].kept and out[9].kept and out[8].kept and out[8].group_size == 1


# --- Merkle manifest ----------------------------------------------------------


def h(*parts):
    return sha("".join(parts))


def plain_tree(leaves):
    """All rows of nodes from the leaves up."""
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([h(*rows[-1][a:a + 16]) for a in range(0, len(rows[-1]), 16)])
    return rows


def plain_path(rows, at):
    out = []
    for row in rows[:-1]:
        first = at - at % 16
        out.append(("".join(row[first:at]), "".join(row[at + 1:first + 16])))
        at //= 16
    return out


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def manifest_by_hand(rows, lower):
    groups = defaultdict(list)
    for d, source, lang, n, text in rows:
        seen = text
        if text is not None and lower(d):
            seen = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups[source].append((d, plain_leaf((d, source, lang, n, text)), plain_leaf((d, source, lang, n, seen))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(plain_tree([leaf for _, leaf, _ in groups[s]]))
    top = plain_tree([t[-1][0] for t in trees])
    out = Counter()
    for k, s in enumerate(names):
        for at, (d, leaf, seen) in enumerate(groups[s]):
            path = plain_path(trees[k], at) + plain_path(top, k)
            folded = seen
            for left, right in path:
                folded = h(left, folded, right)
            out[d, leaf, trees[k][-1][0], top[-1][0], h(*[x + y for x, y in path]), folded, folded == top[-1][0]] += 1
    return out


def altered(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 0


@pytest.mark.parametrize("case", ["mixed", "many groups", "one", "deep", "empty"])
def test_manifest_equals_a_plain_tree(spark, case):
    r = random.Random(case)
    texts = [None, "", "Ab", "ÀB c", "x" * 100_000, "tie"]
    rows = {
        "mixed": [(r.choice([None, *range(400)]), r.choice([None, "a", "a", "a", "ä", "B", ""]), r.choice([None, "en"]),
                   r.choice([None, 7, -7]), r.choice(texts)) for _ in range(700)],
        "many groups": [(k, f"s{k}", "en", k, "T") for k in range(40)],
        "one": [(5, None, None, None, "ONLY")],
        "deep": [(k, "big" if k % 9 else "small", "en", 1, f"Text {k}") for k in range(5000)],
        "empty": [],
    }[case]
    docs = spark.createDataFrame([(*x, "own") for x in rows],
                                 "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, tree STRING")
    docs = docs.withColumn("root", F.lit(1)).withColumn("at", F.lit(2))
    lower = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    folds = {"deep": 1, "many groups": 1}.get(case, merkle.BLOCK_FOLDS)  # one: several levels of blocks
    out = merkle.prove(docs, found={"text": lower}, block_folds=folds).collect()
    assert Counter(tuple(x) for x in out) == manifest_by_hand(rows, altered)


@pytest.mark.parametrize(("leaves", "folds"), [(1, 0), (1, 3), (16, 1), (17, 2), (256, 2), (4095, 3), (4096, 3), (300, 3), (65537, 5)])
def test_layout_uses_every_place_once(leaves, folds):
    used = np.concatenate([merkle.addresses(leaves, folds, up) for up in range(folds + 1)])
    assert np.array_equal(np.sort(used), np.arange(merkle.size(leaves, folds)))
    assert merkle.addresses(leaves, folds, folds)[0] == 0  # the root comes first


def test_upper_half_is_stored_before_each_lower_half():
    # four rows of nodes: the root and its children, then 16 subtrees of a node and its leaves, one after the other
    top = np.concatenate([merkle.addresses(4096, 3, 3), merkle.addresses(4096, 3, 2)])
    assert sorted(top) == list(range(17))
    first = [merkle.addresses(4096, 3, 1)[0], *merkle.addresses(4096, 3, 0)[:16]]
    assert first == list(range(17, 34))


def test_siblings_by_address():
    r = np.random.default_rng(3)
    leaves = r.integers(0, 256, (777, 32), dtype=np.uint8)
    nodes, rows = merkle.built(leaves, 3), plain_tree([x.tobytes().hex() for x in leaves])
    every = merkle.paths(nodes, 777, 3)
    for at in (0, 15, 16, 400, 776):
        want = plain_path(rows, at)
        assert [merkle.siblings(nodes, 777, 3, up, at // 16 ** up) for up in range(3)] == want == every[at]
        assert merkle.climbed(leaves[at].tobytes().hex(), want) == rows[-1][0]


# --- centroids ----------------------------------------------------------------


def clusters_by_hand(rows, k, rounds, width):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))
    c = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[nearest(v)[1]].append(v)
        for n, members in of.items():
            c[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, n, d in found:
        per[n] += d
    return Counter((i, n, d, per[n], sum(per.values()), sha(",".join(map(str, c[n])))) for i, n, d in found)


@pytest.mark.parametrize("case", ["random", "ties", "few", "large", "none"])
def test_clusters_equal_plain_rounds(spark, case):
    r = random.Random(case)
    rows = {
        "random": [(k, [r.gauss(k % 3, 0.5) for _ in range(6)]) for k in range(300)] + [
            (900, None), (901, [1.0]), (902, [1.0, 2.0, None, 0.0, 0.0, 0.0]), (903, [math.nan] * 6), (904, [math.inf] * 6),
            (905, []), (None, [0.5] * 6), (None, [0.25] * 6)],
        "ties": [(k % 5, [float(k % 2)] * 6) for k in range(40)],
        "few": [(1, [0.0, -0.001, 0.0, 0.0, 0.0, 0.0]), (2, [0.0] * 6)],
        "large": [(k, [r.uniform(-1e5, 1e5) for _ in range(6)]) for k in range(60)] + [(99, [1e30] + [0.0] * 5)],
        "none": [],
    }[case]
    vectors = spark.createDataFrame([(i, v, "own", 1) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, id STRING, cluster INT")
    out = centroids.cluster(vectors, clusters=4, rounds=5, components=6, pivots=3).collect()
    held = [x for x in rows if not (x[1] and any(v is not None and math.isfinite(v) and abs(v) * 1024 >= 2 ** 27 for v in x[1]))]
    assert Counter(tuple(x) for x in out) == clusters_by_hand(held, 4, 5, 6)


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_pruning_changes_no_assignment(spread):
    r = np.random.default_rng(5)
    centers = r.integers(-2000, 2000, (8, 64))
    x = (centers[r.integers(0, 8, 3000)] + r.normal(0, 1024 * spread, (3000, 64))).astype(np.int64)
    x[:50] = x[50:100]
    pivots = centroids.chosen_pivots(x[:500], 12)
    c = x[-8:].copy()
    c[3] = c[5]
    root = lambda d: np.sqrt(d.astype(np.float64))
    exact = centroids.squared(x, c)
    assert (centroids.bounds(root(centroids.squared(x, pivots)), root(centroids.squared(c, pivots))) <= exact).all()
    number, distance, done = centroids.nearest(x, root(centroids.squared(x, pivots)), c, root(centroids.squared(c, pivots)))
    assert np.array_equal(number, exact.argmin(axis=1)) and np.array_equal(distance, exact.min(axis=1))
    assert done <= exact.size and (spread > 1 or done < exact.size * 0.5)  # clear clusters need few exact distances
