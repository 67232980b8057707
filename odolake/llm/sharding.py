"""Minimax contiguous sharding: the smallest capacity that cuts ordered groups into so many shards.

Documents with one text form an atomic group; groups are ordered by the hash of the text.
The capacity of the fullest shard is found by binary search: a capacity is feasible if
filling shard after shard as far as it goes needs no more than the given number.

Groups stay in tables. Their running sums (the places where a cut may fall) come to the
driver as an index of at most ``INDEX_ROWS`` places. Between two places of the index the
greedy check is bracketed: cutting at known places only gives a feasible capacity, cutting
anywhere a lower bound. The places that can still matter lie in one narrow stretch per
shard; the index is refined there until both bounds meet. The answer is exact.

The greedy check's cuts only prove the capacity: where one group is larger than an average
shard they leave the last shards empty. The cuts that are used are, of all cuts at known
places under that capacity, those with the least sum of squared shard sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from odolake.llm.common import hidden, staged, text_key

SHARDS = 40
OVERHEAD = 16  # bytes that a document takes besides its text
INDEX_ROWS = 100_000  # besides the places at groups larger than an average shard
BUCKET_GROUPS = 20_000  # groups that one bucket of the running sum holds on average


@dataclass
class Places:
    """Known running sums where a cut may fall, and whether there are others right before each."""

    ends: np.ndarray
    dense: np.ndarray

    def cut(self, limit: int, optimistic: bool) -> int:
        """The last place up to ``limit``; optimistic: or what an unknown place there could be."""
        k = int(np.searchsorted(self.ends, limit, side="right"))
        known = int(self.ends[k - 1]) if k else 0
        if optimistic and k < len(self.ends) and self.dense[k]:
            return max(known, min(limit, int(self.ends[k]) - 1))
        return known

    def cuts(self, capacity: int, shards: int, optimistic: bool) -> list[int] | None:
        """The end of each shard under the greedy check, or None if the capacity is too small."""
        total, at, out = int(self.ends[-1]), 0, []
        for _ in range(shards):
            at = total if at + capacity >= total else self.cut(at + capacity, optimistic)
            out.append(at)
            if at == total:
                return out
            if len(out) > 1 and out[-2] == at or at == 0:
                return None
        return None

    def even(self, capacity: int, shards: int) -> list[int]:
        """The end of each shard, none above ``capacity``, with the least sum of squared sizes.

        One pass per shard over the places where it may end. The best place to begin a shard
        never moves back as its end moves on, so each pass halves the distance of the ends
        it has solved and looks between the beginnings of their neighbours only.
        """
        ends = np.concatenate([[0], self.ends])
        first, last = [len(ends) - 1], [0]
        for _ in range(shards):
            first.append(int(np.searchsorted(ends, max(0, ends[first[-1]] - capacity))))
            last.append(int(np.searchsorted(ends, ends[last[-1]] + capacity, side="right")) - 1)
        first.reverse()
        x, cost, begins = ends * (shards / ends[-1]), np.zeros(1), []
        for k in range(shards):
            at = np.arange(first[k + 1], last[k + 1] + 1)
            low = np.maximum(first[k], np.searchsorted(ends, ends[at] - capacity))
            high, least, begin = np.minimum(last[k], at), np.zeros(len(at)), np.zeros(len(at), np.int64)
            step = 1 << len(at).bit_length()
            while step:
                mine = np.arange(step, len(at) + 1, 2 * step) - 1
                step //= 2
                if not len(mine):
                    continue
                far = 2 * step or 1
                a, b = low[mine], high[mine]
                a[1:] = np.maximum(a[1:], begin[mine[1:] - far])
                solved = mine + far < len(at)
                b[solved] = np.minimum(b[solved], begin[mine[solved] + far])
                upto = np.cumsum(b - a + 1)
                start = upto - (b - a + 1)
                begin_at = np.arange(upto[-1]) - np.repeat(start - a, b - a + 1)
                tried = cost[begin_at - first[k]] + (np.repeat(x[at[mine]], b - a + 1) - x[begin_at]) ** 2
                least[mine] = np.minimum.reduceat(tried, start)
                best = np.flatnonzero(tried == np.repeat(least[mine], b - a + 1))
                begin[mine] = begin_at[best[np.searchsorted(best, upto) - 1]]  # the last one: empty shards come last
            cost = least
            begins.append(begin)
        out = [len(ends) - 1]
        for k in range(shards - 1, 0, -1):
            out.append(int(begins[k][out[-1] - first[k + 1]]))
        return [int(ends[k]) for k in reversed(out)]

    def smallest(self, shards: int, optimistic: bool, low: int, high: int) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, optimistic) is None:
                low = middle + 1
            else:
                high = middle
        return low


def running(groups: DataFrame, columns: list[str]) -> DataFrame:
    """Adds running sums ``{column}_to`` in the order of ``key``, without a global sort.

    Keys are hashes, so their upper bits deal them into even buckets; sums of the buckets give the bases.
    """
    count = groups.count()
    bits = max(6, min(20, int(np.ceil(np.log2(max(1, count / BUCKET_GROUPS))))))
    cut = groups.withColumn("bucket", F.shiftright(F.col("key"), 64 - bits))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    bases = cut.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).select(
        "bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_base") for c in columns])
    inside = W.partitionBy("bucket").orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = cut.select("*", *[F.sum(c).over(inside).alias(f"{c}_in") for c in columns]).join(bases, "bucket")
    return out.select(*groups.columns, *[(F.col(f"{c}_in") + F.col(f"{c}_base")).alias(f"{c}_to") for c in columns])


def _index(groups: DataFrame, stretches: list[tuple[int, int]] | None, width: int) -> np.ndarray:
    """Per slice of ``width`` bytes the last place in it and their number; only inside the stretches."""
    place = F.col("size_to")
    rows = groups
    if stretches is not None:
        inside = F.lit(False)
        for a, b in stretches:
            inside = inside | place.between(a, b)
        rows = groups.where(inside)
    slices = rows.groupBy(F.floor(place / width).alias("slice")).agg(F.max(place).alias("end"), F.count("*").alias("n"))
    found = slices.select("end", "n").toPandas().sort_values("end")  # no more rows than slices
    return found.to_numpy(dtype=np.int64).reshape(-1, 2)


def smallest_capacity(groups: DataFrame, shards: int, index_rows: int = INDEX_ROWS) -> tuple[int, list[int]]:
    """Capacity of the fullest shard and the running sum at the end of each shard.

    ``groups`` has ``size`` and its running sum ``size_to``. Groups larger than an average shard
    do not count for the width of the index, so what lies between them is seen as finely without them.
    """
    whole = groups.agg(F.max("size_to").alias("total"), F.max("size").alias("most")).first()
    if not whole.total:
        return 0, []
    low, high = max(-(-whole.total // shards), whole.most), -(-whole.total // shards) + whole.most
    small = groups.where(F.col("size") <= whole.total // shards).agg(F.sum("size").alias("bytes")).first()
    stretches, width = None, max(1, (small.bytes or 0) // index_rows)
    known = np.zeros((0, 2), np.int64)
    while True:
        fresh = _index(groups, stretches, width)
        merged = np.unique(np.concatenate([known[:, 0], fresh[:, 0]]))
        dense = np.zeros(len(merged), bool)
        if stretches is None:
            dense[np.searchsorted(merged, fresh[fresh[:, 1] > 1, 0])] = True
        else:  # what was unknown outside the stretches stays so
            dense[np.searchsorted(merged, known[known[:, 1] > 1, 0])] = True
            for a, b in stretches:
                x, y = np.searchsorted(merged, [a, b + 1])
                dense[x:y] = False
                if y < len(merged) and merged[y] > b:
                    dense[y] = True
            dense[np.searchsorted(merged, fresh[fresh[:, 1] > 1, 0])] = True
        known = np.stack([merged, np.where(dense, 2, 1)], 1)
        places = Places(merged, dense)
        high = places.smallest(shards, False, low, high)
        low = places.smallest(shards, True, low, high)
        if low == high or width == 1:
            return high, places.even(high, shards)
        firm, far = places.cuts(low, shards, False) or [], places.cuts(high, shards, True)
        stretches = []
        for k, b in enumerate(far):
            a = firm[k] if k < len(firm) else _walk(places, low, k + 1)
            stretches.append((min(a, b), b))
        wide = sum(b - a + 1 for a, b in stretches)
        width = max(1, min(width // 2, -(-wide // index_rows)))


def _walk(places: Places, capacity: int, shards: int) -> int:
    """Where the greedy check stands after so many shards, by known places."""
    at, total = 0, int(places.ends[-1])
    for _ in range(shards):
        at = total if at + capacity >= total else places.cut(at + capacity, False)
    return at


def _above(key: Column, keys: list[int]) -> Column:
    """How many of the sorted ``keys`` are below ``key``."""
    out = F.lit(0)
    for k in keys:
        out = out + (key > F.lit(k)).cast("int")
    return out


def numbered(rows: DataFrame, order: list[str], column: str) -> DataFrame:
    """Rows numbered from 0 in the order of ``order``; sorted by ranges, so equal keys may span partitions."""
    part, local = "_part", "_local"
    kept = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    index = F.monotonically_increasing_id()
    kept = staged(kept.select("*", F.shiftright(index, 33).alias(part), index.bitwiseAND(F.lit((1 << 33) - 1)).alias(local)),
                  "numbered")
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    bases = kept.groupBy(part).agg(F.count("*").alias("n")).select(
        part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return kept.join(bases, part).withColumn(column, F.col("_base") + F.col(local)).drop(part, local, "_base")


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text",
          overhead: int = OVERHEAD) -> DataFrame:
    """One row per row of ``docs``: id, ``size, text_crc32, law, shard, slot, grown_shard``.

    Shards differ as little as contiguous cuts between whole groups allow: the fullest one is
    as small as it can be. ``slot`` counts a shard's documents from 0, by group and id. A
    missing text has no bytes and is a group of its own; repeated rows get slots of their own.
    With few groups some shards stay empty.
    """
    own = hidden(docs, "s_id")
    lean = staged(docs.select(
        F.col(id_col).alias(own), text_key(F.col(text)).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).alias("text_crc32")), "sizes")
    groups = lean.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    groups = staged(running(staged(groups, "groups"), ["size", "rows"]), "places")
    _, cuts = smallest_capacity(groups, shards)
    ends = groups.where(F.col("size_to").isin(cuts[:-1])).select("key", "rows_to").collect()  # a row per shard
    ends = sorted((r.key, r.rows_to) for r in ends)
    rows = numbered(lean, ["key", own], "number")
    number, start = _above(F.col("key"), [k for k, _ in ends]), F.lit(0).cast("bigint")
    for k, upto in ends:
        start = F.when(F.col("key") > F.lit(k), F.lit(upto)).otherwise(start)
    return rows.select(
        F.col(own).alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), number.cast("int").alias("shard"),
        (F.col("number") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
