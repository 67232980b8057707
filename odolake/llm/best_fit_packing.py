"""Packing of documents into sequences: best fit in each partition, then residual rounds.

A document is its token ids and an end id. Only documents longer than a sequence are cut,
into full pieces and a shorter last one. Pieces are dealt over the partitions whatever their
order in the input, and each partition packs its own by best fit, the longest first. Nearly
full bins are emitted; underfull bins become the items of the next round, until no two of
them fit together.

Two bins above half a sequence never fit together, and a packing leaves one bin of half a
sequence or less at most. So a round takes the bins up to half, and as many of the others as
there are of those, the emptiest: whatever could be merged with a fuller one could be merged
with one of these. A task packs at most ``BLOCK`` items at a time, so its memory does not
depend on the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import staged
from odolake.llm.sharding import numbered
from odolake.llm.tokens import WORD_LEVEL, encoder

CAPACITY = 2048
SLACK = 16  # a bin with no more room than this is nearly full
BLOCK = 200_000  # items that are packed together
DEALT = 25_000  # pieces of a partition in the first packing

PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each item, its offset there, and the fill of each bin; longest items first.

    Open bins are kept by the room they have; the bits of one integer tell which rooms occur.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins[k], offsets[k] = bin_, capacity - room
        room -= size
        fills[bin_] = capacity - room
        if room:
            if not by_room[room]:
                rooms |= 1 << room
            by_room[room].append(bin_)
    return bins, offsets, np.array(fills, np.int64)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text: str, end_id: int) -> DataFrame:
    """One row per piece of a document; a missing text is an empty one."""

    def cut(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, WORD_LEVEL, "<u4")
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            out = []
            for doc, ids in zip(frame["d"], encode(frame["t"])):
                ids += end
                for start in range(0, len(ids), 4 * capacity):
                    part = ids[start:start + 4 * capacity]
                    out.append((doc, start // (4 * capacity), start // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": frame["d"].dtype})

    source = docs.select(F.col(id_col).alias("d"), F.col(text).alias("t"))
    return source.mapInPandas(cut, PIECE.format(id=docs.schema[id_col].dataType.simpleString()))


def _round(items: DataFrame, size: str, capacity: int, number: int) -> DataFrame:
    """``items`` with ``bin``, ``at`` (offset there) and ``fill`` of the bin."""

    def pack(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = (number << 56) | (TaskContext.get().partitionId() << 34)

        def packed(held: list[pd.DataFrame]) -> pd.DataFrame:
            nonlocal made
            frame = pd.concat(held) if len(held) > 1 else held[0]
            bins, at, fills = best_fit(frame[size].to_numpy(), capacity)
            frame = frame.assign(bin=bins + made, at=at, fill=fills[bins])
            made += len(fills)
            return frame

        held: list[pd.DataFrame] = []
        for frame in frames:
            if len(frame):
                held.append(frame)
            if sum(map(len, held)) >= BLOCK:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInPandas(pack, f"{fields}, bin long, at long, fill long")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text", end_id: int = 0,
    slack: int = SLACK,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``start`` counts the document's ids before the piece; the pieces of a sequence stand
    without gaps from offset 0. Missing and empty texts are a piece of one end id. Repeated
    rows are packed as often as they occur; other columns of ``docs`` are left out.
    """
    cut = staged(pieces(docs, tokenizer, capacity, id_col, text, end_id), "pieces")
    dealt = cut.repartition(max(1, -(-cut.count() // DEALT)))
    first = staged(_round(dealt, "length", capacity, 0), "packed")
    placed: list[DataFrame] = []
    rows = first
    while True:
        underfull = (F.col("at") == 0) & (F.col("fill") < capacity - slack)  # the first item stands for its bin
        left = rows.where(underfull).select(F.col("bin").alias("id"), F.col("fill").alias("size"))
        low = 2 * F.col("size") <= capacity
        has = left.agg(F.count_if(low).alias("low"), F.min(F.when(low, F.col("size"))).alias("least"),
                       F.min(F.when(~low, F.col("size"))).alias("next")).first()
        if not has.low or has.low == 1 and (has.next is None or has.least + has.next > capacity):
            break
        others = left.where(~low & (F.col("size") <= capacity - has.least))
        emptiest = numbered(others, ["size", "id"], "n").where(F.col("n") < has.low).drop("n")
        parts = -(-2 * has.low // BLOCK)
        met = left.where(low).unionByName(emptiest).repartition(parts)
        rows = staged(_round(met, "size", capacity, len(placed) + 1), "residual")
        placed.append(rows)
    return first.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "bin", "at",
    ).transform(lambda df: _settled(df, placed))


def _settled(first: DataFrame, placed: list[DataFrame]) -> DataFrame:
    """Follow every bin through the rounds to its sequence."""
    where = None
    for rows in reversed(placed):
        step = rows.select("id", "bin", "at")
        if where is not None:
            step = step.join(where, step["bin"] == where["from"], "left").select(
                "id", F.coalesce("to", "bin").alias("bin"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("at"))
        where = step.select(F.col("id").alias("from"), F.col("bin").alias("to"), F.col("at").alias("base"))
    if where is None:
        return first.withColumnsRenamed({"bin": "sequence_id", "at": "offset"})
    out = first.join(where, first["bin"] == where["from"], "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"),
                      (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"))
