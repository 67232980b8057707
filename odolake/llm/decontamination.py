"""Documents that hold benchmark items, also altered ones: q-gram filter, then banded alignment.

An item of ``m`` characters counts as contained if some stretch of the document is within
``k`` edits of it, ``k = edit_rate * m``. Then at least ``m - q + 1 - k * q`` of its q-grams
occur in the document, on diagonals (place in the document minus place in the item) that
span no more than ``k + 1``. Diagonals are therefore dealt into overlapping bands, twice that
wide and one such width apart: one band holds all of them. Bands with fewer shared q-grams
than the bound are dropped without loss; the text of the others is aligned with the item.
An item so short that ``k`` edits could spoil all its q-grams gets shorter ones, of at most
``m / (k + 1)`` characters, so the bound is never below one and no item loses any of its edits.

Documents never move. The benchmark is taken in blocks of bounded size, each one broadcast
as an index and held against all documents; with several blocks each one's result is
written before the next is sent, so one index is held at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.llm.common import staged
from odolake.llm.words import mix

Q = 8
EDIT_RATE = 0.1
BLOCK_CHARS = 4_000_000  # characters of the benchmark in one broadcast
CHUNK_CHARS = 500_000  # characters of documents that are looked at together
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def normal(text: str) -> str:
    """Lower case, single blanks."""
    return " ".join(text.lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, out = codes.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(q):
        out = out * _PRIME + wide[k:k + n]
    return mix(out)


def allowed_edits(sizes: np.ndarray, edit_rate: float) -> np.ndarray:
    return np.floor(sizes * edit_rate + 1e-9).astype(np.int64)


def gram_length(size: int, q: int, edit_rate: float) -> int:
    """``q``, or as much less as leaves one q-gram whole after all the edits of an item of so many characters."""
    k = int(allowed_edits(np.array([size]), edit_rate)[0])
    return min(q, max(1, size // (k + 1))) if k else q


@dataclass
class Index:
    """Items of a block of the benchmark by their q-grams; all of them with q-grams of one length."""

    ids: list
    texts: list[str]
    q: int
    edits: np.ndarray  # k of each item
    bound: np.ndarray  # shared q-grams that k edits leave at least
    grams: np.ndarray  # sorted
    first: np.ndarray  # where the places of a gram begin
    item: np.ndarray
    place: np.ndarray
    may_be: np.ndarray  # by the upper bits of a hash
    short: list[int]  # items with fewer than q characters

    @classmethod
    def build(cls, rows: list[tuple], q: int, edit_rate: float) -> Index:
        ids, texts = [r[0] for r in rows], [normal(r[1]) for r in rows]
        sizes = np.array([len(t) for t in texts], np.int64)
        edits = allowed_edits(sizes, edit_rate)
        hashes, item, place = [], [], []
        for k, t in enumerate(texts):
            h = gram_hashes(points(t), q)
            hashes.append(h)
            item.append(np.full(len(h), k))
            place.append(np.arange(len(h)))
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        may_be = np.zeros(1 << _BITS, bool)
        may_be[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        whole = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])[order]
        return cls(ids, texts, q, edits, sizes - q + 1 - edits * q, grams, np.append(first, len(h)),
                   whole(item), whole(place), may_be, [k for k, t in enumerate(texts) if 0 < len(t) < q])

    def candidates(self, codes: np.ndarray, of: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Document number, item and lowest diagonal of the bands that meet the bound.

        ``codes`` are documents behind each other; ``of`` and ``start`` tell a character's
        document and where that begins.
        """
        if not len(self.grams):
            return
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.may_be[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        gram = np.searchsorted(self.grams, h[at])
        gram[gram == len(self.grams)] = 0
        real = (self.grams[gram] == h[at]) & (of[at] == of[np.minimum(at + self.q - 1, len(of) - 1)])
        at, gram = at[real], gram[real]
        if not len(at):
            return
        times = self.first[gram + 1] - self.first[gram]
        entry = np.repeat(self.first[gram] - np.cumsum(times) + times, times) + np.arange(times.sum())
        at = np.repeat(at, times)
        item = self.item[entry]
        reach = int(self.edits.max()) + max(map(len, self.texts)) + 1  # diagonals may be negative
        diagonal = at - start[at] - self.place[entry] + reach
        band = diagonal // (self.edits[item] + 1)
        bands = int(band.max()) + 1
        key = (of[at].astype(np.int64) * len(self.texts) + item) * bands + band
        key, count = np.unique(key, return_counts=True)
        upper = np.searchsorted(key, key + 1)
        upper[upper == len(key)] = 0
        count = count + np.where((key[upper] == key + 1) & (key % bands != bands - 1), count[upper], 0)
        item = key // bands % len(self.texts)
        kept = count >= self.bound[item]
        for k, i in zip(key[kept].tolist(), item[kept].tolist()):
            yield k // bands // len(self.texts), i, (k % bands) * int(self.edits[i] + 1) - reach

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """Document number, item, start, end (in the normalised text) and edits; the best place of each item."""
        flat = [normal(t) for t in texts]
        codes = points("".join(flat))
        sizes = np.array([len(t) for t in flat], np.int64)
        of, start = np.repeat(np.arange(len(flat)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        seen = set()
        for doc, item, low in self.candidates(codes, of, start):
            k, m = int(self.edits[item]), len(self.texts[item])
            a, b = max(0, low - k), min(len(flat[doc]), low + 3 * k + 2 + m)  # edits at the ends may leave the band
            if best.get((doc, item), (1,))[0] == 0 or (doc, item, a, b) in seen:
                continue
            seen.add((doc, item, a, b))
            found = align(self.texts[item], flat[doc][a:b], k)
            if found and ((doc, item) not in best or found < best[doc, item]):
                best[doc, item] = (found[0], found[1] + a, found[2] + a)
        for item in self.short:  # k is 0 there
            for doc, t in enumerate(flat):
                at = t.find(self.texts[item])
                if at >= 0:
                    best[doc, item] = (0, at, at + len(self.texts[item]))
        for (doc, item), (edits, a, b) in sorted(best.items()):
            yield doc, item, a, b, edits


def _last_row(item: np.ndarray, region: np.ndarray, k: int) -> np.ndarray:
    """Edits of the whole item against the best stretch of the region that ends at each place."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for n, c in enumerate(item, 1):
        fresh = np.empty_like(row)
        fresh[0] = n
        np.minimum(row[:-1] + (region != c), row[1:] + 1, out=fresh[1:])
        row = np.minimum.accumulate(fresh - steps) + steps
        if row.min() > k:
            break
    return row


def align(item: str, region: str, k: int) -> tuple[int, int, int] | None:
    """Fewest edits, start and end of the item in a band's region, or None beyond ``k`` edits.

    The region holds the diagonals of one band and ``k`` more on each side: the table is that band.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if k == 0:
        return None
    a, b = points(item), points(region)
    row = _last_row(a, b, k)
    end = int(row.argmin())
    if row[end] > k:
        return None
    back = _last_row(a[::-1], b[:end][::-1], k)
    return int(row[end]), end - int(back.argmin()), end


def _blocks(benchmark: DataFrame, item_id: str, text: str, q: int, edit_rate: float) -> Iterator[tuple[list[Index], bool]]:
    """Blocks of the benchmark, an index for each length of q-grams; and whether there is more than one block."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where(
        F.length(F.btrim("t")) > 0)
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    count = -(-chars // BLOCK_CHARS)
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k)
        block: dict[int, list] = {}
        for r in part.collect():
            if size := len(normal(r.t)):
                block.setdefault(gram_length(size, q, edit_rate), []).append((r.i, r.t))
        if block:
            yield [Index.build(items, length, edit_rate) for length, items in sorted(block.items())], count > 1


def _looked_at(texts: list, indexes: list[Index]) -> Iterator[tuple]:
    """Document number, item id, start, end and edits of a batch's matches, a bounded number of characters at a time."""
    a, size = 0, 0
    for b in range(len(texts)):
        size += len(texts[b] or "")
        if size >= CHUNK_CHARS or b == len(texts) - 1:
            for index in indexes:
                for doc, item, *rest in index.matches([t or "" for t in texts[a:b + 1]]):
                    yield doc + a, index.ids[item], *rest
            a, size = b + 1, 0


def contained(
    docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE, id_col: str = "doc_id",
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and item it holds: id, ``item_id, start, end, edits``.

    An item is held if a stretch of the document is within a tenth of the item's characters (rounded down) in
    edits of it, whatever its length. Compared after lower-casing and with single blanks; start and end count characters of
    that form. Missing and empty texts hold nothing, empty items are held by none, items
    of less than ten characters must occur unchanged. Repeated rows are reported as often as they occur.
    """
    spark: SparkSession = docs.sparkSession
    kinds = [docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start long, end long, edits int"
    source = docs.select(F.col(id_col).alias("d"), F.col(text).alias("t"))
    out = None
    for indexes, several in _blocks(benchmark, item_id, item_text, q, edit_rate):
        sent = spark.sparkContext.broadcast(indexes)

        def look(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_looked_at(batch.column("t").to_pylist(), sent.value))
                if found:
                    doc, item, a, b, edits = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("d").take(pa.array(doc)), pa.array(item), pa.array(a, pa.int64()),
                         pa.array(b, pa.int64()), pa.array(edits, pa.int32())],
                        names=["doc_id", "item_id", "start", "end", "edits"])

        part = source.mapInArrow(look, schema)
        if several:
            part = staged(part, "contained")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE, text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, as they are.

    Rows with a missing or empty text stay, and of repeated rows all or none. An empty benchmark removes nothing.
    """
    position = docs.columns.index(text)
    for indexes, several in _blocks(benchmark, item_id, item_text, q, edit_rate):
        sent = docs.sparkSession.sparkContext.broadcast(indexes)

        def clean(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = {doc for doc, *_ in _looked_at(batch.column(position).to_pylist(), sent.value)}
                yield batch.filter(pa.array([k not in found for k in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
        if several:
            docs = staged(docs, "decontaminated")
            sent.destroy()
    return docs
