"""Token ids of a corpus as flat binary files with 64-bit document offsets.

The format, in one folder of the shared storage:

* ``tokens-*.bin``: ids as little-endian unsigned integers, 16 bits wide if the vocabulary
  allows it, else 32; documents in ascending order of their id, files in ascending order too;
* ``offsets-*.bin``: signed 64-bit, one more than the file has documents, counted from the
  start of the file;
* ``ids-*.bin``: signed 64-bit document ids (a missing id is the smallest number);
* ``manifest``: Parquet, a row per file with its number of documents and ids and its base:
  the ids in all files before it, a prefix sum over the files.

Files are named after the attempt that wrote them, and only those in the manifest count, so
a repeated task does no harm. Where the folder is on a local disk, files are memory-mapped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.llm.common import hidden
from odolake.llm.tokens import BYTE_LEVEL, encoder
from odolake.session import staging_path

TASK_BYTES = 64 << 20  # of text that one task encodes; it streams, so this is no bound of memory, and a large corpus takes more
FILE_BYTES = 64 << 20  # a file ends with the document that reaches so many bytes of ids
NO_ID = np.iinfo(np.int64).min
READ_ROWS = 2_000  # documents per batch when reading back

MANIFEST = "task int, part int, stem string, n_docs long, n_tokens long"


def _storage(root: str):
    """The file system of a folder and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def write(
    docs: DataFrame, tokenizer: str, root: str | None = None, id_col: str = "doc_id", text: str = "text", end_id: int = 0,
    vocabulary: int = 50_257, task_bytes: int = TASK_BYTES, file_bytes: int = FILE_BYTES,
) -> str:
    """Encode ``docs`` into files below ``root`` and return that folder.

    A missing text is an empty one; every document ends with ``end_id``. Documents without
    an id come first; rows with the same id stand together, by a hash of their text. Tasks take ranges of
    ids, as many as the bytes of all texts ask for, and a task begins a new file when one is full.
    """
    spark = docs.sparkSession
    root = root or staging_path(spark, "token-files")
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype).tobytes()
    width = np.dtype(dtype).itemsize

    def written(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, BYTE_LEVEL, dtype)
        store, folder = _storage(root)
        store.create_dir(folder, recursive=True)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        number, n, total, files, stem = 0, 0, 0, [], ""

        def closed() -> pd.DataFrame:
            for f in files:
                f.close()
            return pd.DataFrame({"task": [task], "part": [number], "stem": [stem], "n_docs": [n], "n_tokens": [total]})

        for frame in frames:
            ids = [x + end for x in encode(frame["t"])]
            doc, lengths, a = frame["d"].to_numpy(), np.array([len(x) for x in ids], np.int64), 0
            while a < len(ids):
                if not files:
                    n, total, stem = 0, 0, f"{task:06d}-{number:04d}-{attempt}"
                    files = [store.open_output_stream(f"{folder}/{kind}-{stem}.bin") for kind in ("tokens", "offsets", "ids")]
                    files[1].write(np.zeros(1, "<i8").tobytes())
                upto = total * width + np.cumsum(lengths[a:])
                full = int(np.searchsorted(upto, file_bytes))  # the document that ends the file
                b = min(a + full + 1, len(ids))
                files[0].write(b"".join(ids[a:b]))
                files[1].write((upto[:b - a] // width).astype("<i8").tobytes())
                files[2].write(doc[a:b].astype("<i8").tobytes())
                n, total = n + b - a, int(upto[b - a - 1]) // width
                if full < len(upto):
                    yield closed()
                    files, number = [], number + 1
                a = b
        if files:
            yield closed()

    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))
    source = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID))).alias("d"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("h"),
        F.col(text).alias("t"))
    dealt = source.repartitionByRange(tasks, "d", "h").sortWithinPartitions("d", "h")
    rows = dealt.mapInPandas(written, MANIFEST).toPandas()  # a row per file
    rows = rows.sort_values(["task", "part"], ignore_index=True)
    rows["part"] = np.arange(len(rows), dtype=np.int32)
    rows["base"] = rows["n_tokens"].cumsum() - rows["n_tokens"]
    rows["dtype"] = dtype
    spark.createDataFrame(rows, f"{MANIFEST}, base long, dtype string").coalesce(1).write.parquet(f"{root}/manifest")
    return root


def read(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts all ids before the document; the checksum is taken over the ids as
    little-endian 32-bit integers.
    """

    def load(store, path: str, dtype: str) -> np.ndarray:
        if store.type_name == "local":
            return np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.zeros(0, dtype)
        with store.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype)

    def documents(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _storage(root)
        for frame in frames:
            for f in frame.itertuples():
                tokens, offsets, ids = (load(store, f"{folder}/{kind}-{f.stem}.bin", t) for kind, t in (
                    ("tokens", f.dtype), ("offsets", "<i8"), ("ids", "<i8")))
                for a in range(0, f.n_docs, READ_ROWS):
                    b = min(a + READ_ROWS, f.n_docs)
                    edges = offsets[a:b + 1]
                    yield pd.DataFrame({
                        "doc_id": ids[a:b], "start": f.base + edges[:-1], "n_tokens": np.diff(edges),
                        "ids_crc32": [zlib.crc32(tokens[x:y].astype("<u4").tobytes()) for x, y in zip(edges, edges[1:])],
                    })

    files = spark.read.parquet(f"{root}/manifest")
    count = max(1, files.count())
    dealt = files.withColumnRenamed("part", hidden(files, "file")).repartitionById(
        count, F.pmod(F.col("file"), F.lit(count)))
    out = dealt.mapInPandas(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")))
