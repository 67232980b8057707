"""The layers as Parquet tables under one folder, partitioned by date and micro-batch.

A batch of a table is written once: a commit mark tells that it is complete, a repeated call
then does nothing, and the leftovers of a broken attempt are removed before the next one. So
streams, which read the tables as they grow, see every row once. Erasure replaces files under
their own names: a stream that has read a file does not read it again, and one that has not
reads the erased rows as such.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolake import schemas as S
from odolake.functions.timing import instant
from odolake.operators import erasure
from odolake.operators.cleaning import missing_keys
from odolake.session import pinned, staged

_ROW_BITS = 33  # Spark's own limit of rows per partition in monotonically_increasing_id
_BATCH_BITS = 40


def with_batch_ids(rows: DataFrame, batch_id: int, column: str = "id") -> DataFrame:
    """Number the rows of a micro-batch: batch number in the high bits, dense index below.

    Ids grow with the batches and a retried batch gets the same range, with no look at the
    table and no global sort: only the row count of each partition comes to the driver.
    """
    spark = rows.sparkSession
    kept = pinned(rows)
    sizes = kept.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    offsets, total = [], 0
    for s in sizes:
        offsets.append((s.part, (batch_id << _BATCH_BITS) + total))
        total += s.n
    starts = spark.createDataFrame(offsets, "_part INT, _start BIGINT")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = kept.select("*", F.spark_partition_id().alias("_part"), local.alias("_local"))
    return numbered.join(F.broadcast(starts), "_part").withColumn(  # one row per partition
        column, F.col("_start") + F.col("_local") + 1
    ).drop("_part", "_start", "_local")


class Store:
    """Named tables below ``root``; a batch number is written to a table once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _layout(self, name: str) -> tuple[T.StructType, str | None]:
        schema, time = S.TABLES[name]
        parts = [T.StructField("event_date", T.DateType())] if time else []
        return T.StructType([*schema.fields, *parts, T.StructField("batch_id", T.LongType())]), time

    def _folder(self, name: str):
        """The table's folder and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def create(self) -> None:
        """Create the folders of the tables that do not exist yet."""
        for name in S.TABLES:
            folder, files = self._folder(name)
            files.mkdirs(folder)

    def _scan(self, name: str, since=None, batches=None) -> DataFrame:
        layout, time = self._layout(name)
        df = self.spark.read.schema(layout).parquet(self.path(name))
        if batches is not None:
            df = df.where(F.col("batch_id").isin(list(batches)))
        if since is not None and time:
            start = instant(since)
            df = df.where((F.col("event_date") >= F.to_date(start)) & (F.col(time) >= start))
        return df

    def read(self, name: str, since=None, batches=None) -> DataFrame:
        """A table; with ``since`` only rows from then on, pruned by date and pushed to the scan; of some batches only."""
        return self._scan(name, since, batches).select(*S.TABLES[name][0].names)

    def current(self, name: str, since=None) -> DataFrame:
        """A table in which later batches supersede rows of the same key: the newest row of every key, in one shuffle.

        Erased rows have lost their key and are left out.
        """
        names, key = S.TABLES[name][0].names, S.SUPERSEDED_BY[name]
        living = self._scan(name, since).where(F.col("vehicle_id") != S.ERASED)
        rest = F.struct(*[n for n in names if n not in key])
        newest = living.groupBy(*key).agg(F.max_by(rest, "batch_id").alias("_row"))
        return newest.select(*key, "_row.*").select(*names)

    def stream(self, name: str, **options: str) -> DataFrame:
        """The table as a stream of its new files."""
        layout, _ = self._layout(name)
        reader = self.spark.readStream.schema(layout)
        for key, value in options.items():
            reader = reader.option(key, value)
        return reader.parquet(self.path(name)).select(*S.TABLES[name][0].names)

    def _file(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, *parts: str) -> bool:
        path, files = self._file(*parts)
        return files.exists(path)

    def _mark(self, *parts: str) -> None:
        path, files = self._file(*parts)
        files.create(path, True).close()

    def _matching(self, *parts: str) -> list:
        path, files = self._file(*parts)
        return [s.getPath() for s in files.globStatus(path) or []]

    def write_batch(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """Write the rows of one batch; nothing happens if the table has that batch already."""
        if self._exists("_commits", name, str(batch_id)):
            return
        schema, time = S.TABLES[name]
        columns: list[Column] = []
        for f in schema.fields:
            value = F.col(f.name) if f.name in rows.columns else F.lit(None)
            columns.append(value.cast(f.dataType).alias(f.name))
        parts = ["event_date"] if time else []
        if time:
            columns.append(F.to_date(F.col(time)).alias("event_date"))
        for left in self._matching(name, *(["event_date=*"] if time else []), f"batch_id={batch_id}"):
            left.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(left, True)
        out = rows.select(*columns, F.lit(batch_id).cast("bigint").alias("batch_id"))
        # rows of a date together: few files per date, and a large date is still split
        out = out.hint("rebalance", *parts) if parts else out
        out.write.mode("append").partitionBy(*parts, "batch_id").parquet(self.path(name))
        self._mark("_commits", name, str(batch_id))

    def seed_vehicles(self, new: DataFrame, batch_id: int) -> None:
        """Add the vehicles that are not known yet."""
        self.write_batch("vehicle_metadata", missing_keys(new, self.read("vehicle_metadata")), batch_id)

    def _stage_rewrite(self, name: str, is_hit: Callable, change: Callable, folder: str) -> list[tuple[str | None, str]]:
        """New versions of the files with a hit, written aside: (new file or None if it is empty, its place)."""
        data, _ = S.TABLES[name]
        layout, _ = self._layout(name)
        rows = self.spark.read.schema(layout).parquet(self.path(name)).withColumn("_file", F.col("_metadata.file_path"))
        touched = sorted(r[0] for r in is_hit(rows).select("_file").distinct().collect())  # names of files
        if not touched:
            return []
        slots = self.spark.createDataFrame(list(enumerate(touched)), "_slot INT, _file STRING")
        mine = rows.join(F.broadcast(slots), "_file")  # one row per file
        fresh = change(mine.select(*data.names, "_slot")).repartition(len(touched), "_slot")
        fresh.write.partitionBy("_slot").parquet(f"{self.root}/{folder}/{name}")
        new = {}
        for path in self._matching(folder, name, "_slot=*", "part-*"):
            new[int(path.getParent().getName().split("=")[1])] = path.toString()
        return [(new.get(k), place) for k, place in enumerate(touched)]

    def erase(self, keys: DataFrame, requested_by: str, batch_id: int, erased_at=None) -> DataFrame:
        """Erase the known keys from every layer, log it, and return the log rows.

        Only files that hold a requested key are rewritten. The new versions of all tables, the
        list of swaps and the log are written first. From then on the erasure is certain: if
        it is interrupted between two swaps, ``recover`` (which the next erasure calls) finishes it,
        with the counts taken before anything changed.
        """
        self.recover()
        work = f"_erasure/{batch_id}-{uuid.uuid4().hex}"
        known = staged(erasure.known_keys(keys, self.read("vehicle_metadata")), "erasure-keys")
        layers = {name: self.read(name) for name in erasure.COUNTED}
        log = erasure.audit_rows(erasure.affected_counts(layers, known), requested_by, instant(erased_at))
        swaps: list[tuple[str | None, str]] = []

        def holds(rows: DataFrame) -> DataFrame:
            return rows.join(known, "vehicle_id", "left_semi")

        for name in erasure.BLANKED:
            swaps += self._stage_rewrite(name, holds, lambda df, table=name: erasure.erase(df, known, table), work)
        swaps += self._stage_rewrite(
            "bronze_dlq", lambda df: erasure.naming(df, known), lambda df: erasure.scrub_dead_letters(df, known), work)
        swaps += self._stage_rewrite("vehicle_metadata", holds, lambda df: erasure.without_keys(df, known), work)
        self.spark.createDataFrame(swaps, "new STRING, place STRING").coalesce(1).write.parquet(f"{self.root}/{work}/swaps")
        log.coalesce(1).write.parquet(f"{self.root}/{work}/log")
        path, files = self._file(work, "batch")
        out = files.create(path, True)
        out.writeLong(batch_id)
        out.close()
        self._mark(work, "ready")
        return self._finish(work)

    def _finish(self, work: str) -> DataFrame:
        """Swap what is not swapped yet, write the log and drop the work folder; safe to repeat."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()

        def at(text: str):
            return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(text))

        option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        overwrite = self.spark.sparkContext._gateway.new_array(option, 1)
        overwrite[0] = option.OVERWRITE
        for swap in self.spark.read.parquet(f"{self.root}/{work}/swaps").collect():  # a row per file
            place = at(swap.place)
            files = place.getFileSystem(conf)
            new = at(swap.new) if swap.new else None
            if new is None or files.exists(new):
                if new is None:
                    files.delete(place, False)
                else:  # in one step: a reader that opens the place finds the old file or the new one
                    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(new, place, overwrite)
        path, files = self._file(work, "batch")
        source = files.open(path)
        batch_id = source.readLong()
        source.close()
        log = staged(self.spark.read.parquet(f"{self.root}/{work}/log"), "erasure-log")
        self.write_batch("erasure_log", log, batch_id)
        folder, files = self._file(work)
        files.delete(folder, True)
        return log

    def recover(self) -> None:
        """Finish erasures that were interrupted, and drop those that had not become certain."""
        for folder in self._matching("_erasure", "*"):
            work = f"_erasure/{folder.getName()}"
            if self._exists(work, "ready"):
                self._finish(work)
            else:
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def purge(self, name: str, as_of, keep: str) -> None:
        """Drop whole date partitions older than ``keep``; metadata work, no row is read."""
        cutoff = self.spark.range(1).select(F.to_date(instant(as_of) - F.expr(f"INTERVAL {keep}")).alias("d")).first().d
        folder, files = self._folder(name)
        for status in files.listStatus(folder):
            label = status.getPath().getName()
            if label.startswith("event_date=") and label.split("=")[1] < cutoff.isoformat():
                files.delete(status.getPath(), True)
