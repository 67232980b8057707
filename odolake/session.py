"""Session set-up and staging of intermediate results in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a JSON object that repeats a key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "odolake", cores: int | str = "*", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    cpus = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or _local_folders.get(context.applicationId)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="odolake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def staging_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/odolake/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def release_staging(spark: SparkSession) -> None:
    """Delete what this application has staged; frames that still read it are void then."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, and gives Catalyst the true
    size, so that it broadcasts the result in a later join only when it is small.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 50_000  # of costly work on single rows: some seconds


def spread(df: DataFrame, *keys: str, least: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt out evenly before costly work, in at least ``least`` tasks (one per core by default).

    A Parquet file is split by its row groups, however many splits Spark plans for its bytes, so a file of few
    large groups would be read, and worked on, by few tasks. The number of tasks follows the number of
    rows, which Parquet tells without reading them. With ``keys`` rows go by their hash, else in turns.
    """
    least = df.sparkSession.sparkContext.defaultParallelism if least is None else least
    tasks = max(least, -(-df.count() // rows_per_task))
    return df.repartition(tasks, *keys) if tasks > 1 else df


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps partitions and their row order as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
