"""Session settings for local runs, and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", *, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("uptide")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure a checkpoint folder is set: the cluster's, or a new one in local mode."""
    if not spark.sparkContext.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(configured or shared_folder(spark, "checkpoints"))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder path below the cluster's ``spark.checkpoint.dir``; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="uptide-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to all of the session's shuffle partitions, which are not merged afterwards.

    Adaptive execution merges partitions by their compressed size. Narrow rows compress so well that a merged partition holds
    millions of them, and as many partitions as cores are left: a task's memory would grow with the input.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextlib.contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by four tasks per core, not by a task each (up to 10,000), whose starts take longer than the listing."""
    before = spark.conf.get(LISTING, None)
    spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed once it is written, not when the driver happens to collect garbage.

    They would stay beside the written table and the shuffles of later steps, and an executor's disk would hold all of them at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several steps read to the shared folder, and read it back.

    It is computed once, its lineage ends there, its shuffles are freed, and it survives the loss of executors.
    """
    path = shared_folder(df.sparkSession, purpose)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, purpose: str, key: str, *, dealt: bool = False) -> DataFrame:
    """As ``stored``, in one bucket of rows per shuffle partition by ``key``: grouping, windows and joins by it need no exchange.

    A key's rows are read by one task, so there must be few of them per key. ``dealt`` rows come from ``spread`` by the key.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, purpose)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    with freed_shuffles(spark):
        (df if dealt else spread(df, key)).write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)
