"""Continuous ingestion of production files and incremental refresh of the monthly report.

A file source sees every path once: *new* files arrive through the stream. A file that is
modified or removed does not; :func:`refresh_if_changed` compares content snapshots and
recomputes in batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from uptide.operators.incremental import has_changes
from uptide.session import stored
from uptide.sources.manifest import Manifest
from uptide.sources.snapshots import content_snapshot, snapshot_changes
from uptide.streaming import levels

POLL_SECONDS = 300
#: What Spark gives for a file as a whole.
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def production_stream(
    spark: SparkSession, folder: str, *, pattern: str = "EQ-*.csv", archive: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of the paths of new CSV files; with ``archive``, finished files move there.

    The contents are not read here: ``prepare=readers.production_rows`` of :func:`start_ingestion` reads a batch's files by
    their headers.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select("path")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """State of queries started inside lies in RocksDB, on disk, and a batch saves its changes only."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_rows(stream: DataFrame, keys: Sequence[str], ts: str, expiry: str | None = None) -> DataFrame:
    """Rows whose key no earlier batch has brought; of copies within a batch the least by ``ts``, then the other columns.

    The keys are remembered in the stream's state store, by key, so a batch looks up its own keys only. Each key's state
    holds its first row, by batch time and order, and the time of the last batch that brought it; equal times mean a new
    key. Copies of a batch combine in the map tasks. Output mode ``update``.

    With ``expiry`` ("90 days") a key is forgotten once the stream is so far beyond its ``ts``; rows that come even later
    are dropped, and of differing copies within a batch any one may stay.
    """
    if expiry:
        return stream.withWatermark(ts, expiry).dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in dict.fromkeys([ts, *stream.columns]) if c not in keys]
    seen = stream.withColumn("__at", F.current_timestamp()).groupBy(*keys)
    first = seen.agg(F.min(F.struct("__at", *rest)).alias("__row"), F.max("__at").alias("__last")).filter("__row.__at = __last")
    return first.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in stream.columns])


def store_batch(batch: DataFrame, batch_id: int, target: str) -> DataFrame:
    """Write a batch into its own folder, replacing it on a retry, and read it back."""
    path = f"{target}/batch_id={batch_id}"
    batch.hint("rebalance").write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


class Ingestion:
    """Streams that run one after another: each reads what the one before it wrote."""

    def __init__(self, starts: Sequence[Callable[[], StreamingQuery]], together: bool):
        self._waiting = list(starts)
        self.queries: list[StreamingQuery] = []
        self._start(len(self._waiting) if together else 1)

    def _start(self, n: int) -> None:
        for _ in range(n):
            self.queries.append(self._waiting.pop(0)())

    def awaitTermination(self, timeout: float | None = None) -> bool:
        """Wait for all streams, starting the next when the one before it has ended; seconds apply to each."""
        at = 0
        while at < len(self.queries):
            ended = self.queries[at].awaitTermination(timeout) if timeout else (self.queries[at].awaitTermination(), True)[1]
            if not ended:
                return False
            if self._waiting:
                self._start(1)
            at += 1
        return True

    def stop(self) -> None:
        self._waiting.clear()
        for q in self.queries:
            q.stop()


def start_ingestion(
    stream: DataFrame,
    *,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str = "prod_ts",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
    poll_seconds: int | None = POLL_SECONDS,
    expiry: str | None = None,
) -> Ingestion:
    """Append the rows with new keys (:func:`first_rows`) to the table at ``target``.

    ``poll_seconds=None`` processes what is there and stops. ``after`` gets the stored rows of each batch, for incremental
    aggregates. ``prepare`` makes records of each batch of the source, such as the rows of new files: it runs
    in a stream of its own, whose records the second stream reads as they appear and then removes.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], "ready int").write.mode("append").parquet(f"{target}/_layout")
    trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = store_batch(batch, batch_id, target)
        if after:
            after(stored, batch_id)

    def start_table(records: DataFrame, state: str) -> StreamingQuery:
        rows = first_rows(records, keys, ts, expiry)
        writer = rows.writeStream.outputMode("append" if expiry else "update").foreachBatch(write)
        with _state_settings(spark):
            return writer.option("checkpointLocation", state).trigger(**trigger).start()

    if not prepare:
        return Ingestion([lambda: start_table(stream, checkpoint)], True)

    columns = prepare(spark.createDataFrame([], stream.schema)).schema
    records = f"{checkpoint}/records"
    spark.createDataFrame([], columns).write.mode("overwrite").parquet(f"{records}/batch-none")

    def start_records() -> StreamingQuery:
        def keep(batch: DataFrame, batch_id: int) -> None:
            prepare(batch).write.mode("overwrite").parquet(f"{records}/batch-{batch_id}")

        return stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{checkpoint}/source").trigger(**trigger).start()

    def start_rows() -> StreamingQuery:
        source = spark.readStream.schema(columns).option("cleanSource", "delete").parquet(f"{records}/*")
        return start_table(source, f"{checkpoint}/rows")

    return Ingestion([start_records, start_rows], poll_seconds is not None)


def read_ingested(spark: SparkSession, target: str, columns: T.StructType) -> DataFrame:
    """The table; empty before the first batch."""
    layout = T.StructType([*columns.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(layout).option("basePath", target).parquet(target).filter(F.col("batch_id").isNotNull()).drop("batch_id")


DAILY_TOTALS = ["qtd", "registros"]


def daily_partials(target: str, *, entity: str, ts: str, compound: str, quantity: str, fanout: int = levels.FANOUT) -> Callable[[DataFrame, int], None]:
    """Hook for :func:`start_ingestion`: daily sums of each batch's new rows, kept in levels."""

    def write(stored: DataFrame, batch_id: int) -> None:
        days = stored.select(entity, F.to_date(ts).alias("day"), compound, F.col(quantity).alias("qtd"), F.lit(1).cast("long").alias("registros"))
        levels.add_batch(days, batch_id, target, [entity, "day", compound], DAILY_TOTALS, fanout)

    return write


def monthly_from_partials(spark: SparkSession, target: str, *, entity: str, compound: str) -> DataFrame:
    """Monthly table from the daily sums of all batches; only sums are read, never the records."""
    days = levels.read_sums(spark, target, [entity, "day", compound], DAILY_TOTALS)
    return days.groupBy(entity, F.trunc("day", "month").alias("mes"), compound).agg(
        F.sum("qtd").alias("qtd"), F.sum("registros").alias("registros"), F.count("day").alias("dias")
    )


def refresh_if_changed(
    spark: SparkSession, folder: str, state: str, run: Callable[[DataFrame], None], *, force: bool = False
) -> bool:
    """Run a batch job when the input files differ from the stored snapshot; store the new one on success.

    Snapshots are kept as versions under ``state``; a failing ``run`` leaves the last one in place. Files of equal size and
    time are not read again, unless forced. Returns whether the job ran.
    """
    manifest = Manifest(spark, state)
    version, entries = manifest.latest()
    old = None
    if entries:
        where = f"{state}/{entries[0]['path']}"
        old = spark.read.parquet(f"{where}/files"), spark.read.parquet(f"{where}/buckets")
    files, buckets = content_snapshot(spark, folder, previous=None if force else old)
    files = stored(files, "snapshot")
    nothing = spark.createDataFrame([], files.schema)
    changes = snapshot_changes(old[0] if old else nothing, files)
    if not force and not has_changes(changes):
        return False
    run(changes)
    part = f"part-{uuid.uuid4().hex}"
    files.write.parquet(f"{state}/{part}/files")
    buckets.write.parquet(f"{state}/{part}/buckets")
    manifest.commit(version + 1, [{"path": part}])
    manifest.vacuum()
    return True
