"""Runs whose log, models, tables and processed inputs become visible together.

A run writes everything into a folder of its own; then one manifest version adds the folder. Readers see committed runs only.
A run that is repeated under its id replaces its earlier outcome, and one that died before its commit leaves nothing. Input
files move to the archive after the commit: a file counts as processed once a committed run lists it, and moves that a crash
prevented are made up for by the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide import schema
from uptide.sources.listing import list_files
from uptide.sources.manifest import Manifest

PROCESSED = "path string, size long, modified timestamp, run_id string, archive string"


def commit_run(
    spark: SparkSession,
    root: str,
    run_id: str,
    log: DataFrame,
    *,
    models: Mapping[str, PipelineModel] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    inputs: Sequence[str] = (),
    pattern: str = "*",
    archive: str | None = None,
) -> None:
    """Store a run: its log rows (``schema.RUN_LOG``), fitted models, tables, and the input folders' files as processed.

    With ``archive`` the processed files move there. The files are listed before anything is computed from ``log``, so
    what arrives meanwhile belongs to a later run.
    """
    part = f"part-{uuid.uuid4().hex}"
    files = pending_inputs(spark, root, *inputs, pattern=pattern) if inputs else spark.createDataFrame([], PROCESSED)
    files.select("path", "size", "modified", F.lit(run_id).alias("run_id"), F.lit(archive).cast("string").alias("archive")).write.parquet(f"{root}/{part}/inputs")
    log.select(*schema.RUN_LOG.names).withColumn("run_id", F.lit(run_id)).write.parquet(f"{root}/{part}/log")
    for name, model in (models or {}).items():
        model.write().save(f"{root}/{part}/models/{name}")
    for name, table in (tables or {}).items():
        table.write.parquet(f"{root}/{part}/tables/{name}")
    manifest = Manifest(spark, root)
    version, entries = manifest.latest()
    made = {"run": run_id, "path": part, "models": sorted(models or {}), "tables": sorted(tables or {})}
    # Files that an earlier try of the run has processed stay processed: their list goes on with the new entry.
    before = [e for e in entries if e["run"] == run_id]
    made["inputs"] = [part, *(p for e in before for p in e["inputs"])]
    manifest.commit(version + 1, [*(e for e in entries if e["run"] != run_id), made])
    archive_processed(spark, root)


def committed(spark: SparkSession, root: str) -> list[dict]:
    return Manifest(spark, root).latest()[1]


def processed_inputs(spark: SparkSession, root: str) -> DataFrame:
    """Files that committed runs have processed, the runs' ids and the archives they move to."""
    paths = [f"{root}/{p}/inputs" for e in committed(spark, root) for p in e["inputs"]]
    return spark.read.schema(PROCESSED).parquet(*paths) if paths else spark.createDataFrame([], PROCESSED)


def pending_inputs(spark: SparkSession, root: str, *folders: str, pattern: str = "*") -> DataFrame:
    """Files below the folders that no committed run has processed as they are now: new or changed ones."""
    known = processed_inputs(spark, root).select("path", "size", "modified").distinct()
    return list_files(spark, *folders, pattern=pattern).join(known, ["path", "size", "modified"], "left_anti")


def archive_processed(spark: SparkSession, root: str) -> int:
    """Move the processed files that are still in place, if unchanged, to their runs' archives; returns how many."""
    store, moved = Manifest(spark, root), 0
    waiting = processed_inputs(spark, root).filter(F.col("archive").isNotNull())
    for r in waiting.select("path", "archive", F.unix_millis("modified").alias("at")).distinct().toLocalIterator():
        name = r["path"].rsplit("/", 1)[-1]
        moved += store.move(r["path"], f"{r['archive']}/{name}", r["at"])
    return moved


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """Run-log rows of all committed runs."""
    paths = [f"{root}/{e['path']}/log" for e in committed(spark, root)]
    return spark.read.schema(schema.RUN_LOG).parquet(*paths) if paths else spark.createDataFrame([], schema.RUN_LOG)


def _entry(spark: SparkSession, root: str, run_id: str | None) -> dict:
    runs = [e for e in committed(spark, root) if run_id in (None, e["run"])]
    if not runs:
        raise ValueError(f"no committed run {run_id or ''} in {root}")
    return max(runs, key=lambda e: e["run"])


def read_table(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """A table of a run, of the last one by default."""
    return spark.read.parquet(f"{root}/{_entry(spark, root, run_id)['path']}/tables/{name}")


def load_model(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> PipelineModel:
    return PipelineModel.load(f"{root}/{_entry(spark, root, run_id)['path']}/models/{name}")
