"""Incremental sums in levels: small parts of many batches are merged into few larger ones.

A batch adds one part of level 0. ``FANOUT`` parts of a level are summed into one of the next, so that a table of n batches
has at most (FANOUT - 1) * log(n) parts, and each sum is rewritten log(n) times. Parts become visible, and are replaced, by a
manifest: a run that ends between two steps leaves the table as it was, and what it wrote is removed by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.sources.manifest import Manifest

FANOUT = 8


def _joined(intervals: list[list[int]]) -> list[list[int]]:
    """Batch numbers as maximal intervals."""
    out: list[list[int]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _sums(df: DataFrame, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals])


def _part(root: str, df: DataFrame, level: int, batches: list[list[int]]) -> dict:
    name = f"part-{level}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return {"path": name, "level": level, "batches": _joined(batches)}


def parts(spark: SparkSession, root: str) -> list[dict]:
    """The parts the table consists of."""
    return Manifest(spark, root).latest()[1]


def add_batch(sums: DataFrame, batch_id: int, root: str, keys: Sequence[str], totals: Sequence[str], fanout: int = FANOUT) -> None:
    """Add a batch's sums once, however often the batch is delivered, and merge the levels that are full."""
    spark = sums.sparkSession
    manifest = Manifest(spark, root)
    version, entries = manifest.latest()
    if not any(low <= batch_id <= high for e in entries for low, high in e["batches"]):
        entries = [*entries, _part(root, _sums(sums, keys, totals), 0, [[batch_id, batch_id]])]
        version += 1
        manifest.commit(version, entries)
    level = 0
    while level <= max(e["level"] for e in entries):
        full = [e for e in entries if e["level"] == level]
        if len(full) >= fanout:
            merged = _sums(spark.read.parquet(*[f"{root}/{e['path']}" for e in full]), keys, totals)
            made = _part(root, merged, level + 1, [b for e in full for b in e["batches"]])
            entries = [*[e for e in entries if e["level"] != level], made]
            version += 1
            manifest.commit(version, entries)
        level += 1
    manifest.vacuum()


def read_sums(spark: SparkSession, root: str, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """The sums over all batches."""
    entries = parts(spark, root)
    if not entries:
        raise ValueError(f"no batch was added to {root}")
    return _sums(spark.read.parquet(*[f"{root}/{e['path']}" for e in entries]), keys, totals)
