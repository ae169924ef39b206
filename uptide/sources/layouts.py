"""CSV files of any layouts in one folder: a catalogue of their headers, and one scan per layout."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from uptide.sources.listing import decoded

#: A first line with so many known column names is a header.
HEADER_NAMES = 2


def list_paths(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the folder's files that match; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return sorted(r["path"] for r in files.select("path").collect())


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, line``: the first line of each file that is not blank. A file's later splits add nothing."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            codes = batch.column("path").dictionary_encode().indices.to_numpy()
            at = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist()] if len(codes) else []
            if at and batch.column("path")[0].as_py() == last:
                at = at[1:]
            if at:
                found = batch.take(pa.array(at))
                last = batch.column("path")[len(codes) - 1].as_py()
                yield found.rename_columns(["path", "line"])

    lines = spark.read.text(list(paths)).filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    return lines.select(F.col("_metadata.file_path").alias("path"), "value").mapInArrow(firsts, "path string, line string")


def header_cells(line: str) -> list[str]:
    return [c.replace("﻿", "").strip() for c in next(csv.reader([line]), [])]


def read_layouts(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Mapping[str, Sequence[str]],
    types: Mapping[str, str],
    *,
    standard: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The files' rows as ``columns`` (name -> header names in order of preference) and ``source_file``.

    A file's first line is its header if it names ``HEADER_NAMES`` of the ``standard`` headers; without one, the file has
    the standard headers' order. Files that have the wanted columns in the same places are one scan, of those columns only
    and split over tasks however large a file is; no line is compared with headers. Text that is no value of the column's
    type becomes NULL, a column that a file lacks gets ``defaults`` or NULL.
    """
    layouts: dict[tuple, list[str]] = {}
    for r in first_lines(spark, paths).collect() if paths else ():  # a row per file, as in the listing
        cells = header_cells(r["line"])
        header = len(set(cells) & set(standard)) >= HEADER_NAMES
        names = cells if header else list(standard)
        places = tuple(next((names.index(h) for h in heads if h in names), None) for heads in columns.values())
        layouts.setdefault((header, places), []).append(unquote(r["path"]))
    parts = [_scan(spark, files, header, dict(zip(columns, places, strict=True)), types, defaults or {}) for (header, places), files in sorted(layouts.items(), key=lambda x: x[1])]
    if not parts:
        schema = T.StructType([*[T.StructField(n, T.DataType.fromDDL(types[n])) for n in columns], T.StructField("source_file", T.StringType())])
        return spark.createDataFrame([], schema)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _scan(spark: SparkSession, files: list[str], header: bool, places: Mapping[str, int | None], types: Mapping[str, str], defaults: Mapping[str, object]) -> DataFrame:
    width = max([p for p in places.values() if p is not None], default=0) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(schema).option("header", header).option("enforceSchema", True).csv(files)

    def value(name: str):
        if places[name] is None:
            return F.lit(defaults.get(name)).try_cast(types[name])
        return F.trim(F.regexp_replace(f"c{places[name]}", "﻿", "")).try_cast(types[name])

    return rows.select(*[value(n).alias(n) for n in places], decoded(F.col("_metadata.file_name")).alias("source_file"))
