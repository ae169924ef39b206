"""XLSX workbooks as rows of text cells: one workbook per row of a Spark scan.

A sheet is limited to 1,048,576 rows by its format, so one file fits one task; many files
run in parallel. Only the first sheet is read.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

CELLS = "source_file string, row_no int, cells array<string>"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_EPOCH = datetime(1899, 12, 30)
# Built-in number formats of the XLSX standard that show a date.
_DATE_FORMATS = {14, 15, 16, 17, 22}


def _column_index(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format is a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{_NS}numFmt")
        if re.search(r"[ymd]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)
    }
    formats = root.find(f"{_NS}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else ()) if int(x.get("numFmtId", 0)) in _DATE_FORMATS | custom}


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cell texts) of the first sheet; dates as ISO text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in s.iter(f"{_NS}t")) for s in root.iter(f"{_NS}si")]
        dates = _date_styles(book)
        first = min((n for n in book.namelist() if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))
        with book.open(first) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_NS}row":
                    continue
                cells: list[str | None] = []
                for c in row.iter(f"{_NS}c"):
                    index = _column_index(c.get("r"))
                    cells += [None] * (index + 1 - len(cells))
                    value, inline = c.find(f"{_NS}v"), c.find(f"{_NS}is")
                    if inline is not None:
                        cells[index] = "".join(t.text or "" for t in inline.iter(f"{_NS}t"))
                    elif value is not None and value.text is not None:
                        if c.get("t") == "s":
                            cells[index] = shared[int(value.text)]
                        elif c.get("t") in (None, "n") and int(c.get("s", 0)) in dates:
                            moment = _EPOCH + timedelta(days=float(value.text))
                            cells[index] = (moment + timedelta(milliseconds=500)).strftime("%Y-%m-%d %H:%M:%S")
                        else:
                            cells[index] = value.text
                yield int(row.get("r", 0)), cells
                row.clear()


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for name, content in zip(frame["source_file"], frame["content"]):
            block: list[tuple] = []
            for number, cells in sheet_rows(content):
                block.append((name, number, cells))
                if len(block) == 10_000:
                    yield pd.DataFrame(block, columns=["source_file", "row_no", "cells"])
                    block = []
            if block:
                yield pd.DataFrame(block, columns=["source_file", "row_no", "cells"])


def read_cells(spark: SparkSession, folder: str, pattern: str = "*.xlsx") -> DataFrame:
    """All rows of all matching workbooks: ``source_file, row_no, cells``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content")
    return named.mapInPandas(_batches, CELLS)


def named_cells(cells: DataFrame, names: list[str], first_column: int = 0) -> DataFrame:
    """Cells by position as text columns, starting at ``first_column``."""
    return cells.select(
        *[F.get("cells", F.lit(first_column + i)).alias(n) for i, n in enumerate(names)], "source_file", "row_no"
    )
