"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from uptide.session import use_checkpoints

#: Word of the contracts: a run of anything but ASCII white space (Java and Python spelling).
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; the result survives lost executors and has no lineage."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


class Spans:
    """Spans by start, which may overlap; finds those that touch a stretch without looking at all."""

    def __init__(self, spans: Sequence[tuple[int, int]]):
        self.order = sorted(range(len(spans)), key=lambda n: spans[n])
        self.starts = [spans[n][0] for n in self.order]
        self.reach = list(accumulate((spans[n][1] for n in self.order), max))

    def touching(self, start: int, end: int) -> list[int]:
        """Numbers, in the given sequence, of spans that may touch the stretch: all that do, few others."""
        return self.order[bisect_right(self.reach, start) : bisect_left(self.starts, end)]

    def touch(self, start: int, end: int) -> bool:
        """Whether any span has a place in common with the stretch."""
        last = bisect_left(self.starts, end)
        return last > 0 and self.reach[last - 1] > start


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def either_case(word: str) -> str:
    """Pattern of an ASCII word in either case, without the Unicode foldings of IGNORECASE."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else re.escape(c) for c in word)


def spans_text(spans: list[tuple[str, int, int]], order: dict[str, int]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))
