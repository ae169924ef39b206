"""Co-moments of many columns in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

_ROW = T.StructType(
    [*(T.StructField(c, T.IntegerType()) for c in ("i", "j")), T.StructField("n", T.LongType()), T.StructField("odd", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("mx", "my", "cxx", "cyy", "cxy"))]
)
#: A spread below this share of the mean's size is rounding: the column counts as constant.
ROUNDING = 1e-13


class _Gram:
    """Sums over the rows of a task, relative to a first value per column: with m = 1 where a value is there and x = 0 where
    not, ``m'm, x'm, (x*x)'m, x'x`` hold every pair's sums over the rows where both are there."""

    def __init__(self, k: int):
        self.shift = np.zeros(k)
        self.known = np.zeros(k, bool)
        self.n, self.odd, self.s, self.q, self.p = (np.zeros((k, k)) for _ in range(5))

    def add(self, values: np.ndarray, there: np.ndarray) -> None:
        finite = there & np.isfinite(values)
        for c in np.flatnonzero(~self.known & finite.any(axis=0)):
            self.shift[c] = values[np.argmax(finite[:, c]), c]
            self.known[c] = True
        m = there.astype(np.float64)
        x = np.where(finite, values - self.shift, 0.0)
        bad = (there & ~finite).astype(np.float64)
        self.n += m.T @ m
        self.odd += bad.T @ m + m.T @ bad
        self.s += x.T @ m
        self.q += (x * x).T @ m
        self.p += x.T @ x

    def rows(self) -> pa.RecordBatch:
        i, j = np.triu_indices(len(self.shift))
        some = self.n[i, j] > 0
        i, j = i[some], j[some]
        n, sx, sy = self.n[i, j], self.s[i, j], self.s[j, i]
        columns = [
            i.astype(np.int32), j.astype(np.int32), n.astype(np.int64), self.odd[i, j].astype(np.int64), self.shift[i] + sx / n, self.shift[j] + sy / n,
            self.q[i, j] - sx * sx / n, self.q[j, i] - sy * sy / n, self.p[i, j] - sx * sy / n,
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_ROW.names)


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per pair of columns (each with itself as well): ``x, y, n, mean_x, mean_y, sxx, syy, sxy, odd``.

    Every pair is over the rows where both are not NULL; ``odd`` counts rows with NaN or infinity among them, which leave
    the sums. All columns share one accumulator, so the plan is the same for 5 and for 500 columns; a task sends one row per
    pair, and tasks are merged around the common mean.
    """
    k = len(columns)

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = _Gram(k)
        for batch in batches:
            values = np.empty((batch.num_rows, k))
            there = np.empty((batch.num_rows, k), bool)
            for c in range(k):
                column = batch.column(c)
                there[:, c] = column.is_valid().to_numpy(zero_copy_only=False)
                values[:, c] = column.fill_null(0.0).to_numpy(zero_copy_only=False)
            gram.add(values, there)
        yield gram.rows()

    parts = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(accumulate, _ROW)
    pair = Window.partitionBy("i", "j")
    total = F.sum("n").over(pair)
    centred = parts.select("*", *[(F.sum(F.col("n") * F.col(m)).over(pair) / total).alias(f"t{m}") for m in ("mx", "my")])
    dx, dy = F.col("mx") - F.col("tmx"), F.col("my") - F.col("tmy")
    merged = centred.groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.sum("odd").alias("odd"),
        F.max("tmx").alias("mean_x"),
        F.max("tmy").alias("mean_y"),
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("sxx"),
        F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("sxy"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    return merged.select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), "n", "mean_x", "mean_y", "sxx", "syy", "sxy", "odd")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x, y, corr`` for every pair of columns once; NULL if a side is constant or no row has both, NaN if values are no numbers."""
    found = co_moments(df, columns)

    def spread(s: str, mean: str):
        return F.when(F.col(s) > F.col("n") * F.pow(F.abs(mean) * ROUNDING, F.lit(2)), F.col(s))

    corr = F.col("sxy") / F.sqrt(spread("sxx", "mean_x") * spread("syy", "mean_y"))
    corr = F.when(corr.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    names = [F.lit(c) for c in columns]
    pairs = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(names[i].alias("x"), names[j].alias("y")) for i in range(len(columns)) for j in range(i, len(columns))])).alias("p")).select("p.*")
    rows = found.select("x", "y", F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(corr).alias("corr"))
    return pairs.join(rows, ["x", "y"], "left")
