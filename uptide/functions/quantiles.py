"""Exact quantiles of whole columns without gathering the column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from uptide.session import stored

RANK_ACCURACY = 10_000
#: Parts that the values to be ordered are cut into, per column.
ORDER_BLOCKS = 256


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    accuracy: int = RANK_ACCURACY,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles as rows ``(*by, column, probability, value)``, within each group of ``by``.

    ``percentile`` keeps every distinct value of a column in one buffer. Here a first pass
    brackets every wanted rank with ``percentile_approx`` (rank error at most n/accuracy on
    either side); a second pass counts values, keeping a value only inside a bracket and a
    count, least and greatest value between brackets, so that a rank's neighbour just outside
    a bracket is known as well. What is left, at most about ``4 n / accuracy`` values per rank,
    is written to the shared folder once and ordered in ``ORDER_BLOCKS`` blocks. The answer is
    exact as every row is counted; NULLs and the other columns' values play no part.

    Both passes run while the frame is built. ``weight`` names a column of whole numbers: a row
    then stands for so many. It is meant for rows that are grouped already, and counts all their
    distinct values without brackets.
    """
    probabilities = sorted(probabilities)
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    given = df.select(group.alias("g"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)], *([F.col(weight).alias("n")] if weight else []))
    if weight:
        cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in range(len(columns))])
        rows = given.select("g", "n", F.inline(cells)).filter(F.col("v").isNotNull() & (F.col("n") > 0))
        counted = rows.groupBy("g", "c", F.lit(0).alias("segment"), F.col("v").alias("value")).agg(F.sum("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    else:
        counted = _counted(given, len(columns), probabilities, bool(by), accuracy)
    upto = _cumulated(stored(counted, "quantiles"))
    # The ranks of a column: a few dozen, of which each counted row keeps those that fall into it.
    ranks = [
        F.struct(F.lit(float(p)).alias("probability"), rank.alias("rank"), at(rank).alias("at"))
        for p in probabilities
        for rank in [(F.col("total") - 1) * F.lit(p)]
        for at in (F.floor, F.ceil)
    ]
    within = F.filter(F.array(*ranks), lambda r: (r["at"] < F.col("upto")) & (r["at"] >= F.col("upto") - F.col("n")))
    value = (
        F.when(F.col("value").isNotNull(), F.col("value"))
        .when(F.col("r.at") == F.col("upto") - 1, F.col("most"))
        .when(F.col("r.at") == F.col("upto") - F.col("n"), F.col("least"))
        .otherwise(F.raise_error(F.lit("quantile rank fell outside its bracket")).cast("double"))
    )
    hits = upto.select("*", F.explode(within).alias("r")).select("g", "c", "r.*", value.alias("value"))
    found = hits.groupBy("g", "c", "probability", "rank").agg(F.min_by("value", "at").alias("lo"), F.max_by("value", "at").alias("hi"))
    lo, hi, part = F.col("lo"), F.col("hi"), F.col("rank") - F.floor("rank")
    between = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * part)
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(*[F.col("g")[c].alias(c) for c in by], F.element_at(names, F.col("c") + 1).alias("column"), "probability", between.alias("value"))


def _counted(given: DataFrame, columns: int, probabilities: Sequence[float], grouped: bool, accuracy: int) -> DataFrame:
    """``g, c, segment, value, n, least, most``: values inside the brackets, and one row per segment between them."""
    margin = 2.0 / accuracy
    edges = sorted({min(1.0, max(0.0, p + s)) for p in probabilities for s in (-margin, margin)})
    brackets = given.groupBy("g").agg(*[F.percentile_approx(f"v{i}", edges, accuracy).alias(f"e{i}") for i in range(columns)])
    if grouped:
        given = given.join(brackets.withColumnRenamed("g", "g_"), F.col("g").eqNullSafe(F.col("g_")))
        edge = lambda i, p: F.col(f"e{i}")[edges.index(p)]
    else:
        # One row of a few dozen numbers, whatever the size of the input: they become part of the plan.
        row = brackets.first()
        edge = lambda i, p: F.lit(row[f"e{i}"][edges.index(p)] if row and row[f"e{i}"] else None).cast("double")
    cells = []
    for i in range(columns):
        v, inside, segment = F.col(f"v{i}"), F.lit(False), F.lit(0)
        for p in probabilities:
            above_lo, above_hi = v >= edge(i, max(0.0, p - margin)), v > edge(i, min(1.0, p + margin))
            inside = inside | (above_lo & ~above_hi)
            segment = segment + above_lo.cast("int") + above_hi.cast("int")
        cells.append(F.struct(F.lit(i).alias("c"), v.alias("v"), segment.alias("segment"), F.when(inside, v).alias("value")))
    located = given.select("g", F.inline(F.array(*cells))).filter(F.col("v").isNotNull())
    return located.groupBy("g", "c", "segment", "value").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))


def _cumulated(counted: DataFrame) -> DataFrame:
    """``counted`` with ``upto``, the rows up to and with this one, and ``total``, all rows of its group and column.

    Values are ordered in blocks cut at sketched quantiles; one row per block is ordered over the column.
    """
    points = [i / ORDER_BLOCKS for i in range(1, ORDER_BLOCKS)]
    cuts = counted.groupBy("g", "c").agg(F.percentile_approx("least", points, 10 * ORDER_BLOCKS).alias("cuts"))
    block = F.size(F.filter("cuts", lambda x: x <= F.col("least")))
    placed = counted.join(cuts, ["g", "c"]).select(*counted.columns, block.alias("block"))
    column = Window.partitionBy("g", "c")
    before = column.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("g", "c", "block")
        .agg(F.sum("n").alias("size"))
        .select("g", "c", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(column).alias("total"))
    )
    inside = Window.partitionBy("g", "c", "block").orderBy("segment", "least").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(blocks, ["g", "c", "block"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))


def with_quantiles(
    df: DataFrame, source: DataFrame, columns: Sequence[str], probabilities: Sequence[float], name: str = "__q", weight: str | None = None
) -> DataFrame:
    """``df`` plus a struct column with quantiles of ``source``: field ``q<column index>_<probability index>``.

    They are computed while the frame is built, and are constants of its plan.
    """
    probabilities = sorted(probabilities)
    long = exact_quantiles(source, columns, probabilities, weight=weight).collect()
    found = {(r["column"], r["probability"]): r["value"] for r in long}
    fields = [F.lit(found.get((c, float(p)))).cast("double").alias(f"q{i}_{k}") for i, c in enumerate(columns) for k, p in enumerate(probabilities)]
    return df.select("*", F.struct(*fields).alias(name))
