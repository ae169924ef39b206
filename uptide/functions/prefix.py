"""Running totals and row numbers that survive a key holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptide.session import spread, stored, stored_by

#: The block of a row as two columns that are never NULL: whether it has one, and the block or a fixed value.
PLACE = ("__dated", "__block")


def running_totals(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str | Column],
    block: Column,
    totals: Mapping[str, str],
    keep_place: bool = False,
) -> DataFrame:
    """Add, per ``keys`` and in ``order``, the running total of each column of ``totals``.

    A plain window over ``keys`` would put all rows of one key into one task. Instead the
    rows are cut into blocks, and a row's total is (sum of the earlier blocks) + (running
    sum inside its block). ``block`` must never decrease along ``order``: the day of the
    ordering timestamp, for example. Only block sums, one row per key and block, meet in a
    window over the key alone; the rows are shuffled once, on key and block.

    ``totals`` maps output name -> summed column. A NULL input gives a NULL total and adds
    nothing to the following rows; a row with a NULL key gets NULL totals. A NULL block comes
    first, as NULLs do in ``order``. ``order`` should be total, or tied rows may swap sums.
    ``keep_place`` keeps the block as the columns ``PLACE``: grouping by ``keys`` and these needs no further exchange.
    """
    # The block as two columns that are never NULL, so that joining on it and cutting windows by it share one exchange.
    kind = df.select(block.alias("b")).schema["b"].dataType
    zero = F.lit({"date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}.get(kind.typeName(), "0")).cast(kind)
    place = list(PLACE)
    part = [*keys, *place]
    rows = df.withColumns(dict(zip(place, (block.isNotNull(), F.coalesce(block, zero)))))
    sums = rows.groupBy(*part).agg(*[F.sum(c).alias(f"__sum_{o}") for o, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*part, *[F.sum(f"__sum_{o}").over(before).alias(f"__before_{o}") for o in totals])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = spread(rows, *part).join(spread(offsets, *part), part, "left")
    result = [
        F.when(
            F.col(c).isNotNull() & known,
            F.sum(c).over(inside) + F.coalesce(F.col(f"__before_{o}"), F.lit(0)),
        ).alias(o)
        for o, c in totals.items()
    ]
    return joined.select(*df.columns, *(place if keep_place else ()), *result)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "numero") -> DataFrame:
    """Add the row's number, from 1, in the order of the whole table.

    The rows are range-partitioned and sorted once and written to the shared folder with their place; only the sizes of the
    partitions, one row each, are summed in one task.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "numbered")
    parts = placed.groupBy("__part").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__part", "__first", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__place") - F.col("__first") + 1
    return placed.join(offsets, "__part").select(number.alias(name), *df.columns)


def number_sections(sections: Sequence[DataFrame], key: str, section: str, order: Sequence[str], name: str = "numero") -> DataFrame:
    """As ``number_rows`` by ``key``, ``section`` and ``order``, of frames that hold one section each; keys are not NULL.

    A row's number is the number of rows of earlier keys and sections plus its place in its own section. Only the sizes, one row
    per key and section, are sorted over the whole table; frames that are stored by ``key`` are numbered without an exchange.
    Both sides lie by key, so they are merged: their files are so small beside their rows that Spark would broadcast millions.
    """
    sizes = None
    for rows in sections:
        size = rows.groupBy(key, section).agg(F.count(F.lit(1)).alias("__rows"))
        sizes = size if sizes is None else sizes.unionByName(size)
    sizes = stored(sizes.repartitionByRange(key, section).withColumn("__part", F.spark_partition_id()), "sizes")
    parts = sizes.groupBy("__part").agg(F.sum("__rows").alias("__all"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", F.coalesce(F.sum("__all").over(earlier), F.lit(0)).alias("__earlier"))
    inside = Window.partitionBy("__part").orderBy(key, section).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("__rows").over(inside) - F.col("__rows")
    offsets = sizes.withColumn("__before", before).join(parts, "__part").select(key, section, (F.col("__before") + F.col("__earlier")).alias("__before"))
    offsets = stored_by(offsets, "offsets", key)
    place = F.row_number().over(Window.partitionBy(key, section).orderBy(*order))
    numbered = None
    for rows in sections:
        part = rows.withColumn("__place", place).join(offsets.hint("merge"), [key, section])
        part = part.select((F.col("__before") + F.col("__place")).alias(name), *rows.columns)
        numbered = part if numbered is None else numbered.unionByName(part)
    return numbered
