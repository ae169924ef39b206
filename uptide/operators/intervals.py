"""Joins of points with intervals that may overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from uptide.functions.prefix import running_totals

#: Cells with more than this share of all points are fewer than 1 / share.
HOT_SHARE = 0.001
#: Parts that the points of such a cell are dealt to.
SALTS = 16
#: Parts that the range of the points is cut into for running totals.
BLOCKS = 1024


def interval_join(points: DataFrame, intervals: DataFrame, *, key: str, at: str, start: str, end: str) -> DataFrame:
    """Every point with every interval of its key that holds it (``start`` <= ``at`` < ``end``): the columns of both.

    ``at``, ``start`` and ``end`` are whole numbers, and the sides' other columns have different names. An equi-join on
    cells replaces the comparison of all with all: an interval of length n belongs to the cells of width 2^k >= n, of which
    it covers two at most, however long it is. A point is looked up once per width in use; widths below the median's are
    raised to it, so that few are.

    A cell that holds very many points is split: its points are dealt to ``SALTS`` parts and its intervals copied to each.
    The list of those cells is broadcast; it has fewer than ``1 / HOT_SHARE`` rows.
    """
    length = F.greatest(F.col(end) - F.col(start), F.lit(1))
    level = F.ceil(F.log2(length.cast("double"))).cast("int")
    spans = intervals.filter(F.col(key).isNotNull() & (F.col(end) > F.col(start)))
    typical = spans.agg(F.percentile_approx(level, 0.5)).first()[0]
    if typical is None:
        typical = 0
    levelled = spans.withColumn("__level", F.greatest(level, F.lit(typical)))
    levels = sorted(r[0] for r in levelled.select("__level").distinct().collect())  # 64 at most

    def cell(value: Column, width: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), width)).cast("long")

    first, last = cell(F.col(start), F.col("__level")), cell(F.col(end) - 1, F.col("__level"))
    covered = levelled.withColumn("__cell", F.explode(F.sequence(first, last)))
    located = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("__level", F.explode(F.array(*[F.lit(x) for x in levels] or [F.lit(0)])))
    located = located.withColumn("__cell", cell(F.col(at), F.col("__level")))
    place = [key, "__level", "__cell"]
    sizes = located.groupBy(*place).agg(F.count(F.lit(1)).alias("__points"))
    total = points.count() * len(levels)
    hot = F.broadcast(sizes.filter(F.col("__points") > max(total * HOT_SHARE, 1)).select(*place, F.lit(SALTS).alias("__salts")))
    salts = F.coalesce("__salts", F.lit(1))
    dealt = located.join(hot, place, "left").withColumn("__part", F.pmod(F.xxhash64(*points.columns), salts).cast("int")).drop("__salts")
    copied = covered.join(hot, place, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    met = dealt.join(copied, [*place, "__part"]).filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
    return met.select(key, *[c for c in points.columns if c != key], *[c for c in intervals.columns if c != key])


def interval_totals(points: DataFrame, intervals: DataFrame, totals: list[str], *, key: str, at: str, start: str, end: str, name: str) -> DataFrame:
    """Per interval (``name`` is its own column): number of points inside and sums of ``totals``; 0 and NULL without any.

    What lies inside is the running total before ``end`` less the one before ``start``, so the work follows the points and
    intervals, not their pairs, of which overlapping intervals have quadratically many. Sums of floating-point columns would
    lose digits in that difference: they are taken over the joined points.
    """
    exact = all(isinstance(points.schema[c].dataType, T.IntegralType | T.DecimalType) for c in totals)
    found = _running_inside if exact else _joined_inside
    inside = found(points, intervals, totals, key=key, at=at, start=start, end=end, name=name)
    return intervals.join(inside, name, "left").withColumn("points", F.coalesce("points", F.lit(0)))


def _joined_inside(points: DataFrame, intervals: DataFrame, totals: list[str], *, key: str, at: str, start: str, end: str, name: str) -> DataFrame:
    met = interval_join(points, intervals, key=key, at=at, start=start, end=end)
    return met.groupBy(name).agg(F.count(F.lit(1)).alias("points"), *[F.sum(c).alias(c) for c in totals])


def _running_inside(points: DataFrame, intervals: DataFrame, totals: list[str], *, key: str, at: str, start: str, end: str, name: str) -> DataFrame:
    """Points and sums per ``name`` from running totals at the places where a point lies or an interval starts or ends."""
    spans = intervals.filter(F.col(key).isNotNull() & (F.col(end) > F.col(start))).select(
        F.col(name).alias("__name"), F.col(key).alias("__key"), F.col(start).cast("long").alias("__start"), F.col(end).cast("long").alias("__end")
    )
    sums, known = [f"__sum_{i}" for i in range(len(totals))], [f"__known_{i}" for i in range(len(totals))]
    given = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("__key"), F.col(at).cast("long").alias("__at"), F.lit(1).cast("long").alias("__points"),
        *[F.coalesce(F.col(c), F.lit(0).cast(points.schema[c].dataType)).alias(s) for c, s in zip(totals, sums)],
        *[F.col(c).isNotNull().cast("long").alias(k) for c, k in zip(totals, known)],
    )
    figures = given.columns[2:]
    edges = spans.select("__key", F.explode(F.array("__start", "__end")).alias("__at"), *[F.lit(0).cast(given.schema[c].dataType).alias(c) for c in figures])
    # One row per key and place, so a block of a key has no more rows than whole numbers.
    places = given.unionByName(edges).groupBy("__key", "__at").agg(*[F.sum(c).alias(c) for c in figures])
    first, last = given.agg(F.min("__at"), F.max("__at")).first()
    width = (last - first) // BLOCKS + 1 if first is not None else 1
    block = F.greatest(F.lit(-1), F.least(F.lit(BLOCKS), F.floor((F.col("__at").cast("decimal(20,0)") - F.lit(first or 0)) / width)))
    upto = running_totals(places, keys=["__key"], order=["__at"], block=block.cast("int"), totals={f"{c}_upto": c for c in figures})
    before = F.struct(*[(F.col(f"{c}_upto") - F.col(c)).alias(c) for c in figures])

    def at_place(place: str) -> DataFrame:
        return upto.select(F.col("__key"), F.col("__at").alias(place), before.alias(f"{place}_before"))

    met = spans.join(at_place("__start"), ["__key", "__start"]).join(at_place("__end"), ["__key", "__end"])
    inside = met.select("__name", *[(F.col(f"__end_before.{c}") - F.col(f"__start_before.{c}")).alias(c) for c in figures])
    merged = inside.filter(F.col("__points") > 0).groupBy(F.col("__name").alias(name)).agg(*[F.sum(c).alias(c) for c in figures])
    kinds = {c: points.agg(F.sum(c).alias(c)).schema[c].dataType for c in totals}
    return merged.select(
        name, F.col("__points").alias("points"), *[F.when(F.col(k) > 0, F.col(s)).cast(kinds[c]).alias(c) for c, s, k in zip(totals, sums, known)]
    )
