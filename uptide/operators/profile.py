"""Exploratory profile: descriptive statistics, correlations, outliers, distributions, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from uptide.functions.moments import correlations
from uptide.functions.prefix import running_totals
from uptide.functions.quantiles import exact_quantiles, with_quantiles

# Labels of the quartile bands and of the urgency thirds.
QUARTILE_LABELS = ("Baixa", "Média-Baixa", "Média-Alta", "Alta")
THIRD_LABELS = ("Curto", "Médio", "Longo")
UNDEFINED = "Indefinido"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(columns: Sequence[str], fields: dict[str, list[Column]]) -> Column:
    """Array with one struct per column: its name and, per field, the column's expression."""
    return F.array(
        *[F.struct(F.lit(c).alias("column"), *[v[i].alias(k) for k, v in fields.items()]) for i, c in enumerate(columns)]
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: mean, sample standard deviation, min, quartiles, max, NULL count, count.

    Moments and counts are one aggregation; the quartiles are exact and distributed.
    """
    columns = list(columns or numeric_columns(df))
    values = [F.col(c).cast("double") for c in columns]
    rows = df.agg(
        _long(
            columns,
            {
                "mean": [F.avg(v) for v in values],
                "std": [F.stddev_samp(v) for v in values],
                "min": [F.min(v) for v in values],
                "max": [F.max(v) for v in values],
                "nulls": [F.count_if(v.isNull()) for v in values],
                "count": [F.count(v) for v in values],
            },
        ).alias("r")
    ).select(F.inline("r"))
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n)
                for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
            ]
        )
    )
    return rows.join(quartiles, "column", "left").select(
        "column", "mean", "std", "min", "q1", "median", "q3", "max", "nulls", "count"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full matrix in long form; each pair is computed once, all in one pass over the data. NULL for a constant side."""
    upper = correlations(df, list(columns or numeric_columns(df)))
    one, other = F.struct("x", "y", "corr"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("corr"))
    mirrored = F.when(F.col("x") == F.col("y"), F.array(one)).otherwise(F.array(one, other))
    return upper.select(F.inline(mirrored)).withColumnsRenamed({"x": "feature_x", "y": "feature_y"})


def _with_target(df: DataFrame, target: str, columns: Sequence[str] | None) -> DataFrame:
    """``feature, corr`` of the columns with the target."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    found = correlations(df, [*columns, target])
    return found.filter((F.col("y") == target) & (F.col("x") != target)).select(F.col("x").alias("feature"), "corr")


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """Features by absolute correlation with the target, strongest first, and whether it exceeds 0.5; all, or the ``top``."""
    rows = _with_target(df, target, columns).filter(F.col("corr").isNotNull())
    ranked = rows.select("feature", "corr", (F.abs("corr") > 0.5).cast("int").alias("forte")).orderBy(F.abs("corr").desc(), "feature")
    return ranked if top is None else ranked.limit(top)


def strong_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None, above: float = 0.5) -> DataFrame:
    return _with_target(df, target, columns).filter(F.abs("corr") > above)


def feature_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlations of all pairs of the columns, each once."""
    return correlations(df, columns).filter(F.col("x") != F.col("y")).withColumnsRenamed({"x": "feature_x", "y": "feature_y"})


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.05) -> DataFrame:
    """Per column: rows outside 1.5 interquartile ranges, and a flag when they exceed ``share``."""
    columns = list(columns or numeric_columns(df))
    fenced = with_quantiles(df, df, columns, [0.25, 0.75])
    outside, low, high = [], [], []
    for i, c in enumerate(columns):
        q1, q3 = F.col(f"__q.q{i}_0"), F.col(f"__q.q{i}_1")
        lo, hi = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
        outside.append(F.count_if((F.col(c) < lo) | (F.col(c) > hi)))
        low.append(F.max(lo))
        high.append(F.max(hi))
    rows = fenced.agg(
        F.count(F.lit(1)).alias("n"), _long(columns, {"lower": low, "upper": high, "outliers": outside}).alias("r")
    )
    return rows.select("n", F.inline("r")).select(
        "column", "lower", "upper", "outliers", (F.col("outliers") > F.col("n") * share).cast("int").alias("flagged")
    )


def category_balance(df: DataFrame, columns: Sequence[str], above: float = 0.8) -> DataFrame:
    """Most frequent value per column with its share of the non-NULL rows, and a flag above 0.8."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
        F.max("n").alias("top_count"),
        F.sum("n").alias("total"),
    )
    share = F.col("top_count") / F.col("total")
    return top.select("column", "top_value", "top_count", share.alias("share"), (share > above).cast("int").alias("imbalanced"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are kept."""
    bounds = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")))
    value = F.col(column).cast("double")
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    placed = (
        df.filter(F.col(column).isNotNull())
        .select(value.alias("v"), bounds.scalar().alias("b"))
        .select(
            F.least(
                F.lit(bins), F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("b.lo"), width)), F.lit(0)) + 1
            ).cast("int").alias("bin")
        )
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), bounds.scalar().alias("b"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("b.lo") + width * (F.col("bin") - 1)).alias("lower"),
        (F.col("b.lo") + width * F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _box(grouped, value: Column, q1: Column, median: Column, q3: Column) -> DataFrame:
    lo, hi = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    inside = (value >= lo) & (value <= hi)
    return grouped.agg(
        F.max(q1).alias("q1"),
        F.max(median).alias("median"),
        F.max(q3).alias("q3"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count(value).alias("n"),
    )


def boxplot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Box-plot numbers per column: quartiles, whiskers inside 1.5 ranges, points beyond them."""
    probabilities = [0.25, 0.5, 0.75]
    fenced = with_quantiles(df, df, columns, probabilities)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("double").alias("v"),
                *[F.col(f"__q.q{i}_{k}").alias(f"p{k}") for k in range(3)],
            )
            for i, c in enumerate(columns)
        ]
    )
    rows = fenced.select(F.inline(cells))
    return _box(rows.groupBy("column"), F.col("v"), F.col("p0"), F.col("p1"), F.col("p2"))


def quartile_band(value: Column, q1: Column, q2: Column, q3: Column) -> Column:
    """Band by value edges, closed on the right; NULL stays NULL."""
    low, mid_low, mid_high, high = QUARTILE_LABELS
    return (
        F.when(value <= q1, low).when(value <= q2, mid_low).when(value <= q3, mid_high).when(value.isNotNull(), high)
    )


def boxplot_by_quartile(df: DataFrame, value: str, by: str) -> DataFrame:
    """Box-plot numbers of ``value`` within the four quartile bands of ``by``."""
    banded = with_quantiles(df.select(value, by), df, [by], [0.25, 0.5, 0.75])
    band = quartile_band(F.col(by).cast("double"), *[F.col(f"__q.q0_{k}") for k in range(3)])
    return boxplot_by_group(banded.select(F.col(value).cast("double").alias("v"), band.alias("band")).filter(F.col("band").isNotNull()), "v", "band")


def boxplot_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    """Box-plot numbers of ``value`` per ``group``, groups without a value left out."""
    probabilities = [0.25, 0.5, 0.75]
    long = exact_quantiles(df, [value], probabilities, by=[group])
    picks = [F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"__p{k}") for k, p in enumerate(probabilities)]
    quartiles = long.groupBy(F.col(group).alias("__group")).agg(*picks)
    rows = df.select(group, F.col(value).cast("double").alias("__v")).join(quartiles, F.col(group).eqNullSafe(F.col("__group")))
    return _box(rows.groupBy(group), F.col("__v"), F.col("__p0"), F.col("__p1"), F.col("__p2"))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x over complete rows; NULL slope for a constant x."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    slope = F.try_divide(F.regr_sxy(a, b), F.regr_sxx(a, b))
    return df.agg(
        slope.alias("slope"),
        (F.regr_avgy(a, b) - slope * F.regr_avgx(a, b)).alias("intercept"),
        F.try_divide(F.pow(F.regr_sxy(a, b), 2), F.regr_sxx(a, b) * F.regr_syy(a, b)).alias("r2"),
        F.regr_count(a, b).alias("n"),
    )


def urgency_thirds(df: DataFrame, value: str) -> DataFrame:
    """Rows and share per third of ``value`` (edges: quantiles .33 and .66); NULL is its own class."""
    cut = with_quantiles(df.select(value), df, [value], [0.33, 0.66])
    v = F.col(value).cast("double")
    label = (
        F.when(v.isNull(), UNDEFINED)
        .when(v <= F.col("__q.q0_0"), THIRD_LABELS[0])
        .when(v <= F.col("__q.q0_1"), THIRD_LABELS[1])
        .otherwise(THIRD_LABELS[2])
    )
    counts = cut.groupBy(label.alias("urgencia")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # at most four rows
    return counts.withColumn("proporcao", F.col("n") / F.sum("n").over(everything))


def sorted_curve(df: DataFrame, value: str, blocks: int = 256) -> DataFrame:
    """Sorted-value curve with one row per distinct value: its first and last position and cumulative share.

    Copies are counted before anything is ordered, so a frequent value costs one row. The ordering runs in ``blocks``
    blocks of about as many distinct values each, cut at sketched quantiles; only block sums meet in one task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")).withColumn("__all", F.lit(1))
    cuts = counts.agg(F.percentile_approx(F.col(value).cast("double"), [i / blocks for i in range(1, blocks)], 10 * blocks))
    placed = counts.select("*", cuts.scalar().alias("__cuts"))
    ranked = running_totals(
        placed,
        keys=["__all"],
        order=[value],
        block=F.size(F.filter("__cuts", lambda c: c <= F.col(value).cast("double"))),
        totals={"upto": "n"},
    )
    total = counts.agg(F.sum("n"))
    return ranked.select(value, "n", "upto", total.scalar().alias("__total")).select(
        value,
        "n",
        (F.col("upto") - F.col("n")).alias("first_index"),
        (F.col("upto") - 1).alias("last_index"),
        (F.col("upto") / F.col("__total")).alias("cume_dist"),
    )


def insights(df: DataFrame, columns: Sequence[str], categories: Sequence[str], target: str) -> DataFrame:
    """Findings as rows ``(kind, column, value)``: size, target range, strong correlations, outliers, imbalance."""
    size = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("registros").alias("kind"), F.lit("*").alias("column"), "value"
    )
    t = F.col(target).cast("double")
    span = df.agg(
        F.array(
            F.struct(F.lit("target_media").alias("kind"), F.avg(t).alias("value")),
            F.struct(F.lit("target_min").alias("kind"), F.min(t).alias("value")),
            F.struct(F.lit("target_max").alias("kind"), F.max(t).alias("value")),
        ).alias("r")
    ).select(F.inline("r")).select("kind", F.lit(target).alias("column"), "value")
    strong = strong_correlations(df, target, columns).select(
        F.lit("correlacao_forte").alias("kind"), F.col("feature").alias("column"), F.col("corr").alias("value")
    )
    outliers = iqr_outliers(df, columns).filter(F.col("flagged") == 1).select(
        F.lit("outliers").alias("kind"), "column", F.col("outliers").cast("double").alias("value")
    )
    skewed = category_balance(df, categories).filter(F.col("imbalanced") == 1).select(
        F.lit("desbalanceada").alias("kind"), F.concat_ws("=", "column", "top_value").alias("column"), F.col("share").alias("value")
    )
    return size.unionByName(span).unionByName(strong).unionByName(outliers).unionByName(skewed)
