"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

One pass over the texts gives each document's counts. Every metric's values of a (language, source) group are held in a
sketch: counts of logarithmic buckets (bucket width ``GAMMA``, so a quantile is within 1 % of a true value of its rank),
which merge by addition. They are plain rows built by a group-by that combines in the map tasks, so a hot source is a
few hundred counters, and reruns agree. Groups under ``min_rows`` documents use their language's merged sketch, then
that of all documents. A document fails a metric beyond its group's fence, median + ``spread`` x (upper quartile -
median) (below, for metrics that can be too low: with the lower quartile), where the quartile's distance counts as the
metric's least spread at least. The thresholds come to the documents by a join on language and source.

Edge cases: a null text has no words and fails the base rule; null languages and sources form groups of their own;
repeated rows keep their rows; ties at a fence are kept; an empty table gives an empty result. A metric that is
undefined for a text (no words) is 0.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from uptide.llm.common import WHITE, cut, map_batches

#: Fixed by the contract: base rule and counted characters.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
WINDOW = 8

GAMMA = 1.02
#: Values are counted from here up; smaller ones are 0.
SMALLEST = 1e-6
MIN_ROWS = 50
SPREAD = 6.0

#: Metric: (numerator, denominator, least spread, whether too low fails as well).
METRICS = {
    "symbol_share": ("n_symbols", "word_chars", 0.02, False),
    "upper_share": ("n_upper", "word_chars", 0.05, False),
    "dup_line_share": ("n_dup_lines", "n_lines", 0.05, False),
    "repeat_share": ("n_repeat_words", "n_words", 0.03, False),
    "top_word_share": ("n_top_word", "n_words", 0.03, False),
    "word_length": ("word_chars", "n_words", 0.5, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_top_word")


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    n, windows = len(words), max(0, len(words) - WINDOW + 1)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    line = b" ".join(words)
    runs = [line[a:b] for a, b in zip([0, *(e + 1 for e in ends)], ends[WINDOW - 1 :], strict=False)]
    repeated = 0
    if len(set(runs)) < windows:
        often, covered = Counter(runs), 0
        for i, r in enumerate(runs):
            if often[r] > 1:
                repeated += i + WINDOW - max(i, covered)
                covered = i + WINDOW
    top = max(Counter(words).values(), default=0)
    chars = len(text) - sum(map(text.count, WHITE))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, upper, len(lines), top


def _counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [text_counts(t) for t in batch.column("text").to_pylist()]
    arrays = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "lang", "source")), *arrays], names=["doc_id", "lang", "source", *COUNTS])


def counted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source``, the counts and metrics of each document."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*given.schema.fields[:3], *(T.StructField(c, T.LongType()) for c in COUNTS)])
    df = map_batches(given, _counts, schema)
    return df.withColumns({m: F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(F.lit(0.0)) for m, (n, d, _, _) in METRICS.items()})


# Sketches ------------------------------------------------------------------------------------------------------------


def bucket(value: Column) -> Column:
    """Bucket of a value that is not negative; -1 below ``SMALLEST``."""
    return F.when(value < SMALLEST, F.lit(-1)).otherwise(F.floor(F.log(value / SMALLEST) / math.log(GAMMA))).cast("int")


def bucket_value(b: Column) -> Column:
    """Middle of a bucket."""
    return F.when(b < 0, F.lit(0.0)).otherwise(SMALLEST * F.pow(F.lit(GAMMA), b + 0.5))


def sketches(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """``keys, metric, bucket, n``: one sketch per key and metric."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in metrics])
    return df.select(*keys, F.inline(values)).groupBy(*keys, "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of fewer keys, by addition."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    """``keys, metric, rows`` and a column per named quantile."""
    part = Window.partitionBy(*keys, "metric")
    up = part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("__upto", F.sum("n").over(up)).withColumn("__rows", F.sum("n").over(part))
    reached = [bucket_value(F.min(F.when(F.col("__upto") >= F.ceil(F.col("__rows") * q), F.col("bucket")))).alias(name) for name, q in points.items()]
    return ranked.groupBy(*keys, "metric").agg(F.max("__rows").alias("rows"), *reached)


def thresholds(df: DataFrame, *, min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """``lang, source`` and ``<metric>_low, <metric>_high``: one row per group."""
    points = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    fine = cut(sketches(df, ["lang", "source"], list(METRICS)))
    own = quantiles(fine, ["lang", "source"], points)
    by_lang = quantiles(merged(fine, ["lang"]), ["lang"], points)
    overall = quantiles(merged(fine, []), [], points)
    same = (F.col("o.metric") == F.col("l.metric")) & F.col("o.lang").eqNullSafe(F.col("l.lang"))
    pick = lambda q: F.when(F.col("o.rows") >= min_rows, F.col(f"o.{q}")).when(F.col("l.rows") >= min_rows, F.col(f"l.{q}")).otherwise(F.col(f"a.{q}"))
    levels = own.alias("o").join(by_lang.alias("l"), same).join(overall.alias("a"), F.col("o.metric") == F.col("a.metric"))
    chosen = levels.select("o.lang", "o.source", "o.metric", *[pick(q).alias(q) for q in points])
    least = F.create_map(*[F.lit(x) for m, (_, _, s, _) in METRICS.items() for x in (m, s)])[F.col("metric")]
    fenced = chosen.select(
        "lang",
        "source",
        "metric",
        (F.col("q50") - spread * F.greatest(F.col("q50") - F.col("q25"), least)).alias("low"),
        (F.col("q50") + spread * F.greatest(F.col("q75") - F.col("q50"), least)).alias("high"),
    )
    wide = [F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}") for m in METRICS for side in ("low", "high")]
    return fenced.groupBy("lang", "source").agg(*wide)


def judge(docs: DataFrame, *, min_rows: int = MIN_ROWS, spread: float = SPREAD, **columns) -> DataFrame:
    """The contract's row per document; ``failed`` names the metrics beyond their fences."""
    df = cut(counted(docs, **columns))
    fences = thresholds(df, min_rows=min_rows, spread=spread)
    same = F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source"))
    beyond = [
        F.when((F.col(m) > F.col(f"{m}_high")) | (F.lit(low) & (F.col(m) < F.col(f"{m}_low"))), F.lit(m))
        for m, (_, _, _, low) in METRICS.items()
    ]
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        df.alias("d")
        .join(fences.alias("f"), same)
        .withColumn("base_failed", base)
        .withColumn("failed", F.array_compact(F.array(*beyond)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .select("doc_id", *COUNTS[:5], "base_failed", "kept", "failed")
    )
