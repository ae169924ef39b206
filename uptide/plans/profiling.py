"""Profile of lineitem and of the supplier records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.functions import categories
from uptide.operators import profile
from uptide.plans import adapters as a
from uptide.plans.feature_tables import TARGET_SQL, target
from uptide.plans.maintenance import PRESCRIPTION_SQL, prescription
from uptide.plans.registry import query, rounded
from uptide.session import stored

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line measures; the price of returned lines is unknown."""
    price = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    return a.table(spark, sf, "lineitem").select(
        *[(price if c == "l_extendedprice" else F.col(c)).alias(c) for c in NUMERIC], "l_returnflag", "l_linestatus"
    )


LINES_SQL = """lines AS (SELECT l_quantity, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS l_extendedprice,
  l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_returnflag, l_linestatus FROM lineitem)"""

DESCRIBE_SQL = f"WITH {LINES_SQL}, s AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS mn, quantile_cont({c}, 0.25) AS q1,
    quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3, max({c}) AS mx, count(*) - count({c}) AS nulls, count({c}) AS n FROM lines"""
    for c in NUMERIC
) + """) SELECT "column", round(mean, 8) AS mean, round(std, 8) AS std, round(mn, 8) + 0.0 AS "min", round(q1, 8) AS q1, round(median, 8) AS median,
  round(q3, 8) AS q3, round(mx, 8) AS "max", nulls, n AS "count" FROM s"""


@query("describe_numeric", DESCRIBE_SQL)
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    d = profile.describe(_lines(spark, sf), NUMERIC)
    return rounded(d, 8, "mean", "std", "min", "q1", "median", "q3", "max").withColumn("min", F.col("min") + F.lit(0.0))


def _corr_sql(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS feature_x, '{y}' AS feature_y, round(corr({x}, {y}), 6) AS corr FROM lines" for x, y in pairs
    )


@query("correlation_matrix", f"WITH {LINES_SQL} " + _corr_sql([(x, y) for x in NUMERIC for y in NUMERIC]))
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.correlation_matrix(_lines(spark, sf), NUMERIC), 6, "corr")


FEATURES = ["qty_produced", "qty_scrapped", "qty_reworked", "mass_kg_per_100"]
TARGET_CORR_SQL = f"WITH {TARGET_SQL}, c AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, corr(CAST({f} AS DOUBLE), CAST(target AS DOUBLE)) AS c FROM tt" for f in FEATURES
) + ") SELECT feature, round(c, 6) AS corr, CAST(abs(c) > 0.5 AS BIGINT) AS forte FROM c ORDER BY abs(c) DESC, feature"


@query("target_correlations", TARGET_CORR_SQL)
def target_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.target_correlations(target(spark, sf), "target", FEATURES), 6, "corr")


@query(
    "strong_correlations",
    f"""WITH {a.SUPPLIER_SQL}, c AS (SELECT 'mass_total' AS feature, corr(CAST(mass_kg_per_100 AS DOUBLE) * qty_produced, qty_produced) AS c FROM s_prod
  UNION ALL SELECT 'qty_scrapped', corr(qty_scrapped, qty_produced) FROM s_prod
  UNION ALL SELECT 'mass_kg_per_100', corr(CAST(mass_kg_per_100 AS DOUBLE), qty_produced) FROM s_prod)
SELECT feature, round(c, 6) AS corr FROM c WHERE abs(c) > 0.5""",
)
def strong_correlations(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.supplier_production(spark, sf).withColumn(
        "mass_total", F.col("mass_kg_per_100").cast("double") * F.col("qty_produced")
    )
    found = profile.strong_correlations(rows, "qty_produced", ["mass_total", "qty_scrapped", "mass_kg_per_100"])
    return rounded(found, 6, "corr")


@query(
    "feature_pair_correlations",
    f"WITH {LINES_SQL} " + _corr_sql([(x, y) for i, x in enumerate(NUMERIC) for y in NUMERIC[i + 1 :]]),
)
def feature_pair_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.feature_pairs(_lines(spark, sf), NUMERIC), 6, "corr")


OUTLIER_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", q1 - (q3 - q1) * 1.5 AS lower, q3 + (q3 - q1) * 1.5 AS upper,
    count(*) FILTER (WHERE v < q1 - (q3 - q1) * 1.5 OR v > q3 + (q3 - q1) * 1.5) AS outliers, count(*) AS n
  FROM (SELECT {c} AS v FROM skewed), (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM skewed) GROUP BY q1, q3"""
    for c in ("l_quantity", "price_square", "l_discount")
)
SKEWED_SQL = f"{LINES_SQL}, skewed AS (SELECT *, l_extendedprice * l_extendedprice / 1000000 AS price_square FROM lines)"


def _skewed(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).withColumn("price_square", F.col("l_extendedprice") * F.col("l_extendedprice") / 1000000)


@query(
    "iqr_outliers",
    f"""WITH {SKEWED_SQL}, o AS ({OUTLIER_SQL})
SELECT "column", round(lower, 6) AS lower, round(upper, 6) AS upper, outliers, CAST(outliers > n * 0.05::DOUBLE AS BIGINT) AS flagged FROM o""",
)
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.iqr_outliers(_skewed(spark, sf), ["l_quantity", "price_square", "l_discount"])
    return rounded(found, 6, "lower", "upper")


@query(
    "category_balance",
    """WITH v AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem
  UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem),
c AS (SELECT "column", value, count(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY "column") AS total, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM c)
SELECT "column", value AS top_value, n AS top_count, round(n / total, 6) AS share, CAST(n / total > 0.8::DOUBLE AS BIGINT) AS imbalanced FROM r WHERE rn = 1""",
)
def category_balance(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.category_balance(a.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])
    return rounded(found, 6, "share")


CATEGORIES = ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey")


@query(
    "category_lists",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CASE WHEN count(DISTINCT v) <= 50 THEN string_agg(DISTINCT v, ',' ORDER BY v) END AS valores, count(v) AS n
FROM (SELECT CAST({"CAST(l_quantity AS BIGINT)" if c == "l_quantity" else c} AS VARCHAR) AS v FROM lineitem)"""
        for c in CATEGORIES
    ),
)
def category_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Values of the columns that have at most 50, and how many rows they have."""
    rows = a.table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
    lists = categories.category_lists(rows, CATEGORIES, 50)
    cells = [F.struct(F.lit(c).alias("column"), F.lit(None if v is None else ",".join(v)).alias("valores"), F.count(c).alias("n")) for c, v in lists.items()]
    return rows.agg(F.array(*cells).alias("r")).select(F.inline("r"))


@query(
    "histogram",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
k AS (SELECT least(30, CAST(floor((l_extendedprice - lo) / ((hi - lo) / 30)) AS BIGINT) + 1) AS bin FROM lineitem, b),
c AS (SELECT bin, count(*) AS n FROM k GROUP BY bin)
SELECT CAST(i AS BIGINT) AS bin, round(lo + (hi - lo) / 30 * (i - 1), 4) AS lower, round(lo + (hi - lo) / 30 * i, 4) AS upper, coalesce(n, 0) AS n
FROM range(1, 31) t(i), b LEFT JOIN c ON c.bin = i""",
)
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.histogram(a.table(spark, sf, "lineitem"), "l_extendedprice"), 4, "lower", "upper")


def _box_sql(source: str, value: str, label: str, name: str) -> str:
    return f"""SELECT {label} AS {name}, q1, median, q3, min(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_low,
    max(v) FILTER (WHERE v >= lo AND v <= hi) AS whisker_high, count(v) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS outliers, count(v) AS n
  FROM (SELECT v, {label}, q1, median, q3, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi FROM {source})
  GROUP BY {label}, q1, median, q3"""


@query(
    "boxplot_stats",
    f"""WITH {SKEWED_SQL}, u AS (SELECT 'l_quantity' AS k, l_quantity AS v FROM skewed UNION ALL SELECT 'price_square', price_square FROM skewed),
q AS (SELECT k, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM u GROUP BY k),
s AS (SELECT u.v, u.k, q1, median, q3 FROM u JOIN q ON q.k = u.k),
r AS ({_box_sql("s", "v", "k", "c")})
SELECT c AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(whisker_low, 6) AS whisker_low,
  round(whisker_high, 6) AS whisker_high, outliers, n FROM r""",
)
def boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    box = profile.boxplot(_skewed(spark, sf), ["l_quantity", "price_square"])
    return rounded(box, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "boxplot_by_quartile",
    f"""WITH e AS (SELECT quantile_cont(l_quantity, 0.25) AS e1, quantile_cont(l_quantity, 0.5) AS e2, quantile_cont(l_quantity, 0.75) AS e3 FROM lineitem),
u AS (SELECT l_extendedprice AS v, CASE WHEN l_quantity <= e1 THEN 'Baixa' WHEN l_quantity <= e2 THEN 'Média-Baixa'
  WHEN l_quantity <= e3 THEN 'Média-Alta' ELSE 'Alta' END AS k FROM lineitem, e),
q AS (SELECT k, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM u GROUP BY k),
s AS (SELECT u.v, u.k, q1, median, q3 FROM u JOIN q ON q.k = u.k), r AS ({_box_sql("s", "v", "k", "c")})
SELECT c AS band, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, whisker_low, whisker_high, outliers, n FROM r""",
)
def boxplot_by_quartile(spark: SparkSession, sf: str) -> DataFrame:
    box = profile.boxplot_by_quartile(a.table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return rounded(box, 4, "q1", "median", "q3")


@query(
    "linear_trend",
    f"""WITH {LINES_SQL} SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lines""",
)
def linear_trend(spark: SparkSession, sf: str) -> DataFrame:
    trend = profile.linear_trend(_lines(spark, sf), "l_quantity", "l_extendedprice")
    return rounded(rounded(trend, 4, "slope", "intercept"), 6, "r2")


@query(
    "urgency_tertiles",
    f"""WITH {PRESCRIPTION_SQL}, q AS (SELECT quantile_cont(CAST(left_days AS DOUBLE), 0.33) AS q1, quantile_cont(CAST(left_days AS DOUBLE), 0.66) AS q2 FROM urg),
c AS (SELECT CASE WHEN left_days IS NULL THEN 'Indefinido' WHEN left_days <= q1 THEN 'Curto' WHEN left_days <= q2 THEN 'Médio' ELSE 'Longo' END AS urgencia FROM urg, q)
SELECT urgencia, count(*) AS n, round(count(*) / (SELECT count(*) FROM c), 6) AS proporcao FROM c GROUP BY urgencia""",
)
def urgency_tertiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.urgency_thirds(stored(prescription(spark, sf), "prescricao"), "dias_restantes"), 6, "proporcao")


@query(
    "sorted_curve",
    f"""WITH {PRESCRIPTION_SQL}, c AS (SELECT left_days AS dias_restantes, count(*) AS n FROM urg WHERE left_days IS NOT NULL GROUP BY 1),
r AS (SELECT *, CAST(sum(n) OVER (ORDER BY dias_restantes) AS BIGINT) AS upto, sum(n) OVER () AS total FROM c)
SELECT dias_restantes, n, upto - n AS first_index, upto - 1 AS last_index, round(upto / total, 6) AS cume_dist FROM r""",
)
def sorted_curve(spark: SparkSession, sf: str) -> DataFrame:
    table = stored(prescription(spark, sf), "prescricao")
    return rounded(profile.sorted_curve(table, "dias_restantes"), 6, "cume_dist")


@query(
    "eda_insights",
    f"""WITH {SKEWED_SQL}, o AS ({OUTLIER_SQL}),
c AS (SELECT 'l_quantity' AS f, corr(l_quantity, l_extendedprice) AS c FROM skewed UNION ALL SELECT 'price_square', corr(price_square, l_extendedprice) FROM skewed
  UNION ALL SELECT 'l_discount', corr(l_discount, l_extendedprice) FROM skewed),
b AS (SELECT l_returnflag AS v, count(*) AS n FROM skewed GROUP BY 1)
SELECT 'registros' AS kind, '*' AS "column", CAST(count(*) AS DOUBLE) AS value FROM skewed
UNION ALL SELECT 'target_media', 'l_extendedprice', round(avg(l_extendedprice), 4) FROM skewed
UNION ALL SELECT 'target_min', 'l_extendedprice', round(min(l_extendedprice), 4) FROM skewed
UNION ALL SELECT 'target_max', 'l_extendedprice', round(max(l_extendedprice), 4) FROM skewed
UNION ALL SELECT 'correlacao_forte', f, round(c, 4) FROM c WHERE abs(c) > 0.5
UNION ALL SELECT 'outliers', "column", CAST(outliers AS DOUBLE) FROM o WHERE outliers > n * 0.05
UNION ALL SELECT 'desbalanceada', 'l_returnflag=' || v, round(n / (SELECT sum(n) FROM b), 4) FROM b WHERE n / (SELECT sum(n) FROM b) > 0.8""",
)
def eda_insights(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.insights(
        _skewed(spark, sf), ["l_quantity", "price_square", "l_discount"], ["l_returnflag"], "l_extendedprice"
    )
    return rounded(found, 4, "value")
