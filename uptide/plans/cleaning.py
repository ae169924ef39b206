"""Ingestion and cleaning over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.operators import clean, features, stats
from uptide.plans import adapters as a
from uptide.plans.registry import query, rounded

STANDARD = {
    "prod_date": ("prod_date", "o_orderdate"),
    "order_id": ("order_id", "o_orderkey"),
    "entity": ("entity", "o_custkey"),
    "qty_produced": ("qty_produced",),
    "compound": ("compound", "o_orderpriority", "o_orderstatus"),
    "mass_kg_per_100": ("mass_kg_per_100",),
    "source_file": ("source_file",),
}
STANDARD_TYPES = {
    "prod_date": "date", "order_id": "bigint", "entity": "bigint", "qty_produced": "bigint",
    "compound": "string", "mass_kg_per_100": "double", "source_file": "string",
}
STANDARD_DEFAULTS = {"compound": "N/A", "mass_kg_per_100": 0.0}


@query(
    "union_sources",
    """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS prod_date, l_orderkey AS order_id, l_suppkey AS entity,
  CAST(l_quantity AS BIGINT) AS qty_produced, l_returnflag AS compound, l_extendedprice / 1000 AS mass_kg_per_100,
  'lineitem' AS source_file FROM lineitem
UNION ALL SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderkey, o_custkey, NULL, o_orderpriority, 0.0, 'orders'
FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderkey, o_custkey, NULL, o_orderstatus, 0.0, NULL
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O'""",
)
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    standard = a.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("prod_date"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("entity"),
        F.col("l_quantity").cast("bigint").alias("qty_produced"),
        F.col("l_returnflag").alias("compound"),
        (F.col("l_extendedprice") / 1000).alias("mass_kg_per_100"),
        F.lit("lineitem").alias("source_file"),
    )
    orders = a.table(spark, sf, "orders")
    extended = orders.filter(F.col("o_orderstatus") == "O").withColumn("source_file", F.lit("orders"))
    reduced = orders.filter(~F.col("o_orderstatus").eqNullSafe("O")).drop("o_orderpriority")
    return clean.combine_sources(
        standard,
        clean.standardize(extended, STANDARD, STANDARD_TYPES, STANDARD_DEFAULTS),
        clean.standardize(reduced, STANDARD, STANDARD_TYPES, STANDARD_DEFAULTS),
    )


def _doubled(spark: SparkSession, sf: str) -> DataFrame:
    """All lines, and once more the returned ones."""
    lines = a.table(spark, sf, "lineitem")
    return lines.unionByName(lines.filter(F.col("l_returnflag") == "R"))


LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax + 0.0 AS l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"""


@query("dedup_exact", f"SELECT DISTINCT {LINE_COLUMNS} FROM lineitem")
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_exact_duplicates(_doubled(spark, sf)).withColumn("l_tax", F.col("l_tax") + F.lit(0.0))


@query(
    "dedup_report",
    """SELECT count(*) + (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rows_read, count(*) AS rows_kept,
  (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rows_removed FROM (SELECT DISTINCT * FROM lineitem)""",
)
def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return clean.duplicate_report(_doubled(spark, sf))


@query(
    "dedup_keyed",
    f"""SELECT {LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
FROM lineitem) WHERE rn = 1""",
)
def dedup_keyed(spark: SparkSession, sf: str) -> DataFrame:
    lines = _doubled(spark, sf)
    kept = clean.drop_key_duplicates(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return kept.withColumn("l_tax", F.col("l_tax") + F.lit(0.0))


def _slices(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (supplier, day, part, quantity) of finished lines, and those of all other lines and of all since 1998."""
    rows = a.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        "l_linestatus",
    )
    old = rows.filter(F.col("l_linestatus") == "F").drop("l_linestatus").dropDuplicates()
    return old, rows.filter((F.col("day") >= "1998-01-01") | ~F.col("l_linestatus").eqNullSafe("F")).drop("l_linestatus")


SLICES_SQL = """
rows_ AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS day, l_partkey AS product,
  CAST(l_quantity AS BIGINT) AS qty, l_linestatus FROM lineitem),
old AS (SELECT DISTINCT entity, day, product, qty FROM rows_ WHERE l_linestatus = 'F'),
inc AS (SELECT entity, day, product, qty FROM rows_ WHERE day >= DATE '1998-01-01' OR l_linestatus IS DISTINCT FROM 'F')"""


@query(
    "append_new_rows",
    f"""WITH {SLICES_SQL} SELECT entity, CAST(day AS VARCHAR) AS day, product, qty FROM
  (SELECT * FROM old UNION SELECT * FROM inc)""",
)
def append_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean.append_new_rows(*_slices(spark, sf))


@query(
    "only_new_rows",
    f"""WITH {SLICES_SQL} SELECT entity, CAST(day AS VARCHAR) AS day, product, qty FROM
  (SELECT * FROM inc EXCEPT SELECT * FROM old)""",
)
def only_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean.only_new_rows(*_slices(spark, sf))


@query(
    "append_counts",
    f"""WITH {SLICES_SQL}, u AS (SELECT * FROM old UNION SELECT * FROM inc),
o AS (SELECT entity, count(*) AS n FROM old GROUP BY entity), i AS (SELECT entity, count(*) AS n FROM inc GROUP BY entity),
t AS (SELECT entity, count(*) AS n FROM u GROUP BY entity)
SELECT t.entity, coalesce(o.n, 0) AS rows_before, coalesce(i.n, 0) AS rows_incoming, t.n AS rows_after,
  t.n - coalesce(o.n, 0) AS rows_new FROM t LEFT JOIN o ON o.entity = t.entity LEFT JOIN i ON i.entity = t.entity""",
)
def append_counts(spark: SparkSession, sf: str) -> DataFrame:
    old, incoming = _slices(spark, sf)
    return clean.append_counts(old, incoming, "entity")


@query(
    "impute_nulls",
    f"""WITH {a.SUPPLIER_SQL},
n AS (SELECT entity, order_id, line_no, CASE WHEN unit <> 'R' THEN qty_produced END AS q,
  CASE WHEN compound <> 'Brand#1' THEN mass_kg_per_100 END AS m, CASE WHEN qty_scrapped < 3 THEN compound END AS c FROM s_prod),
f AS (SELECT quantile_cont(CAST(q AS DOUBLE), 0.5) AS mq, quantile_cont(CAST(m AS DOUBLE), 0.5) AS mm FROM n),
t AS (SELECT c AS top FROM n WHERE c IS NOT NULL GROUP BY c ORDER BY count(*) DESC, c LIMIT 1)
SELECT entity, order_id, CAST(line_no AS BIGINT) AS line_no, round(coalesce(CAST(q AS DOUBLE), mq), 4) AS qty_produced,
  round(coalesce(CAST(m AS DOUBLE), mm), 6) AS mass_kg_per_100, coalesce(c, top) AS compound,
  'Desconhecido' AS unlabelled FROM n, f, t""",
)
def impute_nulls(spark: SparkSession, sf: str) -> DataFrame:
    fact = a.supplier_production(spark, sf).select(
        "entity",
        "order_id",
        "line_no",
        F.when(F.col("unit") != "R", F.col("qty_produced")).alias("qty_produced"),
        F.when(F.col("compound") != "Brand#1", F.col("mass_kg_per_100")).alias("mass_kg_per_100"),
        F.when(F.col("qty_scrapped") < 3, F.col("compound")).alias("compound"),
        F.lit(None).cast("string").alias("unlabelled"),
    )
    filled = clean.impute_nulls(fact, numeric=["qty_produced", "mass_kg_per_100"], text=["compound", "unlabelled"])
    return rounded(rounded(filled, 4, "qty_produced"), 6, "mass_kg_per_100")


@query(
    "parse_dates",
    """WITH t AS (SELECT o_orderkey, CASE o_orderstatus
    WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, 'on %d/%m') END AS data_texto FROM orders)
SELECT o_orderkey, strftime(coalesce(try_strptime(data_texto, '%d/%m/%Y %H:%M:%S'), try_strptime(data_texto, '%Y-%m-%d')),
  '%Y-%m-%d %H:%M:%S') AS data_texto FROM t
WHERE coalesce(try_strptime(data_texto, '%d/%m/%Y %H:%M:%S'), try_strptime(data_texto, '%Y-%m-%d')) IS NOT NULL""",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "'on' dd/MM"))
    )
    raw = a.table(spark, sf, "orders").select("o_orderkey", text.alias("data_texto"))
    parsed = clean.convert_date_columns(raw, ["dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd"])
    return clean.drop_undated(parsed, "data_texto")


@query(
    "period_filter",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate <= TIMESTAMP '1998-02-28'""",
)
def period_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.within_period(a.table(spark, sf, "lineitem"), "l_shipdate", "1997-03-01", "1998-02-28")
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "period_summary",
    """SELECT CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS periodo_inicio, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS periodo_fim,
  date_diff('day', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))) AS total_dias,
  date_diff('day', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))) // 30 AS total_meses,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_pecas, count(*) AS registros FROM lineitem""",
)
def period_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines = a.table(spark, sf, "lineitem").select("l_shipdate", F.col("l_quantity").cast("bigint").alias("q"))
    return stats.period_summary(lines, ts="l_shipdate", quantity="q")


@query(
    "entity_presence",
    """SELECT s_suppkey AS entity, CAST(EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey) AS BIGINT) AS has_production
FROM supplier""",
)
def entity_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a supplier has lines: their distinct keys, combined in the map tasks, and one join."""
    suppliers = a.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"))
    lines = a.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity"))
    return clean.presence(suppliers, lines, "entity", "has_production")


@query(
    "dimension_defaults",
    f"""WITH {a.SUPPLIER_DIM_SQL}
SELECT s_suppkey AS entity, CAST(coalesce(last, DATE '2000-01-01') AS VARCHAR) AS last_replacement,
  coalesce(interval_days, 365) AS interval_days FROM supplier LEFT JOIN s_dim ON entity = s_suppkey""",
)
def dimension_defaults(spark: SparkSession, sf: str) -> DataFrame:
    defaults = a.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entity"),
        F.lit("2000-01-01").cast("date").alias("last_replacement"),
        F.lit(features.DEFAULT_INTERVAL_DAYS).alias("interval_days"),
    )
    return features.with_defaults(
        a.supplier_maintenance(spark, sf), defaults, "entity", ["last_replacement", "interval_days"]
    )
