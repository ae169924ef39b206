"""Star-schema tables presented as production records and maintenance data.

Two readings of the same tables: *customers* (orders joined with lineitem) feed events,
windows and prescription; *suppliers* (lineitem joined with part) feed cleaning, features,
statistics and reports. Every function has its SQL twin as a CTE below it.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

AS_OF = datetime.date(2000, 7, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- customers

def customer_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as records of the customer they went to."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("entity"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "entity",
        F.col("l_shipdate").alias("prod_ts"),
        F.col("l_quantity").cast("bigint").alias("qty_produced"),
        (F.col("l_extendedprice") / 1000).cast("decimal(12,5)").alias("mass_kg_per_100"),
    )


def customer_maintenance(spark: SparkSession, sf_dir: str, *, measured: bool = True) -> DataFrame:
    """Urgent orders as replacements, measured by the lines of the order.

    ``measured=False`` leaves the measures NULL and saves reading the lines.
    """
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    # Only the lines of urgent orders are shuffled to be aggregated.
    measures = (
        table(spark, sf_dir, "lineitem")
        .join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_quantity").alias("componente_a_max"),
            F.min("l_quantity").alias("componente_a_min"),
            F.max(F.col("l_extendedprice") / 100).alias("componente_b_max"),
            F.min(F.col("l_extendedprice") / 100).alias("componente_b_min"),
        )
    )
    names = [c for c in measures.columns if c.startswith("componente")]
    if measured:
        orders = orders.join(measures, "o_orderkey", "left")
    else:
        orders = orders.withColumns({c: F.lit(None).cast("double") for c in names})
    return orders.select(
        F.col("o_custkey").alias("equipamento"),
        F.to_date("o_orderdate").alias("data_ultima_substituicao"),
        F.lit(None).cast("date").alias("data_penultima_substituicao"),
        F.lit(None).cast("int").alias("dias_em_operacao"),
        F.col("o_orderstatus").alias("observacoes"),
        "componente_a_max",
        "componente_a_min",
        "componente_b_max",
        "componente_b_min",
        F.lit("orders").alias("arquivo_origem"),
    )


def customer_maintenance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer in the shape of a maintenance sheet: last and previous replacement date."""
    log = customer_maintenance(spark, sf_dir)
    dates = log.groupBy("equipamento", "data_ultima_substituicao").agg(
        F.max(F.struct("componente_a_max", "componente_a_min", "componente_b_max", "componente_b_min", "observacoes")).alias("m")
    )
    newest = Window.partitionBy("equipamento").orderBy(F.desc("data_ultima_substituicao"))
    two = dates.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= 2)
    first, second = F.col("rn") == 1, F.col("rn") == 2
    return (
        two.groupBy("equipamento")
        .agg(
            F.max(F.when(first, F.col("data_ultima_substituicao"))).alias("data_ultima_substituicao"),
            F.max(F.when(second, F.col("data_ultima_substituicao"))).alias("data_penultima_substituicao"),
            F.max(F.when(first, F.col("m"))).alias("m"),
        )
        .select(
            "equipamento",
            "data_ultima_substituicao",
            "data_penultima_substituicao",
            F.datediff("data_ultima_substituicao", "data_penultima_substituicao").alias("dias_em_operacao"),
            "m.observacoes",
            "m.componente_a_max",
            "m.componente_a_min",
            "m.componente_b_max",
            "m.componente_b_min",
            F.lit("orders").alias("arquivo_origem"),
        )
    )


def customer_preventive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-priority orders as preventive events."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "2-HIGH")
        .select(
            F.col("o_custkey").alias("equipamento"),
            F.to_date("o_orderdate").alias("data_evento"),
            F.col("o_orderstatus").alias("tipo_evento"),
            F.lit("orders").alias("arquivo_origem"),
        )
    )


CUSTOMER_SQL = """
c_prod AS (
  SELECT o_custkey AS equipamento, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS day,
         CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice / 1000 AS DECIMAL(12,5)) AS mass
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c_measure AS (
  SELECT l_orderkey, max(l_quantity) AS a_max, min(l_quantity) AS a_min,
         max(l_extendedprice / 100) AS b_max, min(l_extendedprice / 100) AS b_min
  FROM lineitem GROUP BY l_orderkey),
c_log AS (
  SELECT o_custkey AS equipamento, CAST(o_orderdate AS DATE) AS last, o_orderstatus AS notes,
         a_max, a_min, b_max, b_min
  FROM orders LEFT JOIN c_measure ON l_orderkey = o_orderkey
  WHERE o_orderpriority = '1-URGENT'),
c_prev AS (
  SELECT o_custkey AS equipamento, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS notes
  FROM orders WHERE o_orderpriority = '2-HIGH'),
c_recent AS (
  SELECT equipamento, last, notes, a_max, a_min, b_max, b_min FROM (
    SELECT *, row_number() OVER (PARTITION BY equipamento ORDER BY last DESC, notes DESC NULLS LAST,
      a_max DESC NULLS LAST, a_min DESC NULLS LAST, b_max DESC NULLS LAST, b_min DESC NULLS LAST) AS rn
    FROM c_log) WHERE rn = 1),
c_win AS (
  SELECT equipamento, s, e FROM (
    SELECT equipamento, last AS s, lead(last) OVER (PARTITION BY equipamento ORDER BY last) AS e FROM c_log)
  WHERE e IS NOT NULL),
c_window AS (
  SELECT w.equipamento, w.s, w.e, date_diff('day', w.s, w.e) AS days,
         CAST(coalesce(sum(p.qty), 0) AS BIGINT) AS qty,
         CAST(CAST(coalesce(sum(p.mass * p.qty), 0) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2)) AS DOUBLE) AS kg
  FROM (SELECT row_number() OVER () AS id, * FROM c_win) w
  LEFT JOIN c_prod p ON p.equipamento = w.equipamento AND p.ts >= w.s AND p.ts < w.e
  GROUP BY w.id, w.equipamento, w.s, w.e)"""

# ---------------------------------------------------------------- suppliers


def supplier_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as production records of the supplier; the brand stands for the compound."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("compound"))
    line = table(spark, sf_dir, "lineitem")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product"),
        "compound",
        F.col("l_returnflag").alias("unit"),
        F.col("l_shipdate").alias("prod_ts"),
        F.col("l_quantity").cast("bigint").alias("qty_produced"),
        F.floor(F.col("l_quantity") * F.round(F.col("l_discount") * 100) / 100).cast("bigint").alias("qty_scrapped"),
        F.floor(F.col("l_quantity") * F.round(F.col("l_tax") * 100) / 100).cast("bigint").alias("qty_reworked"),
        (F.col("l_extendedprice") / 1000).cast("decimal(12,5)").alias("mass_kg_per_100"),
    )


def supplier_maintenance(spark: SparkSession, sf_dir: str, *, unmapped: bool = False) -> DataFrame:
    """Maintenance sheet per supplier: last urgent order before 2000 and before 1999, sizes around 20.

    Suppliers in debt lack measurements. Those with a balance above 9000 have no sheet, which leaves their records
    unmapped; ``unmapped`` gives every supplier a sheet.
    """
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    lines = table(spark, sf_dir, "lineitem")

    def newest_before(year: str):
        return F.max(F.when(F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("date"), F.to_date("o_orderdate")))

    dates = (
        lines.select("l_orderkey", "l_suppkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey")
        .agg(newest_before("2000").alias("last_replacement"), newest_before("1999").alias("previous_replacement"))
    )
    sizes = lines.groupBy("l_suppkey").agg(
        F.round(20 + F.max("l_extendedprice") / 500000, 4).alias("a_max"),
        F.round(20 - F.min("l_extendedprice") / 50000, 4).alias("a_min"),
        F.round(20 - F.min("l_extendedprice") / 100000, 4).alias("b_max"),
        F.round(20 - F.sum(F.col("l_quantity").cast("bigint")) / F.count("l_quantity") / 50, 4).alias("b_min"),
    )
    measured = F.col("s_acctbal") >= 0
    suppliers = table(spark, sf_dir, "supplier")
    return (
        (suppliers if unmapped else suppliers.filter(F.col("s_acctbal") <= 9000))
        .withColumnRenamed("s_suppkey", "l_suppkey")
        .join(dates, "l_suppkey", "left")
        .join(sizes, "l_suppkey", "left")
        .select(
            F.col("l_suppkey").alias("entity"),
            "last_replacement",
            "previous_replacement",
            F.datediff("last_replacement", "previous_replacement").alias("interval_days"),
            F.col("s_name").alias("notes"),
            F.when(measured, F.col("a_max")).alias("componente_a_max"),
            F.when(measured, F.col("a_min")).alias("componente_a_min"),
            F.when(measured, F.col("b_max")).alias("componente_b_max"),
            F.when(measured, F.col("b_min")).alias("componente_b_min"),
        )
    )


SUPPLIER_SQL = """
s_prod AS (
  SELECT l_suppkey AS entity, l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product,
         p_brand AS compound, l_returnflag AS unit, l_shipdate AS prod_ts,
         CAST(l_quantity AS BIGINT) AS qty_produced,
         CAST(floor(l_quantity * round(l_discount * 100) / 100) AS BIGINT) AS qty_scrapped,
         CAST(floor(l_quantity * round(l_tax * 100) / 100) AS BIGINT) AS qty_reworked,
         CAST(l_extendedprice / 1000 AS DECIMAL(12,5)) AS mass_kg_per_100
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

SUPPLIER_DIM_SQL = """
s_dates AS (
  SELECT l_suppkey, max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS last,
         max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderdate < TIMESTAMP '1999-01-01') AS previous
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY l_suppkey),
s_sizes AS (
  SELECT l_suppkey, round(20 + max(l_extendedprice) / 500000, 4) AS a_max,
         round(20 - min(l_extendedprice) / 50000, 4) AS a_min,
         round(20 - min(l_extendedprice) / 100000, 4) AS b_max,
         round(20 - CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(l_quantity) / 50, 4) AS b_min
  FROM lineitem GROUP BY l_suppkey),
s_all AS (
  SELECT s_suppkey AS entity, s_acctbal, last, previous, date_diff('day', previous, last) AS interval_days, s_name AS notes,
         CASE WHEN s_acctbal >= 0 THEN a_max END AS a_max, CASE WHEN s_acctbal >= 0 THEN a_min END AS a_min,
         CASE WHEN s_acctbal >= 0 THEN b_max END AS b_max, CASE WHEN s_acctbal >= 0 THEN b_min END AS b_min
  FROM supplier LEFT JOIN s_dates d ON d.l_suppkey = s_suppkey LEFT JOIN s_sizes z ON z.l_suppkey = s_suppkey),
s_dim AS (SELECT * EXCLUDE (s_acctbal) FROM s_all WHERE s_acctbal <= 9000)"""
