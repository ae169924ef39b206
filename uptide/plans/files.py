"""Given tables written by the sinks and read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide import schema
from uptide.plans import adapters as a
from uptide.plans.registry import query
from uptide.session import shared_folder
from uptide.sources import readers, sinks, snapshots


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return a.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("bigint").alias("qty_produced"),
        F.col("l_extendedprice").alias("price"),
    )


LINES_SQL = """SELECT l_suppkey AS entity, l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CAST(l_quantity AS BIGINT) AS qty_produced, l_extendedprice AS price FROM lineitem"""


@query("entity_split", LINES_SQL)
def entity_split(spark: SparkSession, sf: str) -> DataFrame:
    """Lines split into a folder per supplier; a second append finds nothing new to write."""
    path = shared_folder(spark, "entity-split")
    lines = _lines(spark, sf)
    sinks.split_by_entity(lines, path, mode="overwrite")
    sinks.append_production(spark, lines, path)
    return readers.read_stage(spark, path, columns=lines.schema)


@query("stage_csv", LINES_SQL)
def stage_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "stage-csv")
    sinks.write_stage(_lines(spark, sf), path, "csv")
    return readers.read_stage(spark, path, "csv", _lines(spark, sf).schema)


@query("stage_json", LINES_SQL)
def stage_json(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "stage-json")
    sinks.write_stage(_lines(spark, sf), path, "json")
    return readers.read_stage(spark, path, "json", _lines(spark, sf).schema)


@query(
    "production_files",
    """SELECT 'EQ-' || l_suppkey AS entity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS prod_ts, l_orderkey AS order_id,
  CAST(l_partkey AS VARCHAR) AS product, CAST(l_quantity AS BIGINT) AS qty_produced, CAST(l_linenumber AS BIGINT) AS qty_scrapped,
  CASE WHEN l_orderkey % 2 = 0 THEN l_returnflag END AS compound FROM lineitem""",
)
def production_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as production files of two layouts in one folder: the standard one, and another order without a compound."""
    path = shared_folder(spark, "production-files")
    head = {name: header for header, name in schema.PRODUCTION_HEADERS.items()}
    lines = a.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias(head["order_id"]),
        F.date_format("l_shipdate", "dd/MM/yyyy HH:mm:ss").alias(head["prod_date"]),
        F.concat(F.lit("EQ-"), "l_suppkey").alias(head["resource"]),
        F.col("l_partkey").alias(head["product"]),
        F.col("l_quantity").cast("bigint").alias(head["qty_produced"]),
        F.col("l_linenumber").alias(head["qty_scrapped"]),
        F.col("l_returnflag").alias(head["compound"]),
    )
    even = F.col(f"`{head['order_id']}`") % 2 == 0
    backwards = [F.col(f"`{c}`") for c in reversed(lines.columns) if c != head["compound"]]
    for part in (lines.filter(even), lines.filter(~even).select(*backwards)):
        part.write.mode("append").option("header", True).csv(path)
    found = readers.read_consolidated_files(spark, path, "part-*.csv")
    return found.select("entity", "prod_ts", "order_id", "product", "qty_produced", "qty_scrapped", "compound")


# Columns of the given tables, i whole numbers, s text, d fractions, t timestamps, v lists of fractions.
TABLE_COLUMNS = {
    "region": "i r_regionkey, s r_name",
    "nation": "i n_nationkey, s n_name, i n_regionkey",
    "customer": "i c_custkey, s c_name, i c_nationkey, d c_acctbal, s c_mktsegment",
    "supplier": "i s_suppkey, s s_name, i s_nationkey, d s_acctbal",
    "part": "i p_partkey, s p_name, s p_brand, s p_type, i p_size, d p_retailprice",
    "orders": "i o_orderkey, i o_custkey, s o_orderstatus, d o_totalprice, t o_orderdate, s o_orderpriority",
    "lineitem": "i l_orderkey, i l_partkey, i l_suppkey, i l_linenumber, d l_quantity, d l_extendedprice, d l_discount, d l_tax, s l_returnflag, s l_linestatus, t l_shipdate",
    "events": "i event_id, t ts, i user_id, s event_type, d value, s props",
    "documents": "i doc_id, s text, s lang, s source, i n_chars",
    "embeddings": "i vec_id, v embedding, i label",
    "pages": "i page_id, s url, s html",
    "benchmark": "i item_id, s text",
    "labels": "i doc_id, i quality, i toxic",
    "conversations": "i conv_id, i turn, s role, s text",
}


def _columns(table: str) -> list[tuple[str, str]]:
    return [(c[0], c[2:]) for c in TABLE_COLUMNS[table].split(", ")]


def _table_digest_sql(table: str) -> str:
    number = "CAST(CAST(floor(CAST({} AS DOUBLE) * 10000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR)"
    text = {
        "i": "CAST({} AS VARCHAR)", "s": "{}", "t": "CAST(epoch_us({}) AS VARCHAR)", "d": number,
        "v": f"array_to_string(list_transform({{}}, lambda x: coalesce({number.format('x')}, '')), ',')",
    }
    cells = [text[kind].format(name) for kind, name in _columns(table)]
    row = " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in cells)
    return f"SELECT '{table}' AS name, CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT) AS h FROM {table}"


@query(
    "file_snapshot",
    f"""WITH h AS ({" UNION ALL ".join(_table_digest_sql(t) for t in TABLE_COLUMNS)}),
b AS (SELECT name, h % 256 AS bucket, count(*) AS n, sum(h) AS digest FROM h GROUP BY 1, 2)
SELECT name, CAST(sum(n) AS BIGINT) AS n_rows, md5(string_agg(bucket || ':' || n || ':' || digest, ',' ORDER BY bucket)) AS hash FROM b GROUP BY name""",
)
def file_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and content hash of each given table, the same however its rows are split into files."""
    digests = None
    for name in TABLE_COLUMNS:
        rows = a.table(spark, sf, name).select(*[c for _, c in _columns(name)])
        one = snapshots.bucket_digests(rows, F.lit(name), snapshots.portable_row_hash(rows))
        digests = one if digests is None else digests.unionByName(one)
    return snapshots.file_hashes(digests).withColumnRenamed("file", "name")


CHANGED = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_returnflag"


@query(
    "table_changes",
    f"""WITH old AS (SELECT {CHANGED} FROM lineitem),
new AS (SELECT * REPLACE (CASE WHEN l_orderkey % 89 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM old WHERE l_orderkey % 97 <> 0),
d AS (SELECT 'removed' AS side, * FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) UNION ALL SELECT 'added', * FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old))
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_returnflag, side, count(*) AS copies FROM d GROUP BY ALL""",
)
def table_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that differ between two versions of lineitem, whose unequal buckets alone are compared row by row."""
    root = shared_folder(spark, "versions")
    old = a.table(spark, sf, "lineitem").selectExpr("l_orderkey", "CAST(l_linenumber AS BIGINT) l_linenumber", "l_suppkey", "CAST(l_quantity AS BIGINT) l_quantity", "l_returnflag")
    quantity = F.when(F.col("l_orderkey") % 89 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    new = old.filter(F.col("l_orderkey") % 97 != 0).withColumn("l_quantity", quantity)
    versions = []
    # The order of a line decides its bucket, so that changed lines meet in few buckets.
    key = F.xxhash64("l_orderkey")
    for name, rows in (("old", old), ("new", new)):
        rows.write.parquet(f"{root}/{name}")
        table = spark.read.schema(rows.schema).parquet(f"{root}/{name}")
        digests = snapshots.bucket_digests(table, F.lit("lineitem"), snapshots.row_hash(table), 4096, key)
        versions.append((table, (snapshots.file_hashes(digests), digests)))
    (before, was), (after, now) = versions
    return snapshots.changed_rows(before, after, snapshots.changed_buckets(was, now), key, 4096)
