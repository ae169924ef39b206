"""Streaming ingestion of the events table, and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.plans import adapters as a
from uptide.plans.registry import query
from uptide.session import shared_folder
from uptide.sources import listing
from uptide.streaming import ingest

KEYS = ["event_id"]


def _run(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame]:
    """Ingest the events table as a stream; returns the table, the partial sums, and a batch frame with its schema."""
    batch = a.table(spark, sf, "events").drop("props")
    # the pattern matches a single file as well as a directory of part files
    stream = spark.readStream.schema(a.table(spark, sf, "events").schema).parquet(f"{sf}/events.parq*et").drop("props")
    root = shared_folder(spark, "ingest")
    cents = F.round(F.col("value") * 100).cast("bigint")
    partials = ingest.daily_partials(f"{root}/daily", entity="user_id", ts="ts", compound="event_type", quantity="cents")
    started = ingest.start_ingestion(
        stream,
        target=f"{root}/table",
        checkpoint=f"{root}/checkpoint",
        keys=KEYS,
        ts="ts",
        after=lambda stored, n: partials(stored.withColumn("cents", cents), n),
        poll_seconds=None,
    )
    started.awaitTermination()
    return f"{root}/table", f"{root}/daily", batch


@query("stream_ingest", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value FROM events")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    target, _, batch = _run(spark, sf)
    return ingest.read_ingested(spark, target, batch.schema)


@query(
    "stream_monthly",
    """SELECT user_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS mes, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS qtd,
  count(*) AS registros, count(DISTINCT CAST(ts AS DATE)) AS dias FROM events GROUP BY 1, 2, 3""",
)
def stream_monthly(spark: SparkSession, sf: str) -> DataFrame:
    _, daily, _ = _run(spark, sf)
    return ingest.monthly_from_partials(spark, daily, entity="user_id", compound="event_type")


WAVES = 10


@query(
    "stream_waves",
    """SELECT user_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS mes, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS qtd,
  count(*) AS registros, count(DISTINCT CAST(ts AS DATE)) AS dias, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM events GROUP BY 1, 2, 3""",
)
def stream_waves(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive in waves, each with the wave before it again, dated 40 days later: only the first arrival counts.

    The batches' daily sums are merged in levels of four, so parts of two levels answer.
    """
    root = shared_folder(spark, "waves")
    events = a.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    wave = F.pmod("event_id", F.lit(WAVES))
    again = events.withColumn("ts", F.expr("ts + INTERVAL 40 DAYS")).withColumn("cents", F.col("cents") + 1)
    for w in range(WAVES):
        events.filter(wave == w).unionByName(again.filter(wave == w - 1)).write.parquet(f"{root}/source/wave-{w}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/source/*")
        partials = ingest.daily_partials(f"{root}/daily", entity="user_id", ts="ts", compound="event_type", quantity="cents", fanout=4)
        ingest.start_ingestion(
            stream, target=f"{root}/table", checkpoint=f"{root}/checkpoint", keys=KEYS, ts="ts", after=partials, poll_seconds=None
        ).awaitTermination()
    total = ingest.read_ingested(spark, f"{root}/table", events.schema).agg(F.count(F.lit(1)))
    months = ingest.monthly_from_partials(spark, f"{root}/daily", entity="user_id", compound="event_type")
    return months.select("*", total.scalar().alias("total"))


@query("input_listing")
def input_listing(spark: SparkSession, sf: str) -> DataFrame:
    return listing.list_files(spark, sf).select("category", "name", "size")


@query(
    "json_export",
    """WITH t AS (SELECT l_suppkey AS equipamento, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, max(l_returnflag) AS flag FROM lineitem GROUP BY 1)
SELECT equipamento, '{"equipamento":' || equipamento || ',"total_produzido":' || total || ',"unidade":"' || flag || '"}' AS registro, total AS lido FROM t""",
)
def json_export(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics as JSON records, and a field read back from them."""
    totals = (
        a.table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("equipamento"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_produzido"), F.max("l_returnflag").alias("unidade"))
    )
    encoded = totals.select("equipamento", F.to_json(F.struct("equipamento", "total_produzido", "unidade")).alias("registro"))
    return encoded.withColumn(
        "lido", F.from_json("registro", "equipamento bigint, total_produzido bigint, unidade string")["total_produzido"]
    )
