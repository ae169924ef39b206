"""Writers: per-entity tables, stage tables, statistics, splits, models, text reports, run log."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from uptide.operators.clean import only_new_rows
from uptide.session import few_listing_tasks, freed_shuffles


def split_by_entity(df: DataFrame, path: str, entity: str = "entity", mode: str = "append") -> None:
    """One directory per entity. The rebalance hint splits a large entity over several tasks and merges small ones."""
    df.filter(F.col(entity).isNotNull()).hint("rebalance", entity).write.partitionBy(entity).mode(mode).parquet(path)


def append_production(spark: SparkSession, incoming: DataFrame, path: str, entity: str = "entity") -> None:
    """Append the rows a per-entity table does not hold yet; one atomic write."""
    with few_listing_tasks(spark):
        existing = spark.read.schema(_partition_last(incoming, entity)).parquet(path).select(*incoming.columns)
    split_by_entity(only_new_rows(existing, incoming), path, entity)


def _partition_last(df: DataFrame, entity: str) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != entity], df.schema[entity]])


def write_stage(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Stage table: parquet by default, CSV with header and ISO dates, or JSON records."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True).option("dateFormat", "yyyy-MM-dd").option("timestampFormat", "yyyy-MM-dd")
    writer.format(kind).save(path)


def export_statistics(stats: DataFrame, path: str) -> None:
    """Statistics as CSV and as JSON records, side by side; NULL fields are written."""
    write_stage(stats, f"{path}/csv", "csv")
    stats.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/json")


def save_split(df: DataFrame, path: str) -> DataFrame:
    """Write train and test rows to one table partitioned by ``split``, and read it back; what was shuffled for it is freed."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_models(models: dict[str, PipelineModel], path: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/model_{name}")


def save_best_model(models: dict[str, PipelineModel], metrics: DataFrame, best: DataFrame, path: str) -> str:
    """Store the winning model next to its name and metrics; returns the name."""
    name = best.first()["model"]
    models[name].write().overwrite().save(f"{path}/best_model")
    metrics.filter(F.col("model") == name).write.mode("overwrite").json(f"{path}/best_metrics")
    return name


def load_best_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/best_model")


def write_reports(lines: DataFrame, path: str, entity: str = "equipamento") -> None:
    """Text files per entity from lines ``(entity, secao, chave, linha)``.

    Rows are range-partitioned in reading order, so a document is its entity's files in
    name order, also when it is large enough to span tasks.
    """
    order = [entity, "secao", "chave"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(entity, "linha").write.mode("overwrite").partitionBy(entity).text(path)

