"""Statistics per entity and of the whole data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptide.functions.scalar import rate_pct


def entity_statistics(features: DataFrame, maintenance: DataFrame, *, entity: str = "entity") -> DataFrame:
    """Production, quality, target and wear per entity, next to its maintenance attributes.

    ``media_producao_diaria`` and its siblings are means per record. ``maintenance``:
    entity, interval_days, last_replacement, previous_replacement, notes, four measures.
    """
    # Optional inputs -> (output, aggregate); inputs that are not present are skipped.
    wanted = [
        ("qty_produced", "total_produzido", F.sum),
        ("qty_produced", "media_producao_diaria", F.avg),
        ("qty_produced", "max_producao_diaria", F.max),
        ("qty_produced", "total_registros", F.count),
        ("qty_produced_acumulado", "producao_acumulada", F.max),
        ("qty_scrapped", "total_refugado", F.sum),
        ("qty_scrapped", "media_refugo_diario", F.avg),
        ("qty_reworked", "total_retrabalhado", F.sum),
        ("qty_reworked", "media_retrabalho_diario", F.avg),
        ("mass_kg_per_100", "consumo_massa_total_kg", F.sum),
        ("mass_kg_per_100", "consumo_massa_medio_kg", F.avg),
        ("target", "media_dias_manutencao", F.avg),
        ("target", "min_dias_manutencao", F.min),
        ("target", "max_dias_manutencao", F.max),
        ("indice_desgaste", "indice_desgaste_medio", F.avg),
        ("desgaste_componente_a", "desgaste_componente_a_medio", F.avg),
        ("desgaste_componente_b", "desgaste_componente_b_medio", F.avg),
    ]
    aggs = [f(c).alias(out) for c, out, f in wanted if c in features.columns]
    stats = features.filter(F.col(entity).isNotNull()).groupBy(entity).agg(*aggs)
    if {"total_produzido", "total_refugado"} <= set(stats.columns):
        stats = stats.withColumn("taxa_refugo_pct", rate_pct(F.col("total_refugado"), F.col("total_produzido")))
    attributes = maintenance.select(
        entity,
        F.col("interval_days").alias("intervalo_manutencao_dias"),
        F.to_date("last_replacement").alias("data_ultima_manutencao"),
        F.to_date("previous_replacement").alias("data_penultima_manutencao"),
        F.col("notes").alias("observacoes_manutencao"),
        "componente_a_max",
        "componente_a_min",
        "componente_b_max",
        "componente_b_min",
    )
    return stats.join(attributes, entity, "left").withColumnRenamed(entity, "equipamento")


def period_summary(df: DataFrame, *, ts: str, quantity: str) -> DataFrame:
    """First and last date, days between them, whole 30-day months, pieces and records."""
    d = F.to_date(ts)
    days = F.datediff(F.max(d), F.min(d))
    return df.agg(
        F.min(d).alias("periodo_inicio"),
        F.max(d).alias("periodo_fim"),
        days.alias("total_dias"),
        F.floor(days / 30).cast("bigint").alias("total_meses"),
        F.sum(quantity).alias("total_pecas"),
        F.count(F.lit(1)).alias("registros"),
    )


def interval_statistics(dimension: DataFrame, interval: str) -> DataFrame:
    return dimension.agg(
        F.avg(interval).alias("media_dias"), F.min(interval).alias("min_dias"), F.max(interval).alias("max_dias")
    )


def entity_summary(df: DataFrame, *, entity: str, produced: str, scrapped: str, target: str) -> DataFrame:
    """Totals, mean target and scrap rate (0 when undefined) per entity, with the fleet means of both."""
    per_entity = (
        df.filter(F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("equipamento"))
        .agg(
            F.sum(produced).alias("total_produzido"),
            F.sum(scrapped).alias("total_refugado"),
            F.avg(target).alias("media_dias"),
        )
        .withColumn(
            "taxa_refugo",
            F.coalesce(F.try_divide(F.col("total_refugado").cast("double"), F.col("total_produzido")) * 100, F.lit(0.0)),
        )
    )
    fleet = per_entity.agg(F.struct(F.avg("taxa_refugo").alias("rate"), F.avg("media_dias").alias("days")))
    columns = per_entity.columns
    return per_entity.select("*", fleet.scalar().alias("__fleet")).select(
        *columns,
        F.col("__fleet.rate").alias("media_frota_taxa"),
        F.col("__fleet.days").alias("media_frota_dias"),
    )
