"""The batch stages on files: collect, preprocess, cross-reference, prescribe, report.

Each stage is a lazy DataFrame (or a few); write it with ``sources.sinks`` or go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from uptide.operators import events, features, prescribe, reports, stats
from uptide.operators.clean import drop_exact_duplicates, impute_nulls
from uptide.session import stored
from uptide.sources.readers import as_dimension, as_event_source

QUANTITIES = ("qty_produced", "qty_scrapped", "qty_reworked", "mass_kg_per_100")
TIEBREAK = ("order_id", "product", *QUANTITIES, "unit_factor", "compound")


def preprocess(production: DataFrame, maintenance: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """Cleaned records with target, running totals and wear features, entities and compounds still readable."""
    dimension = as_dimension(maintenance, defaults)
    clean = impute_nulls(
        drop_exact_duplicates(production),
        numeric=[*QUANTITIES, "unit_factor"],
        text=["compound", "product", "unit"],
    )
    dated = features.maintenance_target(clean, dimension, carry=("interval_days", *events.MEASURES))
    totals = features.cumulative_features(dated, QUANTITIES, tiebreak=TIEBREAK)
    return features.measurement_features(totals, records=dated)


def encode(preprocessed: DataFrame) -> DataFrame:
    """One-hot columns for product, entity, compound and unit; the entity stays as a key."""
    prefixes = {
        "product": "Cod_Produto", "entity_flag": "Equipamento", "compound": "Descricao_da_massa", "unit": "Cod_Un",
    }
    return features.one_hot(preprocessed.withColumn("entity_flag", F.col("entity")), list(prefixes), prefixes=prefixes)


def statistics(preprocessed: DataFrame, maintenance: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    return stats.entity_statistics(preprocessed, as_dimension(maintenance, defaults))


@dataclass
class CrossReference:
    """Event history, latest readings, windows, idle days and the daily production behind them."""

    history: DataFrame
    recent: DataFrame
    windows: DataFrame
    idle: DataFrame
    ledger: DataFrame


def cross_reference(maintenance: DataFrame, preventive: DataFrame | None, production: DataFrame, as_of) -> CrossReference:
    source = as_event_source(maintenance)
    history = events.event_history(source, preventive)
    recent = events.recent_history(source)
    ledger = events.daily_ledger(
        production, entity="entity", ts="prod_ts", quantity="qty_produced", mass="mass_kg_per_100"
    )
    return CrossReference(
        history, recent, events.operation_windows(history, ledger), events.idle_days(recent, ledger, as_of), ledger
    )


def prescriptions(crossed: CrossReference, as_of) -> DataFrame:
    """Prescription table, most pressing first, undated entities last."""
    table = prescribe.prescription(crossed.recent, crossed.history, crossed.ledger, as_of)
    return table.orderBy(F.asc_nulls_last("dias_restantes"), "equipamento")


def component_reports(production: DataFrame, crossed: CrossReference, prescribed: DataFrame) -> DataFrame:
    cells = reports.monthly_cells(
        production, entity="entity", ts="prod_ts", compound="compound", produced="qty_produced", scrapped="qty_scrapped"
    )
    return reports.report_lines(stored(cells, "cells"), stored(prescribed, "prescricao"), crossed.history)
