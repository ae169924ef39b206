"""Features: target, running totals, wear, one-hot columns, dates, day grain, event history."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptide.functions.categories import category_lists
from uptide.functions.prefix import PLACE, running_totals
from uptide.functions.scalar import clean_name, safe_ratio
from uptide.operators.clean import impute_nulls
from uptide.operators.events import MEASURES

# Fixed values of the target and wear formulas.
UNMAPPED_MAINTENANCE_DATE = datetime.date(2024, 6, 1)
DEFAULT_INTERVAL_DAYS = 365
NOMINAL_SIZE = 20.0
WEAR_SPAN = {"a": 0.6, "b": 2.0}
WEAR_WEIGHT = {"a": 0.6, "b": 0.4}
MEASUREMENT_FEATURES = (
    "componente_a_max", "componente_a_min", "componente_a_variacao", "desgaste_componente_a",
    "componente_b_max", "componente_b_min", "componente_b_variacao", "desgaste_componente_b",
)
DERIVED_FEATURES = ("indice_desgaste", "taxa_desgaste_componente_a", "taxa_desgaste_componente_b")
NO_ENTITY_FLAG, NO_ENTITY_COLUMNS = "Outro", "Desconhecido"


def with_defaults(found: DataFrame, defaults: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Dimension values from ``found``, completed per field and per missing key from ``defaults``."""
    f = found.select(key, *[F.col(c).alias(f"__found_{c}") for c in columns])
    d = defaults.select(key, *[F.col(c).alias(f"__default_{c}") for c in columns])
    return f.join(d, key, "full").select(
        key, *[F.coalesce(f"__found_{c}", f"__default_{c}").alias(c) for c in columns]
    )


def maintenance_target(
    fact: DataFrame,
    dimension: DataFrame,
    *,
    entity: str = "entity",
    ts: str = "prod_ts",
    target: str = "target",
    unmapped_date: datetime.date = UNMAPPED_MAINTENANCE_DATE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Days to the next maintenance; rows after it (negative days) and undated rows are dropped.

    ``dimension`` has the entity and ``last_replacement``, ``interval_days``. Before or on
    the last replacement the target counts to it; later, to last + interval. The join carries
    no broadcast hint: Spark broadcasts the dimension only while it is under its threshold.
    ``carry`` names dimension columns to keep, so that later steps need not join again.
    """
    dim = dimension.select(
        entity, F.to_date("last_replacement").alias("__last"), F.col("interval_days").alias("__interval"), *carry
    )
    d = F.to_date(ts)
    due = F.date_add(F.col("__last"), F.coalesce(F.col("__interval"), F.lit(DEFAULT_INTERVAL_DAYS)).cast("int"))
    days = F.when(d > F.col("__last"), F.datediff(due, d)).otherwise(
        F.datediff(F.coalesce(F.col("__last"), F.lit(unmapped_date)), d)
    )
    return fact.join(dim, entity, "left").withColumn(target, days).filter(F.col(target) >= 0).select(*fact.columns, target, *carry)


def cumulative_features(
    fact: DataFrame, columns: Sequence[str], *, entity: str = "entity", ts: str = "prod_ts", tiebreak: Sequence[str] = (), keep_place: bool = False
) -> DataFrame:
    """Running total per entity in date order as ``<column>_acumulado``; days are the blocks, kept with ``keep_place``."""
    return running_totals(
        fact,
        keys=[entity],
        order=[ts, *tiebreak],
        block=F.to_date(ts),
        totals={f"{c}_acumulado": c for c in columns},
        keep_place=keep_place,
    )


def component_wear(maintenance: DataFrame) -> DataFrame:
    """Add range and wear of both components; a component lacking a bound stays NULL."""
    a_max, a_min = F.col("componente_a_max"), F.col("componente_a_min")
    b_max, b_min = F.col("componente_b_max"), F.col("componente_b_min")
    both_a, both_b = a_max.isNotNull() & a_min.isNotNull(), b_max.isNotNull() & b_min.isNotNull()
    return maintenance.withColumns(
        {
            "componente_a_variacao": a_max - a_min,
            "desgaste_componente_a": F.when(both_a, F.when(a_max == 0, 0.0).otherwise(a_max - NOMINAL_SIZE)),
            "componente_b_variacao": b_max - b_min,
            "desgaste_componente_b": F.when(both_b, F.when(b_min == 0, 0.0).otherwise(NOMINAL_SIZE - b_min)),
        }
    )


def wear_rate(wear: Column, interval: Column) -> Column:
    """Wear per day of operation; 0 without wear or with a non-positive interval."""
    return F.when(wear.isNotNull() & (interval > 0), wear / F.nullif(interval, F.lit(0))).otherwise(0.0)


def wear_index(wear_a: Column, wear_b: Column) -> Column:
    """Weighted wear on a 0-100 scale, capped at 100 per component; negative wear is not floored."""

    def score(wear: Column, part: str) -> Column:
        # least skips NULLs, so a missing wear is tested for first
        return F.when(wear.isNotNull(), F.least(F.lit(100.0), wear / WEAR_SPAN[part] * 100)).otherwise(0.0)

    return score(wear_a, "a") * WEAR_WEIGHT["a"] + score(wear_b, "b") * WEAR_WEIGHT["b"]


def wear_per_thousand(wear_a: Column, wear_b: Column, quantity: Column) -> Column:
    total = F.coalesce(wear_a, F.lit(0.0)) + F.coalesce(wear_b, F.lit(0.0))
    return F.when(quantity > 0, safe_ratio(total, quantity.cast("double")) * 1000).otherwise(0.0)


def measurement_features(
    fact: DataFrame,
    maintenance: DataFrame | None = None,
    *,
    entity: str = "entity",
    quantity: str = "qty_produced_acumulado",
    records: DataFrame | None = None,
) -> DataFrame:
    """Attach measurements, wear rates, wear index and wear per 1000 pieces to every record.

    ``maintenance`` has the entity, ``interval_days`` and the four measures; without it,
    ``fact`` carries these columns already (see ``carry`` of :func:`maintenance_target`),
    which saves a second join. Gaps in the measurements are filled with the median over all
    records (0 when all are missing); rates, index and per-1000 wear are computed before
    that filling. ``records`` are the same rows before further columns were added: the
    medians then skip computing those.
    """

    def measured(df: DataFrame) -> DataFrame:
        if maintenance is not None:
            df = df.join(maintenance.select(entity, "interval_days", *MEASURES), entity, "left")
        return component_wear(df)

    a, b = F.col("desgaste_componente_a"), F.col("desgaste_componente_b")
    joined = measured(fact).withColumn("intervalo_manutencao", F.coalesce("interval_days", F.lit(DEFAULT_INTERVAL_DAYS)))
    interval = F.col("intervalo_manutencao")
    wide = joined.drop("interval_days").withColumns(
        {
            "taxa_desgaste_componente_a": wear_rate(a, interval),
            "taxa_desgaste_componente_b": wear_rate(b, interval),
            "indice_desgaste": wear_index(a, b),
            "desgaste_por_1000_pecas": wear_per_thousand(a, b, F.col(quantity)),
        }
    )
    # The measurements are equal for all records of an entity: medians over records are weighted medians over these groups.
    groups = measured(fact if records is None else records).groupBy(*MEASUREMENT_FEATURES).agg(F.count(F.lit(1)).alias("__n"))
    return impute_nulls(wide, numeric=MEASUREMENT_FEATURES, empty_numeric=0.0, source=groups, weight="__n")


def one_hot(df: DataFrame, columns: Sequence[str], *, max_categories: int = 50, prefixes: Mapping[str, str] | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Replace a text column of at most ``max_categories`` values by 0/1 columns, one per value.

    Columns with more values stay as they are. Values are listed while the frame is built, by one job for all columns;
    ``listed`` may be a smaller frame with the same columns and values. A NULL gives 0 everywhere.
    """
    prefixes = prefixes or {}
    lists = category_lists(df if listed is None else listed, columns, max_categories)
    for column in columns:
        values = lists[column]
        if values is None:
            continue
        prefix = prefixes.get(column, column.replace(" ", "_").replace(".", ""))
        flags = {
            clean_name(f"{prefix}_{v}"): F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values
        }
        df = df.withColumns(flags).drop(column)
    return df


def entity_from_one_hot(df: DataFrame, prefix: str = "Equipamento_") -> Column:
    """Entity whose flag is the first one set; ``Outro`` for none, ``Desconhecido`` without flag columns."""
    flags = [c for c in df.columns if c.startswith(prefix)]
    if not flags:
        return F.lit(NO_ENTITY_COLUMNS)
    names = [F.when(F.col(c).cast("int") == 1, c[len(prefix):].replace("_", "-")) for c in flags]
    return F.coalesce(*names, F.lit(NO_ENTITY_FLAG))


def date_features(
    fact: DataFrame, dimension: DataFrame, *, entity: str = "entity", ts: str = "prod_ts"
) -> DataFrame:
    """Weekday (Monday = 0), month, days since the series starts and since the last known maintenance.

    The last maintenance is the later of ``last_replacement`` and ``previous_replacement``
    that is not after the record.
    """
    start = fact.agg(F.min(F.to_date(ts))).scalar()
    dim = dimension.select(
        entity, F.to_date("last_replacement").alias("__last"), F.to_date("previous_replacement").alias("__previous")
    )
    d = F.to_date(ts)
    known = F.when(d >= F.col("__last"), F.col("__last")).when(d >= F.col("__previous"), F.col("__previous"))
    return fact.join(dim, entity, "left").select(
        *fact.columns,
        F.weekday(d).alias("dia_da_semana"),
        F.month(d).alias("mes"),
        F.datediff(d, start).alias("dias_desde_inicio_serie"),
        F.datediff(d, known).alias("dias_desde_ultima_manutencao"),
    )


def entity_day_grain(
    df: DataFrame,
    *,
    entity: str = "entity",
    ts: str = "prod_ts",
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    maxima: Sequence[str] = (),
    constants: Sequence[str] = (),
) -> DataFrame:
    """One row per entity and day: sums, means, maxima, and values constant within the day.

    Constants use ``max`` (equal to "first" for a constant, and independent of row order);
    columns not listed are dropped. Records that kept the days of their running totals lie by
    them already and are grouped where they are, without an exchange.
    """
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [F.avg(c).alias(c) for c in means]
    aggs += [F.max(c).alias(c) for c in (*maxima, *constants)]
    if set(PLACE) <= set(df.columns):
        dated, day = (F.col(c) for c in PLACE)
        return df.groupBy(entity, *PLACE).agg(*aggs).withColumn("day", F.when(dated, day)).select(entity, "day", *sums, *means, *maxima, *constants)
    return df.groupBy(entity, F.to_date(ts).alias("day")).agg(*aggs)


def preventive_features(daily: DataFrame, preventive: DataFrame, *, entity: str = "entity", day: str = "day") -> DataFrame:
    """As-of features on an entity-day table: preventive events so far and days since the last one.

    ``preventive``: entity, ``event_date``. Events are reduced to one row per entity and
    date first, so the ordered pass sees at most two rows per entity and calendar day.
    """
    events = (
        preventive.filter(F.col("event_date").isNotNull())
        .groupBy(entity, F.to_date("event_date").alias(day))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__event", F.col(day))
        .withColumn("__kind", F.lit(0))
    )
    days = daily.withColumn("__kind", F.lit(1))
    so_far = Window.partitionBy(entity).orderBy(day, "__kind").rowsBetween(Window.unboundedPreceding, 0)
    return (
        days.unionByName(events, allowMissingColumns=True)
        .withColumn("preventivas_ate_data", F.coalesce(F.sum("__n").over(so_far), F.lit(0)))
        .withColumn(
            "dias_desde_ultima_preventiva",
            F.datediff(F.col(day), F.last("__event", ignorenulls=True).over(so_far)),
        )
        .filter(F.col("__kind") == 1)
        .select(*daily.columns, "preventivas_ate_data", "dias_desde_ultima_preventiva")
    )
