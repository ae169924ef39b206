"""Target, features and statistics per record and per supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.operators import features, stats
from uptide.operators.events import MEASURES
from uptide.plans import adapters as a
from uptide.plans.registry import query, rounded
from uptide.session import spread

TIEBREAK = ["order_id", "line_no", "product", "qty_produced", "mass_kg_per_100", "qty_scrapped", "qty_reworked", "unit"]
TIEBREAK_SQL = ", ".join(TIEBREAK)

TARGET_SQL = f"""{a.SUPPLIER_SQL}, {a.SUPPLIER_DIM_SQL},
t0 AS (SELECT p.*, d.last, d.previous, d.interval_days, CAST(prod_ts AS DATE) AS d0 FROM s_prod p LEFT JOIN s_dim d ON d.entity = p.entity),
t AS (SELECT *, CASE WHEN d0 > last THEN date_diff('day', d0, last + CAST(coalesce(interval_days, 365) AS INTEGER))
  ELSE date_diff('day', d0, coalesce(last, DATE '2024-06-01')) END AS target FROM t0),
tt AS (SELECT * FROM t WHERE target >= 0)"""


def target(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Both sides dealt by supplier, whose narrow records and daily sums would fill the memory of merged partitions."""
    production, sheet = (spread(x, "entity") for x in (a.supplier_production(spark, sf), a.supplier_maintenance(spark, sf)))
    return features.maintenance_target(production, sheet, carry=carry)


@query(
    "maintenance_target",
    f"""WITH {TARGET_SQL} SELECT entity, order_id, CAST(line_no AS BIGINT) AS line_no, CAST(d0 AS VARCHAR) AS day, target FROM tt""",
)
def maintenance_target(spark: SparkSession, sf: str) -> DataFrame:
    return target(spark, sf).select("entity", "order_id", "line_no", F.to_date("prod_ts").alias("day"), "target")


CUMULATIVE_SQL = f"""{TARGET_SQL},
cum AS (SELECT *, CAST(sum(qty_produced) OVER w AS BIGINT) AS qty_cum, CAST(sum(qty_scrapped) OVER w AS BIGINT) AS scrap_cum,
  sum(mass_kg_per_100) OVER w AS mass_cum FROM tt
  WINDOW w AS (PARTITION BY entity ORDER BY prod_ts, {TIEBREAK_SQL} ROWS UNBOUNDED PRECEDING))"""


def cumulative(spark: SparkSession, sf: str, carry: tuple[str, ...] = (), keep_place: bool = False) -> DataFrame:
    return features.cumulative_features(
        target(spark, sf, carry), ["qty_produced", "qty_scrapped", "mass_kg_per_100"], tiebreak=TIEBREAK, keep_place=keep_place
    )


@query(
    "cumulative_features",
    f"""WITH {CUMULATIVE_SQL} SELECT entity, order_id, CAST(line_no AS BIGINT) AS line_no, CAST(d0 AS VARCHAR) AS day,
  qty_cum AS qty_produced_acumulado, scrap_cum AS qty_scrapped_acumulado, CAST(mass_cum AS DOUBLE) AS mass_kg_per_100_acumulado FROM cum""",
)
def cumulative_features(spark: SparkSession, sf: str) -> DataFrame:
    return cumulative(spark, sf).select(
        "entity",
        "order_id",
        "line_no",
        F.to_date("prod_ts").alias("day"),
        "qty_produced_acumulado",
        "qty_scrapped_acumulado",
        "mass_kg_per_100_acumulado",
    )


WEAR_SQL = f"""{CUMULATIVE_SQL},
w0 AS (SELECT c.* EXCLUDE (interval_days), coalesce(c.interval_days, 365) AS iv, m.a_max, m.a_min, m.b_max, m.b_min,
  a_max - a_min AS a_range, a_max - 20.0::DOUBLE AS wa, b_max - b_min AS b_range, 20.0::DOUBLE - b_min AS wb
  FROM cum c LEFT JOIN s_dim m ON m.entity = c.entity),
w1 AS (SELECT *, CASE WHEN wa IS NOT NULL AND iv > 0 THEN wa / iv ELSE 0 END AS ra, CASE WHEN wb IS NOT NULL AND iv > 0 THEN wb / iv ELSE 0 END AS rb,
  CASE WHEN wa IS NULL THEN 0 ELSE least(100.0::DOUBLE, wa / 0.6::DOUBLE * 100) END * 0.6::DOUBLE
    + CASE WHEN wb IS NULL THEN 0 ELSE least(100.0::DOUBLE, wb / 2.0::DOUBLE * 100) END * 0.4::DOUBLE AS idx,
  CASE WHEN qty_cum > 0 THEN (coalesce(wa, 0) + coalesce(wb, 0)) / qty_cum * 1000 ELSE 0 END AS per1000 FROM w0),
wm AS (SELECT median(a_max) AS m1, median(a_min) AS m2, median(a_range) AS m3, median(wa) AS m4, median(b_max) AS m5,
  median(b_min) AS m6, median(b_range) AS m7, median(wb) AS m8 FROM w1),
wear AS (SELECT w1.* EXCLUDE (a_max, a_min, a_range, wa, b_max, b_min, b_range, wb), coalesce(a_max, m1) AS a_max, coalesce(a_min, m2) AS a_min,
  coalesce(a_range, m3) AS a_range, coalesce(wa, m4) AS wa, coalesce(b_max, m5) AS b_max, coalesce(b_min, m6) AS b_min,
  coalesce(b_range, m7) AS b_range, coalesce(wb, m8) AS wb FROM w1, wm)"""


def wear(spark: SparkSession, sf: str, keep_place: bool = False) -> DataFrame:
    measures = ("interval_days", *MEASURES)
    return features.measurement_features(cumulative(spark, sf, measures, keep_place), records=target(spark, sf, measures))


@query(
    "wear_features",
    f"""WITH {WEAR_SQL} SELECT entity, order_id, CAST(line_no AS BIGINT) AS line_no, CAST(d0 AS VARCHAR) AS day, product,
  round(a_max, 6) AS componente_a_max, round(a_min, 6) AS componente_a_min, round(a_range, 6) AS componente_a_variacao,
  round(wa, 6) AS desgaste_componente_a, round(b_max, 6) AS componente_b_max, round(b_min, 6) AS componente_b_min,
  round(b_range, 6) AS componente_b_variacao, round(wb, 6) AS desgaste_componente_b, iv AS intervalo_manutencao,
  round(ra, 6) AS taxa_desgaste_componente_a, round(rb, 6) AS taxa_desgaste_componente_b, round(idx, 6) AS indice_desgaste,
  round(per1000, 6) AS desgaste_por_1000_pecas FROM wear""",
)
def wear_features(spark: SparkSession, sf: str) -> DataFrame:
    measured = [*features.MEASUREMENT_FEATURES, *features.DERIVED_FEATURES, "desgaste_por_1000_pecas"]
    rows = wear(spark, sf).select(
        "entity", "order_id", "line_no", F.to_date("prod_ts").alias("day"), "product", "intervalo_manutencao", *measured
    )
    return rounded(rows, 6, *measured)


@query(
    "one_hot",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate AS l_shipmode, CAST(l_returnflag = 'A' AS BIGINT) AS "Equipamento_A",
  CAST(l_returnflag = 'N' AS BIGINT) AS "Equipamento_N", CAST(l_returnflag = 'R' AS BIGINT) AS "Equipamento_R",
  CAST(l_linestatus = 'F' AS BIGINT) AS "l_linestatus_F", CAST(l_linestatus = 'O' AS BIGINT) AS "l_linestatus_O"
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS l_shipdate, l_returnflag, l_linestatus FROM lineitem)""",
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Two small text columns become flags; the part number has too many values and stays."""
    rows = a.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("l_shipmode"), "l_returnflag", "l_linestatus"
    )
    return features.one_hot(
        rows, ["l_returnflag", "l_linestatus", "l_shipmode"], prefixes={"l_returnflag": "Equipamento"}
    )


@query(
    "one_hot_inverse",
    """SELECT CASE l_returnflag WHEN 'N' THEN 'Outro' ELSE l_returnflag END AS equipamento, count(*) AS n FROM lineitem GROUP BY 1""",
)
def one_hot_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """Entities read back from flags, one flag column missing."""
    flags = one_hot(spark, sf).drop("Equipamento_N")
    return flags.groupBy(features.entity_from_one_hot(flags).alias("equipamento")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_features",
    f"""WITH {a.SUPPLIER_SQL}, {a.SUPPLIER_DIM_SQL},
x AS (SELECT p.entity, order_id, line_no, CAST(prod_ts AS DATE) AS d, last, previous FROM s_prod p LEFT JOIN s_dim m ON m.entity = p.entity)
SELECT entity, order_id, CAST(line_no AS BIGINT) AS line_no, CAST(isodow(d) - 1 AS BIGINT) AS dia_da_semana, CAST(month(d) AS BIGINT) AS mes,
  date_diff('day', (SELECT min(d) FROM x), d) AS dias_desde_inicio_serie,
  date_diff('day', CASE WHEN d >= last THEN last WHEN d >= previous THEN previous END, d) AS dias_desde_ultima_manutencao FROM x""",
)
def date_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.date_features(a.supplier_production(spark, sf), a.supplier_maintenance(spark, sf))
    return rows.select(
        "entity", "order_id", "line_no", "dia_da_semana", "mes", "dias_desde_inicio_serie", "dias_desde_ultima_manutencao"
    )


@query(
    "entity_day_grain",
    f"""WITH {CUMULATIVE_SQL} SELECT entity, CAST(d0 AS VARCHAR) AS day, CAST(sum(qty_produced) AS BIGINT) AS qty_produced,
  CAST(sum(qty_scrapped) AS BIGINT) AS qty_scrapped, round(avg(CAST(mass_kg_per_100 AS DOUBLE)), 9) AS mass_kg_per_100,
  max(qty_cum) AS qty_produced_acumulado, max(target) AS target FROM cum GROUP BY entity, d0""",
)
def entity_day_grain(spark: SparkSession, sf: str) -> DataFrame:
    daily = features.entity_day_grain(
        cumulative(spark, sf).withColumn("mass_kg_per_100", F.col("mass_kg_per_100").cast("double")),
        sums=["qty_produced", "qty_scrapped"],
        means=["mass_kg_per_100"],
        maxima=["qty_produced_acumulado"],
        constants=["target"],
    )
    return rounded(daily, 9, "mass_kg_per_100")


@query(
    "preventive_features",
    f"""WITH {a.CUSTOMER_SQL},
days AS (SELECT equipamento, day, CAST(sum(qty) AS BIGINT) AS qty FROM c_prod GROUP BY equipamento, day)
SELECT d.equipamento AS entity, CAST(d.day AS VARCHAR) AS day, d.qty, count(v.d) AS preventivas_ate_data,
  date_diff('day', max(v.d), d.day) AS dias_desde_ultima_preventiva
FROM days d LEFT JOIN c_prev v ON v.equipamento = d.equipamento AND v.d <= d.day GROUP BY d.equipamento, d.day, d.qty""",
)
def preventive_features(spark: SparkSession, sf: str) -> DataFrame:
    daily = features.entity_day_grain(
        a.customer_production(spark, sf).withColumnRenamed("qty_produced", "qty"), sums=["qty"]
    )
    events = a.customer_preventive(spark, sf).select(
        F.col("equipamento").alias("entity"), F.col("data_evento").alias("event_date")
    )
    return features.preventive_features(daily, events)


@query(
    "entity_statistics",
    f"""WITH {WEAR_SQL},
g AS (SELECT entity, CAST(sum(qty_produced) AS BIGINT) AS total_produzido, round(avg(qty_produced), 4) AS media_producao_diaria,
  max(qty_produced) AS max_producao_diaria, count(qty_produced) AS total_registros, max(qty_cum) AS producao_acumulada,
  CAST(sum(qty_scrapped) AS BIGINT) AS total_refugado, round(avg(qty_scrapped), 4) AS media_refugo_diario,
  CAST(sum(qty_reworked) AS BIGINT) AS total_retrabalhado, round(avg(qty_reworked), 4) AS media_retrabalho_diario,
  round(CAST(sum(mass_kg_per_100) AS DOUBLE), 6) AS consumo_massa_total_kg, round(CAST(sum(mass_kg_per_100) AS DOUBLE) / count(*), 6) AS consumo_massa_medio_kg,
  round(avg(target), 4) AS media_dias_manutencao, min(target) AS min_dias_manutencao, max(target) AS max_dias_manutencao,
  round(avg(idx), 4) AS indice_desgaste_medio, round(avg(wa), 4) AS desgaste_componente_a_medio, round(avg(wb), 4) AS desgaste_componente_b_medio,
  round(CAST(sum(qty_scrapped) AS DOUBLE) / sum(qty_produced) * 100, 2) AS taxa_refugo_pct FROM wear GROUP BY entity)
SELECT g.* EXCLUDE (entity), g.entity AS equipamento, interval_days AS intervalo_manutencao_dias, CAST(last AS VARCHAR) AS data_ultima_manutencao,
  CAST(previous AS VARCHAR) AS data_penultima_manutencao, notes AS observacoes_manutencao, a_max AS componente_a_max, a_min AS componente_a_min,
  b_max AS componente_b_max, b_min AS componente_b_min FROM g LEFT JOIN s_dim d ON d.entity = g.entity""",
)
def entity_statistics(spark: SparkSession, sf: str) -> DataFrame:
    result = stats.entity_statistics(wear(spark, sf), a.supplier_maintenance(spark, sf))
    mass = ["consumo_massa_total_kg", "consumo_massa_medio_kg"]
    means = [c for c in result.columns if c.startswith("media_") or c.endswith("_medio")]
    return rounded(rounded(result, 4, *means).withColumns({c: F.col(c).cast("double") for c in mass}), 6, *mass)


@query(
    "interval_stats",
    f"""WITH {a.SUPPLIER_DIM_SQL} SELECT round(avg(interval_days), 4) AS media_dias, min(interval_days) AS min_dias, max(interval_days) AS max_dias FROM s_all""",
)
def interval_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.interval_statistics(a.supplier_maintenance(spark, sf, unmapped=True), "interval_days"), 4, "media_dias")


@query(
    "entity_summary",
    f"""WITH {TARGET_SQL},
g AS (SELECT entity AS equipamento, CAST(sum(qty_produced) AS BIGINT) AS total_produzido, CAST(sum(qty_scrapped) AS BIGINT) AS total_refugado,
  avg(target) AS media_dias, coalesce(CAST(sum(qty_scrapped) AS DOUBLE) / nullif(sum(qty_produced), 0) * 100, 0) AS taxa_refugo FROM tt GROUP BY entity)
SELECT equipamento, total_produzido, total_refugado, round(media_dias, 4) AS media_dias, round(taxa_refugo, 4) AS taxa_refugo,
  round((SELECT avg(taxa_refugo) FROM g), 4) AS media_frota_taxa, round((SELECT avg(media_dias) FROM g), 4) AS media_frota_dias FROM g""",
)
def entity_summary(spark: SparkSession, sf: str) -> DataFrame:
    result = stats.entity_summary(
        target(spark, sf), entity="entity", produced="qty_produced", scrapped="qty_scrapped", target="target"
    )
    return rounded(result, 4, "media_dias", "taxa_refugo", "media_frota_taxa", "media_frota_dias")
