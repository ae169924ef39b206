"""Event history, windows, prescription and forecasts over customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.operators import events, intervals, prescribe
from uptide.plans import adapters as a
from uptide.plans.registry import query


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    return events.daily_ledger(
        a.customer_production(spark, sf), entity="entity", ts="prod_ts", quantity="qty_produced", mass="mass_kg_per_100"
    )


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return events.event_history(a.customer_maintenance(spark, sf, measured=False), a.customer_preventive(spark, sf))


@query(
    "event_history",
    f"""WITH {a.CUSTOMER_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY equipamento ORDER BY last DESC) AS rn FROM (
  SELECT equipamento, last, max(struct_pack(a1 := coalesce(a_max, -1e308), a2 := coalesce(a_min, -1e308),
    b1 := coalesce(b_max, -1e308), b2 := coalesce(b_min, -1e308), n := notes)) AS m
  FROM c_log GROUP BY equipamento, last)),
sheet AS (SELECT x.equipamento, x.last, y.last AS previous, x.m FROM ranked x
  LEFT JOIN ranked y ON y.equipamento = x.equipamento AND y.rn = 2 WHERE x.rn = 1)
SELECT equipamento, CAST(last AS VARCHAR) AS data_evento, 'ULTIMA_SUBSTITUICAO' AS tipo_evento,
  date_diff('day', previous, last) AS dias_em_operacao,
  nullif(m.a1, -1e308) AS componente_a_max, nullif(m.a2, -1e308) AS componente_a_min,
  nullif(m.b1, -1e308) AS componente_b_max, nullif(m.b2, -1e308) AS componente_b_min,
  m.n AS observacoes, 'orders' AS arquivo_origem FROM sheet
UNION ALL
SELECT equipamento, CAST(previous AS VARCHAR), 'PENULTIMA_SUBSTITUICAO', NULL, NULL, NULL, NULL, NULL, NULL, 'orders'
FROM sheet WHERE previous IS NOT NULL
UNION ALL
SELECT equipamento, CAST(d AS VARCHAR), 'PREVENTIVA', NULL, NULL, NULL, NULL, NULL, notes, 'orders' FROM c_prev""",
)
def event_history(spark: SparkSession, sf: str) -> DataFrame:
    return events.event_history(a.customer_maintenance_table(spark, sf), a.customer_preventive(spark, sf))


@query(
    "recent_history",
    f"""WITH {a.CUSTOMER_SQL}
SELECT equipamento, CAST(last AS VARCHAR) AS data_ultima_substituicao,
  CAST(NULL AS VARCHAR) AS data_penultima_substituicao, CAST(NULL AS BIGINT) AS dias_em_operacao,
  notes AS observacoes, a_max AS componente_a_max, a_min AS componente_a_min,
  b_max AS componente_b_max, b_min AS componente_b_min, 'orders' AS arquivo_origem FROM c_recent""",
)
def recent_history(spark: SparkSession, sf: str) -> DataFrame:
    return events.recent_history(a.customer_maintenance(spark, sf))


@query(
    "operation_windows",
    f"""WITH {a.CUSTOMER_SQL}
SELECT equipamento, CAST(s AS VARCHAR) AS data_inicio, CAST(e AS VARCHAR) AS data_fim, days AS dias_operacao,
  qty AS qtd_produzida, kg AS massa_consumida_kg FROM c_window""",
)
def operation_windows(spark: SparkSession, sf: str) -> DataFrame:
    return events.operation_windows(_history(spark, sf), _ledger(spark, sf))


@query(
    "idle_days",
    f"""WITH {a.CUSTOMER_SQL}
SELECT r.equipamento, CAST(r.last AS VARCHAR) AS data_ultima_substituicao,
  CAST(max(p.day) AS VARCHAR) AS data_ultima_producao, '2000-07-01' AS data_referencia,
  greatest(0, coalesce(date_diff('day', max(p.day), DATE '2000-07-01'), 0)) AS dias_ociosidade
FROM c_recent r LEFT JOIN c_prod p ON p.equipamento = r.equipamento GROUP BY r.equipamento, r.last""",
)
def idle_days(spark: SparkSession, sf: str) -> DataFrame:
    return events.idle_days(events.recent_history(a.customer_maintenance(spark, sf)), _ledger(spark, sf), a.AS_OF)


PRESCRIPTION_SQL = f"""{a.CUSTOMER_SQL},
med AS (SELECT median(a_max - a_min) AS ma, median(b_max - b_min) AS mb FROM c_recent),
w_med AS (SELECT equipamento, median(days) AS t_base, median(kg) AS kg FROM c_window GROUP BY equipamento),
since AS (SELECT r.equipamento, CAST(sum(p.mass * p.qty) AS DOUBLE) / 100 AS kg
  FROM c_recent r JOIN c_prod p ON p.equipamento = r.equipamento AND p.ts >= r.last GROUP BY r.equipamento),
last_p AS (SELECT equipamento, max(day) AS d FROM c_prod GROUP BY equipamento),
base AS (
  SELECT r.equipamento, r.last, coalesce(w.t_base, 450.0) AS t_base, a_max - a_min AS amp_a, b_max - b_min AS amp_b,
    CASE WHEN a_max - a_min IS NOT NULL AND abs(ma) > 1e-8 THEN CASE WHEN a_max - a_min = 0 THEN 1.0::DOUBLE ELSE ma / (a_max - a_min) END END AS fa,
    CASE WHEN b_max - b_min IS NOT NULL AND abs(mb) > 1e-8 THEN CASE WHEN b_max - b_min = 0 THEN 1.0::DOUBLE ELSE mb / (b_max - b_min) END END AS fb,
    coalesce(s.kg, 0.0::DOUBLE) AS kg, coalesce(w.kg, 0.0::DOUBLE) AS w_kg,
    greatest(0, coalesce(date_diff('day', l.d, DATE '2000-07-01'), 0)) AS idle
  FROM c_recent r, med
  LEFT JOIN w_med w ON w.equipamento = r.equipamento
  LEFT JOIN since s ON s.equipamento = r.equipamento
  LEFT JOIN last_p l ON l.equipamento = r.equipamento),
fact AS (
  SELECT *, CASE WHEN fa IS NULL AND fb IS NULL THEN 1.0::DOUBLE ELSE
      greatest(0.6::DOUBLE, least(1.2::DOUBLE, CASE WHEN fa IS NULL THEN fb WHEN fb IS NULL THEN fa ELSE (fa + fb) / 2 END)) END AS wear,
    CASE WHEN w_kg > 0 AND kg > 0 THEN greatest(0.7::DOUBLE, least(1.3::DOUBLE, w_kg / kg)) ELSE 1.0::DOUBLE END AS mass_f
  FROM base),
due AS (SELECT *, t_base * wear * mass_f AS t,
    last + CAST(round_even(t_base * wear * mass_f, 0) AS INTEGER) + CAST(idle AS INTEGER) AS due FROM fact),
presc AS (SELECT *, date_diff('day', DATE '2000-07-01', due) AS left_days FROM due),
urg AS (SELECT *, CASE WHEN left_days IS NULL THEN 'DESCONHECIDO' WHEN left_days < 0 THEN 'ATRASADO'
    WHEN left_days < 30 THEN 'URGENTE' WHEN left_days < 90 THEN 'ATENÇÃO' ELSE 'OK' END AS urgencia FROM presc)"""


PRESCRIPTION_ROWS_SQL = """SELECT equipamento, CAST(last AS VARCHAR) AS data_ultima_substituicao, round(t_base, 1) AS "T_base_dias",
  round(amp_a, 4) AS amplitude_a_atual, round(amp_b, 4) AS amplitude_b_atual, round(wear, 4) AS fator_desgaste,
  CAST(CAST(CAST(kg AS DECIMAL(20,7)) AS DECIMAL(20,2)) AS DOUBLE) AS massa_atual_kg,
  CAST(CAST(CAST(w_kg AS DECIMAL(20,6)) AS DECIMAL(20,2)) AS DOUBLE) AS massa_mediana_janelas_kg, round(mass_f, 4) AS fator_massa,
  CAST(round(CAST(CAST(t AS VARCHAR) AS DECIMAL(38,15)), 1) AS DOUBLE) AS "T_prescrito_dias", idle AS dias_ociosidade, CAST(due AS VARCHAR) AS data_prescrita,
  '2000-07-01' AS data_referencia, left_days AS dias_restantes, urgencia FROM urg"""


@query(
    "prescription",
    f"WITH {PRESCRIPTION_SQL} {PRESCRIPTION_ROWS_SQL}",
)
def prescription(spark: SparkSession, sf: str) -> DataFrame:
    recent = events.recent_history(a.customer_maintenance(spark, sf))
    return prescribe.prescription(recent, _history(spark, sf), _ledger(spark, sf), a.AS_OF)


@query("urgency_distribution", f"WITH {PRESCRIPTION_SQL} SELECT urgencia, count(*) AS n FROM urg GROUP BY urgencia")
def urgency_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return prescribe.urgency_distribution(prescription(spark, sf))


HISTORICAL_SQL = f"""{a.SUPPLIER_DIM_SQL},
hist AS (SELECT entity AS equipamento, last, CAST(coalesce(interval_days, 365) AS INTEGER) AS iv,
  last + CAST(coalesce(interval_days, 365) AS INTEGER) AS due,
  date_diff('day', DATE '2000-07-01', last + CAST(coalesce(interval_days, 365) AS INTEGER)) AS left_days FROM s_all)"""


def _supplier_history(spark: SparkSession, sf: str) -> DataFrame:
    dim = a.supplier_maintenance(spark, sf, unmapped=True).select(
        F.col("entity").alias("equipamento"),
        F.col("last_replacement").alias("data_ultima_manutencao"),
        F.col("interval_days").alias("intervalo_manutencao_dias"),
    )
    return prescribe.historical_forecast(dim, a.AS_OF)


@query(
    "historical_forecast",
    f"""WITH {HISTORICAL_SQL}
SELECT equipamento, CAST(last AS VARCHAR) AS data_ultima_manutencao, CAST(iv AS BIGINT) AS intervalo_dias,
  CAST(due AS VARCHAR) AS proxima_troca, left_days AS dias_restantes, CAST(left_days < 0 AS BIGINT) AS atrasado FROM hist""",
)
def historical_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return _supplier_history(spark, sf)


C_HISTORICAL_SQL = f"""{PRESCRIPTION_SQL},
two AS (SELECT equipamento, max(last) FILTER (WHERE rn = 1) AS last, max(last) FILTER (WHERE rn = 2) AS previous FROM (
  SELECT equipamento, last, row_number() OVER (PARTITION BY equipamento ORDER BY last DESC) AS rn
  FROM (SELECT DISTINCT equipamento, last FROM c_log)) GROUP BY equipamento),
hist AS (SELECT equipamento, last, last + CAST(coalesce(date_diff('day', previous, last), 365) AS INTEGER) AS due FROM two),
hist2 AS (SELECT *, date_diff('day', DATE '2000-07-01', due) AS left_days FROM hist),
model AS (SELECT equipamento, greatest(0, CAST(round_even(t_base * wear * mass_f - date_diff('day', last, DATE '2000-07-01') + idle, 0) AS BIGINT)) AS days FROM urg)"""


def _customer_history(spark: SparkSession, sf: str) -> DataFrame:
    sheet = a.customer_maintenance_table(spark, sf).select(
        "equipamento",
        F.col("data_ultima_substituicao").alias("data_ultima_manutencao"),
        F.col("dias_em_operacao").alias("intervalo_manutencao_dias"),
    )
    return prescribe.historical_forecast(sheet, a.AS_OF)


def _closed_form_model(spark: SparkSession, sf: str) -> DataFrame:
    """Days left by the unrounded prescription, in the place of a fitted model's prediction."""
    recent = events.recent_history(a.customer_maintenance(spark, sf))
    p = prescribe.prescription_terms(recent, _history(spark, sf), _ledger(spark, sf), a.AS_OF)
    days = F.col("t") - F.datediff(F.lit(a.AS_OF), F.col("data_ultima_substituicao")) + F.col("idle")
    return prescribe.model_forecast(p.select("equipamento", days.alias("prediction")), a.AS_OF)


@query(
    "model_forecast_bands",
    f"""WITH {C_HISTORICAL_SQL}
SELECT equipamento, days AS dias_previstos, CAST(DATE '2000-07-01' + CAST(days AS INTEGER) AS VARCHAR) AS proxima_troca,
  CASE WHEN days <= 30 THEN 'URGENTE' WHEN days <= 90 THEN 'ATENÇÃO' ELSE 'OK' END AS status FROM model""",
)
def model_forecast_bands(spark: SparkSession, sf: str) -> DataFrame:
    return _closed_form_model(spark, sf)


@query(
    "forecast_comparison",
    f"""WITH {C_HISTORICAL_SQL}
SELECT h.equipamento, left_days AS dias_historico, days AS dias_modelo, days - left_days AS diferenca,
  CASE WHEN days - left_days < -30 THEN 'Antecipar' WHEN days - left_days > 30 THEN 'Pode adiar' ELSE 'Conforme' END AS recomendacao
FROM hist2 h JOIN model m ON m.equipamento = h.equipamento""",
)
def forecast_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return prescribe.compare_forecasts(_customer_history(spark, sf), _closed_form_model(spark, sf))


@query(
    "consolidated_forecast",
    f"""WITH {C_HISTORICAL_SQL},
plan AS (SELECT o_custkey AS equipamento, min(CAST(o_orderdate AS DATE)) AS d FROM orders
  WHERE o_orderpriority = '2-HIGH' AND o_orderdate >= TIMESTAMP '2000-07-01' GROUP BY o_custkey),
j AS (SELECT coalesce(h.equipamento, p.equipamento, m.equipamento) AS equipamento, h.last, h.due AS d1, p.d AS d2,
    DATE '2000-07-01' + CAST(m.days AS INTEGER) AS d3
  FROM hist2 h FULL JOIN plan p ON p.equipamento = h.equipamento
  FULL JOIN model m ON m.equipamento = coalesce(h.equipamento, p.equipamento)),
k AS (SELECT j.*, l.d AS lp, least(d1, d2, d3) AS d0, date_diff('day', DATE '2000-07-01', least(d1, d2, d3)) AS n
  FROM j LEFT JOIN last_p l ON l.equipamento = j.equipamento)
SELECT equipamento, CAST(last AS VARCHAR) AS ultima_troca, CAST(lp AS VARCHAR) AS ultima_producao,
  CAST(d1 AS VARCHAR) AS data_historica, CAST(d2 AS VARCHAR) AS data_plano, CAST(d3 AS VARCHAR) AS data_modelo,
  CAST(d0 AS VARCHAR) AS data_consolidada, n AS dias_restantes,
  CASE WHEN n IS NULL THEN 'DESCONHECIDO' WHEN n < 0 THEN 'ATRASADO' WHEN n < 30 THEN 'URGENTE' WHEN n < 90 THEN 'ATENÇÃO' ELSE 'OK' END AS status
FROM k""",
)
def consolidated_forecast(spark: SparkSession, sf: str) -> DataFrame:
    planned = (
        a.table(spark, sf, "orders")
        .filter(F.col("o_orderpriority") == "2-HIGH")
        .select(F.col("o_custkey").alias("equipamento"), F.to_date("o_orderdate").alias("data_planejada"))
    )
    return prescribe.consolidated_forecast(
        _customer_history(spark, sf), planned, _closed_form_model(spark, sf), _ledger(spark, sf), a.AS_OF
    )


@query(
    "events_in_period",
    f"""WITH {a.CUSTOMER_SQL},
period AS (SELECT equipamento, min(day) AS lo, max(day) AS hi FROM c_prod GROUP BY equipamento),
ev AS (SELECT equipamento, last AS d, 'ULTIMA_SUBSTITUICAO' AS t, notes AS n FROM c_log
  UNION ALL SELECT equipamento, d, 'PREVENTIVA', notes FROM c_prev)
SELECT e.equipamento, CAST(d AS VARCHAR) AS data_evento, strftime(d, '%d/%m/%Y') AS data,
  CASE WHEN t = 'PREVENTIVA' THEN 'Preventiva (#' || coalesce(nullif(n, ''), '?') || ')' ELSE 'Última troca' END AS evento,
  CASE WHEN d BETWEEN lo AND hi THEN 'sim' ELSE '—' END AS dentro_periodo
FROM ev e JOIN period p ON p.equipamento = e.equipamento""",
)
def events_in_period(spark: SparkSession, sf: str) -> DataFrame:
    return events.events_in_period(_history(spark, sf), _ledger(spark, sf))


@query(
    "overlapping_windows",
    """WITH e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS entity, epoch_us(ts) // 1000000 AS s, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
w AS (SELECT event_id AS janela, entity, s AS inicio, s + CASE WHEN event_id % 50 = 0 THEN 259200 ELSE 60 * (event_id % 90) END AS fim FROM e)
SELECT w.janela, w.entity, w.inicio, w.fim, count(e.event_id) AS points, CAST(sum(e.cents) AS BIGINT) AS cents
FROM w LEFT JOIN e ON e.entity = w.entity AND e.s >= w.inicio AND e.s < w.fim GROUP BY ALL""",
)
def overlapping_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every event opens a window of up to 90 minutes, every fiftieth one of three days; what its entity does inside.

    A third of all events belong to one entity, whose windows overlap.
    """
    entity = F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")).alias("entity")
    events = a.table(spark, sf, "events").select("event_id", entity, F.expr("unix_seconds(CAST(ts AS timestamp))").alias("s"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    seconds = F.when(F.col("event_id") % 50 == 0, 259200).otherwise(60 * (F.col("event_id") % 90))
    windows = events.select(F.col("event_id").alias("janela"), "entity", F.col("s").alias("inicio"), (F.col("s") + seconds).alias("fim"))
    return intervals.interval_totals(events, windows, ["cents"], key="entity", at="s", start="inicio", end="fim", name="janela")
