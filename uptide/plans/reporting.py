"""Monthly and compound reports over the supplier records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.operators import events, reports
from uptide.plans import adapters as a
from uptide.plans.maintenance import PRESCRIPTION_ROWS_SQL, PRESCRIPTION_SQL, prescription
from uptide.plans.registry import query, rounded
from uptide.session import stored, stored_by


def cells(spark: SparkSession, sf: str, *, by_entity: bool = False) -> DataFrame:
    return reports.monthly_cells(
        a.supplier_production(spark, sf),
        entity="entity",
        ts="prod_ts",
        compound="compound",
        produced="qty_produced",
        scrapped="qty_scrapped",
        by_entity=by_entity,
    )


def _cell_sql(source: str) -> str:
    """Monthly cells and their roll-ups of records (entity, prod_ts, compound, qty_produced, qty_scrapped)."""
    return f"""cell AS (SELECT entity AS equipamento, date_trunc('month', prod_ts) AS mes, compound AS composto, CAST(sum(qty_produced) AS BIGINT) AS qtd,
  CAST(sum(qty_scrapped) AS BIGINT) AS ref, count(DISTINCT CAST(prod_ts AS DATE)) AS dias, count(*) AS registros,
  min(CAST(prod_ts AS DATE)) AS lo, max(CAST(prod_ts AS DATE)) AS hi
  FROM {source} WHERE compound IS NOT NULL GROUP BY 1, 2, 3),
tot AS (SELECT equipamento, CAST(sum(qtd) AS BIGINT) AS qtd, CAST(sum(ref) AS BIGINT) AS ref, count(DISTINCT mes) AS meses, count(DISTINCT composto) AS comps,
  CAST(sum(registros) AS BIGINT) AS registros, min(lo) AS lo, max(hi) AS hi FROM cell GROUP BY 1),
comp AS (SELECT equipamento, composto, CAST(sum(qtd) AS BIGINT) AS qtd, CAST(sum(ref) AS BIGINT) AS ref, count(*) AS meses FROM cell GROUP BY 1, 2),
lead_ AS (SELECT *, row_number() OVER (PARTITION BY equipamento ORDER BY qtd DESC, composto) AS rn FROM comp),
mon AS (SELECT equipamento, mes, CAST(sum(qtd) AS BIGINT) AS qtd FROM cell GROUP BY 1, 2)"""


CELL_SQL = f"{a.SUPPLIER_SQL},\n{_cell_sql('s_prod')}"


@query(
    "monthly_by_compound",
    f"""WITH {CELL_SQL} SELECT c.equipamento, strftime(mes, '%Y-%m') AS ano_mes, composto, c.qtd, c.ref, dias,
  round(CAST(c.qtd AS DOUBLE) * 100 / t.qtd, 6) AS pct_total FROM cell c JOIN tot t ON t.equipamento = c.equipamento""",
)
def monthly_by_compound(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.monthly_by_compound(cells(spark, sf)), 6, "pct_total")


@query(
    "compound_summary",
    f"""WITH {CELL_SQL} SELECT c.equipamento, composto, c.qtd, c.ref, c.meses, round(CAST(c.qtd AS DOUBLE) * 100 / t.qtd, 6) AS pct_total,
  round(coalesce(CAST(c.ref AS DOUBLE) * 100 / nullif(c.qtd, 0), 0), 6) AS taxa_refugo FROM comp c JOIN tot t ON t.equipamento = c.equipamento""",
)
def compound_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.compound_summary(cells(spark, sf)), 6, "pct_total", "taxa_refugo")


@query(
    "compound_rollup",
    f"""WITH {CELL_SQL} SELECT equipamento, CASE WHEN grouping(composto) = 0 THEN composto ELSE 'TOTAL' END AS composto,
  CAST(grouping(equipamento) * 2 + grouping(composto) AS BIGINT) AS nivel, CAST(sum(qtd) AS BIGINT) AS qtd, CAST(sum(ref) AS BIGINT) AS ref,
  count(DISTINCT mes) AS meses FROM cell GROUP BY ROLLUP (equipamento, composto)""",
)
def compound_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return reports.compound_rollup(cells(spark, sf))


@query(
    "entity_kpis",
    f"""WITH {CELL_SQL} SELECT t.equipamento, t.qtd AS total_produzido, t.ref AS total_refugado, CAST(lo AS VARCHAR) AS inicio, CAST(hi AS VARCHAR) AS fim,
  comps AS n_compostos, registros, l.composto AS composto_lider, l.qtd AS qtd_lider, t.meses AS n_meses,
  round(CAST(t.ref AS DOUBLE) * 100 / t.qtd, 6) AS taxa_refugo, round(CAST(l.qtd AS DOUBLE) * 100 / t.qtd, 6) AS pct_lider,
  CASE WHEN CAST(t.ref AS DOUBLE) * 100 / t.qtd < 1.5 THEN 'Dentro do limite aceitável' ELSE 'Acima da meta — investigar' END AS nivel_qualidade
FROM tot t JOIN lead_ l ON l.equipamento = t.equipamento AND l.rn = 1""",
)
def entity_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.entity_kpis(cells(spark, sf)), 6, "taxa_refugo", "pct_lider")


@query(
    "monthly_extremes",
    f"""WITH {CELL_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY equipamento ORDER BY qtd DESC, mes) AS rn FROM mon)
SELECT equipamento, strftime(max(mes) FILTER (WHERE rn = 1), '%Y-%m') AS mes_pico, max(qtd) AS pico, CAST(trunc(avg(qtd)) AS BIGINT) AS media,
  min(qtd) AS menor FROM r GROUP BY equipamento""",
)
def monthly_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return reports.monthly_extremes(cells(spark, sf))


@query(
    "entity_record_counts",
    """SELECT l_suppkey AS equipamento, count(*) AS apontamentos, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_equipamentos
FROM lineitem GROUP BY l_suppkey""",
)
def entity_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.record_counts(a.table(spark, sf, "lineitem"), "l_suppkey")


@query(
    "top_compounds_with_others",
    f"""WITH {CELL_SQL} SELECT equipamento, CASE WHEN rn <= 6 THEN composto ELSE 'Outros' END AS composto, CAST(sum(qtd) AS BIGINT) AS qtd,
  CAST(sum(ref) AS BIGINT) AS ref, least(min(rn), 7) AS posicao FROM lead_ GROUP BY equipamento, CASE WHEN rn <= 6 THEN composto ELSE 'Outros' END""",
)
def top_compounds_with_others(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_compounds(cells(spark, sf), top=6)


@query(
    "top_compounds_overall",
    f"""WITH {CELL_SQL} SELECT composto, CAST(sum(qtd) AS BIGINT) AS qtd FROM comp GROUP BY composto ORDER BY qtd DESC, composto LIMIT 6""",
)
def top_compounds_overall(spark: SparkSession, sf: str) -> DataFrame:
    totals = cells(spark, sf).groupBy("composto").agg(F.sum("qtd").alias("qtd"))
    return totals.orderBy(F.desc("qtd"), "composto").limit(6)


def _replacements(spark: SparkSession, sf: str) -> DataFrame:
    dim = a.supplier_maintenance(spark, sf)
    return dim.select(
        F.col("entity").alias("equipamento"), F.explode(F.array("last_replacement", "previous_replacement")).alias("data_evento")
    )


@query(
    "monthly_spine",
    f"""WITH {a.SUPPLIER_SQL}, {a.SUPPLIER_DIM_SQL},
m AS (SELECT entity AS equipamento, CAST(date_trunc('month', prod_ts) AS DATE) AS mes, CAST(sum(qty_produced) AS BIGINT) AS producao,
  CAST(sum(qty_scrapped) AS BIGINT) AS refugo, CAST(sum(qty_reworked) AS BIGINT) AS retrabalho FROM s_prod GROUP BY 1, 2),
span AS (SELECT greatest(min(mes), CAST(max(mes) - INTERVAL 23 MONTH AS DATE)) AS lo, max(mes) AS hi FROM m),
e AS (SELECT DISTINCT equipamento FROM m, span WHERE mes >= lo),
spine AS (SELECT equipamento, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS mes FROM e, span),
mk AS (SELECT DISTINCT entity AS equipamento, CAST(date_trunc('month', d) AS DATE) AS mes FROM
  (SELECT entity, last AS d FROM s_dim UNION ALL SELECT entity, previous FROM s_dim) WHERE d IS NOT NULL)
SELECT s.equipamento, strftime(s.mes, '%Y-%m') AS ano_mes, coalesce(producao, 0) AS producao, coalesce(refugo, 0) AS refugo,
  coalesce(retrabalho, 0) AS retrabalho, CAST(mk.mes IS NOT NULL AS BIGINT) AS manutencao
FROM spine s LEFT JOIN m ON m.equipamento = s.equipamento AND m.mes = s.mes LEFT JOIN mk ON mk.equipamento = s.equipamento AND mk.mes = s.mes""",
)
def monthly_spine(spark: SparkSession, sf: str) -> DataFrame:
    return reports.monthly_spine(
        a.supplier_production(spark, sf),
        _replacements(spark, sf),
        entity="entity",
        ts="prod_ts",
        produced="qty_produced",
        scrapped="qty_scrapped",
        reworked="qty_reworked",
        months=24,
    )


@query(
    "formatted_labels",
    f"""WITH {CELL_SQL}, f AS (SELECT *, CAST(ref AS DOUBLE) * 100 / qtd AS rate FROM tot)
SELECT equipamento, replace(format('{{:,}}', qtd), ',', '.') AS total_produzido, replace(format('{{:,}}', ref), ',', '.') AS total_refugado,
  replace(format('{{:.2f}}', rate), '.', ',') || ' %' AS taxa_refugo, strftime(lo, '%d/%m/%Y') AS inicio,
  ['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'][month(hi)] || '/' || year(hi) AS fim FROM f""",
)
def formatted_labels(spark: SparkSession, sf: str) -> DataFrame:
    return reports.formatted_kpis(reports.entity_kpis(cells(spark, sf)))


def _int_sql(c: str) -> str:
    return f"replace(format('{{:,}}', {c}), ',', '.')"


def _pct_sql(c: str) -> str:
    return f"replace(format('{{:.2f}}', {c}), '.', ',') || ' %'"


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _block_sql(source: str, section: int, texts: list[str]) -> str:
    """Lines in the order of a list of expressions."""
    return f"""SELECT equipamento, CAST({section} AS BIGINT) AS secao, lpad(CAST(i - 1 AS VARCHAR), 3, '0') AS chave, l[i] AS linha
  FROM (SELECT *, [{", ".join(texts)}] AS l FROM {source}), range(1, {len(texts) + 1}) r(i)"""


def _fixed_sql(section: int, texts) -> str:
    return _block_sql("tot", section, [_text_sql(t) for t in texts])


COMPOUND_TEXT_SQL = " UNION ALL ".join(
    [
        _block_sql(
            "tot", 0,
            [
                f"{_text_sql(reports.TITLE)} || equipamento", "'**Fonte:** `data/raw/' || equipamento || '.csv`'",
                "'**Período coberto:** ' || strftime(lo, '%d/%m/%Y') || ' → ' || strftime(hi, '%d/%m/%Y')", f"'**Total produzido:** ' || {_int_sql('qtd')} || ' peças'",
                f"'**Total refugado:** ' || {_int_sql('ref')} || ' peças (' || {_pct_sql('CAST(ref AS DOUBLE) * 100 / qtd')} || ')'", "'**Compostos distintos utilizados:** ' || comps",
            ],
        ),
        _fixed_sql(3, reports.MONTH_LINES),
        _fixed_sql(5, reports.COMPOUND_LINES),
        f"""SELECT c.equipamento, 4, strftime(mes, '%Y-%m') || '/' || composto, '| ' || strftime(mes, '%Y-%m') || ' | ' || composto || ' | ' || {_int_sql("c.qtd")}
  || ' | ' || {_pct_sql("CAST(c.qtd AS DOUBLE) * 100 / t.qtd")} || ' | ' || {_int_sql("c.ref")} || ' | ' || dias || ' |' FROM cell c JOIN tot t ON t.equipamento = c.equipamento""",
        f"""SELECT c.equipamento, 6, lpad(CAST(1000000000000000000 - c.qtd AS VARCHAR), 20, '0') || '/' || composto, '| ' || composto || ' | ' || {_int_sql("c.qtd")}
  || ' | ' || {_pct_sql("CAST(c.qtd AS DOUBLE) * 100 / t.qtd")} || ' | ' || {_int_sql("c.ref")} || ' | ' || c.meses || ' |' FROM comp c JOIN tot t ON t.equipamento = c.equipamento""",
        f"SELECT equipamento, 7, '0', '| **TOTAL** | **' || {_int_sql('qtd')} || '** | **100,00 %** | **' || {_int_sql('ref')} || '** | **' || meses || '** |' FROM tot",
    ]
)


@query("compound_report_text", f"WITH {CELL_SQL} {COMPOUND_TEXT_SQL}")
def compound_report_text(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines of every supplier: header, months, compounds, total."""
    return reports.report_lines(stored_by(cells(spark, sf, by_entity=True), "cells", "equipamento", dealt=True))


ENTITY_TEXT_SQL = f"""{PRESCRIPTION_SQL},
rec AS (SELECT o_custkey AS entity, l_shipdate AS prod_ts, p_brand AS compound, CAST(l_quantity AS BIGINT) AS qty_produced,
  CAST(floor(l_quantity * round(l_discount * 100) / 100) AS BIGINT) AS qty_scrapped FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey),
{_cell_sql("rec")},
p AS ({PRESCRIPTION_ROWS_SQL}),
ev AS (SELECT equipamento, last AS d, 'Última troca' AS evento FROM c_log
  UNION ALL SELECT equipamento, d, 'Preventiva (#' || coalesce(nullif(notes, ''), '?') || ')' FROM c_prev),
lines AS ({COMPOUND_TEXT_SQL} UNION ALL {_fixed_sql(1, reports.EVENT_LINES)}
UNION ALL SELECT e.equipamento, 2, CAST(d AS VARCHAR) || '/' || evento, '| ' || strftime(d, '%d/%m/%Y') || ' | ' || evento || ' | ' || CASE WHEN d BETWEEN lo AND hi THEN '✅ sim' ELSE '—' END || ' |'
  FROM ev e JOIN tot t ON t.equipamento = e.equipamento
UNION ALL SELECT equipamento, 2, '', {_text_sql(reports.NO_EVENT)} FROM tot WHERE equipamento NOT IN (SELECT equipamento FROM ev)
UNION ALL {_block_sql("(SELECT * FROM p WHERE data_prescrita IS NOT NULL AND equipamento IN (SELECT equipamento FROM tot))", 8, [
    "''", _text_sql(reports.PRESCRIPTION_TITLE), "''", *[f"'**{label}:** ' || strftime(CAST({c} AS DATE), '%d/%m/%Y')" for label, c in (
        ("Data prescrita", "data_prescrita"), ("Data da última troca", "data_ultima_substituicao"), ("Data de referência (hoje)", "data_referencia"))],
    "'**Dias restantes:** ' || coalesce(CAST(dias_restantes AS VARCHAR), '—')", "'**Urgência:** ' || urgencia", *[_text_sql(t) for t in reports.METHOD_LINES],
    *[f"""'| {n} | ' || coalesce(CAST("{n}" AS VARCHAR), '—') || ' |'""" for n in reports.PRESCRIBED], *[_text_sql(t) for t in reports.SCALE_LINES]])}),
numbered AS (SELECT row_number() OVER (ORDER BY equipamento, secao, chave, linha) AS numero, * FROM lines)"""


def _entity_document(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of every customer that produced, with events and prescription, as one document."""
    parts = a.table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("compound"))
    orders = a.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("entity"))
    records = a.table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    scrap = F.floor(F.col("l_quantity") * F.round(F.col("l_discount") * 100) / 100).cast("bigint")
    records = records.withColumns({"qty": F.col("l_quantity").cast("bigint"), "scrap": scrap})
    customer_cells = reports.monthly_cells(records, entity="entity", ts="l_shipdate", compound="compound", produced="qty", scrapped="scrap", by_entity=True)
    history = events.event_history(a.customer_maintenance(spark, sf, measured=False), a.customer_preventive(spark, sf))
    by_customer = stored_by(customer_cells, "cells", "equipamento", dealt=True)
    prescribed = stored_by(prescription(spark, sf), "prescricao", "equipamento")
    sections = reports.report_sections(by_customer, prescribed, stored(history, "history"))
    return reports.report_document(sections)


@query("entity_report_text", f"WITH {ENTITY_TEXT_SQL} SELECT numero, equipamento, secao, chave, linha FROM numbered")
def entity_report_text(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_document(spark, sf)


@query("entity_report_index", f"WITH {ENTITY_TEXT_SQL} SELECT equipamento, CAST(min(numero) AS BIGINT) AS primeira_linha, count(*) AS linhas FROM numbered GROUP BY equipamento")
def entity_report_index(spark: SparkSession, sf: str) -> DataFrame:
    """Where each customer's report lies in the document."""
    return reports.document_index(_entity_document(spark, sf))


@query(
    "report_index",
    """SELECT l_suppkey AS equipamento, '| ' || l_suppkey || ' | ' || replace(format('{:,}', count(*)), ',', '.') || ' | [' || l_suppkey || '.md](' || l_suppkey || '.md) |' AS linha
FROM lineitem GROUP BY l_suppkey""",
)
def report_index(spark: SparkSession, sf: str) -> DataFrame:
    return reports.report_index(a.table(spark, sf, "lineitem"), "l_suppkey")


@query(
    "report_index_document",
    f"""WITH e AS (SELECT l_suppkey AS s, count(*) AS n FROM lineitem GROUP BY 1),
head AS (SELECT [{_text_sql(reports.INDEX_TITLE)}, '', '_Gerado em 01/07/2000._', '_Equipamentos: ' || count(*) || '._', '', {", ".join(_text_sql(t) for t in reports.INDEX_COLUMNS)}] AS l FROM e)
SELECT CAST(i AS BIGINT) AS numero, l[i] AS linha FROM head, range(1, 8) r(i)
UNION ALL SELECT 7 + row_number() OVER (ORDER BY s), '| ' || s || ' | ' || {_int_sql("n")} || ' | [' || s || '.md](' || s || '.md) |' FROM e""",
)
def report_index_document(spark: SparkSession, sf: str) -> DataFrame:
    return reports.index_document(a.table(spark, sf, "lineitem"), "l_suppkey", a.AS_OF)
