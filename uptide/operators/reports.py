"""Monthly production and quality aggregates per entity and compound, and their text rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from uptide.functions.prefix import number_rows, number_sections
from uptide.functions.scalar import (
    format_day, format_int, format_month, format_pct, month_key, month_start, quality_label,
)
from uptide.session import spread, stored_by

# Fixed value: name of the group of all compounds outside the top ones.
OTHERS = "Outros"


def monthly_cells(
    production: DataFrame, *, entity: str, ts: str, compound: str, produced: str, scrapped: str, by_entity: bool = False
) -> DataFrame:
    """Production per entity, month and compound, with the number of production days.

    Days are counted by aggregating to days first, which spreads a busy entity over its
    days and needs no distinct-expansion of the rows. Records without a compound or date
    stay as cells with a NULL: they count in an entity's totals, not in its lists. ``by_entity``
    deals the days, calendar-many a compound, by the entity, for cells that are stored by it.
    """
    days = (
        production.filter(F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("equipamento"), F.to_date(ts).alias("day"), F.col(compound).alias("composto"))
        .agg(
            F.sum(F.coalesce(F.col(produced), F.lit(0))).alias("qtd"),
            F.sum(F.coalesce(F.col(scrapped), F.lit(0))).alias("ref"),
            F.count(F.lit(1)).alias("registros"),
        )
    )
    if by_entity:
        days = spread(days, "equipamento")
    return days.groupBy("equipamento", month_start(F.col("day")).alias("mes"), "composto").agg(
        F.sum("qtd").alias("qtd"),
        F.sum("ref").alias("ref"),
        F.count("day").alias("dias"),
        F.sum("registros").alias("registros"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def monthly_by_compound(cells: DataFrame) -> DataFrame:
    """Cells with the share of the entity's total; a window over months x compounds only."""
    total = F.sum("qtd").over(Window.partitionBy("equipamento"))
    return cells.select(
        "equipamento",
        month_key(F.col("mes")).alias("ano_mes"),
        "composto",
        "qtd",
        "ref",
        "dias",
        F.try_divide(F.col("qtd").cast("double") * 100, total).alias("pct_total"),
    ).filter(F.col("composto").isNotNull() & F.col("ano_mes").isNotNull())


def compound_summary(cells: DataFrame) -> DataFrame:
    """Per entity and compound over the whole period: totals, months in use, share, scrap rate (0 when undefined)."""
    total = F.sum("qtd").over(Window.partitionBy("equipamento"))
    return (
        cells.groupBy("equipamento", "composto")
        .agg(F.sum("qtd").alias("qtd"), F.sum("ref").alias("ref"), F.count("mes").alias("meses"))
        .withColumn("pct_total", F.try_divide(F.col("qtd").cast("double") * 100, total))
        .filter(F.col("composto").isNotNull())
        .withColumn("taxa_refugo", F.coalesce(F.try_divide(F.col("ref").cast("double") * 100, F.col("qtd")), F.lit(0.0)))
    )


def compound_rollup(cells: DataFrame) -> DataFrame:
    """Compound summary with a TOTAL row per entity and one for everything; months are counted anew per level."""
    levels = cells.rollup("equipamento", "composto").agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.sum("qtd").alias("qtd"),
        F.sum("ref").alias("ref"),
        F.count_distinct("mes").alias("meses"),
    )
    return levels.withColumn("composto", F.when(F.col("nivel") == 0, F.col("composto")).otherwise("TOTAL")).filter(
        F.col("composto").isNotNull()
    )


def entity_kpis(cells: DataFrame) -> DataFrame:
    """Header figures per entity, the leading compound and its share, and the quality verdict.

    The first cell of each month counts the month; compounds are summed before the entity is, so nothing is expanded.
    """
    first = F.row_number().over(Window.partitionBy("equipamento", "mes").orderBy("composto")) == 1
    compounds = (
        cells.withColumn("novo", (first & F.col("mes").isNotNull()).cast("int"))
        .groupBy("equipamento", "composto")
        .agg(
            F.sum("qtd").alias("qtd"),
            F.sum("ref").alias("ref"),
            F.sum("registros").alias("registros"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.sum("novo").alias("meses"),
        )
    )
    named = F.col("composto").isNotNull()
    head = compounds.groupBy("equipamento").agg(
        F.sum("qtd").alias("total_produzido"),
        F.sum("ref").alias("total_refugado"),
        F.min("first_day").alias("inicio"),
        F.max("last_day").alias("fim"),
        F.count_if(named).alias("n_compostos"),
        F.sum("registros").alias("registros"),
        F.min_by("composto", F.when(named, F.struct(-F.col("qtd"), F.col("composto")))).alias("composto_lider"),
        F.max(F.when(named, F.col("qtd"))).alias("qtd_lider"),
        F.sum("meses").alias("n_meses"),
    )
    rate = F.coalesce(F.try_divide(F.col("total_refugado").cast("double") * 100, F.col("total_produzido")), F.lit(0.0))
    return (
        head.withColumn("taxa_refugo", rate)
        .withColumn("pct_lider", F.try_divide(F.col("qtd_lider").cast("double") * 100, F.col("total_produzido")))
        .withColumn("nivel_qualidade", quality_label(F.col("taxa_refugo")))
    )


def monthly_extremes(cells: DataFrame) -> DataFrame:
    """Peak month with its output, mean (truncated) and smallest monthly output per entity; earliest month on ties."""
    months = cells.filter(F.col("mes").isNotNull()).groupBy("equipamento", "mes").agg(F.sum("qtd").alias("qtd"))
    return months.groupBy("equipamento").agg(
        F.min_by("mes", F.struct(-F.col("qtd"), F.col("mes"))).alias("mes_pico"),
        F.max("qtd").alias("pico"),
        F.avg("qtd").cast("bigint").alias("media"),
        F.min("qtd").alias("menor"),
    ).withColumn("mes_pico", month_key(F.col("mes_pico")))


def record_counts(production: DataFrame, entity: str) -> DataFrame:
    """Records per entity next to the number of entities."""
    counts = production.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("equipamento")).agg(
        F.count(F.lit(1)).alias("apontamentos")
    )
    return counts.select("*", counts.agg(F.count(F.lit(1))).scalar().alias("n_equipamentos"))


def top_compounds(cells: DataFrame, top: int = 6) -> DataFrame:
    """Top compounds per entity by output, and one row ``Outros`` with the exact rest.

    Only the first ``top`` rows of an entity enter the ranking (Spark limits each group
    before the shuffle); the rest is the entity's total minus those rows.
    """
    named = cells.filter(F.col("composto").isNotNull())
    compounds = named.groupBy("equipamento", "composto").agg(F.sum("qtd").alias("qtd"), F.sum("ref").alias("ref"))
    totals = compounds.groupBy("equipamento").agg(
        F.sum("qtd").alias("all_qtd"), F.sum("ref").alias("all_ref"), F.count(F.lit(1)).alias("all_n")
    )
    order = Window.partitionBy("equipamento").orderBy(F.desc("qtd"), F.asc("composto"))
    best = compounds.withColumn("posicao", F.row_number().over(order)).filter(F.col("posicao") <= top)
    kept = best.groupBy("equipamento").agg(F.sum("qtd").alias("k_qtd"), F.sum("ref").alias("k_ref"))
    rest = (
        totals.filter(F.col("all_n") > top)
        .join(kept, "equipamento")
        .select(
            "equipamento",
            F.lit(OTHERS).alias("composto"),
            (F.col("all_qtd") - F.col("k_qtd")).alias("qtd"),
            (F.col("all_ref") - F.col("k_ref")).alias("ref"),
            F.lit(top + 1).alias("posicao"),
        )
    )
    return best.unionByName(rest)


def monthly_spine(
    production: DataFrame,
    replacements: DataFrame,
    *,
    entity: str,
    ts: str,
    produced: str,
    scrapped: str,
    reworked: str,
    months: int = 6,
) -> DataFrame:
    """Last ``months`` months per entity, zero-filled, with a marker for months of a replacement.

    The period ends with the latest record and starts no earlier than the first. Entities
    are those producing in the period. ``replacements``: equipamento, data_evento.
    """
    daily = (
        production.filter(F.col(ts).isNotNull() & F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("equipamento"), month_start(F.col(ts)).alias("mes"))
        .agg(
            F.sum(produced).alias("producao"),
            F.sum(scrapped).alias("refugo"),
            F.sum(reworked).alias("retrabalho"),
        )
    )
    last, first = F.max("mes"), F.min("mes")
    span = daily.agg(
        F.struct(F.greatest(first, F.add_months(last, -(months - 1))).alias("start"), last.alias("stop"))
    )
    in_period = daily.select("*", span.scalar().alias("span")).filter(F.col("mes") >= F.col("span.start"))
    entities = in_period.groupBy("equipamento").agg(F.max("span").alias("span"))
    spine = entities.select(
        "equipamento",
        F.explode(F.sequence(F.col("span.start"), F.col("span.stop"), F.expr("interval 1 month"))).alias("mes"),
    )
    marks = (
        replacements.filter(F.col("data_evento").isNotNull())
        .select("equipamento", month_start(F.col("data_evento")).alias("mes"))
        .distinct()
        .withColumn("manutencao", F.lit(1))
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("producao", "refugo", "retrabalho", "manutencao")]
    return (
        spine.join(in_period.drop("span"), ["equipamento", "mes"], "left")
        .join(marks, ["equipamento", "mes"], "left")
        .select("equipamento", month_key(F.col("mes")).alias("ano_mes"), *filled)
    )


def formatted_kpis(kpis: DataFrame) -> DataFrame:
    """Header figures as Brazilian-Portuguese text."""
    return kpis.select(
        "equipamento",
        format_int(F.col("total_produzido")).alias("total_produzido"),
        format_int(F.col("total_refugado")).alias("total_refugado"),
        format_pct(F.col("taxa_refugo")).alias("taxa_refugo"),
        format_day(F.col("inicio")).alias("inicio"),
        format_month(F.col("fim")).alias("fim"),
    )


# Headings and fixed lines of the reports.
TITLE = "# Relatório mensal por componente — "
EVENT_LINES = ("", "## Manutenções registradas", "", "| Data | Evento | Dentro do período de produção? |", "|---|---|---|")
NO_EVENT = "| — | _sem registros_ | — |"
MONTH_LINES = ("", "## Produção mensal por composto", "", "| Ano-Mês | Composto | Qtd. produzida | % do total | Refugo | Dias com produção |", "|---|---|---:|---:|---:|---:|")
COMPOUND_LINES = ("", "## Resumo por composto (período inteiro)", "", "| Composto | Qtd. produzida | % do total | Refugo | Meses com uso |", "|---|---:|---:|---:|---:|")
PRESCRIPTION_TITLE = "## Prescrição da próxima manutenção"
METHOD_LINES = (
    "", "### Cálculo", "",
    "- T_base: mediana dos dias em operação do equipamento; 450 sem histórico",
    "- fator_desgaste: mediana das amplitudes ÷ amplitude atual, entre 0,60 e 1,20",
    "- fator_massa: mediana das massas por janela ÷ massa desde a última troca, entre 0,70 e 1,30",
    "- T_prescrito: T_base × fator_desgaste × fator_massa",
    "- data_prescrita: última troca + T_prescrito + dias de ociosidade",
    "", "### Valores", "", "| Campo | Valor |", "|---|---:|",
)
SCALE_LINES = ("", "### Urgência por dias restantes", "", "- abaixo de 0: ATRASADO", "- de 0 a 29: URGENTE", "- de 30 a 89: ATENÇÃO", "- 90 ou mais: OK")
PRESCRIBED = (
    "T_base_dias", "amplitude_a_atual", "amplitude_b_atual", "fator_desgaste", "massa_atual_kg",
    "massa_mediana_janelas_kg", "fator_massa", "T_prescrito_dias", "dias_ociosidade",
)
INDEX_TITLE = "# Índice — relatórios mensais por componente"
INDEX_COLUMNS = ("| Equipamento | Apontamentos | Arquivo |", "|---|---:|---|")


def report_lines(cells: DataFrame, prescribed: DataFrame | None = None, history: DataFrame | None = None) -> DataFrame:
    """Lines ``(equipamento, secao, chave, linha)`` of one Markdown report per entity.

    A document is its lines ordered by ``secao`` and ``chave``. Lines stay rows: the text
    sink sorts them within files, so no document is ever assembled in memory.
    """
    report, *others = report_sections(cells, prescribed, history)
    for section in others:
        report = report.unionByName(section)
    return report


def report_sections(cells: DataFrame, prescribed: DataFrame | None = None, history: DataFrame | None = None) -> list[DataFrame]:
    """The lines of ``report_lines``, a frame per section.

    Every section reads the inputs again, so hand in stored tables, the cells by entity; the figures of the header are stored here.
    Sides of a row or more per entity are merged: by the size of a few packed columns Spark would take them through the driver.
    """
    kpis = stored_by(entity_kpis(cells), "kpis", "equipamento")

    def line(df: DataFrame, section: int, key, text) -> DataFrame:
        return df.select("equipamento", F.lit(section).alias("secao"), key.cast("string").alias("chave"), text.alias("linha"))

    def block(df: DataFrame, section: int, texts) -> DataFrame:
        """Lines in the order of an array."""
        rows = df.select("equipamento", F.lit(section).alias("secao"), F.posexplode(texts).alias("i", "linha"))
        return rows.select("equipamento", "secao", F.format_string("%03d", "i").alias("chave"), "linha")

    def fixed(section: int, texts: Sequence[str]) -> DataFrame:
        return block(kpis, section, F.array(*[F.lit(t) for t in texts]))

    def cellrow(*columns):
        return F.concat(F.lit("| "), F.concat_ws(" | ", *columns), F.lit(" |"))

    k = {c: F.col(c) for c in kpis.columns}
    name = k["equipamento"].cast("string")
    header = F.array(
        F.concat(F.lit(TITLE), name),
        F.concat(F.lit("**Fonte:** `data/raw/"), name, F.lit(".csv`")),
        F.concat(F.lit("**Período coberto:** "), format_day(k["inicio"]), F.lit(" → "), format_day(k["fim"])),
        F.concat(F.lit("**Total produzido:** "), format_int(k["total_produzido"]), F.lit(" peças")),
        F.concat(
            F.lit("**Total refugado:** "), format_int(k["total_refugado"]), F.lit(" peças ("), format_pct(k["taxa_refugo"]), F.lit(")")
        ),
        F.concat(F.lit("**Compostos distintos utilizados:** "), k["n_compostos"].cast("string")),
    )
    parts = [block(kpis, 0, header)]
    if history is not None:
        from uptide.operators.events import events_in_period

        period = kpis.select(F.col("equipamento").alias("entity"), F.explode(F.array("inicio", "fim")).alias("day"))
        seen = events_in_period(history.hint("merge"), period, ("✅ sim", "—"))
        without = kpis.join(history.select("equipamento").distinct().hint("merge"), "equipamento", "left_anti")
        parts += [
            fixed(1, EVENT_LINES),
            line(
                seen, 2, F.concat_ws("/", F.coalesce(F.col("data_evento").cast("string"), F.lit("9999")), F.col("evento")),
                cellrow(F.col("data"), F.col("evento"), F.col("dentro_periodo")),
            ).unionByName(line(without, 2, F.lit(""), F.lit(NO_EVENT))),
        ]
    monthly = monthly_by_compound(cells)
    summary = compound_summary(cells)
    parts += [
        fixed(3, MONTH_LINES),
        line(
            monthly, 4, F.concat_ws("/", "ano_mes", "composto"),
            cellrow(
                F.col("ano_mes"), F.col("composto"), format_int(F.col("qtd")), format_pct(F.col("pct_total")),
                format_int(F.col("ref")), F.col("dias").cast("string"),
            ),
        ),
        fixed(5, COMPOUND_LINES),
        line(
            summary, 6, F.concat_ws("/", F.format_string("%020d", F.lit(10**18) - F.col("qtd")), F.col("composto")),
            cellrow(
                F.col("composto"), format_int(F.col("qtd")), format_pct(F.col("pct_total")), format_int(F.col("ref")),
                F.col("meses").cast("string"),
            ),
        ),
        line(
            kpis, 7, F.lit("0"),
            cellrow(
                F.lit("**TOTAL**"), F.concat(F.lit("**"), format_int(k["total_produzido"]), F.lit("**")), F.lit("**100,00 %**"),
                F.concat(F.lit("**"), format_int(k["total_refugado"]), F.lit("**")),
                F.concat(F.lit("**"), k["n_meses"].cast("string"), F.lit("**")),
            ),
        ),
    ]
    if prescribed is not None:
        known = prescribed.filter(F.col("data_prescrita").isNotNull()).join(
            kpis.select("equipamento").hint("merge"), "equipamento", "left_semi"
        )
        texts = F.array(
            F.lit(""),
            F.lit(PRESCRIPTION_TITLE),
            F.lit(""),
            F.concat(F.lit("**Data prescrita:** "), format_day(F.col("data_prescrita"))),
            F.concat(F.lit("**Data da última troca:** "), format_day(F.col("data_ultima_substituicao"))),
            F.concat(F.lit("**Data de referência (hoje):** "), format_day(F.col("data_referencia"))),
            F.concat(F.lit("**Dias restantes:** "), F.coalesce(F.col("dias_restantes").cast("string"), F.lit("—"))),
            F.concat(F.lit("**Urgência:** "), F.col("urgencia")),
            *[F.lit(t) for t in METHOD_LINES],
            *[cellrow(F.lit(n), F.coalesce(F.col(n).cast("string"), F.lit("—"))) for n in PRESCRIBED],
            *[F.lit(t) for t in SCALE_LINES],
        )
        parts.append(block(known, 8, texts))
    return parts


def report_document(lines: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """All reports as one document: the lines, in one frame or a frame per section, with their numbers, entities in order."""
    if isinstance(lines, DataFrame):
        return number_rows(lines, ["equipamento", "secao", "chave", "linha"])
    return number_sections(lines, "equipamento", "secao", ["chave", "linha"])


def document_index(document: DataFrame) -> DataFrame:
    """Where each entity's report lies in the document: first line and number of lines."""
    return document.groupBy("equipamento").agg(F.min("numero").alias("primeira_linha"), F.count(F.lit(1)).alias("linhas"))


def index_document(production: DataFrame, entity: str, as_of) -> DataFrame:
    """The index as one document of numbered lines: title, date, number of entities, one line per entity."""
    lines = report_index(production, entity).select(F.lit(1).alias("parte"), "equipamento", "linha")
    head = lines.agg(
        F.array(
            F.lit(INDEX_TITLE), F.lit(""), F.concat(F.lit("_Gerado em "), format_day(F.lit(as_of).cast("date")), F.lit("._")),
            F.concat(F.lit("_Equipamentos: "), F.count(F.lit(1)).cast("string"), F.lit("._")), F.lit(""), *[F.lit(t) for t in INDEX_COLUMNS],
        ).alias("texts")
    )
    first = head.select(F.lit(0).alias("parte"), F.posexplode("texts").alias("i", "linha"))
    return number_rows(
        lines.withColumn("i", F.lit(0)).unionByName(first.withColumn("equipamento", F.lit(None).cast(lines.schema["equipamento"].dataType))), ["parte", "i", "equipamento"]
    ).select("numero", "linha")


def report_index(production: DataFrame, entity: str) -> DataFrame:
    """One index line per entity with its number of records."""
    counts = record_counts(production, entity)
    name = F.col("equipamento").cast("string")
    return counts.select(
        "equipamento",
        F.concat(
            F.lit("| "), name, F.lit(" | "), format_int(F.col("apontamentos")), F.lit(" | ["), name, F.lit(".md]("), name, F.lit(".md) |")
        ).alias("linha"),
    )
