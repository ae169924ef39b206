import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide.operators import incremental, reports, runlog
from uptide.session import stored, stored_by

T, D = datetime.datetime, datetime.date


@pytest.fixture(scope="module")
def cells(spark):
    data = [
        ("E1", T(2024, 1, 1, 5), "A", 100, 1), ("E1", T(2024, 1, 1, 9), "A", 100, 1), ("E1", T(2024, 1, 3), "B", 300, 9),
        ("E1", T(2024, 2, 3), "A", 50, 0), ("E1", T(2024, 2, 4), None, 50, 0), ("E2", T(2024, 3, 1), "C", 0, 7),
        (None, T(2024, 1, 1), "A", 9, 9),
    ]
    df = spark.createDataFrame(data, "e string, ts timestamp, c string, q long, s long")
    return reports.monthly_cells(df, entity="e", ts="ts", compound="c", produced="q", scrapped="s")


def test_monthly_by_compound(cells):
    found = rows(reports.monthly_by_compound(cells), "equipamento", "ano_mes", "composto", "qtd", "dias", "pct_total")
    # the record without compound counts in the total of 600, not as a row
    assert found == [
        ("E1", "2024-01", "A", 200, 1, pytest.approx(33.3333, abs=1e-3)),
        ("E1", "2024-01", "B", 300, 1, 50.0),
        ("E1", "2024-02", "A", 50, 1, pytest.approx(8.3333, abs=1e-3)),
        ("E2", "2024-03", "C", 0, 1, None),
    ]


def test_summary_rollup_and_kpis(cells):
    assert rows(reports.compound_summary(cells), "equipamento", "composto", "qtd", "meses", "taxa_refugo") == [
        ("E1", "A", 250, 2, 0.8), ("E1", "B", 300, 1, 3.0), ("E2", "C", 0, 1, 0.0),
    ]
    assert rows(reports.compound_rollup(cells).filter("nivel = 1"), "equipamento", "composto", "qtd", "meses") == [
        ("E1", "TOTAL", 600, 2), ("E2", "TOTAL", 0, 1),
    ]
    kpi = {r.equipamento: r for r in reports.entity_kpis(cells).collect()}
    assert (kpi["E1"].composto_lider, kpi["E1"].qtd_lider, kpi["E1"].n_compostos, kpi["E1"].n_meses) == ("B", 300, 2, 2)
    assert (kpi["E1"].pct_lider, kpi["E1"].fim, kpi["E2"].taxa_refugo) == (50.0, D(2024, 2, 4), 0.0)
    assert rows(reports.monthly_extremes(cells)) == [("E1", "2024-01", 500, 300, 100), ("E2", "2024-03", 0, 0, 0)]


def test_top_compounds_keep_the_total(spark):
    df = spark.createDataFrame([("E1", T(2024, 1, 1), f"C{i}", i, 1) for i in range(1, 11)] + [("E2", T(2024, 1, 1), "X", 5, 0)], "e string, ts timestamp, c string, q long, s long")
    cells = reports.monthly_cells(df, entity="e", ts="ts", compound="c", produced="q", scrapped="s")
    found = rows(reports.top_compounds(cells, top=2), "equipamento", "composto", "qtd", "ref")
    assert found == [("E1", "C10", 10, 1), ("E1", "C9", 9, 1), ("E1", "Outros", 36, 8), ("E2", "X", 5, 0)]


def test_monthly_spine_fills_gaps(spark):
    df = spark.createDataFrame(
        [("E1", T(2024, 1, 5), 10, 1, 0), ("E1", T(2024, 4, 5), 7, 1, 2), ("E2", T(2024, 3, 5), 5, 0, 0), ("OLD", T(2023, 5, 5), 5, 0, 0)],
        "e string, ts timestamp, q long, s long, r long",
    )
    marks = spark.createDataFrame([("E1", D(2024, 2, 20)), ("E1", D(2024, 2, 21)), ("E2", None)], "equipamento string, data_evento date")
    found = reports.monthly_spine(df, marks, entity="e", ts="ts", produced="q", scrapped="s", reworked="r", months=3)
    assert rows(found, "equipamento", "ano_mes", "producao", "manutencao") == [
        ("E1", "2024-02", 0, 1), ("E1", "2024-03", 0, 0), ("E1", "2024-04", 7, 0),
        ("E2", "2024-02", 0, 0), ("E2", "2024-03", 5, 0), ("E2", "2024-04", 0, 0),
    ]
    whole = reports.monthly_spine(df, marks, entity="e", ts="ts", produced="q", scrapped="s", reworked="r", months=60)
    assert whole.agg(F.min("ano_mes")).first()[0] == "2023-05"


def test_report_lines_read_in_order(cells):
    lines = reports.report_lines(cells).filter("equipamento = 'E1'").orderBy("secao", "chave").select("linha").collect()
    text = [r[0] for r in lines]
    assert text[0] == "# Relatório mensal por componente — E1"
    assert "**Total produzido:** 600 peças" in text
    start = text.index("## Resumo por composto (período inteiro)")
    assert [t.split(" | ")[0] for t in text[start + 4:]] == ["| B", "| A", "| **TOTAL**"]


def test_documents_are_numbered_over_parts(spark, cells):
    lines = reports.report_lines(cells)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        document = reports.report_document(lines).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted(document, key=lambda r: r.numero)
    assert [r.numero for r in ordered] == list(range(1, len(ordered) + 1))
    assert ordered == sorted(document, key=lambda r: (r.equipamento, r.secao, r.chave, r.linha))
    index = {r.equipamento: (r.primeira_linha, r.linhas) for r in reports.document_index(spark.createDataFrame(document)).collect()}
    for entity, (first, n) in index.items():
        assert ordered[first - 1].linha == reports.TITLE + entity and {r.equipamento for r in ordered[first - 1 : first - 1 + n]} == {entity}


def test_sections_by_entity_are_numbered_without_an_exchange(spark):
    records = [(f"E{i % 7}", D(2024, 1 + i % 3, 1 + i % 5), None if i % 11 == 0 else "ABC"[i % 3], 10 + i, i % 4) for i in range(90)]
    df = spark.createDataFrame(records, "e string, ts date, c string, q bigint, s bigint")
    cells = reports.monthly_cells(df, entity="e", ts="ts", compound="c", produced="q", scrapped="s", by_entity=True)
    history = spark.createDataFrame([("E1", D(2024, 1, 20), "PREVENTIVA", "#7")], "equipamento string, data_evento date, tipo_evento string, observacoes string")
    by_entity = stored_by(cells, "cells", "equipamento", dealt=True)
    for events in (None, history):
        lines = reports.report_lines(cells, history=events).collect()
        document = reports.report_document(reports.report_sections(by_entity, history=events))
        want = sorted(map(tuple, lines), key=lambda r: r[:4])
        assert [tuple(r) for r in document.orderBy("numero").collect()] == [(n, *r) for n, r in enumerate(want, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        document = reports.report_document(reports.report_sections(by_entity))
        assert "Exchange" not in document._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_sections_without_events(spark, cells):
    history = spark.createDataFrame([("E1", D(2024, 1, 20), "PREVENTIVA", "#7")], "equipamento string, data_evento date, tipo_evento string, observacoes string")
    lines = reports.report_lines(cells, history=history).filter("secao = 2").collect()
    assert [(r.equipamento, r.linha == reports.NO_EVENT) for r in sorted(lines, key=lambda r: r.equipamento)] == [("E1", False), ("E2", True)]
    index = reports.index_document(spark.createDataFrame([("b",), ("a",), ("b",)], "e string"), "e", D(2024, 2, 1)).orderBy("numero").collect()
    assert [r.linha for r in index][2:4] == ["_Gerado em 01/02/2024._", "_Equipamentos: 2._"] and index[-1].linha == "| b | 2 | [b.md](b.md) |" and index[-1].numero == 9


LOG = "run_id string, ts timestamp, step string, model string, mse double, r2 double, accuracy double"


@pytest.fixture(scope="module")
def log(spark):
    t = T(2024, 1, 1)
    return spark.createDataFrame(
        [
            ("r1", t, "s", "b", 2.0, 0.5, 0.7), ("r1", t, "s", "a", 2.0, 0.6, 0.9), ("r1", t, "t", "a", 5.0, 0.1, None),
            ("r1", t, "u", "x", None, None, None), ("r2", t, "s", "c", 1.0, 0.9, 0.9), ("r2", t, "s", "d", 3.0, 0.2, 0.9),
        ],
        LOG,
    )


def test_run_log(log):
    assert rows(runlog.best_per_step(log), "run_id", "step", "best_model", "best_mse", "best_r2") == [
        ("r1", "s", "a", 2.0, 0.6), ("r1", "t", "a", 5.0, 0.1), ("r1", "u", None, None, None), ("r2", "s", "c", 1.0, 0.9),
    ]
    assert rows(runlog.best_by_accuracy(log)) == [("r1", "s", "a", 0.9), ("r2", "s", "c", 0.9)]
    index = runlog.run_index(log)
    assert rows(index, "run_id", "total_steps", "best_step", "best_model") == [("r1", 3, "s", "a"), ("r2", 1, "s", "c")]
    assert runlog.best_run(index).first().run_id == "r2"
    assert rows(runlog.compare_runs(log, ["s", "t"], 1)) == [("r2", 1.0, "c", None, None)]


def test_detect_changes(spark):
    old = spark.createDataFrame([("c", "a", "1"), ("c", "b", "1"), ("d", "a", "1")], "category string, name string, hash string")
    new = spark.createDataFrame([("c", "a", "2"), ("c", "b", "1"), ("c", "z", "1")], "category string, name string, hash string")
    changes = incremental.detect_changes(old, new)
    assert rows(changes, "category", "name", "change") == [("c", "a", "modified"), ("c", "z", "new"), ("d", "a", "removed")]
    assert incremental.has_changes(changes) and not incremental.has_changes(incremental.detect_changes(old, old))
    assert rows(incremental.change_counts(changes)) == [("modified", 1), ("new", 1), ("removed", 1)]


def test_report_takes_no_entities_through_the_driver(spark, cells):
    """Stored sides have a row or more per entity in files of a few bytes a row: by that size Spark would broadcast millions of rows."""
    by_entity = stored_by(cells, "cells", "equipamento")
    history = stored(spark.createDataFrame([("E1", D(2024, 1, 2), "troca", None)], "equipamento string, data_evento date, tipo_evento string, observacoes string"), "history")
    document = reports.report_document(reports.report_sections(by_entity, history=history))
    plan = document._jdf.queryExecution().executedPlan().toString()
    of_entities = [x for x in plan.split("\n") if "Broadcast" in x and "Join" in x and "__part" not in x]
    assert "SortMergeJoin" in plan and not of_entities
    numbers = [r["numero"] for r in document.collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
