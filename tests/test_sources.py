import datetime
import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide import schema
from uptide.operators import ml, reports
from uptide.plans import stages
from uptide.session import LISTING
from uptide.sources import listing, readers, sinks, workbooks
from uptide.streaming import ingest

D, T = datetime.date, datetime.datetime
HEADER = ",".join(schema.PRODUCTION_HEADERS)


def line(date, order, entity, qty, scrap=1, compound="MASSA 1", mass=0.5, product="PR1"):
    return f"{date},{order},{entity},{product},{qty},{scrap},0,1,PC,{compound},{mass}"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder / "EQ-101.csv", HEADER, line("05/03/2024 00:00:00", 1, "EQ-101", 10), line("25/03/2024 00:00:00", 2, "EQ-101 ", 20),
          line("nonsense", 3, "EQ-101", 5))
    write(folder / "EQ-102.csv", HEADER, line("06/03/2024 00:00:00", 4, "EQ-102", 30))
    write(folder / "EQ-138.2.csv", "Cód. Ordem,Data de Produção,Qtd. Produzida,Nome. Produto,Cód. Recurso", "9,2024-03-07,40,Nome X,EQ-138")
    write(folder / "DadosProducao2024.csv", HEADER, line("05/03/2024 00:00:00", 1, "EQ-101", 10, compound="COPY"),
          line("08/03/2024 00:00:00", 11, "EQ-103", 50))
    return folder


def maintenance_csv(path):
    write(
        path,
        "Equipamento,Data,Data,Dias,Obs,A,B,C,D,E,Max,Min,A,B,C,D,Max,Min",
        "EQ-101,2024-03-20,2024-03-01,19,OK,20.1,20,20,20,20,20.3,20.0,19.8,19.7,19.9,19.6,19.9,19.5",
        "EQ-102,2024-03-10,,abc,,x,,,,,20.2,20.1,,,,,,",
        "Total,2024-03-10,,1,,,,,,,,,,,,,,",
    )


def test_entity_files(spark, raw):
    found = readers.read_entity_files(spark, str(raw))
    assert rows(found, "entity", "prod_ts", "order_id", "source_file") == [
        ("EQ-101", T(2024, 3, 5), 1, "EQ-101.csv"), ("EQ-101", T(2024, 3, 25), 2, "EQ-101.csv"),
        ("EQ-101", None, 3, "EQ-101.csv"), ("EQ-102", T(2024, 3, 6), 4, "EQ-102.csv"),
    ]


def test_extended_and_consolidated_files(spark, raw):
    ext = readers.read_extended_files(spark, str(raw))
    assert rows(ext, "entity", "prod_ts", "qty_produced", "qty_scrapped", "compound", "mass_kg_per_100", "source_file") == [
        ("EQ-138", T(2024, 3, 7), 40, None, "Nome X", 0.0, "EQ-138.2.csv")
    ]
    assert rows(readers.read_consolidated_files(spark, str(raw)), "entity", "order_id") == [("EQ-101", 1), ("EQ-103", 11)]


def test_collect_prefers_standard_files(spark, raw):
    found = readers.collect_production(spark, str(raw))
    assert rows(found, "order_id", "compound") == [(1, "MASSA 1"), (11, "MASSA 1"), (2, "MASSA 1"), (3, "MASSA 1"), (4, "MASSA 1"), (9, "Nome X")]


def test_maintenance_by_position(spark, tmp_path):
    maintenance_csv(tmp_path / "dados_manutencao_2024.csv")
    m = readers.read_maintenance(spark, str(tmp_path / "dados_manutencao_2024.csv"))
    assert rows(m, "entity", "last_replacement", "days_in_operation", "a_p1", "a_max", "b_min") == [
        ("EQ-101", D(2024, 3, 20), 19, 20.1, 20.3, 19.5), ("EQ-102", D(2024, 3, 10), None, None, 20.2, None),
    ]
    dim = readers.as_dimension(m, readers.default_maintenance(spark))
    found = {r.entity: (r.last_replacement, r.interval_days) for r in dim.collect()}
    assert len(found) == 27
    assert found["EQ-101"] == (D(2024, 3, 20), 19) and found["EQ-102"] == (D(2024, 3, 10), 343)
    assert found["EQ-127"] == (D(2024, 8, 10), 406)


def test_preventive_and_simple_files(spark, tmp_path):
    write(tmp_path / "prev.csv", "Equipamento,Grp,Texto,N,Data,Ordem", " EQ-101 ,PREV.MEC,REVISÃO,1,2024-02-01,5070000", "EQ-102,PREV.MEC,REVISÃO,2,??,")
    assert rows(readers.read_preventive(spark, str(tmp_path / "prev.csv")), "equipamento", "data_evento", "n_solicitacao", "ordem") == [
        ("EQ-101", D(2024, 2, 1), 1, 5070000), ("EQ-102", None, 2, None),
    ]
    write(tmp_path / "simple.csv", "equipamento,data_manutencao,tipo,descricao", "EQ-101,2026-01-22,Corretiva,x")
    assert rows(readers.read_simple_maintenance(spark, str(tmp_path / "simple.csv"))) == [("EQ-101", D(2026, 1, 22), "Corretiva", "x")]


def xlsx(path, table):
    """Smallest workbook: shared strings, numbers, and dates with style 1."""
    strings: list[str] = []
    body = []
    for i, row in enumerate(table, 1):
        cells = []
        for j, v in enumerate(row):
            ref = f"{chr(65 + j)}{i}"
            if isinstance(v, D):
                cells.append(f'<c r="{ref}" s="1"><v>{(v - D(1899, 12, 30)).days}</v></c>')
            elif isinstance(v, (int, float)):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            elif v is not None:
                if v not in strings:
                    strings.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{strings.index(v)}</v></c>')
        body.append(f'<row r="{i}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{''.join(body)}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(f'<si><t>{escape(s)}</t></si>' for s in strings)}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')


def test_workbooks(spark, tmp_path):
    head = list(schema.PRODUCTION_HEADERS)
    xlsx(tmp_path / "EQ-101.xlsx", [head, [D(2024, 3, 5), 1, "EQ-101", "PR1", 10, 1, 0, 1, "PC", "MASSA & 1", 0.5]])
    xlsx(tmp_path / "EQ-102.xlsx", [head, [D(2024, 12, 31), 2, "EQ-102", "PR1", 20, None, 0, 1, "PC", None, 0.5]])
    found = readers.read_production_workbooks(spark, str(tmp_path))
    assert rows(found, "entity", "prod_ts", "qty_produced", "qty_scrapped", "compound", "source_file") == [
        ("EQ-101", T(2024, 3, 5), 10, 1, "MASSA & 1", "EQ-101.xlsx"), ("EQ-102", T(2024, 12, 31), 20, None, None, "EQ-102.xlsx"),
    ]
    sheet = [[None, "Histórico"], [None, "Equipamento"], [None, "EQ-101", D(2024, 3, 20), D(2024, 3, 1), 19, "OK", *[20.0] * 5, 20.3, 20.0, *[19.0] * 4, 19.9, 19.5]]
    xlsx(tmp_path / "dados_manutencao.xlsx", sheet)
    m = readers.read_maintenance_workbooks(spark, str(tmp_path))
    assert rows(m, "entity", "last_replacement", "days_in_operation", "a_max", "b_min", "source_file") == [
        ("EQ-101", D(2024, 3, 20), 19, 20.3, 19.5, "dados_manutencao.xlsx")
    ]
    assert workbooks.read_cells(spark, str(tmp_path)).filter("cells[0] is null").count() == 3


def test_listing(spark, raw, tmp_path):
    files = listing.list_files(spark, str(raw))
    assert rows(files, "name", "category") == [
        ("DadosProducao2024.csv", "producao"), ("EQ-101.csv", "raw_csv"), ("EQ-102.csv", "raw_csv"), ("EQ-138.2.csv", "raw_csv"),
    ]
    os.utime(raw / "EQ-102.csv", (2_000_000_000, 2_000_000_000))
    assert listing.newest_file(files, r"^EQ-", r"^Dados").first().name == "EQ-102.csv"
    assert listing.newest_file(files, r"^none").collect() == []
    for n in ("Report_R5.pdf", "Report_R12.pdf"):
        write(raw / n, "x")
    assert listing.next_report_version(listing.list_files(spark, str(raw)), "_v1").first()[0] == "R13_v1"
    assert listing.next_report_version(files.filter("false")).first()[0] == "R5"
    assert readers.first_folder_with(spark, [str(tmp_path / "none"), str(raw)], "EQ-*.xlsx", "EQ-*.csv") == str(raw)


def test_split_and_append(spark, raw, tmp_path):
    path = str(tmp_path / "table")
    first = readers.read_entity_files(spark, str(raw)).select("entity", "order_id", "qty_produced")
    sinks.split_by_entity(first, path)
    assert {"entity=EQ-101", "entity=EQ-102"} <= set(os.listdir(path))
    more = first.unionByName(readers.read_consolidated_files(spark, str(raw)).select("entity", "order_id", "qty_produced"))
    for _ in range(2):  # appending again adds nothing
        sinks.append_production(spark, more, path)
    assert rows(spark.read.parquet(path), "order_id") == [(1,), (11,), (2,), (3,), (4,)]


def test_stage_tables(spark, tmp_path):
    df = spark.createDataFrame([("E1", D(2024, 1, 2), None)], "equipamento string, d date, v double")
    sinks.write_stage(df, str(tmp_path / "p"))
    assert rows(readers.read_stage(spark, str(tmp_path / "p"))) == rows(df)
    sinks.export_statistics(df, str(tmp_path / "s"))
    assert readers.read_stage(spark, str(tmp_path / "s/csv"), "csv", df.schema).first().d == D(2024, 1, 2)
    assert set(readers.read_stage(spark, str(tmp_path / "s/json"), "json").columns) == {"equipamento", "d", "v"}


def test_stages_from_files_to_reports(spark, raw, tmp_path):
    maintenance_csv(tmp_path / "dados_manutencao_2024.csv")
    production = readers.collect_production(spark, str(raw))
    maintenance = readers.read_maintenance(spark, str(tmp_path / "dados_manutencao_2024.csv"))
    pre = stages.preprocess(production, maintenance, readers.default_maintenance(spark))
    assert rows(pre, "order_id", "target", "qty_produced_acumulado") == [(1, 15, 10), (11, 186, 50), (2, 14, 30), (4, 4, 30), (9, 86, 40)]
    assert "Equipamento_EQ_101" in stages.encode(pre).columns
    assert stages.statistics(pre, maintenance).count() == 4
    crossed = stages.cross_reference(maintenance, None, production, D(2024, 4, 1))
    assert rows(crossed.windows) == [("EQ-101", D(2024, 3, 1), D(2024, 3, 20), 19, 10, 0.05)]
    prescribed = stages.prescriptions(crossed, D(2024, 4, 1))
    assert [r.equipamento for r in prescribed.collect()] == ["EQ-101", "EQ-102"]
    sinks.write_reports(stages.component_reports(production, crossed, prescribed), str(tmp_path / "md"))
    folder = tmp_path / "md" / "equipamento=EQ-101"
    text = "".join((folder / n).read_text(encoding="utf-8") for n in sorted(os.listdir(folder)) if n.endswith(".txt"))
    assert text.startswith("# Relatório mensal por componente — EQ-101\n") and "**Urgência:** " in text


def test_models_are_stored_and_compared(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "double(id % 17) x", "double(id % 5) y", "cast(null as double) empty", "3.0D * (id % 17) - (id % 5) target")
    table = sinks.save_split(ml.split_by_key(df, df.id.cast("string")), str(tmp_path / "split"))
    names = ml.feature_columns(table, "target", exclude=["id"])
    assert names == ["x", "y"]
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    assert 40 < test.count() < 120
    models = {n: ml.fit(n, train, names, "target", rounds=3) for n in ml.MODEL_NAMES}
    metrics = ml.compare_models(models, test, names, "target")
    ranking = ml.model_ranking(metrics).orderBy("rank").collect()
    assert (ranking[0].model, ranking[0].marca, ranking[0].ajuste) == ("linear_regression", "★", "Excelente")
    assert sinks.save_best_model(models, metrics, ml.best_model(metrics), str(tmp_path / "m")) == "linear_regression"
    sinks.save_models(models, str(tmp_path / "m"))
    again = ml.predictions(sinks.load_best_model(str(tmp_path / "m")), test, names, "target").first()
    assert again.prediction == pytest.approx(again.target)


def test_constant_and_leaky_features_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 1, 5.0)], "target double, indice_desgaste double, intervalo_manutencao double, Equipamento_E1 int, q double")
    assert ml.feature_columns(df, "target") == ["Equipamento_E1", "q"]
    assert ml.feature_columns(df.drop("Equipamento_E1"), "target") == ["indice_desgaste", "q"]
    data = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 3.0, None)], "entity string, c double, Cod_Un_PC double")
    assert rows(ml.constant_features(data, ["c", "Cod_Un_PC"], "entity")) == [("Cod_Un_PC", 0, 1, "encoding"), ("c", 1, 0, "original")]


def test_stream_equals_batch_and_survives_a_retry(spark, raw, tmp_path):
    target, state = str(tmp_path / "t"), str(tmp_path / "c")
    daily = str(tmp_path / "d")
    keys = ["order_id", "entity", "prod_ts"]

    def run():
        stream = ingest.production_stream(spark, str(raw), files_per_batch=1)
        hook = ingest.daily_partials(daily, entity="entity", ts="prod_ts", compound="compound", quantity="qty_produced")
        query = ingest.start_ingestion(stream, target=target, checkpoint=state, keys=keys, prepare=readers.production_rows, after=hook, poll_seconds=None)
        query.awaitTermination(120)
        return ingest.read_ingested(spark, target, readers.read_production(spark, str(raw)).schema)

    batch = readers.read_production(spark, str(raw)).filter("source_file != 'EQ-138.2.csv'")
    assert rows(run().filter("source_file != 'EQ-138.2.csv'"), "order_id") == rows(batch, "order_id")
    write(raw / "EQ-110.csv", HEADER, line("05/03/2024 00:00:00", 1, "EQ-101", 10), line("05/04/2024 00:00:00", 77, "EQ-110", 70))
    found = run()
    assert found.filter("order_id = 1").count() == 1 and found.filter("order_id = 77").count() == 1
    monthly = ingest.monthly_from_partials(spark, daily, entity="entity", compound="compound")
    assert rows(monthly.filter("entity = 'EQ-101' and mes is not null"), "qtd", "dias") == [(30, 2)]
    # the same batch delivered again replaces its own folder
    again = found.filter("order_id = 77")
    for _ in range(2):
        ingest.store_batch(again.withColumn("order_id", again.order_id + 1000), 99, target)
    assert ingest.read_ingested(spark, target, found.schema).filter("order_id = 1077").count() == 1


def test_refresh_only_on_change(spark, raw, tmp_path):
    state, seen = str(tmp_path / "state"), []

    def refresh(force=False):
        return ingest.refresh_if_changed(spark, str(raw), state, lambda c: seen.append(rows(c, "name", "change")), force=force)

    assert refresh() and len(seen[0]) == 4
    assert not refresh()
    write(raw / "EQ-102.csv", HEADER, line("06/03/2024 00:00:00", 4, "EQ-102", 31))
    assert refresh() and seen[-1] == [("EQ-102.csv", "modified")]
    with pytest.raises(RuntimeError):
        write(raw / "EQ-102.csv", HEADER)
        ingest.refresh_if_changed(spark, str(raw), state, lambda c: (_ for _ in ()).throw(RuntimeError()))
    assert refresh() and not refresh() and refresh(force=True)


def test_production_is_read_by_each_files_header(spark, tmp_path):
    write(tmp_path / "EQ-1.csv", "Qtd. Refugada,Qtd. Produzida,Cód. Ordem,Data de Produção,Cód. Recurso", "5,100,1,05/03/2024,EQ-1")
    write(tmp_path / "EQ-2.csv", "Cód. Ordem,Data de Produção,Cód. Recurso,Qtd. Produzida,Qtd. Refugada", "2,06/03/2024,EQ-2,200,M1")
    found = readers.read_entity_files(spark, str(tmp_path))
    assert rows(found, "entity", "order_id", "qty_produced", "qty_scrapped") == [("EQ-1", 1, 100, 5), ("EQ-2", 2, 200, None)]


def test_many_columns_repeated_names_and_large_files(spark, tmp_path):
    names = list(schema.PRODUCTION_HEADERS)
    extra = [f"Extra {i}" for i in range(100)]
    head = [*extra[:90], *reversed(names), *extra[90:]]
    row = {**dict(zip(names, line("05/03/2024", 7, "EQ-1", 70).split(","))), **dict.fromkeys(extra, "x")}
    write(tmp_path / "EQ-1.csv", "", ",".join(head), ",".join(row[h] for h in head), ",".join(row[h] for h in head).replace(",70,", ",71,"))
    # a row of data that names two columns is data; further columns do not make another layout
    write(tmp_path / "EQ-2.csv", HEADER, line("06/03/2024", 8, "EQ-2", 80, compound="Cód. Ordem", product="Cód. Un."))
    write(tmp_path / "EQ-3.csv", "\ufeff" + HEADER + ",More", *(line("07/03/2024", n, "EQ-3", n) + ",y" for n in range(4000)))
    write(tmp_path / "EQ-4 50%.csv", line("08/03/2024", 9, "EQ-4", 90))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = readers.read_entity_files(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 8
        assert rows(found.filter("entity != 'EQ-3'"), "entity", "order_id", "qty_produced", "product", "compound") == [
            ("EQ-1", 7, 70, "PR1", "MASSA 1"), ("EQ-1", 7, 71, "PR1", "MASSA 1"), ("EQ-2", 8, 80, "Cód. Un.", "Cód. Ordem"), ("EQ-4 50%", 9, 90, "PR1", "MASSA 1"),
        ]
        third = found.filter("entity = 'EQ-3'")
        assert third.count() == 4000 and third.filter("prod_ts is null or qty_produced != order_id").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert readers.read_entity_files(spark, str(tmp_path), "none*.csv").count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A folder per supplier must not mean a task per supplier."""
    path, tasks = str(tmp_path / "split"), 4 * spark.sparkContext.defaultParallelism
    rows = spark.range(2 * tasks + 5).select(F.col("id").alias("entity"), F.lit(1).alias("n"))
    rows.coalesce(1).write.partitionBy("entity").parquet(path)
    before = spark.conf.get(LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    found = readers.read_stage(spark, path, columns=rows.schema)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= tasks
    assert spark.conf.get(LISTING) == before and found.count() == 2 * tasks + 5
