"""Readers of production, maintenance and preventive files, and of stage tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from uptide import schema
from uptide.functions.scalar import parse_timestamp, safe_double
from uptide.operators.clean import combine_sources, drop_key_duplicates, with_entity_prefix
from uptide.operators.events import MEASURES
from uptide.operators.features import DEFAULT_INTERVAL_DAYS, with_defaults
from uptide.session import few_listing_tasks
from uptide.sources.layouts import list_paths, read_layouts
from uptide.sources.workbooks import named_cells, read_cells

DEDUP_KEYS = ("order_id", "prod_ts", "resource", "product", "qty_produced")


def _typed(raw: DataFrame, entity) -> DataFrame:
    """Canonical production record: parsed date, trimmed entity, raw date dropped."""
    return raw.select(
        parse_timestamp(F.col("prod_date"), schema.DATE_FORMATS).alias("prod_ts"),
        F.trim(entity).alias("entity"),
        *[F.col(c) for c in raw.columns if c != "prod_date"],
    )


def _read(spark: SparkSession, paths: Sequence[str], *, fallbacks: Mapping[str, Sequence[str]] | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Production rows of files whose columns are found by each file's own header."""
    columns = {n: (h, *(fallbacks or {}).get(n, ())) for h, n in schema.PRODUCTION_HEADERS.items()}
    return read_layouts(spark, paths, columns, schema.PRODUCTION_TYPES, standard=list(schema.PRODUCTION_HEADERS), defaults=defaults)


def production_rows(files: DataFrame) -> DataFrame:
    """Production records of the files listed in ``path``; the entity is the resource column."""
    paths = sorted(r["path"] for r in files.select("path").distinct().collect())
    return _typed(_read(files.sparkSession, paths), F.col("resource"))


def _csv(spark: SparkSession, folder: str, pattern: str, **options) -> DataFrame:
    return _read(spark, list_paths(spark, folder, pattern), **options)


def read_entity_files(spark: SparkSession, folder: str, pattern: str = "EQ-*.csv") -> DataFrame:
    """Standard per-entity files; the entity is the file stem. Stems with a dot are extended files and left out."""
    rows = _csv(spark, folder, pattern)
    stem = F.regexp_extract("source_file", r"^(.+)\.csv$", 1)
    return _typed(rows.filter(~F.col("source_file").rlike(r"^[^.]*\.[^.]+\.csv$")), stem)


def read_extended_files(spark: SparkSession, folder: str, pattern: str = "EQ-*.*.csv") -> DataFrame:
    """Files with other columns, of any layouts; a description stands in for a missing compound."""
    rows = _csv(
        spark,
        folder,
        pattern,
        fallbacks={"compound": schema.COMPOUND_FALLBACKS},
        defaults={"compound": schema.MISSING_COMPOUND, "mass_kg_per_100": 0.0},
    )
    return _typed(rows, F.split("source_file", r"\.")[0])


def read_consolidated_files(spark: SparkSession, folder: str, pattern: str = "DadosProducao*.csv") -> DataFrame:
    """Files with many entities; the entity is the resource column."""
    return _typed(_csv(spark, folder, pattern), F.col("resource"))


def read_production(spark: SparkSession, folder: str) -> DataFrame:
    """Production with the resource as entity and the file it came from, for events and reports."""
    return _typed(_csv(spark, folder, "EQ-*.csv"), F.col("resource"))


def collect_production(spark: SparkSession, folder: str) -> DataFrame:
    """All production files as one table without repeated business keys, standard files first.

    Dates are parsed before comparing keys. A kind of file that is absent adds nothing.
    """
    sources = [read_entity_files(spark, folder), read_consolidated_files(spark, folder)]
    if has_files(spark, folder, "EQ-*.*.csv"):
        sources.insert(1, read_extended_files(spark, folder))
    ranked = [s.withColumn("source_rank", F.lit(i)) for i, s in enumerate(sources)]
    merged = combine_sources(*ranked)
    return drop_key_duplicates(merged, DEDUP_KEYS, ["source_rank", "source_file"]).drop("source_rank")


def production_from_cells(cells: DataFrame) -> DataFrame:
    """Production records from workbook cells in file order; each sheet's first row is its header."""
    rows = named_cells(cells.filter(F.col("row_no") > 1), schema.PRODUCTION.names)
    typed = [F.col(n).try_cast(schema.PRODUCTION_TYPES[n]).alias(n) for n in schema.PRODUCTION.names]
    return _typed(rows.select(*typed, "source_file"), F.col("resource"))


def read_production_workbooks(spark: SparkSession, folder: str, pattern: str = "EQ-*.xlsx") -> DataFrame:
    return production_from_cells(read_cells(spark, folder, pattern))


def read_maintenance_workbooks(spark: SparkSession, folder: str, pattern: str = "dados_manutencao*.xlsx") -> DataFrame:
    """Maintenance sheets with a blank first column and two header rows."""
    return maintenance_from_cells(named_cells(read_cells(spark, folder, pattern), schema.MAINTENANCE.names, 1))


def read_preventive_workbooks(spark: SparkSession, folder: str, pattern: str = "historico_preventivas*.xlsx") -> DataFrame:
    return preventive_from_cells(named_cells(read_cells(spark, folder, pattern), schema.PREVENTIVE.names))


def first_folder_with(spark: SparkSession, folders: list[str], *patterns: str) -> str | None:
    """First existing folder holding a file that matches one of the glob patterns."""
    for folder in folders:
        try:
            if any(has_files(spark, folder, p) for p in patterns):
                return folder
        except AnalysisException:  # the folder does not exist
            continue
    return None


def has_files(spark: SparkSession, folder: str, pattern: str) -> bool:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return not files.isEmpty()


def maintenance_from_cells(cells: DataFrame, source: str | None = None) -> DataFrame:
    """Typed maintenance table from text cells in the order of ``schema.MAINTENANCE``.

    Header rows fall out with the entity prefix test, however many there are. Numbers and
    dates that do not parse become NULL.
    """
    rows = with_entity_prefix(cells, "entity", schema.ENTITY_PREFIX)

    def date(name: str):
        return F.to_date(parse_timestamp(F.col(name), ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")))

    return rows.select(
        "entity",
        date("last_replacement").alias("last_replacement"),
        date("previous_replacement").alias("previous_replacement"),
        safe_double(F.col("days_in_operation")).cast("int").alias("days_in_operation"),
        "notes",
        *[safe_double(F.col(c)).alias(c) for c in schema.MAINTENANCE.names[5:]],
        (F.lit(source) if source else F.col("source_file")).alias("source_file"),
    )


def read_maintenance(spark: SparkSession, path: str, *, leading_blank: bool = False) -> DataFrame:
    """Maintenance sheet as CSV, read by position because header names repeat."""
    fields = [T.StructField("blank", T.StringType())] if leading_blank else []
    layout = T.StructType([*fields, *schema.MAINTENANCE.fields])
    raw = spark.read.schema(layout).option("header", False).csv(path)
    return maintenance_from_cells(raw.select("*", F.col("_metadata.file_name").alias("source_file")))


def as_event_source(maintenance: DataFrame) -> DataFrame:
    """Maintenance table under the column names of the event history."""
    measures = dict(zip(MEASURES, ("a_max", "a_min", "b_max", "b_min")))
    return maintenance.select(
        F.col("entity").alias("equipamento"),
        F.col("last_replacement").alias("data_ultima_substituicao"),
        F.col("previous_replacement").alias("data_penultima_substituicao"),
        F.col("days_in_operation").alias("dias_em_operacao"),
        F.col("notes").alias("observacoes"),
        *[F.col(c).alias(n) for n, c in measures.items()],
        F.col("source_file").alias("arquivo_origem"),
    )


def as_dimension(maintenance: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """Maintenance table as feature dimension; with ``defaults``, gaps and absent entities are completed.

    An entity without an interval gets 365 days once defaults are in use.
    """
    dim = maintenance.select(
        "entity",
        "last_replacement",
        "previous_replacement",
        F.col("days_in_operation").alias("interval_days"),
        "notes",
        *[F.col(c).alias(n) for n, c in zip(MEASURES, ("a_max", "a_min", "b_max", "b_min"))],
    )
    if defaults is None:
        return dim
    filled = with_defaults(dim, defaults, "entity", ["last_replacement", "interval_days"])
    rest = dim.drop("last_replacement", "interval_days")
    return filled.join(rest, "entity", "left").withColumn(
        "interval_days", F.coalesce("interval_days", F.lit(DEFAULT_INTERVAL_DAYS))
    )


def default_maintenance(spark: SparkSession) -> DataFrame:
    """Last known dates and intervals as a dimension."""
    rows = [line.split() for line in schema.DEFAULT_MAINTENANCE.strip().splitlines()]
    return spark.createDataFrame(rows, "entity string, d string, i string").select(
        "entity", F.to_date("d").alias("last_replacement"), F.col("i").cast("int").alias("interval_days")
    )


def preventive_from_cells(cells: DataFrame) -> DataFrame:
    rows = cells.withColumn("entity", F.trim("entity")).filter(F.col("entity").startswith(schema.ENTITY_PREFIX))
    return rows.select(
        F.col("entity").alias("equipamento"),
        F.to_date(parse_timestamp(F.col("event_date"), ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy"))).alias("data_evento"),
        F.col("event_type").alias("tipo_evento"),
        safe_double(F.col("request_no")).cast("int").alias("n_solicitacao"),
        safe_double(F.col("order")).cast("bigint").alias("ordem"),
        F.col("source_file").alias("arquivo_origem"),
    )


def read_preventive(spark: SparkSession, path: str) -> DataFrame:
    """Preventive events as CSV; undated events are kept with a NULL date."""
    raw = spark.read.schema(schema.PREVENTIVE).option("header", False).csv(path)
    return preventive_from_cells(raw.select("*", F.col("_metadata.file_name").alias("source_file")))


def read_simple_maintenance(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.SIMPLE_MAINTENANCE).option("header", True).csv(path)


def read_stage(spark: SparkSession, path: str, kind: str = "parquet", columns: T.StructType | str | None = None) -> DataFrame:
    """Stage table written by the sinks: parquet (default), JSON records or CSV with ISO dates.

    CSV needs its ``columns``: nothing is guessed from the data, and a header that differs is an error.
    """
    if kind == "csv" and columns is None:
        raise ValueError("CSV stages are read with a schema")
    reader = spark.read.schema(columns) if columns is not None else spark.read
    with few_listing_tasks(spark):
        return reader.format(kind).option("header", True).option("enforceSchema", False).load(path)
