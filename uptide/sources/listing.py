"""Listings of input files: categories, newest file, report versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from uptide.functions.scalar import report_version

# Category -> file-name pattern, the first match decides.
CATEGORIES = {
    "producao": r"^DadosProducao.*\.(xlsx|csv)$",
    "raw_xlsx": r"^EQ-.*\.xlsx$",
    "raw_csv": r"^EQ-.*\.csv$",
    "manutencao_xlsx": r"^(Dados Manut|dados_manutencao|historico_preventivas|Histórico Geral Preventivas).*\.xlsx$",
    "manutencao_csv": r"^(Dados Manut|dados_manutencao|historico_preventivas).*\.csv$",
}
OTHER_CATEGORY = "outros"
FIRST_REPORT_VERSION = 5


def decoded(uri: Column) -> Column:
    """A file's path or name as it is, from its URI."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, *folders: str, pattern: str = "*", more: Sequence[Column] = ()) -> DataFrame:
    """``category, name, path, size, modified`` and ``more`` of all files below the folders; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(list(folders))
        .select("path", "length", "modificationTime", *more)
    )
    extra = files.columns[3:]
    name = F.element_at(F.split("path", "/"), -1)
    category = F.lit(OTHER_CATEGORY)
    for label, rule in reversed(CATEGORIES.items()):
        category = F.when(F.col("name").rlike(rule), label).otherwise(category)
    return files.withColumn("name", name).select(
        category.alias("category"),
        "name",
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        *extra,
    )


def newest_file(files: DataFrame, *patterns: str) -> DataFrame:
    """The most recently modified file whose name matches one of the regular expressions; path breaks ties."""
    wanted = F.lit(False)
    for rule in patterns:
        wanted = wanted | F.col("name").rlike(rule)
    return files.filter(wanted).agg(F.max(F.struct("modified", "path", "name", "size")).alias("f")).filter(
        F.col("f").isNotNull()
    ).select("f.path", "f.name", "f.size", "f.modified")


def next_report_version(files: DataFrame, suffix: str = "") -> DataFrame:
    """One row: ``R<highest version + 1>``, or the first version when no report exists."""
    highest = F.max(report_version(F.regexp_replace("name", r"\.[^.]*$", "")))
    number = F.coalesce(highest + 1, F.lit(FIRST_REPORT_VERSION))
    return files.agg(F.concat(F.lit("R"), number.cast("string"), F.lit(suffix)).alias("version"))
