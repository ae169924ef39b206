"""Training-data pipeline over ``documents``: toxicity, near-duplicates, secrets, source mix, token ids.

Every stage works on all rows that its predecessor kept; stages but the last return the columns of ``documents``. Each
stage's result is written as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.llm import mixing, pieces, secrets, simhash, toxicity
from uptide.llm.common import table
from uptide.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above go. Labels teach only by documents that are in ``docs``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that of the smallest id."""
    return simhash.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets but wide examples become a mark; every document stays, ``n_chars`` follows the text."""
    return _counted(secrets.redact_live(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: the rounded number of times that their words are taken."""
    return mixing.repeat_taken(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document."""
    return pieces.encode_documents(docs)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", tokenise),
]

#: String kernels, hashes of other engines and piece models are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
