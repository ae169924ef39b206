"""The operators of this package as registered queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from uptide.llm import ann, decontaminate, mixing, periodic_runs, pieces, pii, prefix_trie, quality, secrets, sentence_spans, simhash, suffix_dedup, toxicity
from uptide.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda spark, sf_dir: toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op2_sentencepiece": lambda spark, sf_dir: pieces.encode_documents(table(spark, sf_dir, "documents")),
    "op3_simhash": lambda spark, sf_dir: simhash.near_duplicates(table(spark, sf_dir, "documents")),
    "op4_quality": lambda spark, sf_dir: quality.judge(table(spark, sf_dir, "documents")),
    "op5_pii": lambda spark, sf_dir: pii.pii_report(table(spark, sf_dir, "documents")),
    "op6_suffix_dedup": lambda spark, sf_dir: suffix_dedup.substring_report(table(spark, sf_dir, "documents")),
    "op7_mixing": lambda spark, sf_dir: mixing.mix(table(spark, sf_dir, "documents")),
    "op8_ann": lambda spark, sf_dir: ann.search(table(spark, sf_dir, "embeddings")),
    "op9_secrets": lambda spark, sf_dir: secrets.secret_report(table(spark, sf_dir, "documents")),
    "op10_sentence_spans": lambda spark, sf_dir: sentence_spans.span_report(table(spark, sf_dir, "documents"), every=True),
    "op11_decontamination": lambda spark, sf_dir: decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op12_periodic_runs": lambda spark, sf_dir: periodic_runs.run_report(table(spark, sf_dir, "documents")),
    "op13_prefix_trie": lambda spark, sf_dir: prefix_trie.trie_report(table(spark, sf_dir, "conversations")),
}

SQL: dict[str, str] = {"op7_mixing": mixing.SQL, "op11_decontamination": decontaminate.SQL, "op13_prefix_trie": prefix_trie.SQL}
