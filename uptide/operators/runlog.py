"""Run history: best models per step, comparison of runs, run index.

The log is a long table: run_id, ts, step, model, mse, r2, accuracy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def best_per_step(log: DataFrame) -> DataFrame:
    """Model with the smallest MSE per run and step; steps without any MSE have no best model."""
    order = F.when(F.col("mse").isNotNull(), F.struct("mse", "model"))
    return log.groupBy("run_id", "step").agg(
        F.min("ts").alias("ts"),
        F.min_by("model", order).alias("best_model"),
        F.min("mse").alias("best_mse"),
        F.min_by("r2", order).alias("best_r2"),
    )


def best_by_accuracy(log: DataFrame) -> DataFrame:
    """Classification steps: model with the highest accuracy, by name on ties."""
    rows = log.filter(F.col("accuracy").isNotNull())
    return rows.groupBy("run_id", "step").agg(
        F.min_by("model", F.struct(-F.col("accuracy"), F.col("model"))).alias("best_model"),
        F.max("accuracy").alias("best_accuracy"),
    )


def run_index(log: DataFrame) -> DataFrame:
    """One row per run: time, number of steps, and the best model over all its steps."""
    steps = best_per_step(log)
    order = F.when(F.col("best_mse").isNotNull(), F.struct("best_mse", "step"))
    return steps.groupBy("run_id").agg(
        F.min("ts").alias("ts"),
        F.count(F.lit(1)).alias("total_steps"),
        F.min_by("step", order).alias("best_step"),
        F.min_by("best_model", order).alias("best_model"),
        F.min("best_mse").alias("best_mse"),
    )


def last_runs(log: DataFrame, n: int) -> DataFrame:
    return log.select("run_id").distinct().orderBy(F.desc("run_id")).limit(n)


def compare_runs(log: DataFrame, steps: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` runs side by side: ``<step>_mse`` and ``<step>_model`` per step."""
    recent = log.join(last_runs(log, n), "run_id", "left_semi")
    return (
        best_per_step(recent)
        .groupBy("run_id")
        .pivot("step", list(steps))
        .agg(F.min("best_mse").alias("mse"), F.min("best_model").alias("model"))
    )


def best_run(index: DataFrame) -> DataFrame:
    """The run with the smallest best MSE, the earliest on ties."""
    rows = index.filter(F.col("best_mse").isNotNull())
    return rows.agg(F.min_by(F.struct(*rows.columns), F.struct("best_mse", "run_id")).alias("r")).select("r.*")


def metrics_as_log(metrics: DataFrame, run_id: str, ts, step: str) -> DataFrame:
    """Metric rows of a comparison as run-log rows."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(ts).cast("timestamp").alias("ts"),
        F.lit(step).alias("step"),
        "model",
        "mse",
        "r2",
        F.lit(None).cast("double").alias("accuracy"),
    )


def step_outcomes(results: DataFrame) -> DataFrame:
    """Steps per status of a run, from rows (step, status)."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
