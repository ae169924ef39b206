"""Run log derived from orders, and snapshots derived from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptide.operators import incremental, runlog
from uptide.plans import adapters as a
from uptide.plans.registry import query
from uptide.session import shared_folder, stored
from uptide.sources import runs

STEPS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """Order days as runs, priorities as steps, states as models, prices as errors."""
    day = F.to_date("o_orderdate")
    rows = a.table(spark, sf, "orders").groupBy(
        F.date_format(day, "yyyyMMdd_HHmmss").alias("run_id"),
        F.col("o_orderpriority").alias("step"),
        F.col("o_orderstatus").alias("model"),
    )
    mse = F.round(F.avg("o_totalprice") / 1000, 3)
    return rows.agg(
        F.to_timestamp(F.min(day)).alias("ts"),
        F.when(F.col("o_orderstatus") != "P", mse).alias("mse"),
        F.round(1 - mse / 1000, 6).alias("r2"),
        F.round(F.max("o_totalprice") / 1000000, 4).alias("accuracy"),
    )


LOG_SQL = """log AS (SELECT strftime(o_orderdate, '%Y%m%d_%H%M%S') AS run_id, o_orderpriority AS step, o_orderstatus AS model,
  min(o_orderdate) AS ts, CASE WHEN o_orderstatus <> 'P' THEN round(avg(o_totalprice) / 1000, 3) END AS mse,
  round(1 - round(avg(o_totalprice) / 1000, 3) / 1000, 6) AS r2, round(max(o_totalprice) / 1000000, 4) AS accuracy FROM orders GROUP BY 1, 2, 3),
steps AS (SELECT run_id, step, min(ts) AS ts, arg_min(model, struct_pack(e := mse, m := model)) FILTER (WHERE mse IS NOT NULL) AS best_model, min(mse) AS best_mse,
  arg_min(r2, struct_pack(e := mse, m := model)) FILTER (WHERE mse IS NOT NULL) AS best_r2 FROM log GROUP BY 1, 2),
idx AS (SELECT run_id, min(ts) AS ts, count(*) AS total_steps, arg_min(step, struct_pack(e := best_mse, s := step)) FILTER (WHERE best_mse IS NOT NULL) AS best_step,
  arg_min(best_model, struct_pack(e := best_mse, s := step)) FILTER (WHERE best_mse IS NOT NULL) AS best_model, min(best_mse) AS best_mse FROM steps GROUP BY 1)"""


@query(
    "best_per_step",
    f"WITH {LOG_SQL} SELECT run_id, step, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, best_model, best_mse, best_r2 FROM steps",
)
def best_per_step(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.best_per_step(_log(spark, sf))


@query(
    "best_by_accuracy",
    f"""WITH {LOG_SQL} SELECT run_id, step, arg_min(model, struct_pack(x := -accuracy, m := model)) AS best_model, max(accuracy) AS best_accuracy
FROM log GROUP BY 1, 2""",
)
def best_by_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.best_by_accuracy(_log(spark, sf))


@query(
    "run_index",
    f"WITH {LOG_SQL} SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, total_steps, best_step, best_model, best_mse FROM idx",
)
def run_index(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.run_index(_log(spark, sf))


@query(
    "run_comparison",
    f"""WITH {LOG_SQL}, l AS (SELECT DISTINCT run_id FROM log ORDER BY run_id DESC LIMIT 5)
SELECT run_id, """ + ", ".join(
        f"""min(best_mse) FILTER (WHERE step = '{s}') AS "{s}_mse", min(best_model) FILTER (WHERE step = '{s}') AS "{s}_model" """ for s in STEPS
    ) + " FROM steps WHERE run_id IN (SELECT run_id FROM l) GROUP BY run_id",
)
def run_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.compare_runs(_log(spark, sf), STEPS, 5)


@query(
    "best_run",
    f"""WITH {LOG_SQL} SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, total_steps, best_step, best_model, best_mse FROM idx
WHERE best_mse IS NOT NULL ORDER BY best_mse, run_id LIMIT 1""",
)
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.best_run(runlog.run_index(_log(spark, sf)))


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents as files: before, without the longest; after, without short Spanish ones and with one source rewritten."""
    docs = a.table(spark, sf, "documents")
    keys = [F.col("source").alias("category"), F.col("doc_id").cast("string").alias("name")]
    old = docs.filter(F.col("n_chars") <= 5000).select(*keys, F.md5("text").alias("hash"))
    text = F.when(F.col("source") == "src7", F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    new = docs.filter((F.col("lang") != "es") | (F.col("n_chars") > 5000)).select(*keys, F.md5(text).alias("hash"))
    return old, new


SNAPSHOT_SQL = """o AS (SELECT source AS category, CAST(doc_id AS VARCHAR) AS name, md5(text) AS h FROM documents WHERE n_chars <= 5000),
n AS (SELECT source AS category, CAST(doc_id AS VARCHAR) AS name, md5(CASE WHEN source = 'src7' THEN text || chr(10) ELSE text END) AS h FROM documents WHERE lang <> 'es' OR n_chars > 5000),
ch AS (SELECT coalesce(o.category, n.category) AS category, coalesce(o.name, n.name) AS name, o.h AS old_hash, n.h AS new_hash,
  CASE WHEN o.name IS NULL THEN 'new' WHEN n.name IS NULL THEN 'removed' WHEN o.h <> n.h THEN 'modified' END AS change
  FROM o FULL JOIN n ON o.category = n.category AND o.name = n.name)"""


@query("snapshot_diff", f"WITH {SNAPSHOT_SQL} SELECT * FROM ch WHERE change IS NOT NULL")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.detect_changes(*_snapshots(spark, sf))


@query("change_counts", f"WITH {SNAPSHOT_SQL} SELECT change, count(*) AS n FROM ch WHERE change IS NOT NULL GROUP BY change")
def change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.change_counts(incremental.detect_changes(*_snapshots(spark, sf)))


RUNS = 3
RUN_TIME = "2026-04-01 00:00:00"
RUNS_SQL = """m AS (SELECT CAST(year(o_orderdate) % 3 AS BIGINT) AS r, o_orderpriority AS step, o_orderstatus AS model,
  CASE WHEN o_orderstatus <> 'P' THEN round(avg(o_totalprice) / 1000, 3) END AS mse, round(max(o_totalprice) / 1000000, 4) AS r2 FROM orders GROUP BY 1, 2, 3),
s AS (SELECT 'run_' || r AS run_id, step, arg_min(model, struct_pack(e := mse, m := model)) FILTER (WHERE mse IS NOT NULL) AS best_model, min(mse) AS best_mse FROM m GROUP BY 1, 2)"""


def _committed_runs(spark: SparkSession, sf: str) -> str:
    """Three runs, an order year's remainder each, stored one by one; the last is stored wrongly first and then repeated."""
    root = shared_folder(spark, "runs")
    orders = a.table(spark, sf, "orders").withColumn("r", F.year("o_orderdate") % RUNS)
    mse = F.when(F.col("o_orderstatus") != "P", F.round(F.avg("o_totalprice") / 1000, 3)).alias("mse")
    metrics = stored(orders.groupBy("r", F.col("o_orderpriority").alias("step"), F.col("o_orderstatus").alias("model")).agg(mse, F.round(F.max("o_totalprice") / 1000000, 4).alias("r2")), "metrics")
    for r in (*range(RUNS), RUNS - 1):
        log = None
        for step in STEPS:
            rows = runlog.metrics_as_log(metrics.filter((F.col("r") == r) & (F.col("step") == step)), f"run_{r}", RUN_TIME, step)
            log = rows if log is None else log.unionByName(rows)
        wrong = r == RUNS - 1 and len(runs.committed(spark, root)) < RUNS
        runs.commit_run(spark, root, f"run_{r}", log.limit(1) if wrong else log)
    return root


@query(
    "committed_runs",
    f"""WITH {RUNS_SQL} SELECT run_id, '{RUN_TIME}' AS ts, count(*) AS total_steps, arg_min(step, struct_pack(e := best_mse, s := step)) FILTER (WHERE best_mse IS NOT NULL) AS best_step,
  arg_min(best_model, struct_pack(e := best_mse, s := step)) FILTER (WHERE best_mse IS NOT NULL) AS best_model, min(best_mse) AS best_mse FROM s GROUP BY run_id""",
)
def committed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Index of the committed runs."""
    return runlog.run_index(runs.read_log(spark, _committed_runs(spark, sf)))


@query(
    "step_outcomes",
    f"WITH {RUNS_SQL} SELECT CASE WHEN best_mse < 150 THEN 'ok' WHEN best_mse IS NULL THEN 'sem modelo' ELSE 'alto' END AS status, count(*) AS n FROM s GROUP BY 1",
)
def step_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of the committed runs by whether their best model's error is small."""
    steps = runlog.best_per_step(runs.read_log(spark, _committed_runs(spark, sf)))
    status = F.when(F.col("best_mse") < 150, "ok").when(F.col("best_mse").isNull(), "sem modelo").otherwise("alto")
    return runlog.step_outcomes(steps.select("step", status.alias("status")))
