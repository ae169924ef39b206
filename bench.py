"""Benchmark: wall-clock seconds per registered query, warm, median of the timed runs; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from uptide.plans.catalog import QUERIES
from uptide.session import local_session

# Headline queries: every family of operators, each reading whole tables.
HEADLINE = (
    "prescription", "operation_windows", "idle_days", "event_history", "recent_history", "consolidated_forecast",
    "union_sources", "dedup_exact", "dedup_keyed", "only_new_rows", "impute_nulls", "period_summary",
    "maintenance_target", "cumulative_features", "wear_features", "one_hot", "entity_day_grain", "preventive_features",
    "entity_statistics", "describe_numeric", "correlation_matrix", "iqr_outliers", "boxplot_by_quartile", "sorted_curve",
    "monthly_by_compound", "compound_rollup", "entity_kpis", "top_compounds_with_others", "monthly_spine",
    "model_ranking", "hash_split", "run_comparison", "snapshot_diff", "stream_monthly",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"))
    timings: dict[str, float] = {}
    for name in names:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
