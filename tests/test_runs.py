import datetime
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide import schema
from uptide.operators import ml, runlog
from uptide.sources import runs
from uptide.sources.manifest import Manifest

NOW = datetime.datetime(2024, 5, 1)


def log(spark, mse, step="train", models=("a", "b")):
    metrics = spark.createDataFrame([(m, float(mse + i), 0.5) for i, m in enumerate(models)], "model string, mse double, r2 double")
    return runlog.metrics_as_log(metrics, "ignored", NOW, step)


@pytest.fixture()
def inputs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in ("a.csv", "b c.csv"):
        (folder / n).write_text("x\n")
    return folder


def test_a_repeated_run_replaces_its_outcome(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert rows(runs.read_log(spark, root)) == [] and runs.read_log(spark, root).schema.names == schema.RUN_LOG.names
    for run_id, mse in (("r1", 3), ("r2", 1), ("r1", 2)):
        runs.commit_run(spark, root, run_id, log(spark, mse), tables={"split": spark.range(mse)})
    index = runlog.run_index(runs.read_log(spark, root))
    assert rows(index, "run_id", "ts", "best_model", "best_mse") == [("r1", NOW, "a", 2.0), ("r2", NOW, "a", 1.0)]
    assert runs.read_table(spark, root, "split", "r1").count() == 2 and runs.read_table(spark, root, "split").count() == 1
    with pytest.raises(ValueError, match="no committed run"):
        runs.read_table(spark, root, "split", "r3")


def test_models_log_and_archive_become_visible_together(spark, tmp_path, inputs, monkeypatch):
    root, archive = str(tmp_path / "runs"), str(tmp_path / "done")
    table = spark.range(50).selectExpr("double(id) x", "2.0D * id + 1 target")
    model = ml.fit("linear_regression", table, ["x"], "target")

    def commit():
        runs.commit_run(spark, root, "r1", log(spark, 1), models={"line": model}, inputs=[str(inputs)], pattern="*.csv", archive=archive)

    # dies before the commit: nothing is there, nothing has moved
    monkeypatch.setattr(Manifest, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        commit()
    monkeypatch.undo()
    assert runs.committed(spark, root) == [] and sorted(os.listdir(inputs)) == ["a.csv", "b c.csv"] and not os.path.exists(archive)
    assert runs.pending_inputs(spark, root, str(inputs)).count() == 2

    # dies between the commit and the moves: the files are processed, and the next run moves them
    monkeypatch.setattr(Manifest, "move", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        commit()
    monkeypatch.undo()
    assert runs.pending_inputs(spark, root, str(inputs)).count() == 0 and len(os.listdir(inputs)) == 2
    assert runs.load_model(spark, root, "line").transform(table).filter(F.abs(F.col("prediction") - F.col("target")) > 1e-6).count() == 0
    assert rows(runs.read_log(spark, root), "run_id", "model") == [("r1", "a"), ("r1", "b")]

    (inputs / "late.csv").write_text("y\n")
    commit()  # the same run again takes what arrived since, and keeps what it had
    assert [n for n in sorted(os.listdir(inputs)) if not n.startswith(".")] == []
    assert [n for n in sorted(os.listdir(archive)) if not n.startswith(".")] == ["a.csv", "b c.csv", "late.csv"]
    assert runs.processed_inputs(spark, root).count() == 3 and len(runs.committed(spark, root)) == 1

    # a file that changes after it was processed is pending again, and does not overwrite the archived one
    (inputs / "a.csv").write_text("changed\n")
    assert rows(runs.pending_inputs(spark, root, str(inputs)), "name") == [("a.csv",)]
    runs.commit_run(spark, root, "r2", log(spark, 5), inputs=[str(inputs)], archive=archive)
    assert len([n for n in os.listdir(archive) if n.startswith("a.csv")]) == 2 and os.path.exists(f"{archive}/a.csv")


def test_steps_by_status(spark):
    results = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("c", "failed")], "step string, status string")
    assert rows(runlog.step_outcomes(results)) == [("failed", 1), ("ok", 2)]
