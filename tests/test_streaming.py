import datetime
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide.sources.manifest import Manifest
from uptide.streaming import ingest, levels

SCHEMA = "id long, ts timestamp, v long"
KEYS, TOTALS = ["k"], ["n"]


def at(day):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day)


class Table:
    """A stream of files that a test adds one by one."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.files = spark, root, options, 0

    def add(self, *records):
        folder = f"{self.root}/in"
        self.spark.createDataFrame(list(records), SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run(self, **options):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/in")
        options = {"target": f"{self.root}/t", "checkpoint": f"{self.root}/c", "keys": ["id"], "ts": "ts", "poll_seconds": None, **self.options, **options}
        assert ingest.start_ingestion(stream, **options).awaitTermination(180)
        return rows(ingest.read_ingested(self.spark, f"{self.root}/t", self.spark.createDataFrame([], SCHEMA).schema))


def test_first_arrival_stays_whatever_its_month(spark, tmp_path):
    t = Table(spark, str(tmp_path))
    t.add((1, at(50), 1), (2, at(3), 5), (2, at(3), 4), (None, at(1), 7))
    t.add((1, at(0), 2), (3, at(90), 3), (None, at(0), 8))
    first = [(1, at(50), 1), (2, at(3), 4), (3, at(90), 3), (None, at(1), 7)]
    assert t.run() == first
    t.add((3, at(1), 9), (2, at(2), 9), (4, at(400), 6))  # another run looks the keys up in the stored state
    assert t.run() == [*first[:3], (4, at(400), 6), first[3]]


def test_keys_expire(spark, tmp_path):
    t = Table(spark, str(tmp_path), expiry="10 days")
    for record in ((1, at(0), 1), (1, at(5), 2), (2, at(100), 3), (1, at(101), 4), (2, at(103), 5)):
        t.add(record)
        found = t.run()
    assert found == [(1, at(0), 1), (1, at(101), 4), (2, at(100), 3)]


def test_state_lies_in_rocksdb(spark, tmp_path):
    t = Table(spark, str(tmp_path))
    t.add((1, at(0), 1))
    t.run()
    names = [n for _, _, files in os.walk(tmp_path / "c" / "state") for n in files]
    assert any(n.endswith((".changelog", ".zip")) for n in names)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ingest.ROCKSDB


def part_files(root):
    return [n for n in os.listdir(root) if n.startswith("part-")]


def batch(spark, i):
    return spark.createDataFrame([(f"k{i % 3}", 1), ("all", 10)], "k string, n long")


def test_levels_stay_few(spark, tmp_path):
    root = str(tmp_path / "sums")
    for i in range(14):
        levels.add_batch(batch(spark, i), i, root, KEYS, TOTALS, fanout=3)
        if i % 5 == 0:
            levels.add_batch(batch(spark, i), i, root, KEYS, TOTALS, fanout=3)  # delivered again
    found = levels.parts(spark, root)
    assert sorted(p["level"] for p in found) == [0, 0, 1, 2] and sum(h - l + 1 for p in found for l, h in p["batches"]) == 14
    assert rows(levels.read_sums(spark, root, KEYS, TOTALS)) == [("all", 140), ("k0", 5), ("k1", 5), ("k2", 4)]
    assert len(part_files(root)) <= 5 and len(Manifest(spark, root).versions()) == 2


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_merge_that_was_killed_is_resumed(spark, tmp_path, monkeypatch, step):
    root, real, calls = str(tmp_path / "sums"), Manifest.commit, []
    for i in range(2):
        levels.add_batch(batch(spark, i), i, root, KEYS, TOTALS, fanout=3)

    def dies(self, version, entries):
        calls.append(version)
        if len(calls) == step:
            raise KeyboardInterrupt
        real(self, version, entries)

    monkeypatch.setattr(Manifest, "commit", dies)
    try:
        levels.add_batch(batch(spark, 2), 2, root, KEYS, TOTALS, fanout=3)
    except KeyboardInterrupt:
        # before its commit the batch is not there at all, after it the merge changes nothing
        assert dict(rows(levels.read_sums(spark, root, KEYS, TOTALS)))["all"] == (20 if step == 1 else 30)
    monkeypatch.undo()
    for i in (2, 3):
        levels.add_batch(batch(spark, i), i, root, KEYS, TOTALS, fanout=3)
    assert rows(levels.read_sums(spark, root, KEYS, TOTALS)) == [("all", 40), ("k0", 2), ("k1", 1), ("k2", 1)]
    assert [p["level"] for p in levels.parts(spark, root)] == [1, 0] and len(part_files(root)) <= 5


def test_manifest_versions(spark, tmp_path):
    m = Manifest(spark, str(tmp_path / "m"))
    assert m.latest() == (0, [])
    m.commit(1, [{"path": "part-a", "note": "é"}])
    m.commit(2, [])
    assert m.latest() == (2, []) and m.read(1) == [{"path": "part-a", "note": "é"}]
    with pytest.raises(ValueError, match="exists"):
        m.commit(2, [])
