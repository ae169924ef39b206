import os

from pyspark.sql import functions as F

from tests.conftest import rows
from uptide.sources import snapshots


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")



def frozen(spark, pair, root):
    """Snapshots as tables, as a later run finds them."""
    out = []
    for name, df in zip(("files", "buckets"), pair):
        df.write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return tuple(out)


def test_files_are_hashed_by_lines_and_read_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a b.csv", *(f"line {i}" for i in range(3000)))
    write(folder / "b.csv", "x", "y", "y")
    (folder / "c.csv").write_text("")
    (folder / "d.xlsx").write_bytes(bytes(range(256)))
    first = frozen(spark, snapshots.content_snapshot(spark, str(folder)), str(tmp_path / "s1"))
    assert rows(first[0], "name", "n_rows") == [("a b.csv", 3000), ("b.csv", 3), ("d.xlsx", 1)]
    assert first[1].groupBy("file").agg(F.sum("n")).count() == 3

    # same size and time: taken from the last snapshot without reading
    stamp = os.stat(folder / "b.csv").st_mtime_ns
    write(folder / "b.csv", "x", "z", "y")
    os.utime(folder / "b.csv", ns=(stamp, stamp))
    same = snapshots.content_snapshot(spark, str(folder), previous=first)
    assert rows(same[0], "name", "hash") == rows(first[0], "name", "hash")
    assert snapshots.changed_buckets(first, same).isEmpty()

    lines = [f"line {i}" for i in range(3000)]
    lines[7] = "changed"
    write(folder / "a b.csv", *reversed(lines))
    os.remove(folder / "d.xlsx")
    write(folder / "e.csv", "new")
    second = snapshots.content_snapshot(spark, str(folder), previous=first)
    assert rows(snapshots.snapshot_changes(first[0], second[0]), "name", "change") == [("a b.csv", "modified"), ("d.xlsx", "removed"), ("e.csv", "new")]
    by_file = {r["f"].rsplit("/", 1)[-1]: r["n"] for r in snapshots.changed_buckets(first, second).groupBy(F.col("file").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert by_file["a%20b.csv"] in (1, 2) and by_file["d.xlsx"] == 1 and by_file["e.csv"] == 1


def test_order_and_split_do_not_matter(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 7 as string) s", "if(id % 5 = 0, null, id / 3) d", "array(float(id), null) v")
    shuffled = df.orderBy(F.desc("id")).repartition(7)
    hashes = {
        rows(snapshots.file_hashes(snapshots.bucket_digests(d, F.lit("f"), h(d))))[0] for d in (df, shuffled) for h in (snapshots.row_hash, snapshots.portable_row_hash)
    }
    assert len(hashes) == 2 and {h[1] for h in hashes} == {500}
    one = spark.createDataFrame([("a", None), ("", "b")], "x string, y string")
    other = spark.createDataFrame([("a", ""), (None, "b")], "x string, y string")
    for h in (snapshots.row_hash, snapshots.portable_row_hash):
        assert not set(rows(one.select(h(one)))) & set(rows(other.select(h(other))))


def test_changed_rows_reads_changed_buckets_only(spark):
    old = spark.createDataFrame([(i, i % 3) for i in range(200)] + [(5, 2)], "id long, v long")
    new = spark.createDataFrame([(i, 9 if i == 50 else i % 3) for i in range(200) if i != 60] + [(300, 1), (300, 1)], "id long, v long")
    key = F.xxhash64("id")
    pairs = []
    for df in (old, new):
        digests = snapshots.bucket_digests(df, F.lit("t"), snapshots.row_hash(df), 64, key)
        pairs.append((snapshots.file_hashes(digests), digests))
    buckets = snapshots.changed_buckets(*pairs)
    assert buckets.count() <= 4
    found = rows(snapshots.changed_rows(old, new, buckets, key, 64))
    assert found == sorted([(50, 2, "removed", 1), (50, 9, "added", 1), (60, 0, "removed", 1), (5, 2, "removed", 1), (300, 1, "added", 2)], key=lambda r: tuple((v is None, str(v)) for v in r))
