"""Content snapshots: digests of rows per file and bucket, compared from the top down.

A row's hash deals it to one of ``BUCKETS`` buckets; a bucket's digest is the number of its rows and the sum of their hashes,
so it does not depend on the order or the split of the rows and combines in the map tasks. A file's hash covers its buckets.
Two snapshots are compared file by file; only the buckets of files that differ are compared, and only rows of buckets that
differ are read. Text files of any size are split over tasks; other files are hashed as a whole. Files without a byte are no
files to Spark and not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from uptide.operators.incremental import detect_changes
from uptide.sources.listing import decoded, list_files

BUCKETS = 256
#: Files whose lines are rows.
TEXT_FILES = r"(?i)\.(csv|txt|json|md)$"
BUCKET = T.StructType([T.StructField("file", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("digest", T.DecimalType(38, 0))])


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns; NULL and empty text differ, as do columns swapped."""
    return F.xxhash64(*[F.struct(F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) for c in df.columns])


def portable_row_hash(df: DataFrame, digits: int = 4) -> Column:
    """60-bit hash that any engine can repeat: the head of the MD5 of the columns' texts, each with its length.

    Timestamps count as microseconds, fractions as whole multiples of 10^-digits, lists as their items joined by commas.
    """

    def text(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.ArrayType):
            return F.array_join(F.transform(c, lambda x: F.coalesce(text(x, t.elementType), F.lit(""))), ",")
        if isinstance(t, (T.DoubleType, T.FloatType)):
            return F.floor(c.cast("double") * float(10**digits) + 0.5).cast("string")
        if isinstance(t, T.TimestampNTZType):
            return F.unix_micros(c.cast("timestamp")).cast("string")
        if isinstance(t, T.TimestampType):
            return F.unix_micros(c).cast("string")
        return c.cast("string")

    cells = [text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]
    return F.conv(F.substring(F.md5(F.concat(*marked)), 1, 15), 16, 10).cast("long")


def bucket_digests(rows: DataFrame, file: Column, hash_: Column, buckets: int = BUCKETS, by: Column | None = None) -> DataFrame:
    """``file, bucket, n, digest`` of rows; ``by`` is a number that decides the bucket instead of the row's hash."""
    hashed = rows.select(file.alias("file"), hash_.alias("h"), (hash_ if by is None else by).alias("by"))
    bucket = F.pmod(F.col("by"), F.lit(buckets)).cast("int").alias("bucket")
    return hashed.groupBy("file", bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest"))


def file_hashes(digests: DataFrame) -> DataFrame:
    """``file, n_rows, hash``: MD5 over a file's buckets in order, at most as many as there are buckets."""
    parts = F.array_sort(F.collect_list(F.struct("bucket", "n", "digest")))
    line = F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p["bucket"], p["n"], p["digest"].cast("string"))), ",")
    return digests.groupBy("file").agg(F.sum("n").alias("n_rows"), F.md5(line).alias("hash"))


def content_snapshot(spark: SparkSession, *folders: str, pattern: str = "*", previous: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, buckets) below the folders. Files of equal path, size and time as in ``previous`` are taken from there unread.

    Files: ``category, name, path, size, modified, file, n_rows, hash``.
    """
    listed = list_files(spark, *folders, pattern=pattern, more=[F.col("_metadata.file_path").alias("file")])
    kept = spark.createDataFrame([], T.StructType([*BUCKET.fields]))
    wanted = listed
    if previous:
        same = previous[0].select("file", "size", "modified")
        kept = previous[1].join(listed.join(same, ["file", "size", "modified"], "left_semi").select("file"), "file", "left_semi")
        wanted = listed.join(same, ["file", "size", "modified"], "left_anti")
    # As many paths as files that changed: what the file sources would list as well.
    paths = wanted.select("path", F.col("path").rlike(TEXT_FILES).alias("is_text")).collect()
    found = [kept.select(*BUCKET.names)]
    if texts := sorted(r["path"] for r in paths if r["is_text"]):
        lines = spark.read.text(texts)
        found.append(bucket_digests(lines, F.col("_metadata.file_path"), F.xxhash64("value")))
    if others := sorted(r["path"] for r in paths if not r["is_text"]):
        whole = spark.read.format("binaryFile").load(others)
        found.append(bucket_digests(whole, F.col("_metadata.file_path"), F.xxhash64("content")))
    digests = found[0]
    for more in found[1:]:
        digests = digests.unionByName(more)
    return listed.join(file_hashes(digests), "file"), digests


def changed_buckets(old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``file, bucket`` whose rows differ; buckets of files with equal hashes are not looked at."""
    before, after = old[0].select("file", F.col("hash").alias("was")), new[0].select("file", F.col("hash").alias("is"))
    differ = before.join(after, "file", "full").filter(~F.col("was").eqNullSafe(F.col("is"))).select("file")
    sides = [d.join(differ, "file", "left_semi").select(*BUCKET.names, F.lit(s).alias("side")) for d, s in ((old[1], -1), (new[1], 1))]
    both = sides[0].unionByName(sides[1]).groupBy("file", "bucket")
    return both.agg(F.sum(F.col("n") * F.col("side")).alias("n"), F.sum(F.col("digest") * F.col("side")).alias("d")).filter("n <> 0 OR d <> 0").select("file", "bucket")


def changed_rows(old: DataFrame, new: DataFrame, buckets: DataFrame, hash_: Column, n_buckets: int = BUCKETS) -> DataFrame:
    """Rows that one side has more often: all columns, ``side`` (``removed`` or ``added``) and ``copies``.

    ``buckets`` are the numbers of the buckets to compare, at most ``n_buckets`` of them; other rows end at the scan.
    """
    wanted = [r["bucket"] for r in buckets.select("bucket").distinct().collect()]
    keep = F.pmod(hash_, F.lit(n_buckets)).isin(wanted)
    both = old.filter(keep).withColumn("__side", F.lit(-1)).unionByName(new.filter(keep).withColumn("__side", F.lit(1)))
    counted = both.groupBy(*new.columns).agg(F.sum("__side").alias("__n")).filter("__n <> 0")
    return counted.select(*new.columns, F.when(F.col("__n") > 0, "added").otherwise("removed").alias("side"), F.abs("__n").alias("copies"))


def snapshot_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """New, modified and removed files between two snapshots' files, by path."""
    changes = detect_changes(*[f.select("category", F.col("file").alias("name"), "hash") for f in (old, new)])
    return changes.withColumn("name", decoded(F.element_at(F.split("name", "/"), -1)))
