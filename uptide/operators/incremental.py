"""Changed-input detection by comparing file snapshots (category, name, hash)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Kinds of change.
NEW, MODIFIED, REMOVED = "new", "modified", "removed"


def detect_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """New, modified (hash differs) and removed entries between two snapshots."""
    keys = ["category", "name"]
    o = old.select(*keys, F.col("hash").alias("old_hash"), F.lit(1).alias("in_old"))
    n = new.select(*keys, F.col("hash").alias("new_hash"), F.lit(1).alias("in_new"))
    change = (
        F.when(F.col("in_old").isNull(), NEW)
        .when(F.col("in_new").isNull(), REMOVED)
        .when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), MODIFIED)
    )
    return (
        o.join(n, keys, "full")
        .select(*keys, "old_hash", "new_hash", change.alias("change"))
        .filter(F.col("change").isNotNull())
    )


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def has_changes(changes: DataFrame) -> bool:
    """Whether anything changed; stops at the first difference found."""
    return not changes.isEmpty()
