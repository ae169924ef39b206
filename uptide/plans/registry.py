"""Registry of queries. A query is a function ``(spark, sf_dir) -> DataFrame`` with optional SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def flat(df: DataFrame) -> DataFrame:
    """Plain output types: dates and timestamps as ISO text, decimals as doubles, whole numbers as bigint, flags as 0/1."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: flat(function(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
