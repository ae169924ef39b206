"""Cleaning: duplicates, NULL imputation, dates, column names and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from uptide.functions.quantiles import with_quantiles
from uptide.functions.scalar import clean_name, parse_timestamp

# Fixed value: fill for a text column without any value.
UNKNOWN_TEXT = "Desconhecido"


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_key_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per combination of the keys that exist, the row that comes first in ``order``.

    NULL keys count as equal. The survivor is the minimum of a struct, so map tasks already
    reduce every group of copies to one row; ``order`` is extended by all other columns to
    make the choice total.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    ranked = [c for c in dict.fromkeys([*order, *df.columns]) if c not in keys]
    if not ranked:
        return df.dropDuplicates(keys)
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__row"))
    return first.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows read, rows kept, rows removed. ``keys=None`` compares whole rows."""
    counted = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("rows_removed"),
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, struct ``m`` with the most frequent value per column (``m0``, ``m1`` ...), smallest on ties.

    Values are counted with a shuffle on (column, value); only counts reach the last step.
    """
    counts = (
        df.select(
            F.inline(
                F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
            )
        )
        .filter(F.col("v").isNotNull())
        .groupBy("c", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.struct(-F.col("n"), F.col("v"))
    picks = [F.min_by("v", F.when(F.col("c") == i, rank)).alias(f"m{i}") for i in range(len(columns))]
    return counts.agg(F.struct(*picks).alias("m"))


def impute_nulls(
    df: DataFrame,
    *,
    numeric: Sequence[str] = (),
    text: Sequence[str] = (),
    empty_numeric: float | None = None,
    source: DataFrame | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Fill NULLs: exact median for ``numeric``, mode for ``text``, taken from ``source`` (default: ``df``).

    ``weight`` names a column of ``source``: how many rows each of its rows stands for, in the medians.

    A numeric column without values gets ``empty_numeric`` (NULL keeps it NULL), a text
    column without values gets ``Desconhecido``. Only the listed columns are touched.
    """
    fills: dict[str, Column] = {}
    filled = df
    if numeric:
        filled = with_quantiles(filled, source or df, numeric, [0.5], "__median", weight)
        for i, c in enumerate(numeric):
            fills[c] = F.coalesce(
                F.col(c).cast("double"), F.col(f"__median.q{i}_0"), F.lit(empty_numeric).cast("double")
            )
    if text:
        filled = filled.select("*", modes(source or df, text).scalar().alias("__mode"))
        for i, c in enumerate(text):
            fills[c] = F.coalesce(F.col(c), F.col(f"__mode.m{i}"), F.lit(UNKNOWN_TEXT))
    return filled.select(*[fills.get(c, F.col(c)).alias(c) for c in df.columns])


def convert_date_columns(df: DataFrame, formats: Sequence[str], marker: str = "data") -> DataFrame:
    """Parse every text column whose name contains ``marker``; unparsable text becomes NULL."""
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and marker in f.name.lower()
    ]
    return df.withColumns({n: parse_timestamp(F.col(n), formats) for n in names})


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def within_period(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= ts <= end``. A date bound means midnight: later rows of the end day fall out."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) <= F.lit(end).cast("timestamp"))
    return df


def with_entity_prefix(df: DataFrame, entity: str, prefix: str) -> DataFrame:
    """Rows of a valid entity, its name trimmed; the prefix is tested on the raw text."""
    return df.filter(F.col(entity).startswith(prefix)).withColumn(entity, F.trim(entity))


def drop_undated(df: DataFrame, ts: str) -> DataFrame:
    return df.dropna(subset=[ts])


def combine_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack sources by column name; columns a source lacks are NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def standardize(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    types: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Project a non-standard schema onto standard names.

    ``mapping`` lists, per standard column, the source columns to try in order: the first
    one present is taken, none present gives the default (NULL when there is none). Text that is
    no value of the standard type becomes NULL.
    """
    defaults = defaults or {}
    columns = []
    for name, candidates in mapping.items():
        present = first_present(df, candidates)
        source = F.col(f"`{present}`") if present else F.lit(defaults.get(name))
        columns.append(source.try_cast(types[name]).alias(name))
    return df.select(*columns)


def first_present(df: DataFrame, candidates: Sequence[str], *, contains: bool = False) -> str | None:
    """First candidate that is a column of ``df``; with ``contains`` the first column holding a candidate's text."""
    for candidate in candidates:
        for column in df.columns:
            if column == candidate or (contains and candidate.lower() in column.lower()):
                return column
    return None


def append_new_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing and incoming rows without exact duplicates."""
    return existing.unionByName(incoming).dropDuplicates()


def presence(entities: DataFrame, records: DataFrame, entity: str, flag: str) -> DataFrame:
    """Entities with a 0/1 ``flag``: whether any record names them. Records are reduced to distinct entities first."""
    seen = records.select(F.col(entity).alias("__seen")).distinct()
    return entities.join(seen, F.col(entity) == F.col("__seen"), "left").select(
        *entities.columns, F.col("__seen").isNotNull().cast("int").alias(flag)
    )


def _marked(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return existing.select(*existing.columns, F.lit(0).alias("__new")).unionByName(
        incoming.select(*incoming.columns, F.lit(1).alias("__new"))
    )


def only_new_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Distinct incoming rows that do not exist yet; NULLs compare as equal.

    One aggregation over both tables instead of an anti join: copies of a row, on either
    side, combine before the shuffle.
    """
    seen = _marked(existing.select(*incoming.columns), incoming).groupBy(*incoming.columns).agg(F.min("__new").alias("__new"))
    return seen.filter(F.col("__new") == 1).drop("__new")


def append_counts(existing: DataFrame, incoming: DataFrame, entity: str) -> DataFrame:
    """Per entity: rows before, incoming rows, rows after the append, new rows.

    The reference point of "new" is the table before the append, as it stands.
    """
    rows = _marked(existing, incoming).groupBy(*existing.columns).agg(
        F.sum(1 - F.col("__new")).alias("__old"), F.sum("__new").alias("__in")
    )
    return rows.groupBy(entity).agg(
        F.sum("__old").alias("rows_before"),
        F.sum("__in").alias("rows_incoming"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.count(F.lit(1)) - F.sum("__old")).alias("rows_new"),
    )
