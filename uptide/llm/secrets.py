"""Secret scan with corpus-wide ownership frequency.

Every text is searched for fixed patterns (base spans) and for generic key-like tokens (candidates). The values of both
are hashed and counted over the corpus by distinct repositories, owners and texts. Copies of a text in other sources add
nothing: each text counts for one owner, and if one owner holds all texts of a value, it is the only one. A generic value
of more than ``max_owners`` owners or ``max_repositories`` repositories is a copied example; a value of a fixed pattern is
one only beyond ``wide_owners`` or ``wide_repositories``, and any value beyond ``max_texts`` texts. All others look live.
Base spans always stay; a generic candidate becomes a span of kind ``generic`` only if it looks live.

Copies of a value within a document count once, copies within a repository or owner are combined before the shuffle;
a value that a third of the corpus holds is a counter, never a gathered group.

Edge cases: a null text is empty; a null owner or repository counts as one owner or repository of its own; repeated rows
are documents of their own with the same result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from uptide.llm.common import Spans, cut, either_case, map_batches

#: Fixed by the contract: base kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token")
ASSIGN = re.compile(
    "(" + "|".join(map(either_case, KEYWORDS)) + "|" + either_case("api") + "_?" + either_case("key") + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

ADDED = "generic"
ORDER = {k: i for i, k in enumerate((*KINDS, ADDED))}

#: Generic candidates: least length, least entropy in bits a character.
MIN_GENERIC = 20
MIN_ENTROPY = 3.3
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")

#: A generic value is owner-specific up to so many owners and repositories.
MAX_OWNERS = 1
MAX_REPOSITORIES = 4
#: A base value is a wide example only beyond so many owners or repositories.
WIDE_OWNERS = 4
WIDE_REPOSITORIES = 16
#: Any value in more distinct texts than this is a wide example.
MAX_TEXTS = 1000


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns; the value of an assignment is its right side."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "key")):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return found


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))


def generic_candidates(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Key-like runs around digits that no base span touches."""
    found, at, base = [], 0, Spans([(a, b) for _, a, b, _ in taken])
    while m := DIGIT.search(text, at):
        left = m.start()
        while left > at and RUN.match(text[left - 1]):
            left -= 1
        right = RUN.match(text, m.start()).end()
        at = right
        value = text[left:right]
        if len(value) >= MIN_GENERIC and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY:
            if not base.touch(left, right):
                found.append((ADDED, left, right, value))
    return found


SCAN = T.StructType(
    [
        T.StructField("__row", T.LongType()),
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("hashes", T.ArrayType(T.LongType())),
    ]
)


def _signed(value: str) -> int:
    h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 7)
    return h - (1 << 64) if h >= 1 << 63 else h


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for text in batch.column("text").to_pylist():
        text = text or ""
        base = base_spans(text)
        rows.append(base + generic_candidates(text, base))
    texts = pa.array([[k for k, *_ in r] for r in rows], pa.list_(pa.string()))
    numbers = [pa.array([[f(s) for s in r] for r in rows], pa.list_(pa.int64())) for f in (lambda s: s[1], lambda s: s[2], lambda s: _signed(s[3]))]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in ("doc_id", "owner", "repository", "text_key")), texts, *numbers],
        names=["doc_id", "owner", "repository", "text_key", "kinds", "starts", "ends", "hashes"],
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per document with its base spans and generic candidates; written once, it is small."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in repository_cols])).alias("repository"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )
    head = [f for f in given.schema.fields if f.name != "text"]
    return cut(map_batches(given, _scan, T.StructType([*head, *SCAN.fields[1:]])))


def ownership(scanned: DataFrame) -> DataFrame:
    """Per value hash: owners, repositories, distinct texts and documents that hold it.

    Group-bys on keys with the text's hash before those without; all combine in the map tasks.
    """
    held = (
        scanned.select("owner", "repository", "text_key", F.explode(F.array_distinct("hashes")).alias("hash"))
        .groupBy("hash", "owner", "repository", "text_key")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    # Each text counts where it stands first; one owner is enough for a value if it has all of its texts.
    placed = held.groupBy("hash", "text_key").agg(F.min(F.struct("owner", "repository")).alias("o"), F.sum("documents").alias("documents"))
    counts = (
        placed.groupBy("hash", "o")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("documents").alias("documents"))
        .groupBy("hash", F.col("o.owner").alias("owner"))
        .agg(F.count(F.lit(1)).alias("repositories"), F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    )
    most = held.groupBy("hash", "owner", "text_key").agg(F.count(F.lit(1)).alias("n")).groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.max("n").alias("most"))
    owners = F.when(F.col("most") == F.col("texts"), F.lit(1).cast("long")).otherwise(F.col("owners"))
    return counts.join(most, "hash").select("hash", owners.alias("owners"), "repositories", "texts", "documents")


def find_secrets(
    docs: DataFrame,
    *,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
    wide_owners: int = WIDE_OWNERS,
    wide_repositories: int = WIDE_REPOSITORIES,
    max_texts: int = MAX_TEXTS,
    **columns,
) -> DataFrame:
    """``doc_id, text_key, found``: spans (kind, start, end, owners, repositories, texts, documents, live) of each document."""
    scanned = scan(docs, **columns)
    counts = ownership(scanned)
    span = F.struct(F.col("s.kinds").alias("kind"), F.col("s.starts").alias("start"), F.col("s.ends").alias("end"), "owners", "repositories", "texts", "documents", "live")
    added = F.col("s.kinds") == ADDED
    few_owners = F.col("owners") <= F.when(added, max_owners).otherwise(wide_owners)
    few_repositories = F.col("repositories") <= F.when(added, max_repositories).otherwise(wide_repositories)
    judged = (
        scanned.where(F.size("hashes") > 0)
        .select("doc_id", "text_key", F.explode(F.arrays_zip("kinds", "starts", "ends", "hashes")).alias("s"))
        .withColumn("hash", F.col("s.hashes"))
        .join(counts, "hash")
        .withColumn("live", few_owners & few_repositories & (F.col("texts") <= max_texts))
        .where(~added | F.col("live"))
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(span)).alias("found"))
    )
    left, right = scanned.select("doc_id", "text_key").alias("l"), judged.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_key") == F.col("r.text_key"))
    empty = F.array().cast(judged.schema["found"].dataType)
    return left.join(right, same, "left").select("l.doc_id", "l.text_key", F.coalesce("r.found", empty).alias("found"))


def _spans_column(found: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in sorted(ORDER, key=ORDER.__getitem__)])
    placed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(placed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, **columns) -> DataFrame:
    """The contract's row per document; ``n_live`` counts spans that look live."""
    found = F.col("found")
    kinds = F.transform(found, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == k)).cast("long").alias(f"n_{k}") for k in KINDS]  # noqa: B023 - used at once
    base = F.filter(found, lambda s: s["kind"] != ADDED)
    return find_secrets(docs, **columns).select(
        "doc_id", *counts, F.size(F.filter(found, lambda s: s["live"])).cast("long").alias("n_live"), F.sha2(_spans_column(base), 256).alias("base_sha256"), _spans_column(found).alias("spans")
    )


def _marked(text: str | None, starts, ends, mark: str) -> str | None:
    if text is None or starts is None:
        return text
    out, at = [], 0
    for a, b in sorted(zip(starts, ends, strict=True)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_live(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]", **columns) -> DataFrame:
    """The documents with every live-looking span replaced by ``mark``; all rows and columns stay.

    Only documents that hold one are looked up, by id and text.
    """
    id_col = columns.get("id_col", "doc_id")
    found = find_secrets(docs, text_col=text_col, **columns)
    live = found.withColumn("live", F.filter("found", lambda s: s["live"])).where(F.size("live") > 0).select("doc_id", "text_key", F.col("live.start").alias("starts"), F.col("live.end").alias("ends"))
    live = live.dropDuplicates(["doc_id", "text_key"])

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([_marked(t, a, b, mark) for t, a, b in zip(texts, starts, ends, strict=True)], dtype=object)

    key = F.xxhash64(F.coalesce(F.col(f"d.{text_col}").cast("string"), F.lit("")))
    joined = docs.alias("d").join(live.alias("v"), F.col(f"d.{id_col}").eqNullSafe(F.col("v.doc_id")) & (key == F.col("v.text_key")), "left")
    changed = F.when(F.col("v.starts").isNotNull(), replaced(F.col(f"d.{text_col}"), F.col("v.starts"), F.col("v.ends"))).otherwise(F.col(f"d.{text_col}"))
    return joined.select(*[changed.alias(c) if c == text_col else F.col(f"d.`{c}`").alias(c) for c in docs.columns])
