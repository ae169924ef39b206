"""Substring deduplication by sliding sentence spans.

Texts are cut into sentences; every run of ``span`` consecutive sentences is hashed after folding case and white space
(a text with fewer sentences is one run). A character of a script without spaces counts as a word. Runs of fewer than
``min_words`` words are too common to count: with ``every``, as the query has it, such a run is lengthened until it has
the words, and runs of fewer than ``span`` sentences are hashed as well once they have ``long_words`` words; without, they
are left out. A text that has too few words as a whole is one run with ``every``: it can equal another such text only.
The hashes are joined globally: the first occurrence, by document id and place, stays; sentences covered by any
other occurrence are removed. A run that repeats within one document is a repeat like any other.

Copies of a run within a document are combined before the shuffle, the first occurrence is a minimum that
combines in the map tasks; the join that follows broadcasts the few very common ones. Texts are not shuffled
until the removals, by document, are known.

Edge cases: a null or empty text has no sentences and comes back unchanged; repeated rows of one id and text are treated
alike; rows of one id with different texts are documents of their own, in the order of their texts' XXH64; a null id comes
before all others; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from uptide.llm.common import cut, map_batches

SPAN = 3
MIN_WORDS = 12
#: A run of one or two sentences counts from so many words on.
LONG_WORDS = 25
#: Hashes with more than this share of all repeated runs are fewer than 1 / share.
HOT_SHARE = 0.001
#: A sentence ends after .!? and closing marks before white space, after CJK stops and closing marks, or at a line end.
END = re.compile(r"[.!?…][\"'”’)\]]*(?=\s)|[。！？｡][\"'”’)\]」』）】》]*|\n+")
#: Thai, Lao, Myanmar, Khmer, kana and Han, which are written without spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
UNSPACED, WORD = re.compile(f"[{_UNSPACED}]"), re.compile(f"[{_UNSPACED}]|[^\\s{_UNSPACED}]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Sentences as (start, end) with the white space that follows them, so that they cover the text."""
    bounds, at = [], 0
    for m in END.finditer(text):
        end = m.end()
        while end < len(text) and text[end].isspace():
            end += 1
        if end > at and not text[at:end].isspace():
            bounds.append((at, end))
            at = end
    if at < len(text):
        if text[at:].isspace() and bounds:
            bounds[-1] = (bounds[-1][0], len(text))
        else:
            bounds.append((at, len(text)))
    return bounds


def runs(text: str, span: int = SPAN, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS, every: bool = False) -> list[tuple[int, int, int]]:
    """(hash, first sentence, sentences) of each run long enough."""
    folded = [text[a:b].lower().split() for a, b in sentences(text)]
    if not folded:
        return []
    joined, sizes = [" ".join(f) for f in folded], [len(f) for f in folded]
    if UNSPACED.search(text):
        sizes = [len(WORD.findall(j)) for j in joined]
    ends, out = [0], []
    for size in sizes:
        ends.append(ends[-1] + size)
    last = len(folded)
    if every and 0 < ends[-1] < min_words:
        min_words = ends[-1]
    for i in range(last):
        lengths = [n for n in range(1, min(span, last - i + 1)) if ends[i + n] - ends[i] >= long_words] if every else []
        end = last if not i else i + span
        end = max(min(end, i + span), bisect_left(ends, ends[i] + min_words) if every else 0)
        if end <= last and ends[end] - ends[i] >= min_words:
            lengths.append(end - i)
        for n in dict.fromkeys(lengths):
            h = xxhash.xxh64_intdigest(" ".join(joined[i : i + n]).encode("utf-8", "surrogatepass"), 11)
            out.append((h - (1 << 64) if h >= 1 << 63 else h, i, n))
    return out


def span_hashes(docs: DataFrame, span: int, min_words: int, long_words: int, every: bool) -> DataFrame:
    """``doc_id, v, hash, at, n``: every run of every document; ``v`` tells apart texts of one id."""
    numbers = [T.StructField("h", T.ArrayType(T.LongType())), T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([docs.schema["doc_id"], docs.schema["v"], *numbers])

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [runs(t or "", span, min_words, long_words, every) for t in batch.column("text").to_pylist()]
        columns = [pa.array([[x[c] for x in r] for r in rows], pa.list_(t)) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("v"), *columns], names=schema.names)

    exploded = map_batches(docs, hashed, schema).select("doc_id", "v", F.explode(F.arrays_zip("h", "i", "n")).alias("r"))
    return exploded.select("doc_id", "v", F.col("r.h").alias("hash"), F.col("r.i").alias("at"), F.col("r.n").alias("n"))


def repeated_runs(spans: DataFrame) -> DataFrame:
    """The runs that another one of the same hash comes before, by (doc_id, v, at)."""
    place = F.struct("doc_id", "v", "at")
    # First occurrence and count per run; only runs found twice go on.
    ends = spans.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("rows"))
    first = cut(ends.where("first <> last").select("hash", "first", "rows"))
    # A hash with more than this share of the repeated runs is one of 1 / share at most: these are broadcast, and their
    # runs are spread over the other join by a salt that finds nothing there.
    often = (first.agg(F.sum("rows")).first()[0] or 0) * HOT_SHARE
    hot = F.broadcast(first.where(F.col("rows") > often).select("hash", F.col("first").alias("hot")))
    rest = first.where(F.col("rows") <= often).select("hash", F.lit(0).cast("long").alias("salt"), "first")
    salt = F.when(F.col("hot").isNotNull(), F.xxhash64("doc_id", "at").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    met = spans.join(hot, "hash", "left").withColumn("salt", salt).join(rest, ["hash", "salt"], "left")
    found = met.withColumn("first", F.coalesce("hot", "first")).where("first IS NOT NULL")
    return found.where(~F.struct("doc_id", "v", "at").eqNullSafe(F.col("first"))).select("doc_id", "v", "at", "n")


def dedup_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS, every: bool = False) -> DataFrame:
    """``doc_id, n_sentences, removed, kept_text``: removed lists the sentences taken out, by number."""
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("v"), text.alias("text"))
    repeats = repeated_runs(span_hashes(given, span, min_words, long_words, every)).groupBy("doc_id", "v").agg(F.collect_set(F.struct("at", "n")).alias("starts"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.v") == F.col("r.v"))
    joined = given.alias("d").join(repeats.alias("r"), same, "left").select("d.doc_id", "d.text", "r.starts")
    schema = T.StructType(
        [joined.schema["doc_id"], T.StructField("n_sentences", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType())), T.StructField("kept_text", T.StringType())]
    )

    def removed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            parts = sentences(text or "")
            gone = sorted({j for r in starts or () for j in range(r["at"], min(r["at"] + r["n"], len(parts)))})
            out = set(gone)
            rows.append((len(parts), gone, text if not gone else "".join(text[a:b] for j, (a, b) in enumerate(parts) if j not in out)))
        arrays = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    return map_batches(joined, removed, schema)


def span_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_sentences, n_removed, removed, kept_sha256`` per document."""
    out = dedup_spans(docs, **options)
    return out.select("doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"), "removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"), "kept_text")
