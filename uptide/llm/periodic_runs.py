"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q that is at least ``min_length`` and ``min_exponent`` * q long and that no
neighbouring word extends. Texts are handled in stretches of whole documents of about ``STRETCH`` words:

1. Two suffixes at the starts of a run's first periods share some words, five at least for the given lengths. Documents
   without five words that repeat have no run; they are found by hash. The suffixes of the others are sorted by prefix
   doubling from five words; common prefixes of neighbours in that order follow from the ranks of each doubling step.
2. Neighbours are united in order of decreasing common prefix. Each class keeps its positions in order; a smaller class is
   inserted into the larger. Two positions that become neighbours at distance d while their classes unite at a common prefix
   of l words seed a stretch of d + l words with period d. d is its smallest period: with a smaller one a position between
   the two would be in the class already. A seed whose word before breaks the period is a run, as the first two periods of
   every run become neighbours in this way.

Edge cases: a null or empty text has no words; a text is one task's work however long; repeated rows have equal results;
ids may be null; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words whose suffixes are sorted at once, beyond which no further document is added.
STRETCH = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RUNS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def shortest_prefix(min_length: int, min_exponent: int) -> int:
    """Words that the suffixes at the starts of the first two periods share, in the run that makes them share fewest."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def documents_with_repeats(t: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Documents in which ``gram`` words in a row may occur twice: all that do, and others where hashes collide."""
    n = len(t) - gram + 1
    if n < 2:
        return np.zeros(0, np.int64)
    mixed = (t.astype(np.uint64) + np.uint64(1)) * _ODD
    mixed ^= mixed >> np.uint64(29)
    h = doc[:n].astype(np.uint64) * _ODD
    for k in range(gram):
        h = (h ^ mixed[k : k + n]) * _ODD
        h ^= h >> np.uint64(32)
    order = np.argsort(h)
    return np.unique(doc[order[1:][h[order[1:]] == h[order[:-1]]]])


def suffix_neighbours(t: np.ndarray, doc: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours (i, j) in the order of the suffixes that share ``gram`` words or more, and the words they share."""
    n = len(t)
    padded = np.append(t, np.full(gram, t[-1]))
    columns = [doc, *(padded[k : k + n] for k in range(gram))]
    order = np.lexsort(columns[::-1])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in columns])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    same = np.flatnonzero(~new)
    rank = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = group
    alike = np.zeros(n + 1, bool)
    alike[1:-1] = ~new[1:]
    steps, size, open_ = [(gram, rank.copy())], gram, np.flatnonzero(alike[1:] | alike[:-1])
    while len(open_):
        value = rank[order[open_] + size]
        by = np.lexsort((value, group[open_]))
        order[open_] = order[open_][by]
        value, g = value[by], group[open_]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (value[1:] != value[:-1])])
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        rank[order[open_]] = group[open_]
        alike = np.zeros(len(open_) + 1, bool)
        alike[1:-1] = ~new[1:]
        open_ = open_[alike[1:] | alike[:-1]]
        size *= 2
        if len(open_):
            steps.append((size, rank.copy()))
    i, j = order[same - 1], order[same]
    shared, a, b = np.zeros(len(i), np.int64), i.copy(), j.copy()
    for words, ranks in reversed(steps):
        equal = (ranks[a] == ranks[b]) * words
        shared += equal
        a += equal
        b += equal
    for _ in range(gram - 1):  # separators are unique, so that no step leaves the document
        equal = t[a] == t[b]
        shared += equal
        a += equal
        b += equal
    return i, j, shared


def seeds(i: np.ndarray, j: np.ndarray, shared: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, distance, common prefix) of positions that become neighbours near enough for a run."""
    by = np.argsort(-shared, kind="stable")
    classes: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []
    for x, y, l in zip(i[by].tolist(), j[by].tolist(), shared[by].tolist(), strict=True):
        into, other = classes.setdefault(x, [x]), classes.setdefault(y, [y])
        if len(into) < len(other):
            into, other = other, into
        reach = l // (min_exponent - 1)
        last = -1
        for n, p in enumerate(other):
            at = bisect_left(into, p)
            # Positions of one class are neighbours since an earlier union.
            if at and into[at - 1] != last and p - into[at - 1] <= reach:
                found.append((into[at - 1], p - into[at - 1], l))
            if at < len(into) and into[at] - p <= reach and (n + 1 == len(other) or other[n + 1] > into[at]):
                found.append((p, into[at] - p, l))
            into.insert(at, p)
            classes[p] = into
            last = p
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, distance, l = (np.array(c, np.int64) for c in zip(*found, strict=True))
    enough = distance + l >= min_length
    return start[enough], distance[enough], l[enough]


def _joined(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers with a separator of its own before each document and at the end; documents, first places and sizes."""
    sizes = np.array([len(w) for w in documents], np.int64)
    firsts = np.cumsum(sizes + 1) - sizes
    t = np.full(int(sizes.sum()) + len(documents) + 1, -1, np.int64)
    for words, first in zip(documents, firsts.tolist(), strict=True):
        t[first : first + len(words)] = words
    t[firsts - 1] = -2 - np.arange(len(documents))
    return t, np.append(np.repeat(np.arange(len(documents)), sizes + 1), len(documents)), firsts, sizes


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    gram = shortest_prefix(min_length, min_exponent)
    t, doc, firsts, sizes = _joined([np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in documents])
    chosen = documents_with_repeats(t, doc, gram)
    if not len(chosen):
        return out
    t, doc, firsts, _ = _joined([t[a:b] for a, b in zip((firsts[chosen]).tolist(), (firsts + sizes)[chosen].tolist(), strict=True)])
    start, period, shared = seeds(*suffix_neighbours(t, doc, gram), min_length, min_exponent)
    leftmost = t[start - 1] != t[start - 1 + period]
    start, period, shared = start[leftmost], period[leftmost], shared[leftmost]
    by = np.lexsort((period, start))
    own = doc[start[by]]
    for d, s, l, p in zip(own.tolist(), (start[by] - firsts[own]).tolist(), (period + shared)[by].tolist(), period[by].tolist(), strict=True):
        out[chosen[d]].append((s, l, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside any run or in a run's first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def periodic_runs(
    docs: DataFrame, *, prepare: Prepare | None = None, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """``doc_id, runs, collapsed``: the runs of each text and its words without repetition. ``prepare`` may rewrite words."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("data"))
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def result(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(documents, min_length, min_exponent)
        texts = [collapsed(w, r) for w, r in zip(documents, runs, strict=True)]
        found = pa.array([[dict(zip(RUN.names, x, strict=True)) for x in r] for r in runs], run_type)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), found, pa.array(texts, pa.binary()).cast(pa.string())], names=RUNS.names)

    def find(batches):
        for batch in batches:
            ids, documents, size = [], [], 0
            for doc_id, data in zip(batch.column("doc_id"), batch.column("data"), strict=True):
                words = data.as_py().split()  # of bytes: at ASCII white space
                ids.append(doc_id.as_py())
                documents.append(prepare(ids[-1], words) if prepare else words)
                size += len(words)
                if size >= STRETCH:
                    yield result(ids, documents)
                    ids, documents, size = [], [], 0
            if ids:
                yield result(ids, documents)

    return given.mapInArrow(find, RUNS)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the CRC-32 of its decimal id, repeats its words from a place that follows from that number."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // len(period)))[: n - a]


def run_report(docs: DataFrame, **options) -> DataFrame:
    """Per document the number of runs, the longest (ties: least start, then period), and digests of runs and kept words."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    found = periodic_runs(docs, prepare=planted, **options).withColumn("top", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(F.col("top.length") * 1000 / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
