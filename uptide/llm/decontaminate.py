"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised to words and put into a suffix automaton. The words of each training document stream through it; the
state and the length of the longest match that ends at a word say which windows of items end there: any ``window``
consecutive words of an item, or a whole item of fewer. Words in any occurrence of a window are hit.

Items of many words are cut into parts that overlap by a window less one word, and parts are dealt to automata of about
``WAVE_WORDS`` words, each built in a task and broadcast (some 40 bytes a word), one pass over the documents each. Hits of
further passes join the first by document. The documents themselves are never shuffled.

Edge cases: null texts have no words and neither hit nor are hit; items without words are no windows; rows of one item id are
one item, and a null item id hits words without being listed; repeated rows of documents have equal results; ids of documents
may be null; an empty table of documents gives an empty result, one of items hits nothing.
"""

from __future__ import annotations

import itertools
import pickle
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from uptide.llm.common import cut

WINDOW = 10
#: Words of items in one automaton; a wave's broadcast is some 40 bytes a word.
WAVE_WORDS = 1 << 17
#: Longer items are cut into parts of so many words.
PART_WORDS = 1 << 12
#: Bytes of a text that are cut into words at once.
STRETCH = 1 << 20

# Words are runs of ASCII letters and digits and anything beyond ASCII: bytes of a character all fall on one side.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


# Automaton -------------------------------------------------------------------------------------------------------------


def build_automaton(items: list[tuple[str | None, list[bytes], bool]], window: int = WINDOW) -> dict:
    """Suffix automaton of (id, words, whole item or not) as arrays; state 0 is the empty match."""
    vocabulary: dict[bytes, int] = {}
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def extend(last: int, c: int) -> int:
        made = -1
        q = step[last].get(c)
        if q is None:
            made = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = made
            p = link[p]
        if p < 0:
            return made
        q = step[p][c]
        if length[q] > length[p] + 1:
            clone = len(step)
            step.append(dict(step[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = clone
            while p >= 0 and step[p].get(c) == q:
                step[p][c] = clone
                p = link[p]
            q = clone
        if made < 0:
            return q
        link[made] = q
        return made

    coded = []
    for name, words, whole in items:
        codes, last = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], 0
        for c in codes:
            last = extend(last, c)
        coded.append((name, codes, whole))
    # The state of the last ``window`` words of a match: the shortest on its chain that holds so many.
    top = [0] * len(step)
    for v in sorted(range(1, len(step)), key=length.__getitem__):
        top[v] = v if length[link[v]] < window <= length[v] else top[link[v]] if length[v] >= window else 0
    names: list[str] = []
    number: dict[str, int] = {}
    holders: dict[int, set[int]] = {}
    for name, codes, whole in coded:
        if name is not None and name not in number:
            number[name] = len(names)
            names.append(name)
        v = 0
        for i, c in enumerate(codes):
            v = step[v][c]
            if i + 1 >= window or (whole and i + 1 == len(codes)):
                holders.setdefault(top[v] if i + 1 >= window else v, set()).update([number[name]] if name is not None else [])
    short = sorted(v for v in holders if length[v] < window)
    width = len(vocabulary) + 1
    edges = [(v * width + c, w) for v, out in enumerate(step) for c, w in out.items()]
    shortest = min((length[v] if length[v] < window else window for v in holders), default=0)
    return {
        "words": list(vocabulary), "width": width, "edges": np.array([e for e, _ in edges], np.int64), "to": np.array([w for _, w in edges], np.int32),
        "link": np.array(link, np.int32), "length": np.array(length, np.int32), "top": np.array(top, np.int32), "short": np.array(short, np.int32),
        "holders": {v: np.array(sorted(h), np.int32) for v, h in holders.items()}, "names": names, "shortest": shortest, "window": window,
    }


class Matcher:
    """Streams words through an automaton."""

    def __init__(self, parts: dict):
        self.numbers = {w: i + 1 for i, w in enumerate(parts["words"])}
        self.width, self.window, self.shortest, self.names, self.holders = (parts[c] for c in ("width", "window", "shortest", "names", "holders"))
        self.step = dict(zip(parts["edges"].tolist(), parts["to"].tolist(), strict=True))
        self.link, self.length, self.top = (parts[c].tolist() for c in ("link", "length", "top"))
        # The longest whole item shorter than a window on each state's chain.
        self.whole = [0] * len(self.link)
        marked = set(parts["short"].tolist())
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.whole[v] = v if v in marked else self.whole[self.link[v]]

    def scan(self, numbers: np.ndarray, base: int, spans: list[list[int]], fired: set[int], at_start: tuple[int, int] = (0, 0)) -> tuple[int, int, int]:
        """Words ``numbers`` (0: in no item) from word ``base`` on; adds spans and fired states; returns the last state and
        match length, and the longest match."""
        step, link, length, top, whole, width, window = self.step, self.link, self.length, self.top, self.whole, self.width, self.window
        state, matched = at_start
        longest = 0
        bounds = np.flatnonzero(np.diff(np.concatenate([[0], numbers != 0, [0]])))
        for a, b in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True):
            if a:
                state, matched = 0, 0
            if matched + b - a < self.shortest and b < len(numbers):
                continue
            for i, c in enumerate(numbers[a:b].tolist(), base + a + 1):
                to = step.get(state * width + c)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = step.get(state * width + c)
                if to is None:
                    matched = 0
                    continue
                state = to
                matched += 1
                if matched >= window:
                    fired.add(top[state])
                    from_ = i - matched
                else:
                    v = state if matched >= length[state] else link[state]
                    if not whole[v]:
                        continue
                    fired.add(whole[v])
                    from_ = i - length[whole[v]]
                if matched > longest:
                    longest = matched
                while spans and spans[-1][0] >= from_:
                    spans.pop()
                if spans and spans[-1][1] >= from_:
                    spans[-1][1] = i
                else:
                    spans.append([from_, i])
        if len(numbers) and not numbers[-1]:
            state, matched = 0, 0
        return state, matched, longest

    def match(self, data: bytes) -> tuple[int, list[list[int]], list[str], int]:
        """(words, hit spans of word numbers, ids of items with occurring windows, longest match of windows)."""
        spans: list[list[int]] = []
        fired: set[int] = set()
        n, longest, at, place = 0, 0, 0, (0, 0)
        while at < len(data):
            end = at + STRETCH
            if end < len(data):  # to the end of a word
                stop = _BREAK.search(data, end)
                end = stop.start() if stop else len(data)
            words = words_of(data[at:end])
            numbers = np.fromiter(map(self.numbers.get, words, itertools.repeat(0)), np.int64, len(words))
            *place, far = self.scan(numbers, n, spans, fired, tuple(place))
            longest = max(longest, far)
            n += len(words)
            at = end
        items: set[int] = set()
        for v in fired:
            while v:  # whole items that end a window occur with it
                items.update(self.holders[v].tolist() if v in self.holders else ())
                v = self.whole[self.link[v]]
        return n, spans, [self.names[i] for i in sorted(items)], longest


# Spark ---------------------------------------------------------------------------------------------------------------

SPAN = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end")])
HITS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("v", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", T.IntegerType())]
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def automata(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, wave_words: int = WAVE_WORDS) -> DataFrame:
    """``wave, automaton``: parts of items dealt by hash, one automaton of about ``wave_words`` words a row."""
    given = items.select(F.col(id_col).cast("string").alias("item"), F.encode(F.col(text_col).cast("string"), "utf-8").alias("data")).where("data IS NOT NULL")
    part = T.StructType([T.StructField("item", T.StringType()), T.StructField("part", T.BinaryType()), T.StructField("whole", T.BooleanType()), T.StructField("size", T.IntegerType())])

    def cut_items(batches):
        for batch in batches:
            rows = []
            for name, data in zip(batch.column("item").to_pylist(), batch.column("data").to_pylist(), strict=True):
                words = words_of(data)
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), PART_WORDS):
                    some = words[at : at + PART_WORDS + window - 1]
                    rows.append((name, b" ".join(some), len(some) == len(words), len(some)))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns, (pa.string(), pa.binary(), pa.bool_(), pa.int32()), strict=True)], names=part.names)

    parts = cut(given.mapInArrow(cut_items, part).distinct())
    waves = -(-(parts.agg(F.sum("size")).first()[0] or 0) // wave_words)
    dealt = parts.withColumn("wave", F.pmod(F.xxhash64("item", "part"), F.lit(max(waves, 1))))

    def build(key, table):
        columns = (table.column(c).to_pylist() for c in ("item", "part", "whole"))
        rows = sorted(zip(*columns, strict=True), key=lambda r: (r[0] or "", r[1]))
        made = pickle.dumps(build_automaton([(name, data.split(), whole) for name, data, whole in rows], window))
        return pa.table({"wave": pa.array([key[0].as_py()], pa.int64()), "automaton": pa.array([made], pa.binary())})

    return cut(dealt.groupBy("wave").applyInArrow(build, "wave long, automaton binary"))


def find_overlaps(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, v, n_words, spans, items, longest`` per document; ``v`` is the XXH64 of its text."""
    sc = docs.sparkSession.sparkContext
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("v"), F.encode(F.coalesce(text, F.lit("")), "utf-8").alias("data"))

    def hits(parts, every: bool) -> DataFrame:
        sent = sc.broadcast(parts)

        def run(batches):
            matcher = Matcher(pickle.loads(sent.value))
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    some = batch.slice(at, 1024)
                    found = [matcher.match(data.as_py()) for data in some.column("data")]
                    n, spans, names, longest = zip(*found, strict=True)
                    spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)
                    arrays = [some.column("doc_id"), some.column("v"), pa.array(n, pa.int64()), spans, pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int32())]
                    out = pa.RecordBatch.from_arrays(arrays, names=HITS.names)
                    yield out if every else out.filter(pc.greater(pc.list_value_length(spans), 0))

        return given.mapInArrow(run, HITS)

    made = automata(items, **options)
    waves = [r[0] for r in made.select("wave").orderBy("wave").collect()]

    def automaton(wave: int) -> bytes:
        return made.where(F.col("wave") == wave).first()["automaton"]

    if not waves:
        return hits(pickle.dumps(build_automaton([])), True)
    first = hits(automaton(waves[0]), True)
    if len(waves) == 1:
        return first
    more = hits(automaton(waves[1]), False)
    for wave in waves[2:]:
        more = more.unionByName(hits(automaton(wave), False))
    # As many rows a document as waves that hit it, repeated for repeated rows.
    more = more.drop("n_words").distinct().groupBy("doc_id", "v").agg(F.flatten(F.collect_list("spans")).alias("spans_"), F.flatten(F.collect_list("items")).alias("items_"), F.max("longest").alias("longest_"))
    more = more.withColumnsRenamed({"doc_id": "doc_", "v": "v_"})
    both = first.join(more, F.col("doc_id").eqNullSafe(F.col("doc_")) & F.col("v").eqNullSafe(F.col("v_")), "left")
    return both.select(
        "doc_id",
        "v",
        "n_words",
        F.when(F.col("spans_").isNull(), F.col("spans")).otherwise(_united(F.array_sort(F.concat("spans", "spans_")))).alias("spans"),
        F.when(F.col("items_").isNull(), F.col("items")).otherwise(F.array_distinct(F.concat("items", "items_"))).alias("items"),
        F.greatest("longest", F.coalesce("longest_", F.lit(0))).alias("longest"),
    )


def _united(spans):
    """Sorted spans to maximal ones; touching spans are one."""
    last = lambda out: F.element_at(out, -1)
    grown = lambda out, s: F.concat(
        F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last(out)["start"].alias("start"), F.greatest(last(out)["end"], s["end"]).alias("end")))
    )
    return F.aggregate(spans, F.array().cast(T.ArrayType(SPAN)), lambda out, s: F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["end"] >= s["start"]), grown(out, s)).otherwise(F.concat(out, F.array(s))))


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return find_overlaps(docs, items, **options).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def remove_overlaps(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_share: float = 0.5, **options) -> DataFrame:
    """The documents without their hit words; those with more than ``max_share`` of their words hit go altogether.

    A span goes from its first word's start to its last word's end. All columns stay, and rows without hits are unchanged.
    """
    found = find_overlaps(docs, items, id_col=id_col, text_col=text_col, **options).where(F.size("spans") > 0).drop_duplicates(["doc_id", "v"])
    hit = F.aggregate("spans", F.lit(0), lambda s, x: s + x["end"] - x["start"])
    found = found.select(F.struct("doc_id", "v").alias("key"), F.struct(F.col("spans"), (hit > F.col("n_words") * max_share).alias("drop")).alias("found"))
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    key = F.struct(F.col("row")[id_col].cast("long").alias("doc_id"), F.xxhash64(F.col("row")[text_col].cast("string")).alias("v"))
    joined = whole.join(found, key.eqNullSafe(F.col("key")), "left").where(~F.coalesce(F.col("found.drop"), F.lit(False)))

    @F.pandas_udf(T.StringType())
    def without(texts, spans):
        import pandas as pd

        return pd.Series([cut_words(t, s) for t, s in zip(texts, spans, strict=True)])

    kept = F.when(F.col("found").isNull(), F.col("row")[text_col]).otherwise(without(F.col("row")[text_col], F.col("found.spans")))
    return joined.select(*(kept.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def cut_words(text: str | None, spans) -> str | None:
    """The text without the words of the spans (start, end)."""
    if text is None or spans is None or not len(spans):
        return text
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for s in spans:
        out.append(data[at : places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*out, data[at:]]).decode()


SQL = r"""
WITH word_lists AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
item_lists AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least(10, len(w)) AS k FROM item_lists WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT d.r, d.w, s.k, unnest(range(1, len(d.w) - s.k + 2)) AS i FROM word_lists d, sizes s WHERE len(d.w) >= s.k)),
hits AS (SELECT g.r, g.i, g.k, w.item FROM grams g JOIN windows w ON w.k = g.k AND w.win = g.win),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
items AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM word_lists d LEFT JOIN covered c USING (r) LEFT JOIN items i USING (r)
"""
