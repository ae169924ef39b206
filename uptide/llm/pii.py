"""Personal data by fixed patterns and a semi-Markov conditional random field.

Base spans come from the fixed patterns. Around digits and address marks a text is cut into zones of words; over each
zone the field scores whole segments: a segment of up to ``MAX_WORDS`` words gets a kind (email, ip, card, phone, or
none, for single words) and a score from features of the whole span (its shape, digit groups and separators, check
digit, number range, neighbours) plus one for the kinds of neighbouring segments. Bounded-entity dynamic programming picks
boundaries and kinds together. Segments of a kind that no base span touches become added spans, if their posterior
probability by the forward-backward sums reaches ``LEAST``.

Training is by maximum likelihood on zones around base spans of a bounded sample of documents (``MAX_ZONES``), on the
same zones rewritten (spaced or bracketed address marks, other separators, missing plus sign), and on spoilt ones
(wrong check digit, numbers over 255, too few digits, versions and dates), whose spans are none. No label table is used.

Zones depend on the text around them only, and a zone longer than ``ZONE_WORDS`` words is solved in one pass like any
other; work grows linearly. Edge cases: a null text is empty; repeated rows keep their rows; with no base span in the
sample the seed examples below still train the field; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from uptide.llm.common import Spans, cut, map_batches, spans_text

#: Fixed by the contract: base kinds in order and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

ORDER = {k: i for i, k in enumerate(KINDS)}
NONE = len(KINDS)
MAX_WORDS = 9
CONTEXT = 2
ZONE_WORDS = 64
#: Most documents and zones that training reads.
MAX_DOCUMENTS, MAX_ZONES = 20_000, 240
EPOCHS = 12
LEAST = 0.9

TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]|\sat\s(?=\s*\S+\s+dot\s|\s*\S+\s*[\[(]dot|\s*[^\s.]+\.[^\W_])", re.I)
WORD = re.compile(r"\S+")
ACTIVE = re.compile(r"[0-9@]|^[\[(]?(?:at|dot)[\])]?$", re.I)
EDGE = ".,;:!?\"'“”‘’"

#: Seed zones: kind spans marked by braces. They teach forms that a sample may lack.
SEEDS = (
    "write to {email:anna.k@post.example.org} today",
    "write to {email:anna.k at post.example.org} today",
    "write to {email:anna.k (at) post.example.org} today",
    "mail {email:bob [at] mail [dot] net} soon",
    "mail {email:bob at mail dot net} soon",
    "server {ip:10.20.30.40} down",
    "server {ip:10 . 20 . 30 . 40} down",
    "server {ip:10[.]20[.]30[.]40} down",
    "card {card:4539 1488 0343 6467} used",
    "card {card:4539.1488.0343.6467} used",
    "card {card:4539/1488/0343/6467} used",
    "call {phone:+1 (366) 555-9807} now",
    "call {phone:(366) 555-9807} now",
    "call {phone:366-555-9807} now",
    "call {phone:001 366 555 9807} now",
    "version 10.20.30 out",
    "number 300.400.500.600 is no host",
    "order 4539148803436468 shipped",
    "on 2021-03-04 at 10:20 there",
    "about 12 of 300 people at 5 dot points",
    "code 12345678 and 87654321 seen",
    "page 12 at line 40",
    "sum 1 234 567 of 89",
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, each kind leftmost and without overlaps."""
    found, at, low = [], 0, 0
    while (at := text.find("@", at)) >= 0:
        left = at
        while left > low and text[left - 1] in LOCAL_CHARS:
            left -= 1
        m = DOMAIN.match(text, at) if left < at else None
        if m:
            found.append(("email", left, m.end()))
            low = at = m.end()
        else:
            at += 1
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and luhn(d):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return found


# Zones and segments ----------------------------------------------------------------------------------------------------


def zones(text: str) -> list[list[tuple[int, int]]]:
    """Word spans of each zone: the words around triggers; zones that touch are one."""
    out: list[list[tuple[int, int]]] = []
    at = 0
    while m := TRIGGER.search(text, at):
        start = m.start()
        for _ in range(CONTEXT + 1):  # back over words
            while start > at and text[start - 1].isspace():
                start -= 1
            while start > at and not text[start - 1].isspace():
                start -= 1
        words, quiet, pos = [], 0, start
        while w := WORD.search(text, pos):
            words.append(w.span())
            pos = w.end()
            if w.start() > m.start():
                quiet = 0 if ACTIVE.search(w[0]) else quiet + 1
                if quiet > CONTEXT:
                    break
        out.append(words)
        at = max(pos, m.end())
    return [z for z in out if z]


def segments(words: list[str]) -> list[tuple[int, int]]:
    """Candidate segments (first, last + 1) that can be an entity: active or address words at both ends."""
    active = [bool(ACTIVE.search(w)) for w in words]
    near = [a or (i > 0 and words[i - 1].lower().strip("[]()") in ("at", "dot")) or (i + 1 < len(words) and words[i + 1].lower().strip("[]()") in ("at", "dot")) or w in (".", "-", "/") for i, (w, a) in enumerate(zip(words, active, strict=True))]
    out = []
    for i in range(len(words)):
        if not near[i] or words[i] in (".", "-", "/"):
            continue
        for j in range(i + 1, min(i + MAX_WORDS, len(words)) + 1):
            if not near[j - 1]:
                break
            out.append((i, j))
    return out


def trimmed(words: list[str], i: int, j: int) -> str:
    return " ".join(words[i:j]).strip(EDGE)


def features(words: list[str], i: int, j: int) -> list[str]:
    """Features of a whole segment; every one is combined with its kind by the weights."""
    text = trimmed(words, i, j)
    digits = _digits(text)
    n = len(digits)
    shape = re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 9)), re.sub(r"[A-Za-zÀ-￿]+", "a", text))
    marks = "".join(sorted(set(re.sub(r"[\w\s]", "", text))))
    lower = text.lower()
    address = re.sub(r"\s*[\[(]?\bat\b[\])]?\s*", "@", re.sub(r"\s*[\[(]?\bdot\b[\])]?\s*", ".", lower), count=1)
    groups = re.findall(r"[0-9]+", text)
    letters = any(c.isalpha() for c in text)
    out = [
        "bias",
        f"words={j - i}",
        f"digits={min(n, 20)}",
        f"marks={marks[:6]}",
        f"groups={min(len(groups), 6)}",
        f"letters={letters}",
        f"shape={shape[:24]}",
        f"address={bool(DOMAIN.search(address)) and bool(re.fullmatch(r'[a-z0-9._%+-]+@[a-z0-9-]+(?:[.][a-z0-9-]+)+', address))}",
        f"dotted={len(groups) == 4 and not letters and '.' in text and all(len(g) <= 3 and int(g) <= 255 for g in groups) and re.fullmatch(r'[0-9]+(?:[^0-9]*[.][^0-9]*[0-9]+){3}', text) is not None}",
        f"check={CARD_DIGITS[0] <= n <= CARD_DIGITS[1] and not letters and luhn(digits)}",
        f"callable={PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1] and not letters}/{text[:1] in '+('}/{[len(g) for g in groups][-2:] == [3, 4]}",
        f"before={words[i - 1].lower().strip(EDGE)[:8] if i and not ACTIVE.search(words[i - 1]) and len(words[i - 1]) < 9 else ''}",
        f"next={bool(j < len(words) and ACTIVE.search(words[j]))}/{bool(i and ACTIVE.search(words[i - 1]))}",
    ]
    return out


@dataclass
class Field:
    """Weights by feature and kind, and between the kinds of neighbouring segments (NONE: none; NONE + 1: start)."""

    index: dict[str, int]
    weights: np.ndarray
    between: np.ndarray

    def scores(self, listed: list[list[str]]) -> np.ndarray:
        """(segments x kinds) scores; a feature never seen weighs nothing."""
        return np.array([self.weights[[self.index[f] for f in fs if f in self.index]].sum(axis=0) for fs in listed]).reshape(len(listed), NONE)


@dataclass
class Lattice:
    """Segments of a zone by their end; the first score column set is for kinds, none only for single words."""

    size: int
    spans: list[tuple[int, int]]
    scores: np.ndarray  # spans x NONE
    plain: np.ndarray  # words: score of none

    def sums(self, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward and backward log sums: value[p, kind of the segment that ends at (forward) p]."""
        lows = -1e30
        ahead = np.full((self.size + 1, NONE + 2), lows)
        ahead[0, NONE + 1] = 0.0
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for s, (i, j) in enumerate(self.spans):
            by_end.setdefault(j, []).append(s)
            by_start.setdefault(i, []).append(s)
        for p in range(1, self.size + 1):
            arrive = np.logaddexp.reduce(ahead[p - 1][:, None] + between, axis=0)
            ahead[p, NONE] = arrive[NONE] + self.plain[p - 1]
            if p in by_end:
                rows = by_end[p]
                starts = [self.spans[s][0] for s in rows]
                into = np.logaddexp.reduce(ahead[starts][:, :, None] + between[None], axis=1)[:, :NONE] + self.scores[rows]
                ahead[p, :NONE] = np.logaddexp.reduce(into, axis=0)
        back = np.full((self.size + 1, NONE + 2), lows)
        back[self.size] = 0.0
        for p in range(self.size - 1, -1, -1):
            parts = [between[:, NONE] + self.plain[p] + back[p + 1, NONE]]
            if p in by_start:
                rows = by_start[p]
                ends = [self.spans[s][1] for s in rows]
                parts += [between[:, k] + (self.scores[rows, k] + back[ends, k])[:, None] for k in range(NONE)]
            back[p] = np.logaddexp.reduce(np.vstack(parts), axis=0)
        return ahead, back, float(back[0, NONE + 1])

    def posteriors(self, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Probabilities of (segment, kind), of none per word, expected neighbours, and the log of the sum."""
        ahead, back, total = self.sums(between)
        starts = np.array([i for i, _ in self.spans], int)
        ends = np.array([j for _, j in self.spans], int)
        pair = np.zeros((NONE + 2, NONE + 2))
        own = np.zeros((len(self.spans), NONE))
        if len(self.spans):
            joint = ahead[starts][:, :, None] + between[None, :, :NONE] + (self.scores + back[ends][:, :NONE])[:, None, :] - total
            joint = np.exp(np.minimum(joint, 0.0))
            own = joint.sum(axis=1)
            pair[:, :NONE] += joint.sum(axis=0)
        words = np.arange(self.size)
        joint = np.exp(np.minimum(ahead[words] + between[:, NONE][None] + (self.plain + back[words + 1, NONE])[:, None] - total, 0.0))
        pair[:, NONE] += joint.sum(axis=0)
        return own, joint.sum(axis=1), pair, total

    def best(self, between: np.ndarray) -> list[tuple[int, int, int]]:
        """(first, last + 1, kind) of the best segmentation's entities."""
        value = np.full((self.size + 1, NONE + 2), -1e30)
        value[0, NONE + 1] = 0.0
        came: dict[tuple[int, int], tuple[int, int]] = {}
        by_end: dict[int, list[int]] = {}
        for s, (_, j) in enumerate(self.spans):
            by_end.setdefault(j, []).append(s)
        for p in range(1, self.size + 1):
            step = value[p - 1] + between[:, NONE]
            value[p, NONE] = step.max() + self.plain[p - 1]
            came[p, NONE] = (p - 1, int(step.argmax()))
            for s in by_end.get(p, ()):
                i = self.spans[s][0]
                step = value[i][:, None] + between[:, :NONE]
                top, x = step.argmax(axis=0), step.max(axis=0) + self.scores[s]
                for k in range(NONE):
                    if x[k] > value[p, k]:
                        value[p, k] = x[k]
                        came[p, k] = (i, int(top[k]))
        out, p, k = [], self.size, int(value[self.size].argmax())
        while p:
            i, before = came[p, k]
            if k < NONE:
                out.append((i, p, k))
            p, k = i, before
        return out[::-1]


def lattice(field: Field, words: list[str]) -> Lattice:
    spans = segments(words)
    plain = np.zeros(len(words))
    return Lattice(len(words), spans, field.scores([features(words, i, j) for i, j in spans]), plain)


# Training --------------------------------------------------------------------------------------------------------------


def seed_zone(marked: str) -> tuple[list[str], list[tuple[int, int, int]]]:
    words, gold, at = [], [], 0
    for m in re.finditer(r"\{(\w+):([^}]*)\}", marked):
        words += marked[at : m.start()].split()
        inside = m[2].split()
        gold.append((len(words), len(words) + len(inside), KINDS.index(m[1])))
        words += inside
        at = m.end()
    return words + marked[at:].split(), gold


def rewritten(words: list[str], gold: list[tuple[int, int, int]], turn: int) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """The zone with its first entity in another form, and spoilt; forms rotate with ``turn``."""
    i, j, k = gold[0]
    text = " ".join(words[i:j]).strip(EDGE)
    d = _digits(text)
    if KINDS[k] == "email":
        forms, bad = [text.replace("@", x) for x in (" at ", " (at) ", " [at] ")] + [text.replace("@", " at ").replace(".", " dot ")], text.replace("@", " and ")
    elif KINDS[k] == "ip":
        forms, bad = [text.replace(".", x) for x in ("[.]", " . ", "(.)")], ".".join(str(300 + int(x[-3:])) for x in text.split("."))
    elif KINDS[k] == "card":
        forms = [x.join(d[a : a + 4] for a in range(0, len(d), 4)) for x in (".", "/", " - ")]
        bad = d[:-1] + str((int(d[-1]) + 3) % 10)
    else:
        local = d[-10:]
        forms, bad = [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"00{d[:-10] or '1'} {local[:3]} {local[3:6]} {local[6:]}"], local[:7]
    other = forms[turn % len(forms)].split()
    rest = [(a + len(other) - (j - i), b + len(other) - (j - i), x) for a, b, x in gold[1:]]
    spoilt = bad.split()
    rest_bad = [(a + len(spoilt) - (j - i), b + len(spoilt) - (j - i), x) for a, b, x in gold[1:]]
    return [(words[:i] + other + words[j:], [(i, i + len(other), k), *rest]), (words[:i] + spoilt + words[j:], rest_bad)]


def fit(examples: list[tuple[list[str], list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5, ridge: float = 0.002) -> Field:
    """Maximum likelihood by AdaGrad over zones; gradients are observed minus expected counts."""
    ready = []
    index: dict[str, int] = {}
    for words, gold in examples:
        spans = segments(words)
        if not set((i, j) for i, j, _ in gold) <= set(spans):
            continue
        ids = [np.array([index.setdefault(f, len(index)) for f in features(words, i, j)]) for i, j in spans]
        ready.append((len(words), spans, ids, gold))
    weights, between = np.zeros((max(1, len(index)), NONE)), np.zeros((NONE + 2, NONE + 2))
    seen_w, seen_b = np.full_like(weights, 1e-2), np.full_like(between, 1e-2)
    for epoch in range(epochs):
        for turn in range(len(ready)):
            size, spans, ids, gold = ready[(turn * 7 + epoch) % len(ready)] if len(ready) % 7 else ready[turn]
            scores = np.array([weights[x].sum(axis=0) for x in ids]).reshape(len(ids), NONE)
            own, _, pair, _ = Lattice(size, spans, scores, np.zeros(size)).posteriors(between)
            delta = -own
            kinds = {(i, j): k for i, j, k in gold}
            for s, span in enumerate(spans):
                if span in kinds:
                    delta[s, kinds[span]] += 1.0
            seen = np.zeros_like(between)
            before, p = NONE + 1, 0
            starts = {i: (j, k) for i, j, k in gold}
            while p < size:
                p, k = starts.get(p, (p + 1, NONE))
                seen[before, k] += 1.0
                before = k
            gradient = np.zeros_like(weights)
            for x, row in zip(ids, delta, strict=True):
                gradient[x] += row
            rows = np.unique(np.concatenate(ids)) if ids else np.zeros(0, int)
            g = gradient[rows] - ridge * weights[rows]
            seen_w[rows] += g**2
            weights[rows] += rate * g / np.sqrt(seen_w[rows])
            g = seen - pair - ridge * between
            seen_b += g**2
            between += rate * g / np.sqrt(seen_b)
    return Field(index, weights, between)


def example_zones(text: str) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """Zones with the base spans that fill whole words; of overlapping ones the longest."""
    base = sorted(base_spans(text), key=lambda s: (s[1] - s[2], s[1]))
    near, out = Spans([(a, b) for _, a, b in base]), []
    for zone in zones(text):
        if not zone or len(zone) > ZONE_WORDS:
            continue
        gold, taken = [], []
        for kind, a, b in (base[n] for n in sorted(near.touching(zone[0][0], zone[-1][1]))):
            inside = [n for n, (x, y) in enumerate(zone) if x < b and a < y]
            if inside and zone[inside[0]][0] <= a and b <= zone[inside[-1]][1] and not any(x < b and a < y for x, y in taken):
                if text[zone[inside[0]][0] : zone[inside[-1]][1]].strip(EDGE) == text[a:b].strip(EDGE):
                    gold.append((inside[0], inside[-1] + 1, ORDER[kind]))
                    taken.append((a, b))
        out.append(([text[x:y] for x, y in zone], sorted(gold)))
    return out


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_documents: int = MAX_DOCUMENTS, max_zones: int = MAX_ZONES) -> Field:
    """Fits the field; the driver gets ``max_zones`` zones at most, those of the least hashes of ``max_documents``."""
    text = F.col(text_col).cast("string")
    some = docs.select(F.col(id_col).alias("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).join(some.distinct(), "doc_id", "left_semi").where(F.col("text").rlike("[0-9@]"))
    schema = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("gold", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [z for t in batch.column("text").to_pylist() for z in example_zones(t)]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.list_(pa.string())), pa.array([[list(g) for g in gold] for _, gold in rows], pa.list_(pa.list_(pa.int32())))], names=schema.names)

    zoned = cut(map_batches(given.select("text"), found, schema).distinct().withColumn("kind", F.coalesce(F.try_element_at(F.flatten("gold"), F.lit(3)), F.lit(NONE))))
    part = max(1, max_zones // (NONE + 1))
    rows = []
    for kind in range(NONE + 1):
        rows += zoned.where(F.col("kind") == kind).orderBy(F.xxhash64("words"), "words").limit(part).collect()
    real = [(list(r["words"]), [tuple(g) for g in r["gold"]]) for r in rows]
    examples = [seed_zone(s) for s in SEEDS] * 3 + real
    for turn, (words, gold) in enumerate(real):
        if gold:
            examples += rewritten(words, gold, turn)
    return fit(examples)


# Search ----------------------------------------------------------------------------------------------------------------


def added_spans(field: Field, text: str, base: list[tuple[str, int, int]], least: float = LEAST) -> list[tuple[str, int, int]]:
    """Entities of the best segmentations that no base span touches."""
    known, out = Spans([(a, b) for _, a, b in base]), []
    for zone in zones(text):
        words = [text[a:b] for a, b in zone]
        net = lattice(field, words)
        best = net.best(field.between) if net.spans else []
        fresh = []
        for i, j, k in best:
            a, b = zone[i][0], zone[j - 1][1]
            if known.touch(a, b):
                continue
            while a < b and text[a] in EDGE:
                a += 1
            while b > a and text[b - 1] in EDGE:
                b -= 1
            if a < b:
                fresh.append((i, j, k, a, b))
        if fresh:
            place = {s: n for n, s in enumerate(net.spans)}
            own = net.posteriors(field.between)[0]
            out += [(KINDS[k], a, b) for i, j, k, a, b in fresh if own[place[i, j], k] >= least]
    return out


def find_pii(docs: DataFrame, field: Field, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans as text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([given.schema["doc_id"], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            every = base + added_spans(shared.value, text, base, least)
            rows.append((*(sum(k == kind for k, _, _ in base) for kind in KINDS), hashlib.sha256(spans_text(base, ORDER).encode()).hexdigest(), spans_text(every, ORDER)))
        columns = [pa.array([r[i] for r in rows], pa.int64() if i < NONE else pa.string()) for i in range(NONE + 2)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return map_batches(given, search, schema)


def pii_report(docs: DataFrame, **columns) -> DataFrame:
    return find_pii(docs, train(docs, **columns), **columns)
