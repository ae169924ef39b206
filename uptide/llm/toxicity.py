"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings sums, over all common subsequences of ``P`` characters, the product of their weights
``DECAY ** span``, normalised; so an insult with inserted or left-out characters, or with another ending, stays near to
the plain one. A text's strings are its units: words in lower case, look-alike digits folded, marks inside dropped,
spelled-out words ("i d i o t") joined, long words in overlapping windows, each with a mark for its start.

Training: labelled texts (a bounded sample, see ``MAX_TRAIN``; of near copies one each) are bags of units. Spark counts in
how many contexts (the unit before) of toxic and other texts each unit and each word beginning occurs. Units that occur in toxic texts far more often than by chance, alone
or by their beginning, are positives; frequent units of the other texts are negatives, and rounds of training add
those negatives that score highest. Landmarks are drawn from both; a linear squared-hinge machine on the Nyström
features K_nm K_mm^(-1/2) gives the unit's score. As the kernel is a product of explicit subsequence weights, the
machine folds into one table of weights per subsequence, so scoring costs the same for any number of landmarks.
A text's two best units give its score by a logistic fit on the sample.

Scoring reads every whole text; labels, language, source and id are no inputs. Edge cases: null and empty texts get the
score of a text without any unit; repeated rows keep their rows; with no labelled text, or one class only, every score
is the class's smoothed share; an empty table gives an empty result. A doc_id labelled twice counts twice.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from uptide.llm.common import cut, map_batches

P = 3
DECAY = 0.6
MAX_SPAN = 6
ALPHABET = 64
WINDOW, STRIDE = 24, 12
PREFIX = 4

#: Most labelled texts that training reads, those of the least hashes.
MAX_TRAIN = 12_000
MAX_POSITIVES, MAX_NEGATIVES, HARD = 3_000, 4_000, 1_500
LANDMARKS = 256
ROUNDS = 3
#: Least contexts and least standard scores of a positive unit or word beginning.
LEAST_CONTEXTS, LEAST_Z = 4, 5.0
#: Training texts that share one of so many min-hashes of three-word shingles count as copies.
MIN_HASHES = 4
THRESHOLD = 0.7
LOW = -2.0
KEPT_UNITS = 400_000
#: Texts scored together.
AT_ONCE = 256

#: Look-alike characters, fixed values.
FOLDED = str.maketrans("013457@$", "oieastas")
MARKS = re.compile(r"[\W_]+")
SPELLED = re.compile(r"(?:(?<=\s)|^)\S(?:\s\S){3,}(?=\s|$)")

# All subsequence positions within a span, by first position; each with its weight.
STEPS = [((0, *rest), DECAY ** (rest[-1] + 1)) for rest in combinations(range(1, MAX_SPAN), P - 1)]


def units_of(word: str) -> list[str]:
    """Units of one lower-case word."""
    plain = MARKS.sub("", word.translate(FOLDED))
    if len(plain) <= WINDOW:
        return [plain] if plain else []
    return [plain[i : i + WINDOW] for i in range(0, len(plain) - STRIDE, STRIDE)]


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words of a text, spelled-out ones joined as well."""
    low = (text or "").lower()
    found = set(low.split())
    for m in SPELLED.finditer(low):
        found.add("".join(m[0].split()))
    return found


def codes(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes, one row per unit: 1 the start mark, letters, then folded others; 0 beyond the end."""
    size = max(map(len, units)) + 1
    grid = np.zeros((len(units), size), np.int64)
    lengths = np.array([len(u) + 1 for u in units])
    flat = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    coded = np.where((flat >= 97) & (flat <= 122), flat - 95, 28 + flat % (ALPHABET - 28))
    inside = np.arange(size)[None, :] < lengths[:, None]
    inside[:, 0] = False
    grid[inside] = coded
    grid[:, 0] = 1
    return grid, lengths


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(units x places) subsequence codes and weights, summed over equal codes of a unit and scaled to length 1.

    Code 0 with weight 0 fills up.
    """
    grid, lengths = codes(units)
    size = grid.shape[1]
    places, weights = [], []
    for steps, weight in STEPS:
        n = size - steps[-1]
        if n <= 0:
            continue
        code = np.zeros((len(units), n), np.int64)
        for s in steps:
            code = code * ALPHABET + grid[:, s : s + n]
        there = (np.arange(n)[None, :] + steps[-1]) < lengths[:, None]
        places.append(np.where(there, code, 0))
        weights.append(np.where(there, weight, 0.0))
    if not places:
        return np.zeros((len(units), 1), np.int64), np.zeros((len(units), 1))
    code, weight = np.concatenate(places, axis=1), np.concatenate(weights, axis=1)
    order = np.argsort(code, axis=1, kind="stable")
    code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
    last = np.ones(code.shape, bool)
    last[:, :-1] = code[:, 1:] != code[:, :-1]
    total = np.cumsum(weight, axis=1)
    ends = np.where(last, total, 0.0)
    before = np.maximum.accumulate(np.concatenate([np.zeros((len(units), 1)), ends[:, :-1]], axis=1), axis=1)
    weight = np.where(last, total - before, 0.0)
    norm = np.sqrt((weight**2).sum(axis=1, keepdims=True))
    return code, weight / np.maximum(norm, 1e-12)


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised string kernel of each a with each b."""
    code_a, weight_a = subsequences(a)
    code_b, weight_b = subsequences(b)
    out, table = np.empty((len(a), len(b))), np.zeros(ALPHABET**P)
    for j in range(len(b)):
        used = weight_b[j] > 0
        table[code_b[j][used]] = weight_b[j][used]
        out[:, j] = (table[code_a] * weight_a).sum(axis=1)
        table[code_b[j][used]] = 0.0
    return out


@dataclass
class Model:
    """Weights per subsequence, an offset, and the logistic fit over a text's two best units."""

    table: np.ndarray
    offset: float
    logistic: np.ndarray | None
    prior: float

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def unit_scores(self, units: list[str]) -> np.ndarray:
        if not units:
            return np.zeros(0)
        out = np.empty(len(units))
        order = np.argsort([len(u) for u in units], kind="stable")
        for i in range(0, len(units), 4096):
            part = order[i : i + 4096]
            code, weight = subsequences([units[j] for j in part])
            out[part] = (self.table[code] * weight).sum(axis=1) + self.offset
        return np.clip(out, LOW, 2.0)

    def learn_words(self, words: set[str]) -> None:
        """Scores of new words into the table of known ones, which is bounded."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KEPT_UNITS:
            self.known.clear()
            new = list(words)
        parts = [units_of(w) for w in new]
        scores = iter(self.unit_scores([u for p in parts for u in p]))
        for w, p in zip(new, parts, strict=True):
            self.known[w] = float(max((next(scores) for _ in p), default=LOW))

    def best_two(self, words: set[str]) -> tuple[float, float]:
        known = self.known
        top = sorted((known[w] for w in words), reverse=True)[:2]
        return (*top, LOW, LOW)[:2]

    def score(self, pair: tuple[float, float]) -> float:
        if self.logistic is None:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.logistic @ np.array([1.0, *pair]), -30, 30))))


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Primal squared-hinge machine by Newton steps on the active rows."""
    x = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    active = np.ones(len(x), bool)
    for _ in range(steps):
        xa = x[active] * (c * weight[active])[:, None]
        w = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all() or not now.any():
            break
        active = now
    return w[:-1], float(w[-1])


def spread_choice(units: list[str], n: int) -> list[str]:
    """n units at even distances of the sorted list: near duplicates stand together and are thinned out."""
    units = sorted(set(units))
    if len(units) <= n:
        return units
    return [units[int(i)] for i in np.linspace(0, len(units) - 1, n)]


def machine(positives: list[str], negatives: list[str], landmarks: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """Fits the Nyström machine and folds it into a table of subsequence weights."""
    # Inserted characters: each positive also with one more letter inside, evenly over places and letters.
    inserted = [u[: 1 + i % (len(u) - 1)] + chr(97 + (7 * i) % 26) + u[1 + i % (len(u) - 1) :] for i, u in enumerate(sorted(positives)) if 4 < len(u) < WINDOW]
    units = [*positives, *inserted, *negatives]
    y = np.array([1.0] * (len(positives) + len(inserted)) + [-1.0] * len(negatives))
    marks = spread_choice(positives, landmarks // 2) + spread_choice(negatives, landmarks - landmarks // 2)
    value, vector = np.linalg.eigh(kernel(marks, marks))
    strong = value > 1e-6 * value.max()
    root = vector[:, strong] / np.sqrt(value[strong])
    z = kernel(units, marks) @ root
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, offset = squared_hinge(z, y, weight)
    beta = root @ w
    table = np.zeros(ALPHABET**P)
    code, scaled = subsequences(marks)
    np.add.at(table, code.ravel(), (scaled * beta[:, None]).ravel())
    table[0] = 0.0
    return table, offset


def logistic(pairs: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression of the label on the two best units, by Newton steps."""
    x = np.concatenate([np.ones((len(pairs), 1)), pairs], axis=1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    # A better unit never lowers the score.
    if (w[1:] < 0).any() and pairs.any():
        return logistic(pairs * (w[1:] > 0), y, ridge) * np.array([1.0, w[1] > 0, w[2] > 0])
    return w


# Spark ---------------------------------------------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, max_train: int) -> DataFrame:
    """``text, y`` of the training fold: at most ``max_train`` rows, those whose ids have the least hashes."""
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y is not null and doc_id is not null")
    fold = y.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    least = fold.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.join(least, "doc_id").select("text", (F.col("y") > 0).cast("int").alias("y"))


def min_hashes(text: str | None) -> list[int]:
    """The least hash of the text's three-word shingles under ``MIN_HASHES`` seeds."""
    words = (text or "").lower().split()
    shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    h = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in shingles], np.uint64)
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)[:MIN_HASHES]
    return [int(x) for x in (h[:, None] * odd[None, :]).min(axis=0).view(np.int64)]


def without_copies(rows: DataFrame) -> DataFrame:
    """One of the rows that share a text or a min-hash, so that a group of copies doesn't make its words telling."""
    names = [f"m{i}" for i in range(MIN_HASHES)]

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [min_hashes(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("r"), *(pa.array([v[i] for v in values], pa.int64()) for i in range(MIN_HASHES))], names=["r", *names])

    known = rows.select(F.xxhash64("text").alias("r"), "text", "y")
    kept = map_batches(known.select("r", "text"), hashed, T.StructType([T.StructField(n, T.LongType()) for n in ("r", *names)]))
    for n in names:
        kept = kept.groupBy(n).agg(F.min(F.struct("r", *[x for x in names if x != n])).alias("s")).select(n, "s.*")
    return known.join(kept.select("r"), "r", "left_semi").groupBy("r").agg(F.first("text").alias("text"), F.max("y").alias("y")).select("text", "y")


def unit_counts(train: DataFrame) -> DataFrame:
    """``unit, begins, toxic, other``: in how many contexts of each class a unit, or a word beginning, occurs."""
    schema = T.StructType([T.StructField("unit", T.StringType()), T.StructField("before", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("other", T.IntegerType())])

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[str, str], list[int]] = {}
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            units = [u for w in (text or "").lower().split() for u in units_of(w)]
            for key in set(zip(units, ["", *units], strict=False)):
                found.setdefault(key, [0, 0])[1 - y] = 1
        keys = list(found)
        return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(2)), *(pa.array([found[k][i] for k in keys], pa.int32()) for i in range(2))], names=schema.names)

    contexts = map_batches(train, pairs, schema).groupBy("unit", "before").agg(F.max("toxic").alias("toxic"), F.max("other").alias("other"))
    units = contexts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    units = cut(units)
    longer = units.where(F.length("unit") > PREFIX)
    begins = longer.groupBy(F.substring("unit", 1, PREFIX).alias("unit")).agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    return units.withColumn("begins", F.lit(False)).unionByName(begins.withColumn("begins", F.lit(True)))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fits the model; the driver holds bounded lists of units and two numbers per sampled text."""
    rows = cut(training_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_train=max_train).repartition(64))
    rows = cut(without_copies(rows))
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    prior = (toxic + 1) / (toxic + other + 2)
    constant = Model(np.zeros(ALPHABET**P), LOW, None, prior)
    if not toxic or not other:
        return constant
    counts = cut(unit_counts(rows))
    total = counts.where("not begins").agg(F.sum("toxic"), F.sum("other")).first()
    expected = (F.col("toxic") + F.col("other")) * ((total[0] or 0) / max(1, (total[0] or 0) + (total[1] or 0)))
    scored = counts.withColumn("z", (F.col("toxic") - expected) / F.sqrt(expected))
    strong = scored.where((F.col("z") >= LEAST_Z) & (F.col("toxic") >= LEAST_CONTEXTS) & (F.col("toxic") > F.col("other")))
    begins = strong.where("begins").select(F.col("unit").alias("begin"))
    alone = strong.where("not begins")
    # Units of a telling beginning, as long as they are not common in other texts themselves.
    by_begin = scored.where("not begins and toxic > other").join(begins, F.substring("unit", 1, PREFIX) == F.col("begin"), "left_semi")
    found = alone.unionByName(by_begin).groupBy("unit").agg(F.max("z").alias("z"))
    positives = [r["unit"] for r in found.orderBy(F.desc("z"), "unit").limit(MAX_POSITIVES).collect()]
    if not positives:
        return constant
    plain = scored.where(f"not begins and other > 0 and z < {LEAST_Z / 2}")
    frequent = plain.orderBy(F.desc("other"), "unit").limit(MAX_NEGATIVES // 2).collect()
    hashed = plain.orderBy(F.xxhash64("unit"), "unit").limit(MAX_NEGATIVES // 2).collect()
    negatives = sorted({r["unit"] for r in (*frequent, *hashed)} - set(positives))
    model = Model(*machine(positives, negatives), None, prior)
    for _ in range(ROUNDS - 1):
        hard = hardest(plain.select("unit"), model).orderBy(F.desc("s"), "unit").limit(HARD).collect()
        negatives = sorted({*negatives, *(r["unit"] for r in hard if r["s"] > -1.0)} - set(positives))
        model = Model(*machine(positives, negatives), None, prior)
    pairs = bests(rows.select("y", "text"), model).collect()
    model.logistic = logistic(np.array([[r["a"], r["b"]] for r in pairs]), np.array([float(r["y"]) for r in pairs]))
    model.known.clear()
    return model


def hardest(units: DataFrame, model: Model) -> DataFrame:
    shared = units.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("unit", T.StringType()), T.StructField("s", T.DoubleType())])

    def scores(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("unit"), pa.array(shared.value.unit_scores(batch.column("unit").to_pylist()))], names=schema.names)

    return map_batches(units, scores, schema)


def bests(rows: DataFrame, model: Model) -> DataFrame:
    """The other columns of ``rows`` and a, b: the scores of its text's two best units, and their score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in ("a", "b", "score"))])

    def best(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(i, AT_ONCE)
                model = shared.value
                words = [words_of(t) for t in part.column("text").to_pylist()]
                model.learn_words(set().union(*words))
                pairs = [model.best_two(w) for w in words]
                values = [(*p, model.score(p)) for p in pairs]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *(pa.array([v[j] for v in values], pa.float64()) for j in range(3))], names=schema.names)

    return rows.mapInArrow(best, schema)


def score_documents(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return bests(given, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    model = train(docs, labels, **columns)
    return score_documents(docs, model, **{k: v for k, v in columns.items() if k in ("id_col", "text_col")})


def drop_toxic(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD, **columns) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    model = train(docs, labels, text_col=text_col, **columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found: list[float] = []
            for i in range(0, len(texts), AT_ONCE):  # few texts' words in memory, and the known words stay in use
                words = [words_of(t) for t in texts.iloc[i : i + AT_ONCE]]
                shared.value.learn_words(set().union(*words))
                found += [shared.value.score(shared.value.best_two(w)) for w in words]
            yield pd.Series(found, texts.index, float)

    scored = F.pandas_udf(scores, "double")(F.col(text_col).cast("string"))
    return docs.where(scored < threshold)
