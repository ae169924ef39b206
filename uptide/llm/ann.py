"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

Vectors of one direction class: equal vectors become one row with their ids. The tree is fitted on at most ``FIT_ROWS``
distinct vectors (those of the least hashes) and sent to the executors; every row is assigned to a leaf. A query walks
the tree with a priority queue of nodes, nearest first, and visits leaves in that order. How many leaves it visits is
widened until the calibration queries' exact neighbours, found by reading all rows once, are covered to ``RECALL``.
Visits and leaf rows meet in blocks of bounded size by an equal-key join; each pair of blocks is one matrix product.

A vector that a third of the rows share is one class of ids. Of its ids only the ``k + 1`` smallest can be among a
query's k nearest, as ties go to smaller ids, so the others are not carried; that loses nothing.

Edge cases: vectors that are null, zero, hold null or non-finite components, or are not of the most common length (ties:
the shorter) take no part, nor do null ids. Rows repeated with the same id and vector are one candidate. An id with
several vectors is a query by the least of them. With fewer candidates than k all are returned; an empty table gives an
empty result. Very large or small components are scaled by a power of two, which is exact, before norms are taken.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from uptide.llm.common import cut, map_batches

K = 5
QUERY_STEP = 50
FIT_ROWS = 20_000
#: Rows a leaf should hold at the fit, and most leaves (both of the sample, so the tree's size is bounded).
LEAF_ROWS, MAX_LEAVES = 40, 729
LEVELS = 3
CALIBRATION = 128
RECALL = 0.98
ROUNDS = 10
BLOCK = 2048


@dataclass
class Tree:
    """Nodes by number; node 0 is the root. Leaves are nodes without children."""

    centres: np.ndarray
    children: list[list[int]]

    def leaf(self, units: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector, by the nearest child at every level."""
        at = np.zeros(len(units), np.int64)
        open_ = np.arange(len(units))
        while len(open_):
            for node in np.unique(at[open_]):
                if kids := self.children[node]:
                    mine = open_[at[open_] == node]
                    at[mine] = np.array(kids)[np.argmax(units[mine] @ self.centres[kids].T, axis=1)]
            open_ = open_[[bool(self.children[n]) for n in at[open_]]]
        return at

    def visits(self, unit: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in best-bin-first order."""
        heap, found = [(0.0, 0)], []
        while heap and (most is None or len(found) < most):
            _, node = heapq.heappop(heap)
            if kids := self.children[node]:
                for distance, kid in zip(1.0 - self.centres[kids] @ unit, kids, strict=True):
                    heapq.heappush(heap, (float(distance), kid))
            else:
                found.append(node)
        return found


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows as doubles, by a power of two near 1 where squares could overflow or vanish."""
    x = x.astype(np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    odd = (top > 1e120) | (top < 1e-120)
    return np.where(odd, np.ldexp(x, -np.frexp(top)[1]), x)


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out first centres; deterministic."""
    first = [0]
    near = x @ x[0]
    for _ in range(k - 1):
        first.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[first[-1]])
    centres = x[first]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres, np.argmax(x @ centres.T, axis=1)


def fit(x: np.ndarray, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES, levels: int = LEVELS) -> Tree:
    """Tree over unit vectors."""
    branches = max(2, round(min(max_leaves, len(x) / leaf_rows) ** (1 / levels)))
    centres, children = [np.zeros(x.shape[1])], [[]]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, level = todo.pop()
        if level == levels or len(rows) < 2 * branches:
            continue
        found, own = k_means(x[rows], branches)
        for j in range(branches):
            if (own == j).any():
                children[node].append(len(centres))
                centres.append(found[j])
                children.append([])
                todo.append((len(centres) - 1, rows[own == j], level + 1))
        if len(children[node]) < 2:  # equal vectors only
            for _ in children[node]:
                centres.pop(), children.pop(), todo.pop()
            children[node] = []
    return Tree(np.array(centres), children)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def candidates(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """``v, ids``: distinct usable vectors as arrays of doubles, each with its ``k + 1`` smallest ids."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    common = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    usable = usable.where(F.size("v") == (common[0]["n"] if common else 0)).withColumn("h", F.xxhash64("v"))
    # Repeated rows go first. The limit on ranks works before its shuffle: a common vector leaves k + 1 rows per task.
    ranked = usable.select("h", "v", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= k + 1)
    return ranked.groupBy("h", "v").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def queries(vectors: DataFrame, id_col: str, vector_col: str, step: int, dimension: int) -> DataFrame:
    """``qid, q``: rows whose id is divisible by ``step``, usable vectors only."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    mine = vectors.select(F.col(id_col).cast("long").alias("qid"), v.alias("q")).where((F.col("qid") % step == 0) & F.col("q").isNotNull())
    return mine.where(finite & F.exists("q", lambda x: x != 0)).where(F.size("q") == dimension).groupBy("qid").agg(F.min("q").alias("q"))


def nearest(scores: np.ndarray, ids: list[list[int]], qids: list[int], k: int) -> list[tuple[int, int, float]]:
    """(query, id, score) of each query's k best among classes of ids; ties to smaller ids."""
    out = []
    lead = np.array([x[0] for x in ids])
    for row, qid in zip(scores, qids, strict=True):
        if len(row) > k + 1:
            floor = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
            some = np.nonzero(row >= floor)[0]
        else:
            some = np.arange(len(row))
        some = some[np.lexsort((lead[some], -row[some]))][: k + 1]
        pairs = sorted((-row[j], i) for j in some for i in ids[j] if i != qid)
        out += [(qid, i, -s) for s, i in pairs[:k]]
    return out


def cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    q, c = scaled(q), scaled(c)
    return (q @ c.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1))


FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def _found_batch(rows: list[tuple[int, int, float]]) -> pa.RecordBatch | None:
    if not rows:
        return None
    q, i, s = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=FOUND.names)


def brute_force(classes: DataFrame, q: np.ndarray, qids: list[int], k: int = K) -> DataFrame:
    """Exact neighbours of a bounded set of queries: all rows are read once, a few rows per batch remain."""

    def best(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        return _found_batch(nearest(cosines(q, _matrix(batch.column("v"))), batch.column("ids").to_pylist(), qids, k))

    return top(map_batches(classes, best, FOUND), k)


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    query_step: int = QUERY_STEP,
    recall: float = RECALL,
    fit_rows: int = FIT_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found, nearest first."""
    spark = vectors.sparkSession
    classes = cut(candidates(vectors, id_col, vector_col, k))
    sample = classes.orderBy("h", "v").limit(fit_rows).select("v").toPandas()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sample.empty:
        return empty
    x = unit_rows(scaled(np.stack(sample["v"].to_numpy())))
    asked = cut(queries(vectors, id_col, vector_col, query_step, x.shape[1]))
    tree = spark.sparkContext.broadcast(fit(x))

    # Rows to leaves, leaves to blocks.
    schema = T.StructType([T.StructField("leaf", T.LongType()), *classes.select("h", "v", "ids").schema.fields])

    def assigned(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = tree.value.leaf(unit_rows(scaled(_matrix(batch.column("v")))))
        return pa.RecordBatch.from_arrays([pa.array(leaves), *(batch.column(c) for c in ("h", "v", "ids"))], names=schema.names)

    placed = cut(map_batches(classes.select("h", "v", "ids"), assigned, schema))
    visits = _calibrated(placed, asked, tree, k, recall)
    blocks = _blocks(placed.select("leaf", "h", F.struct("v", "ids").alias("x")), block)

    # Queries to the leaves that they visit.
    to = T.StructType([T.StructField("qid", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType())), T.StructField("leaves", T.ArrayType(T.LongType()))])

    def walked(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = [tree.value.visits(u, visits) for u in unit_rows(scaled(_matrix(batch.column("q"))))]
        return pa.RecordBatch.from_arrays([batch.column("qid"), batch.column("q"), pa.array(leaves, pa.list_(pa.int64()))], names=to.names)

    walks = map_batches(asked, walked, to).select("qid", "q", F.explode("leaves").alias("leaf"))
    asking = _blocks(walks.select("leaf", F.xxhash64("qid").alias("h"), F.struct("qid", "q").alias("x")), block).withColumnRenamed("xs", "qs")

    def met(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for i in range(batch.num_rows):
            c, q = batch.column("xs")[i].values, batch.column("qs")[i].values
            scores = cosines(_matrix(q.field("q")), _matrix(c.field("v")))
            rows += nearest(scores, c.field("ids").to_pylist(), q.field("qid").to_pylist(), k)
        return _found_batch(rows)

    pairs = asking.select("leaf", "qs").join(blocks.select("leaf", "xs"), "leaf").select("xs", "qs")
    return top(map_batches(pairs, met, FOUND), k).select("query_id", "rank", "vec_id", "score")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """``leaf, xs``: the rows of each leaf in arrays of about ``block`` at most."""
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).alias("n"))
    return rows.join(sizes, "leaf").groupBy("leaf", F.pmod("h", F.col("n")).alias("b")).agg(F.collect_list("x").alias("xs"))


def _calibrated(placed: DataFrame, asked: DataFrame, tree, k: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the exact neighbours of the calibration queries lies in them."""
    some = asked.orderBy(F.xxhash64("qid"), "qid").limit(CALIBRATION).toPandas()
    if some.empty:
        return 1
    q, qids = np.stack(some["q"].to_numpy()), [int(i) for i in some["qid"]]
    exact = brute_force(placed, q, qids, k)
    leaf_of = placed.select("leaf", F.explode("ids").alias("vec_id"))
    # An id may stand in several classes; its leaf is then that of any of them.
    where = exact.join(leaf_of, "vec_id").groupBy("query_id", "vec_id").agg(F.min("leaf").alias("leaf")).toPandas()
    order = {i: {leaf: n + 1 for n, leaf in enumerate(tree.value.visits(u))} for i, u in zip(qids, unit_rows(scaled(q)), strict=True)}
    ranks = sorted(order[int(r.query_id)][int(r.leaf)] for r in where.itertuples())
    return ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)] if ranks else 1
