"""Prefix trie of conversations, rolled up by bands of depth.

Every distinct sequence of first turns is a node; its key is two 64-bit exclusive-ors of hashes of (depth, role, text), so
that a conversation's keys are running totals and a conversation that holds a third of all turns is numbered and hashed in
blocks. Nodes come from one aggregation of (conversation, depth) rows, which combines in the map tasks. Subtree sums:

1. Depths are cut into bands of equal height. A node adds its numbers to its ancestors within its band only, found on the
   path of its smallest member, so a row becomes ``height`` rows at most.
2. From the deepest band up, the totals of the band's top nodes, now complete, are added to the ancestors in the band above:
   one round a band. The height is the square root of the greatest shared depth or ``MIN_HEIGHT``, the larger.

Nodes of one member need neither: their subtree is a path with one leaf and nothing to save. So depth counts only as far as
conversations share it.

The ids of the members that end in a node are joined in runs of ``RUN`` consecutive numbers before they meet; the digest
then streams over a node's runs in order, with one run in memory.

Edge cases: null roles and texts are empty; turns are ordered by (turn, role, text), null turns first, so repeated rows are
repeated turns; rows of a null conversation id belong to no conversation and are left out; further columns are not read; an
empty table has no nodes, as its root has no member.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from uptide.llm.common import WORD, cut

MIN_HEIGHT = 8
#: Conversation ids (by number, not by rows) that one joined run may span.
RUN = 1024
#: Parents with more than this share of all nodes as children: fewer than 1 / share, so they can be broadcast.
HOT_SHARE = 0.001
KEY = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns without their texts, in order, and the blocks of conversations they lie in.

    Turns: ``conv_id, block, seq, t1, t2, words``; within a block a conversation's turns have consecutive ``seq``. Blocks:
    ``conv_id, block, first`` (least seq) ``, before`` (turns of the conversation in earlier blocks) ``, n`` (its turns).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    given = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # A range exchange on the whole order splits a hot conversation; the place in the sorted partition is the number.
    placed = cut(
        given.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.spark_partition_id().cast("long").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.xxhash64("role", "text").alias("t1"),
            F.xxhash64(F.lit(1), "role", "text").alias("t2"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
    )
    every = Window.partitionBy("conv_id")
    earlier = every.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("conv_id", "block").agg(F.min("seq").alias("first"), F.count("*").alias("rows"))
    return placed, blocks.select("conv_id", "block", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(every).alias("n"))


def plain_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as they are: ``conv_id, block, depth, t1, t2, words``, and the conversations."""
    placed, blocks = numbered_turns(turns)
    depth = (F.col("seq") - F.col("first") + F.col("before") + 1).alias("depth")
    return placed.join(blocks, ["conv_id", "block"]).select("conv_id", "block", depth, "t1", "t2", "words"), blocks.select("conv_id").distinct()


def grafted_turns(turns: DataFrame, *, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of the family's first conversation, then the own turns after the first h.

    The family's first is ``c - c % family``; h is the CRC-32 of the decimal id modulo ``most``.
    """
    placed, blocks = numbered_turns(turns)
    blocks = cut(blocks)
    convs = blocks.groupBy("conv_id").agg(F.max("n").alias("n"))
    convs = convs.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    grafts = cut(convs.join(sizes, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k")))
    known = placed.join(blocks.join(grafts, "conv_id"), ["conv_id", "block"]).withColumn("pos", F.col("seq") - F.col("first") + F.col("before") + 1)
    own = known.where("pos > h").select("conv_id", "block", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "t1", "t2", "words")
    heads = known.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "words")
    # A family has ``family`` members and a head fewer than ``most`` turns.
    taken = grafts.join(heads, "base").where("pos <= h").select("conv_id", F.lit(-1).cast("long").alias("block"), F.col("pos").alias("depth"), "t1", "t2", "words")
    return own.unionByName(taken), grafts.select("conv_id")


def prefix_rows(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth from 0: ``conv_id, depth, k1, k2`` (node), ``p1, p2`` (parent), ``words``."""
    e1, e2 = (F.xxhash64("depth", c).alias(e) for c, e in (("t1", "e1"), ("t2", "e2")))
    elements = cut(turns.select("conv_id", "block", "depth", e1, e2, "words"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = elements.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    offsets = sums.select("conv_id", "block", *(F.coalesce(F.bit_xor(s).over(earlier), F.lit(0)).alias(o) for s, o in (("s1", "o1"), ("s2", "o2"))))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keys = [F.bit_xor(e).over(inside).bitwiseXOR(F.col(o)).alias(k) for e, o, k in (("e1", "o1", "k1"), ("e2", "o2", "k2"))]
    rows = elements.join(offsets, ["conv_id", "block"]).select("conv_id", "depth", *keys, "e1", "e2", "words")
    rows = rows.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"), "words")
    zero = F.lit(0).cast("long")
    return cut(rows.unionByName(convs.select("conv_id", *(zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "words")))))


def _nodes(rows: DataFrame) -> DataFrame:
    """Nodes with members and children; ``single`` counts children of one member."""
    nodes = cut(rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("p1", "p2", "words"))))
    alone = F.sum((F.col("n_convs") == 1).cast("long")).alias("single")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"), alone)
    return cut(nodes.join(below, KEY, "left").fillna(0, ["n_children", "single"]))


def _parents(nodes: DataFrame) -> DataFrame:
    """``depth, k1, k2, parent_conv_id`` of all nodes but the root; parents of very many children are broadcast."""
    up = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    share = nodes.count() * HOT_SHARE
    hot = F.broadcast(up.where(F.col("n_children") > share).drop("n_children"))
    below, on = nodes.where("depth > 0").select(*KEY, "p1", "p2"), ["depth", "p1", "p2"]
    few = below.join(hot, on, "left_anti").join(up.where(F.col("n_children") <= share).drop("n_children"), on)
    return below.join(hot, on).unionByName(few).select(*KEY, "parent_conv_id")


def _summed(parts: DataFrame, *more: Column) -> DataFrame:
    return parts.groupBy(*KEY).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), *more)


def band_rollup(rows: DataFrame, nodes: DataFrame, height: int | None = None) -> DataFrame:
    """Subtree sums of the nodes with several members: ``depth, k1, k2, saved, leaves``."""
    shared = nodes.where("n_convs > 1")
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    height = height or max(MIN_HEIGHT, math.isqrt(deepest) + 1)
    band = F.floor(F.col("depth") / height).alias("band")
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    leaves = ((F.col("n_children") == 0).cast("long") + F.col("single")).alias("leaves")
    shared = cut(shared.select(*KEY, "conv_id", band, own, leaves))
    tops = shared.where((F.col("depth") > 0) & (F.col("depth") % height == 0)).select("conv_id", (F.col("band") - 1).alias("band"))
    wanted = shared.select("conv_id", "band").unionByName(tops).distinct()
    # At most ``height`` nodes a path.
    paths = rows.where(F.col("depth") <= deepest).select("conv_id", band, F.struct(*KEY).alias("node")).join(wanted, ["conv_id", "band"], "left_semi")
    paths = paths.groupBy("conv_id", "band").agg(F.collect_list("node").alias("path"))
    if deepest >= height:
        paths = cut(paths)

    def to_ancestors(parts: DataFrame) -> DataFrame:
        at = parts.join(paths, ["conv_id", "band"]).select(F.explode(F.filter("path", lambda p: p["depth"] <= F.col("depth"))).alias("up"), "saved", "leaves")
        return _summed(at.select("up.*", "saved", "leaves"))

    inside = to_ancestors(shared)
    if deepest < height:
        return inside
    inside = cut(inside.join(shared.select(*KEY, "conv_id", "band"), KEY))
    done, carried = [], None
    for b in range(deepest // height, -1, -1):
        level = inside.where(F.col("band") == b).drop("band")
        if carried is not None:
            level = _summed(level.unionByName(carried, allowMissingColumns=True), F.max("conv_id").alias("conv_id"))
        level = cut(level)
        done.append(level.drop("conv_id"))
        top = level.where(F.col("depth") == b * height).withColumn("band", F.lit(b - 1).cast("long"))
        carried = to_ancestors(top) if b else None
    out = done[0]
    for level in done[1:]:
        out = out.unionByName(level)
    return out


_ENDS = T.StructType([*(T.StructField(c, T.LongType()) for c in KEY), T.StructField("ends_sha256", T.StringType())])


def _stream_digests(batches):
    """Sorted runs of ids to one digest per node; a digest is all that is held between rows."""
    key, digest, out = None, None, []

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f) for i, f in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=_ENDS.names)

    for batch in batches:
        for *here, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if here != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = here, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) > 10_000:
            yield flush(out)
            out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
    yield flush(out)


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the ids that end in a node."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("node")).select("node.*", "conv_id")
    runs = last.groupBy(*KEY, F.floor(F.col("conv_id") / RUN).alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "ids").mapInArrow(_stream_digests, _ENDS)


def prefix_trie(turns: DataFrame, convs: DataFrame, height: int | None = None) -> DataFrame:
    """Nodes of the trie over ``plain_turns`` or ``grafted_turns``."""
    rows = prefix_rows(turns, convs)
    nodes = _nodes(rows)
    sums = band_rollup(rows, nodes, height)
    out = nodes.join(_parents(nodes), KEY, "left").join(sums, KEY, "left").join(_ends(rows), KEY, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def trie_report(turns: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations."""
    return prefix_trie(*grafted_turns(turns))


# CRC-32 four bits at a time; fixed values of the reflected polynomial EDB88320.
CRC_NIBBLES = "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"


def crc32_sql(text: str) -> str:
    """DuckDB expression of the CRC-32 of an ASCII string expression."""
    nibbles = f"flatten(list_transform(list_filter(string_split({text}, ''), lambda s: s <> ''), lambda s: [ord(s) & 15, ord(s) >> 4]))"
    step = f"lambda c, b: xor(c >> 4, ({CRC_NIBBLES})[(xor(c, b) & 15) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {nibbles}::BIGINT[]), {step}))"


SQL = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT c, max(pos) AS n FROM own GROUP BY c),
convs AS (SELECT s.c, s.c - s.c % 20 AS base, {crc32_sql("CAST(s.c AS VARCHAR)")} % 4 AS h FROM sizes s),
grafts AS (SELECT v.c, v.base, v.h, least(v.h, coalesce(s.n, 0)) AS k FROM convs v LEFT JOIN sizes s ON s.c = v.base),
turns AS (
  SELECT g.c, o.pos AS d, o.r, o.t FROM grafts g JOIN own o ON o.c = g.base AND o.pos <= g.h
  UNION ALL SELECT g.c, g.k + o.pos - g.h, o.r, o.t FROM grafts g JOIN own o ON o.c = g.c AND o.pos > g.h),
steps AS (
  SELECT c, 0 AS d, '' AS t, [] AS p FROM grafts
  UNION ALL SELECT c, d, t, list([r, t]) OVER (PARTITION BY c ORDER BY d) FROM turns),
named AS (SELECT *, min(c) OVER (PARTITION BY p) AS rep, max(d) OVER (PARTITION BY c) AS last FROM steps),
members AS (SELECT *, lag(rep) OVER (PARTITION BY c ORDER BY d) AS parent FROM named),
nodes AS (
  SELECT rep, d, min(parent) AS parent, count(*) AS n, len(regexp_extract_all(min(t), '[^\\x20\\x09-\\x0D]+')) AS words,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = last), '')) AS ends
  FROM members GROUP BY rep, d),
children AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT x.*, coalesce(c.n_children, 0) AS n_children FROM nodes x LEFT JOIN children c USING (rep, d)),
sums AS (
  SELECT a.rep, a.d, sum((x.n_children = 0)::BIGINT) AS n_leaves, sum((x.n - 1) * x.words) AS saved
  FROM full_nodes x JOIN members a ON a.c = x.rep AND a.d <= x.d GROUP BY a.rep, a.d)
SELECT x.rep AS conv_id, x.d::BIGINT AS depth, x.parent AS parent_conv_id, x.n AS n_convs, x.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM full_nodes x JOIN sums s USING (rep, d)
"""
