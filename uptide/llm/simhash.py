"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has a bit set where over half of the XXH64 values of its word shingles have it. Equal
fingerprints become one row first, so copies cost nothing more. Distinct fingerprints go into tiles by the population
counts of their four 16-bit lanes. Fingerprints within ``radius`` bits have counts that differ by ``radius`` in sum at
most, so a tile meets only such tiles, once each, and every other tile pair is skipped. Full tiles are split into pieces
of bounded size. A pair of pieces is compared with numpy exclusive-or and bit counts, in blocks, and yields a spanning
forest of its links, never all pairs. Components come from the forest by rounds of joins (label propagation with
pointer jumping); every round is a Spark job whose input is a written checkpoint.

Edge cases: a null, empty or word-less text has fingerprint zero and links like any other; texts with fewer words than a
shingle are one shingle; repeated rows and ids keep their rows; a null id gets its own row and never serves as a
component unless no other id is in it; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from uptide.llm.common import cut, map_batches

SHINGLE = 3
HASH_SEED = 42
RADIUS = 2
#: Most fingerprints in a piece of a tile.
PIECE = 4096
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of one text. bytes.lower() and bytes.split() follow ASCII, as the words are defined."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    view, digest = line, xxhash.xxh64_intdigest
    last = min(shingle, len(words)) - 1
    hashes = np.fromiter((digest(view[a:b], HASH_SEED) for a, b in zip(starts, ends[last:], strict=False)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        block = np.ascontiguousarray(hashes[i : i + (1 << 14)].astype("<u8"))
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(BITS[2 * ones > n].sum(dtype=np.uint64))


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    values = np.fromiter((fingerprint(t) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(values.view(np.int64))], names=["doc_id", "t", "fp"])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, t, fp``: fp is the fingerprint as a signed long, t a hash of the text that tells apart rows of one id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    return map_batches(given, _fingerprints, T.StructType([*given.schema.fields[:2], T.StructField("fp", T.LongType())]))


def neighbour_tiles(radius: int) -> list[int]:
    """Offsets between the codes of tiles that may hold links: lane counts as digits of base 32, later tiles only."""
    steps = [()]
    for _ in range(4):
        steps = [(*s, d) for s in steps for d in range(-radius, radius + 1) if sum(map(abs, s)) + abs(d) <= radius]
    return [o for o in (sum(d << (5 * (3 - i)) for i, d in enumerate(s)) for s in steps) if o > 0]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest among the fingerprints of two pieces (the same array: within it)."""
    same = left is right
    nodes = left if same else np.concatenate([left, right])
    parent = np.arange(len(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    shift = 0 if same else len(left)
    step = max(1, (1 << 18) // max(1, len(right)))
    for a in range(0, len(left), step):
        near = np.bitwise_count(left[a : a + step, None] ^ right[None, :]) <= radius
        for i, j in zip(*np.nonzero(near), strict=True):
            x, y = root(a + int(i)), root(shift + int(j))
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((int(nodes[a + int(i)]), int(nodes[shift + int(j)])))
    return links


def _compare(radius: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        links: list[tuple[int, int]] = []
        for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
            x = np.frombuffer(a, np.uint64)
            links += forest(x, x if b is None else np.frombuffer(b, np.uint64), radius)
        if not links:
            return None
        pairs = np.array(links, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])

    return run


def links(distinct: DataFrame, *, radius: int = RADIUS, piece: int = PIECE) -> DataFrame:
    """``src, dst``: links between distinct fingerprints that connect all that lie within ``radius`` bits.

    ``distinct`` has one column ``fp``. Tiles are looked up by equal codes: the pieces of a tile once at home and once
    for each neighbour, a few dozen copies of 8 bytes a fingerprint.
    """
    lane = lambda i: F.bit_count(F.shiftrightunsigned("fp", 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)))
    coded = distinct.withColumn("tile", lane(0) * (1 << 15) + lane(1) * (1 << 10) + lane(2) * (1 << 5) + lane(3))
    sizes = coded.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / piece).alias("pieces"))

    pieces = cut(
        coded.join(sizes, "tile")
        .withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")))
        .groupBy("tile", "piece")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    schema = T.StructType([T.StructField("tile", T.IntegerType()), T.StructField("piece", T.LongType()), T.StructField("fps", T.BinaryType())])

    def to_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("fps")
        flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
        rows = [flat[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("tile"), batch.column("piece"), pa.array(rows, pa.binary())], names=["tile", "piece", "fps"])

    pieces = map_batches(pieces.select(F.col("tile").cast("int").alias("tile"), "piece", "fps"), to_bytes, schema)
    out = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])
    home = pieces.select("tile", F.col("piece").alias("p"), F.col("fps").alias("right"))
    own = pieces.select("tile", F.col("piece").alias("q"), F.col("fps").alias("left"))
    to = [F.lit(o) for o in neighbour_tiles(radius)]
    guests = own.select(F.explode(F.array(*to)).alias("step"), "tile", "left").select((F.col("tile") + F.col("step")).alias("tile"), F.lit(-1).cast("long").alias("q"), "left")
    met = own.unionByName(guests).join(home, "tile").where(F.col("q") <= F.col("p"))
    pairs = met.select("left", F.when(F.col("q") != F.col("p"), F.col("right")).alias("right"))
    return map_batches(pairs, _compare(radius), out)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable, for every node of an edge but roots; ids are signed longs.

    Alternating large-star and small-star rounds on checkpointed edges until nothing changes; each round is a few
    shuffles of the edges, and the number of rounds grows with the logarithm of the longest chain.
    """
    pairs = cut(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).where("a <> b").distinct())
    if pairs.isEmpty():
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: every larger neighbour joins the node's least neighbour.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours join the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = cut(small.where("a <> b").distinct())
        changed = after.exceptAll(pairs).limit(1).count() or pairs.exceptAll(after).limit(1).count()
        pairs = after
        if not changed:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classified(docs: DataFrame, *, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, t, fp, root, component_id`` per document; root is the component's least fingerprint."""
    fps = cut(fingerprints(docs, id_col=id_col, text_col=text_col))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), radius=radius))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "t", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per document; component_id is the smallest id reachable by links."""
    return classified(docs, **options).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component stays: that of the smallest id, and of the least text hash if an id repeats."""
    rows = classified(docs, id_col=id_col, text_col=text_col, **options)
    counted = rows.groupBy("root", "doc_id", "t").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "t", "n"))
    kept = cut(counted.groupBy("root").agg(best.alias("w")).select(F.col("w.doc_id").alias("id"), F.col("w.t").alias("t"), F.col("w.n").alias("n")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("t"))
    single = whole.join(kept.where("n = 1"), same, "left_semi")
    # Rows that repeat an id and its text are one document.
    repeated = whole.join(kept.where("n > 1"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
