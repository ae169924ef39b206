"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks (DataFrame functions only).

A source's target is its weight's share of ``total_share`` times all words, held to ``cap`` times its own size; the
excess goes to the others by weight. The targets' words are dealt to sources word by word; within a source, equal blocks of
words (``block_words``, fewer in sources of few words, one at least) go to groups of shards and then to shards of bounded
size, each time to the highest quotients votes / 1, votes / 3, votes / 5 ... Within a shard documents stand in seeded order and their words form blocks; a quota of q over n blocks takes every
block q // n times and q % n consecutive ones, from a seeded start, once more. No document is taken over ``cap`` times.

Edge cases: a null or word-less text has size 0 and takes 0; the null source is a source of its own, last in order;
repeated rows are documents of their own; an empty table gives an empty table with the same columns. A null id is
ordered as the empty string. Ties in quotients go to more votes, then to the earlier source or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptide.llm.common import WHITE, WORD, cut
from uptide.session import stored

#: Fixed by the contract: weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
CAP = 2

SEED = 20261201
BLOCK_WORDS = 64
#: Blocks are at most this share of a source, so that small sources come near their targets as well.
BLOCK_SHARE = 1024
SHARD_WORDS = 1 << 17
SHARD_ROWS = 1 << 16
#: Shards that are compared with one another at once.
GROUP_SHARDS = 1024


def _digits(key: Column, start: int) -> Column:
    """Eight hexadecimal digits of a key as a number."""
    return F.conv(F.substring(key, start, 8), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    """Number of words: each becomes one letter, white space goes. A count of matches would hold all words of a text as an array."""
    return F.length(F.translate(F.regexp_replace(text, WORD, "w"), WHITE, ""))


def apportion(parties: DataFrame, group: list[str], votes: str, seats: str, capacity: str, order: list[Column]) -> DataFrame:
    """Sainte-Laguë: adds ``quota``, the party's share of the group's ``seats`` (a column equal within the group).

    With m parties and N seats the seats that every party holds at divisor V / (N - m) are certain, and none can go
    beyond those at V / (N + m); only the quotients between, about three a party, are ranked.
    """
    whole = Window.partitionBy(*group)
    ranked = Window.partitionBy(*group).orderBy(F.col("__quotient").desc(), F.col(votes).desc(), *order, F.col("__seat"))
    at = lambda n: F.floor(F.col(votes) * n / F.col("__votes") + 0.5)
    bounded = (
        parties.withColumn("__votes", F.sum(votes).over(whole))
        .withColumn("__m", F.count(F.lit(1)).over(whole))
        .withColumn("__low", F.when(F.col("__votes") > 0, F.least(F.greatest(at(F.col(seats) - F.col("__m")), F.lit(0)), F.col(capacity))).otherwise(0))
        .withColumn("__high", F.when(F.col("__votes") > 0, F.least(at(F.col(seats) + F.col("__m")), F.col(capacity))).otherwise(0))
        .withColumn("__rest", F.col(seats) - F.sum("__low").over(whole))
    )
    # Seat 0 stands for the certain seats, so that every party keeps one row at least.
    seat = F.explode(F.concat(F.array(F.lit(0).cast("long")), F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low") + 1, F.col("__high"))).otherwise(F.array().cast("array<bigint>"))))
    dealt = (
        bounded.withColumn("__seat", seat)
        .withColumn("__quotient", F.when(F.col("__seat") > 0, F.col(votes) / (2 * F.col("__seat") - 1)))
        .withColumn("__rank", F.row_number().over(ranked))
    )
    # Nulls sort last when descending: the ranks of real seats come first.
    won = ((F.col("__seat") > 0) & (F.col("__rank") <= F.col("__rest"))).cast("long")
    keep = [F.first(c).alias(c) for c in parties.columns if c not in group and c not in ("__party",)]
    return dealt.groupBy(*group, "__party").agg(*keep, (F.first("__low") + F.sum(won)).alias("quota"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    group_shards: int = GROUP_SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and the document's ``source``, one row per document."""
    sized = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(n_words(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("__key"),
        )
    )
    targets = source_targets(sized, weights, total_share, cap)
    block = F.least(F.lit(block_words), F.greatest(F.floor(F.col("source_size") / BLOCK_SHARE), F.lit(1))).cast("long")
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("__rows") / SHARD_ROWS), F.lit(1)).cast("long")
    targets = targets.withColumn("__block", block).withColumn("__shards", shards).withColumn("__seats", F.round(F.col("quota") / F.col("__block")).cast("long"))
    # Few rows, written once, as are the quotas: the plans over all documents stay two joins and one window.
    targets = stored(targets, "targets")
    columns = ["doc_id", F.col("d.source").alias("source"), "size", "__key", "source_size", "target", "__seats", "__block", "__party"]
    placed = (
        sized.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select(*columns, (_digits(F.col("__key"), 1) % F.col("__shards")).alias("__shard"))
        .withColumnRenamed("__party", "__src")
    )
    parts = (
        placed.groupBy("__src", "__shard")
        .agg(F.sum("size").alias("__votes_in"), F.first("__seats").alias("__seats"), F.first("__block").alias("__block"))
        .withColumn("__blocks", F.ceil(F.col("__votes_in") / F.col("__block")).cast("long"))
        .withColumn("__capacity", cap * F.col("__blocks"))
        .withColumn("__group", F.floor(F.col("__shard") / group_shards))
    )
    groups = parts.groupBy("__src", F.col("__group").alias("__party")).agg(*(F.sum(c).alias(c) for c in ("__votes_in", "__capacity")), F.first("__seats").alias("__seats"))
    groups = apportion(groups, ["__src"], "__votes_in", "__seats", "__capacity", [F.col("__party")]).select("__src", F.col("__party").alias("__group"), F.col("quota").alias("__seats"))
    parts = parts.drop("__seats").join(groups, ["__src", "__group"]).withColumn("__party", F.col("__shard"))
    quotas = apportion(parts, ["__src", "__group"], "__votes_in", "__seats", "__capacity", [F.col("__party")]).select(
        "__src", F.col("__party").alias("__shard"), "__blocks", "quota"
    )
    quotas = stored(quotas, "quotas")
    start = F.sum("size").over(Window.partitionBy("__src", "__shard").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    blocks = F.greatest(F.col("__blocks"), F.lit(1))
    offset = _digits(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__src"), F.col("__shard"))), 1) % blocks
    first, last = F.col("__start"), F.col("__start") + F.col("size")

    def overlap(a: Column, b: Column) -> Column:
        """Words of the document in the blocks from a to b, b excluded."""
        return F.greatest(F.least(last, b * F.col("__block")) - F.greatest(first, a * F.col("__block")), F.lit(0))

    extra = F.col("quota") % blocks
    end = F.col("__offset") + extra
    return (
        placed.withColumn("__start", start)
        .join(quotas, ["__src", "__shard"])
        .withColumn("__offset", offset)
        .withColumn(
            "taken",
            (F.floor(F.col("quota") / blocks) * F.col("size") + overlap(F.col("__offset"), F.least(end, blocks)) + overlap(F.lit(0), end - blocks)).cast("long"),
        )
        .select("doc_id", "source", "size", "source_size", "target", "taken")
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...], total_share: float, cap: int) -> DataFrame:
    """Per source: size, target and quota in words.

    Sources in order of capacity per weight fill up one after another; the level that the rest shares is the largest
    (words left) / (weight left) of that order. One row per source is ordered in one task, never the documents.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("__ratio", "__party")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__party") - 1) % len(weights) + 1).cast("int"))
    level = (F.col("__all") * total_share - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0))) / F.sum("__weight").over(after)
    filled = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
        .withColumn("__party", F.row_number().over(everything).cast("long"))
        .withColumn("__weight", weight)
        .withColumn("__ratio", cap * F.col("source_size") / F.col("__weight"))
        .withColumn("__all", F.sum("source_size").over(whole))
        .withColumn("__level", level)
        .withColumn("__level", F.max("__level").over(whole))
        .withColumn("target", F.least((cap * F.col("source_size")).cast("double"), F.greatest(F.col("__level"), F.lit(0.0)) * F.col("__weight")))
        .withColumn("__seats", F.round(F.sum("target").over(whole)).cast("long"))
        .withColumn("__capacity", cap * F.col("source_size"))
        .withColumn("__group", F.lit(0))
        .select("__group", "__party", "source", "source_size", "__rows", "target", "__seats", "__capacity")
    )
    return apportion(filled, ["__group"], "target", "__seats", "__capacity", [F.col("__party")]).drop("__group")


def repeat_taken(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents as the mix takes them, with their own columns: each row as often as its words are taken, rounded.

    Word-less documents stay once: they weigh nothing. Rows are matched by id and text; copies of a row share equally.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(
        F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    mixed = mix(keyed, id_col="key", **options)
    times = mixed.groupBy(F.col("doc_id").alias("key")).agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share"), F.sum("size").alias("size"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("share") + 0.5)).otherwise(1).cast("int")
    joined = keyed.select("key", "row").join(times, "key").withColumn("copies", copies).where("copies > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _lague_sql(name: str, parties: str, group: str) -> str:
    """CTEs ``name``: the parties (party, votes, seats, capacity and more) with their quota, by all quotients in order."""
    return f"""{name}_seats AS (
  SELECT {group}, party, row_number() OVER (PARTITION BY {group} ORDER BY votes / (2 * seat - 1)::DOUBLE DESC, votes DESC, party, seat) AS place, seats
  FROM (SELECT {group}, party, votes, seats, unnest(range(1, least(seats, capacity) + 1)) AS seat FROM {parties} WHERE votes > 0)),
{name} AS (
  SELECT p.*, coalesce(w.won, 0) AS quota FROM {parties} p
  LEFT JOIN (SELECT {group}, party, count(*) AS won FROM {name}_seats WHERE place <= seats GROUP BY {group}, party) w USING ({group}, party))"""


def _overlap_sql(a: str, b: str) -> str:
    return f"greatest(least(begins + size, ({b}) * block) - greatest(begins, ({a}) * block), 0)"


#: The whole mix with the parameters' defaults.
SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows, row_number() OVER (ORDER BY source ASC NULLS LAST) AS party,
         sum(sum(size)) OVER ()::BIGINT AS words FROM sized GROUP BY source),
weighed AS (SELECT *, {list(WEIGHTS)}[(party - 1) % {len(WEIGHTS)} + 1] AS weight FROM sources),
levels AS (
  SELECT *, (words * {TOTAL_SHARE}::DOUBLE - coalesce(sum({CAP} * source_size) OVER (ORDER BY {CAP} * source_size / weight::DOUBLE, party ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY {CAP} * source_size / weight::DOUBLE, party ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT *, least(({CAP} * source_size)::DOUBLE, greatest(max(level) OVER (), 0::DOUBLE) * weight) AS target FROM levels),
source_parties AS (SELECT *, 0 AS whole, target AS votes, round(sum(target) OVER ())::BIGINT AS seats, {CAP} * source_size AS capacity FROM targets),
{_lague_sql("source_quotas", "source_parties", "whole")},
dealt AS (
  SELECT party AS src, source, source_size, target, least({BLOCK_WORDS}, greatest(source_size // {BLOCK_SHARE}, 1)) AS block, quota,
         greatest(ceil(source_size / {SHARD_WORDS}), ceil(n_rows / {SHARD_ROWS}), 1)::BIGINT AS shards FROM source_quotas),
placed AS (
  SELECT d.doc_id, d.source, d.size, d.k, t.src, t.source_size, t.target, t.block, round(t.quota / t.block)::BIGINT AS seats,
         CAST('0x' || substr(d.k, 1, 8) AS BIGINT) % t.shards AS shard FROM sized d JOIN dealt t ON d.source IS NOT DISTINCT FROM t.source),
shards AS (
  SELECT src, shard, shard // {GROUP_SHARDS} AS grp, sum(size)::BIGINT AS votes, min(seats) AS seats, ceil(sum(size) / min(block))::BIGINT AS blocks, {CAP} * ceil(sum(size) / min(block))::BIGINT AS capacity
  FROM placed GROUP BY src, shard),
groups AS (SELECT src, grp AS party, sum(votes)::BIGINT AS votes, min(seats) AS seats, sum(capacity)::BIGINT AS capacity FROM shards GROUP BY src, grp),
{_lague_sql("group_quotas", "groups", "src")},
shard_parties AS (SELECT s.src * 1000000 + s.grp AS src_grp, s.src, s.shard AS party, s.votes, g.quota AS seats, s.capacity, s.blocks FROM shards s JOIN group_quotas g ON g.src = s.src AND g.party = s.grp),
{_lague_sql("shard_quotas", "shard_parties", "src_grp")},
starts AS (
  SELECT p.*, sum(size) OVER (PARTITION BY p.src, p.shard ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS begins, q.quota, greatest(q.blocks, 1) AS n_blocks,
         CAST('0x' || substr(md5('{SEED}:' || p.src || ':' || p.shard), 1, 8) AS BIGINT) % greatest(q.blocks, 1) AS first_block
  FROM placed p JOIN shard_quotas q ON q.src = p.src AND q.party = p.shard)
SELECT doc_id, source, size, source_size, target,
       ((quota // n_blocks) * size + {_overlap_sql("first_block", "least(first_block + quota % n_blocks, n_blocks)")} + {_overlap_sql("0", "first_block + quota % n_blocks - n_blocks")})::BIGINT AS taken
FROM starts
"""
