"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Targets: sources share the corpus by weight; no source gets more than a number of repeats of
   itself, and the excess goes to the others by weight, until none is above.
2. Apportionment: the corpus is so many blocks of equal size; they go one by one to the source with
   the highest quotient ``target / (2 k + 1)``, ``k`` being the blocks it has.  The blocks of a source
   go to its shards in the same way, by shard size.
3. Selection: a shard is a line of documents in seeded order, cut into blocks.  Its quota is so many
   whole passes over the line and a seeded, evenly spaced choice of blocks.  Both are counted from a
   document's place in its line alone, so no block is ever a row.

Defined cases: a null text has size 0; a null source is a source of its own, the last; documents
without words take nothing; rows that repeat are documents of their own, in the order of the hash of
the row number within equal rows; without any words all targets are 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioworks.llm.common import WORD, whole
from folioworks.operators.tables import with_row_index
from folioworks.session import written

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 17


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Sizes, weights and targets per source, from rows (source, size)."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_index(per_source.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "rank")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    rows = written(ranked.select("source", "source_size", "rank", weight.cast("bigint").alias("weight"), F.lit(False).alias("full")), "mix-sources")
    while True:
        total, taken, open_weight, n_full = rows.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("full"), repeats * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)),
            F.count(F.when(F.col("full"), 1)),
        ).first()
        share = F.col("weight") * F.lit(total - taken).cast("double") / F.lit(float(max(open_weight, 1)))
        target = F.when(F.col("full"), (repeats * F.col("source_size")).cast("double")).otherwise(share)
        rows = written(
            rows.withColumn("target", target).withColumn("full", F.col("full") | (F.col("target") > repeats * F.col("source_size"))), "mix-targets"
        )
        if rows.filter("full").count() == n_full:
            return rows.drop("full")


def apportion(parties: DataFrame, group: Sequence[str], seats: Column, votes: str, order: Sequence[str], most: Column) -> DataFrame:
    """Highest quotients ``votes / (2 k + 1)`` within each group; ties go to the party first in order.

    With ``n`` parties a party's seats differ from its exact share by less than ``n`` times that share
    plus one half: divisors ``total / (seats + n)`` and ``total / (seats - n)`` give at least and at
    most all seats.  So the seats below that range are certain, and only the quotients within it,
    about three per party, are ranked.
    """
    keys = list(group)
    totals = parties.groupBy(*keys).agg(F.sum(votes).cast("double").alias("_total"), F.count(F.lit(1)).alias("_n"), F.max(seats).cast("bigint").alias("_seats"))
    same = reduce(lambda a, b: a & b, [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys], F.lit(True))
    rows = parties.alias("p").join(totals.alias("t"), same).select("p.*", "_total", "_n", "_seats", most.cast("bigint").alias("_most"))
    part = F.when(F.col("_total") > 0, F.col(votes) / F.col("_total")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0), F.floor(part * F.greatest(F.col("_seats") - F.col("_n"), F.lit(0)) - 0.5))
    high = F.least(F.col("_most"), F.ceil(part * (F.col("_seats") + F.col("_n")) + 0.5))
    rows = written(
        rows.select("*", F.least(low, F.col("_most")).cast("bigint").alias("_low"), high.cast("bigint").alias("_high")).drop("_total", "_n", "_most"),
        "mix-parties",
    )
    certain = rows.groupBy(*keys).agg((F.max("_seats") - F.sum("_low")).alias("_open"))
    quotients = (
        rows.filter("_high > _low")
        .select(*keys, *order, votes, F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_k"))
        .select(*keys, *order, (F.col(votes) / (2 * F.col("_k") + 1)).alias("_quotient"), (-F.col(votes) / (2 * F.col("_k") + 1)).alias("_down"))
    )
    ranked = with_row_index(quotients, [*keys, "_down", *order], "_place")
    first = ranked.groupBy(*keys).agg(F.min("_place").alias("_first"))
    null_safe = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))
    won = (
        ranked.alias("r")
        .join(first.alias("f"), null_safe("r", "f"))
        .join(certain.alias("c"), null_safe("r", "c"))
        .filter(F.col("_place") - F.col("_first") < F.col("_open"))
        .groupBy(*[F.col(f"r.{k}") for k in keys], *order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    by = reduce(lambda x, y: x & y, [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in [*keys, *order]], F.lit(True))
    return (
        rows.alias("p")
        .join(won.alias("w"), by, "left")
        .select("p.*", (F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).alias("quota"))
        .drop("_seats", "_low", "_high")
    )


def _number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    text: str = "text",
) -> DataFrame:
    """doc_id, size, source_size, target, taken and the source of every document."""
    # Rows go to shards by id and text, so that rows without an id, or with one they share, are spread too.
    name = F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(whole(text).cast("binary")))
    size = F.regexp_count(whole(text), F.lit(f"({WORD})")).cast("bigint")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), F.md5(name).alias("_digest"))
    sized = written(sized, "mix-sizes")
    targets = source_targets(sized.select("source", "size"), weights, repeats)
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # The sources' blocks.  A source never takes more whole blocks than it may be repeated.
    targets = written(targets.withColumn("_all", F.lit(0)), "mix-all")
    sources = written(
        apportion(
            targets, ["_all"], F.lit(total // block), "target", ["rank"], F.ceil(F.col("source_size") / block) * repeats
        ).drop("_all"),
        "mix-quotas",
    )
    placed = (
        sized.filter("size > 0")
        .join(sources.select("source", "rank", F.ceil(F.col("source_size") / shard_words).alias("_shards")).withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "size", "rank", "_digest", F.pmod(_number(F.col("_digest"), 1), F.col("_shards")).alias("shard"))
    )
    line = W.partitionBy("rank", "shard").orderBy(F.substring("_digest", 9, 24), "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = written(placed.select("*", F.sum("size").over(line).alias("_end")), "mix-lines")
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(sources.select("rank", F.col("quota").alias("_blocks")), "rank")
    quotas = apportion(shards, ["rank"], F.col("_blocks"), "shard_size", ["shard"], F.ceil(F.col("shard_size") / block) * repeats)
    n = F.ceil(F.col("shard_size") / block)
    shift = F.pmod(_number(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("rank").cast("string"), F.col("shard").cast("string"))), 1), n)
    plan = quotas.select(
        F.col("rank").alias("_rank"), F.col("shard").alias("_shard"), n.alias("_n"), F.expr(f"quota div ceil(shard_size / {block})").alias("_passes"), (F.col("quota") % n).alias("_some"), shift.alias("_shift")
    )
    # Of the first x blocks of a line, those chosen: evenly spaced, their start shifted by the seed.
    chosen = lambda x: F.expr(f"(({x}) * _some + _shift) div _n")
    words = lambda at: chosen(f"({at}) div {block}") * block + F.expr(f"({at}) % {block}") * (
        chosen(f"({at}) div {block} + 1") - chosen(f"({at}) div {block}")
    )
    taken = F.col("_passes") * F.col("size") + words("_end") - words("_end - size")
    mixed = placed.join(plan, (F.col("rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard"))).select("rank", "doc_id", "size", taken.alias("taken"))
    ranks = sources.select("source", F.col("rank").alias("_rank"), "source_size", "target")
    full = mixed.join(ranks, F.col("rank") == F.col("_rank"))
    empty = (
        sized.filter("size = 0")
        .withColumnRenamed("source", "_source")
        .join(ranks, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("taken", F.lit(0).cast("bigint"))
    )
    kept = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return full.select(*kept).unionByName(empty.select(*kept))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(text, '')) AS hash, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM d GROUP BY source),
s1 AS (SELECT *, [1, 2, 3][rank % 3 + 1]::BIGINT AS weight, sum(source_size) OVER ()::BIGINT AS total FROM s0),
s2 AS (SELECT *, coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS caps, (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS open_w FROM s1
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, weight * (total - caps)::DOUBLE / open_w > 3 * source_size AS is_full FROM s2),
s4 AS (SELECT *, total - coalesce(sum(3 * source_size) FILTER (WHERE is_full) OVER (), 0)::BIGINT AS rest,
              coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER (), 0)::BIGINT AS ws FROM s3),
s5 AS (SELECT source, rank, source_size, total, CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE weight * rest::DOUBLE / ws END AS target FROM s4),
q1 AS (SELECT rank, total, target / (2 * k + 1) AS quotient, k FROM (SELECT *, unnest(range(0, CAST(ceil(source_size / {BLOCK_WORDS}.0) * {REPEATS} AS BIGINT))) AS k FROM s5)),
q2 AS (SELECT rank, count(*) AS blocks FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, rank) AS place FROM q1) WHERE place <= total // {BLOCK_WORDS} GROUP BY rank),
m AS (SELECT d.r, d.doc_id, d.size, s5.rank, md5(concat('{SEED}-', coalesce(d.doc_id::VARCHAR, 'null'), '-', d.hash)) AS digest,
        CAST(ceil(s5.source_size / {SHARD_WORDS}.0) AS BIGINT) AS shards FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source WHERE d.size > 0),
l AS (SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT % shards AS shard FROM m),
l2 AS (SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY substr(digest, 9, 24), doc_id, size, r ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM l),
h AS (SELECT rank, shard, sum(size)::BIGINT AS shard_size FROM l GROUP BY rank, shard),
g1 AS (SELECT rank, shard, shard_size / (2 * k + 1) AS quotient FROM (SELECT *, unnest(range(0, CAST(ceil(shard_size / {BLOCK_WORDS}.0) * {REPEATS} AS BIGINT))) AS k FROM h)),
g2 AS (SELECT rank, shard, count(*) AS quota FROM (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY quotient DESC, shard) AS place FROM g1)
        JOIN q2 USING (rank) WHERE place <= blocks GROUP BY rank, shard),
h2 AS (SELECT rank, shard, CAST(ceil(shard_size / {BLOCK_WORDS}.0) AS BIGINT) AS n, coalesce(quota, 0) AS quota,
        ('0x' || substr(md5(concat('{SEED}-', rank, '-', shard)), 1, 8))::BIGINT AS seeded FROM h LEFT JOIN g2 USING (rank, shard)),
h3 AS (SELECT rank, shard, n, quota // n AS passes, quota % n AS rest_blocks, seeded % n AS shift FROM h2),
f AS (SELECT l2.*, h3.*, e - size AS b FROM l2 JOIN h3 ON l2.rank = h3.rank AND l2.shard = h3.shard),
t AS (SELECT r, passes * size
        + ((e // {BLOCK_WORDS} * rest_blocks + shift) // n) * {BLOCK_WORDS} + (e % {BLOCK_WORDS}) * (((e // {BLOCK_WORDS} + 1) * rest_blocks + shift) // n - (e // {BLOCK_WORDS} * rest_blocks + shift) // n)
        - ((b // {BLOCK_WORDS} * rest_blocks + shift) // n) * {BLOCK_WORDS} - (b % {BLOCK_WORDS}) * (((b // {BLOCK_WORDS} + 1) * rest_blocks + shift) // n - (b // {BLOCK_WORDS} * rest_blocks + shift) // n) AS taken FROM f)
SELECT doc_id, d.source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source LEFT JOIN t USING (r)
"""
