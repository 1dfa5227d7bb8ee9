"""Which texts contain which keys, without comparing every text with every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.operators.tables import left_join
from folioworks.session import written

#: Block lengths; the longest bounds what a key is spelt out to, which is so many times its length.
BLOCKS = tuple(2**i for i in range(1, 7))
#: From this block length on, a key has at least three blocks to choose from instead of one.
CHOICE = 8
#: Blocks with one text beyond which they are dealt out by salt.
HOT = 1 << 20


def _block_length(length: Column) -> Column:
    """Blocks as long as they can be for any text to hold a whole one wherever the key lies, and often more than one."""
    width = F.lit(1)
    for q in BLOCKS:
        width = F.when(length >= (4 * q - 1 if q >= CHOICE else 2 * q - 1), F.lit(q)).otherwise(width)
    return width


def key_grams(keys: DataFrame, key: str) -> DataFrame:
    """``(_key, _length, _q, _class, _r, _gram)``: the grams a key may be found by.

    A text is cut into blocks of q characters; where a key occurs, the whole blocks that it covers begin
    r, r + q, r + 2q ... characters into the key, with r below q.  Each of the q classes of places needs
    one of its grams.
    """
    sized = keys.select(F.col(key).alias("_key")).filter(F.length("_key") > 0).distinct()
    sized = sized.select("_key", F.length("_key").alias("_length"), _block_length(F.length("_key")).alias("_q"))
    starts = "transform(sequence(0, _length - _q), r -> struct(r % _q AS _class, r AS _r, substring(_key, r + 1, _q) AS _gram))"
    return sized.select("_key", "_length", "_q", F.inline(F.expr(starts)))


def text_blocks(texts: DataFrame, text_id: str, text: str, grams: DataFrame) -> DataFrame:
    """``(_tid, _q, _i, _gram)``: the blocks of the texts that are a gram of some key."""
    asked = written(grams.select("_q", "_gram").distinct(), "grams")
    # Only the block lengths some key asks for are cut; there are never more than len(BLOCKS) + 1.
    in_use = sorted(row["_q"] for row in asked.select("_q").distinct().collect())

    def cut(q: int) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{{q}}}"), F.lit(0))
        return F.transform(found, lambda block, i: F.struct(F.lit(q).alias("_q"), i.alias("_i"), block.alias("_gram")))

    blocks = texts.select(F.col(text_id).alias("_tid"), F.inline(F.concat(*[cut(q) for q in in_use or [1]])))
    return written(blocks.join(asked, ["_q", "_gram"], "left_semi"), "blocks")


def anchors(grams: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(_q, _gram, _r, _length, _n)``: per key and class the gram that the fewest blocks have, ``_n`` of them.

    A class with a gram that no block has cannot occur, and drops out.
    """
    counts = written(blocks.groupBy("_q", "_gram").agg(F.count(F.lit(1)).alias("_n")), "gram-counts")
    counted = grams.join(counts, ["_q", "_gram"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = counted.groupBy("_key", "_class").agg(F.min(F.struct("_n", "_r", "_gram", "_q", "_length")).alias("_a"))
    return rarest.filter("_a._n > 0").select("_a.*").distinct()


def contains_pairs(
    texts: DataFrame, text_id: str, text: str, keys: DataFrame, key_id: str, key: str
) -> DataFrame:
    """All pairs ``(text_id, key_id)`` where the text holds the key literally.

    Texts are cut into blocks (together as long as the text) and met with the grams of the keys in an
    equi-join.  Blocks that are the gram of no key are dropped at once; the others are counted, and each
    key is looked for by its rarest grams, so a start that very many texts and keys have in common does
    not count.  Blocks of a gram that is frequent all the same are dealt out by salt.  A hit says where
    in the text a key of which length may start; that piece of the text is taken out and meets the keys
    in a second equi-join.  Keys with a common start do not multiply: what is joined are distinct grams.
    """
    usable = keys.select(F.col(key_id).alias("_kid"), F.col(key).alias("_key")).filter(F.length("_key") > 0)
    grams = written(key_grams(keys, key), "key-grams")
    blocks = text_blocks(texts, text_id, text, grams)
    chosen = written(anchors(grams, blocks), "anchors")
    salts = F.ceil(F.col("_n") / HOT)
    spread = chosen.select("_q", "_gram", "_r", "_length", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_salt"))
    # At most one row per so many blocks.
    hot = chosen.filter(F.col("_n") > HOT).select("_q", "_gram", salts.alias("_salts")).distinct()
    salt = F.pmod(F.xxhash64("_tid", "_i"), F.coalesce("_salts", F.lit(1).cast("bigint")))
    dealt = blocks.join(hot, ["_q", "_gram"], "left").withColumn("_salt", salt).drop("_salts")
    begin = F.col("_i") * F.col("_q") - F.col("_r")
    hits = dealt.join(spread, ["_q", "_gram", "_salt"]).select("_tid", "_length", begin.alias("_begin")).filter(F.col("_begin") >= 0)
    # Written, so that the planner sees how few they are and need not shuffle the texts for them.
    hits = written(hits, "hits")
    pieces = (
        hits.join(texts.select(F.col(text_id).alias("_tid"), F.col(text).alias("_text")), "_tid")
        .select("_tid", F.expr("substring(_text, _begin + 1, _length)").alias("_piece"))
        .distinct()
    )
    found = pieces.join(usable, F.col("_piece") == F.col("_key"))
    return found.select(F.col("_tid").alias(text_id), F.col("_kid").alias(key_id)).distinct()


def first_containing(
    keys: DataFrame, key: str, texts: DataFrame, position: str, text: str, value: str, alias: str
) -> DataFrame:
    """Per key the value of the first text, by position, that contains it; null when none does.

    Each distinct key is looked up once, however many rows share it.
    """
    distinct_keys = keys.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    trimmed = texts.withColumn("_trimmed", F.trim(F.col(text)))
    pairs = contains_pairs(trimmed, position, "_trimmed", distinct_keys.withColumn("_id", F.col("_k")), "_id", "_k")
    first = pairs.groupBy("_id").agg(F.min(position).alias("_first"))
    found = first.join(
        texts.select(F.col(position).alias("_first"), F.col(value).alias(alias)), "_first"
    ).select(F.col("_id").alias("_k"), alias)
    return left_join(keys, found, F.col(key), "_k").drop("_k")
