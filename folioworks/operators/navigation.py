"""Navigation lists: categories carried down to the links that follow them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioworks.operators.tables import last_per_key

BLOCK = 65_536


def fill_levels(
    links: DataFrame, doc: str, position: str, level: str, text: str, block: int = BLOCK
) -> DataFrame:
    """Give each link its ``category`` and ``subcategory``; drop links that have no place.

    Level 1 names a category and clears the subcategory, level 2 names the subcategory of the links
    after it (its own is null), level 3 takes both.

    The running maximum is taken in two steps, inside blocks of ``block`` positions and across the
    blocks of a document, so that even one very long list is spread over many tasks.
    """
    def mark(n: int) -> Column:
        return F.max(F.when(F.col(level) == n, F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))

    rows = links.withColumn("_block", F.floor(F.col(position) / block))
    blocks = rows.groupBy(doc, "_block").agg(mark(1).alias("_b1"), mark(2).alias("_b2"))
    prior = W.partitionBy(doc).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        F.col(doc).alias("_doc"),
        F.col("_block").alias("_cblock"),
        F.max("_b1").over(prior).alias("_c1"),
        F.max("_b2").over(prior).alias("_c2"),
    )
    inside = W.partitionBy(doc, "_block").orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_l1", mark(1).over(inside)).withColumn("_l2", mark(2).over(inside))
    rows = rows.join(carried, (F.col(doc) == F.col("_doc")) & (F.col("_block") == F.col("_cblock")))
    first = F.coalesce("_l1", "_c1")
    second = F.coalesce("_l2", "_c2")
    category = F.nullif(first["t"], F.lit(""))
    sub = F.when(second["p"] > first["p"], F.nullif(second["t"], F.lit("")))
    placed = (
        rows.withColumn("category", F.when(F.col(level) == 1, F.col(text)).otherwise(category))
        .withColumn("_sub", sub)
        .withColumn("subcategory", F.when(F.col(level) == 3, F.col("_sub")))
        .filter(
            (F.col(level) == 1)
            | ((F.col(level) == 2) & F.col("category").isNotNull())
            | ((F.col(level) == 3) & F.col("category").isNotNull() & F.col("_sub").isNotNull())
        )
    )
    return placed.drop("_block", "_doc", "_cblock", "_l1", "_l2", "_c1", "_c2", "_sub")


def url_hierarchy(links: DataFrame, doc: str, position: str, level: str, text: str, url: str) -> DataFrame:
    """One row per URL; the last link to a URL decides, its first position is kept."""
    placed = fill_levels(links, doc, position, level, text)
    return last_per_key(placed, url, position, ["category", "subcategory"])
