"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.session import written


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """Rows (node, component): the smallest node reachable.  ``links`` has columns a and b.

    Stars in turn: every node's larger neighbours are tied to its smallest neighbour, then its smaller
    ones, until nothing moves.  Each round is two aggregations and two joins, written to the shared
    folder; the number of rounds grows with the logarithm of a component's size, and rows never outnumber
    the links.  Nodes without a link are not in the result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours v of u move to the smallest of u's surroundings.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # Smaller neighbours v of u, and u itself, move to the smallest of them.
        tied = large.join(least, "u")
        small = (
            tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        edges = written(small, "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.groupBy("u").agg(F.min("v").alias(label))
    roots = edges.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias(label))
    return written(stars.unionByName(roots).withColumnRenamed("u", "node"), "components")
