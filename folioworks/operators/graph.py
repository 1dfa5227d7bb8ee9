"""Directed link graphs as edge and vertex frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_from_lists(df: DataFrame, src: str, targets: str) -> DataFrame:
    """Distinct edges of a list column; null and empty lists give none."""
    return df.select(F.col(src).alias("src"), F.explode(targets).alias("dst")).distinct()


def vertices(df: DataFrame, src: str, edges: DataFrame) -> DataFrame:
    """All owners plus every target that is linked to, even if it is no owner itself."""
    return df.select(F.col(src).alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()


def degree(edges: DataFrame) -> DataFrame:
    """In- plus out-degree; a self-loop counts twice.  Both ends come from one scan."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def prune(edges: DataFrame, min_degree: int = 2) -> DataFrame:
    """Edges left after one pass of removing the vertices below ``min_degree`` (not a k-core)."""
    low = degree(edges).filter(F.col("degree") < min_degree).select("node")
    return edges.join(low, F.col("src") == F.col("node"), "left_anti").join(
        low, F.col("dst") == F.col("node"), "left_anti"
    )


def self_loops(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("node"))


def short_label(title, length: int = 13):
    return F.concat(F.substring(title, 1, length), F.lit("..."))


def labels(nodes: DataFrame, titles: DataFrame, key: str, title: str) -> DataFrame:
    """A short label per vertex; vertices without a title have none."""
    side = titles.select(F.col(key).alias("node"), short_label(F.col(title)).alias("label"))
    return nodes.join(side, "node", "left")
