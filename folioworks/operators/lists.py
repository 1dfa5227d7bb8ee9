"""Grouping rows into list columns: one row and one whole list per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gather(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    alias: str,
    keep_nulls: bool = False,
    distinct: bool = False,
    count_alias: str | None = None,
    pieces: int = 1,
) -> DataFrame:
    """One sorted list per key, with ``count_alias`` for the rows behind it.

    Equal entries are counted before anything is shuffled, so copies cost nothing.  A list is one
    value; what has no such bound by nature is better kept as rows.  Lists of very many entries take
    less memory in several ``pieces`` that are put together at the end, at the cost of a shuffle.
    """
    counted = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    copies = F.least(F.col("_n"), F.lit(1)) if distinct else F.col("_n")
    entries = F.array_repeat("_v", copies.cast("int"))
    if not keep_nulls:
        entries = F.when(F.col("_v").isNull(), F.array().cast(entries_type(df, value))).otherwise(entries)
    figures = [F.sum("_n").alias(count_alias)] if count_alias else []
    if pieces > 1:
        piece = F.pmod(F.xxhash64("_v"), F.lit(pieces)).alias("_piece")
        counted = counted.groupBy(*keys, piece).agg(F.flatten(F.collect_list(entries)).alias("_v"), F.sum("_n").alias("_n"))
        entries = F.col("_v")
    return counted.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list(entries))).alias(alias), *figures)


def entries_type(df: DataFrame, column: str) -> T.ArrayType:
    return T.ArrayType(df.schema[column].dataType)


def join_text(df: DataFrame, keys: Sequence[str], position: str, text: str, *, alias: str, end: str = "\n") -> DataFrame:
    """Concatenate texts in order of ``position``, each followed by ``end``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    pieces = F.transform(ordered, lambda s: F.concat(F.coalesce(s["t"], F.lit("")), F.lit(end)))
    return df.groupBy(*keys).agg(F.array_join(pieces, "").alias(alias))


def list_counts(df: DataFrame, column: str, *, alias: str = "n") -> DataFrame:
    """Count the elements of a list column over all rows, most frequent first."""
    return (
        df.select(F.explode(column).alias(column))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(F.desc(alias), F.asc_nulls_first(column))
    )
