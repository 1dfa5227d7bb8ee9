"""A corpus from raw documents: rules, near-duplicates, benchmark leaks, secrets, mix.

Each stage takes all that its predecessor kept, written as Parquet and read again.  All but the last
return the columns of documents; the last returns what the mix takes of each document.

Defined cases: a null or empty text breaks the quality rules and goes in the first stage; of rows that agree
in all columns one stays; rows with a null or repeated doc_id are rows of their own, a row without one
staying only where its group has no other; an empty table goes through all stages as an empty table;
columns beyond those of documents pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioworks.llm import decontaminate, mixing, quality_rules, secret_scan, simhash_dedup
from folioworks.llm.common import table
from folioworks.session import written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash_dedup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials masked."""
    return secret_scan.mask_live(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("mixing", mix),
]

#: SimHash groups and window fingerprints have no SQL form; tests/llm holds the run against a plain one on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
