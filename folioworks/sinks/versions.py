"""Published tables as versions behind a pointer.

A version is a folder of its own that nothing ever changes.  The pointer is a log beside the versions; a
version counts once its line is in the log, and readers take the last.  So there is no moment without a
table, nothing is renamed or replaced, and a reader who has begun goes on reading the version it found.
It works alike on file systems and object stores, and needs nothing but Spark's reader and writer.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.contracts import Contract
from folioworks.sinks.publish import conform, target_path, write_checked

_LINE = "version bigint, folder string, rows bigint"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``(version, folder, rows)`` of all versions of a table; empty if there is none yet."""
    try:
        return spark.read.schema(_LINE).json(f"{path}/pointer")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LINE)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the last version are; of two that were published at once, the later in order of name."""
    last = versions(spark, path).agg(F.max(F.struct("version", "folder")).alias("last")).first().last
    if last is None:
        raise FileNotFoundError(f"nothing has been published under {path}")
    return f"{path}/{last.folder}"


def read_current(spark: SparkSession, folder: str, table: str, *, smoke: bool = False) -> DataFrame:
    return spark.read.parquet(current_path(spark, target_path(folder, table, smoke=smoke)))


def publish_version(df: DataFrame, contract: Contract, folder: str, *, smoke: bool = False) -> str:
    """Write a new version, check it while it is written, and point to it if every row keeps the contract.

    A run that is broken off, or whose rows break the contract, leaves a folder that no pointer names.
    """
    spark = df.sparkSession
    path = target_path(folder, contract.name, smoke=smoke)
    last = versions(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    name = f"v{last + 1:09d}-{uuid.uuid4().hex}"
    rows = write_checked(conform(df, contract), contract, f"{path}/{name}")
    spark.createDataFrame([(last + 1, name, rows)], _LINE).coalesce(1).write.mode("append").json(f"{path}/pointer")
    return f"{path}/{name}"
