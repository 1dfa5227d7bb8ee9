"""Publishing a table: put it into shape, check it against its contract, replace the parquet."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioworks.contracts import Contract
from folioworks.operators.hierarchy import interval_labels, tree_json_lines
from folioworks.operators.quality import cast, reconcile, rules


def target_path(folder: str, table: str, *, smoke: bool = False) -> str:
    """Trial output carries its own name, so it can never replace the full table."""
    return f"{folder.rstrip('/')}/{'smoke_test_' if smoke else ''}{table}.parquet"


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns only, in order and cast; a missing column is an error, a spare one a warning."""
    missing, extra = reconcile(df, contract)
    if missing:
        raise ValueError(f"{contract.name} lacks the columns {missing}")
    if extra:
        warnings.warn(f"{contract.name}: columns left out: {extra}", stacklevel=2)
    return cast(df, contract)


class _Folders:
    """Folders of the store that a path is in.  A rename is cheap on a file system; an object store copies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._store.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._store.delete(self._path(path), True)

    def move(self, old: str, new: str) -> None:
        if not self._store.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {old} to {new}")


def aside_path(path: str) -> str:
    """Where the old table waits while the new one takes its place."""
    return f"{path}.previous"


def recover(spark: SparkSession, path: str) -> None:
    """Put the old table back if a publication was broken off before the new one stood in its place."""
    folders = _Folders(spark, path)
    if folders.exists(aside_path(path)) and not folders.exists(path):
        folders.move(aside_path(path), path)


def _promote(spark: SparkSession, staging: str, path: str) -> None:
    """Put a finished folder in the place of the old one.

    The old table moves aside first and is deleted last, so one whole table is there at any time.
    """
    recover(spark, path)
    folders, aside = _Folders(spark, path), aside_path(path)
    folders.delete(aside)
    if folders.exists(path):
        folders.move(path, aside)
    try:
        folders.move(staging, path)
    except Exception:
        recover(spark, path)
        raise
    folders.delete(aside)


def write_checked(shaped: DataFrame, contract: Contract, path: str) -> int:
    """Write rows and count them and the rules they break on the way; a broken rule is an error."""
    seen = Observation()
    broken = [F.count_if(bad).alias(label) for label, bad in rules(contract, shaped.columns).items()]
    shaped.observe(seen, F.count(F.lit(1)).alias("rows"), *broken).write.mode("overwrite").parquet(path)
    failed = {label: n for label, n in seen.get.items() if label != "rows" and n}
    if failed:
        raise ValueError(f"{contract.name} breaks its contract: {failed}; the rows are in {path}")
    return seen.get["rows"]


def publish(df: DataFrame, contract: Contract, folder: str, *, smoke: bool = False) -> str:
    """Write the table and replace the published one by it if every row keeps the contract.

    The rules are counted while the rows are written to a folder beside the table, so the plan runs
    once and the rows are written once.  A run that is broken off leaves the old table in its place or
    beside it, from where ``recover``, or the next run, puts it back.
    """
    path = target_path(folder, contract.name, smoke=smoke)
    staging = f"{path}.staging"
    write_checked(conform(df, contract), contract, staging)
    _promote(df.sparkSession, staging, path)
    return path


def export_tree_json(nodes: DataFrame, folder: str, attributes: list[str]) -> None:
    """Write the hierarchy as JSON text; the part files, in order of name, are the document."""
    lines = tree_json_lines(nodes, interval_labels(nodes), attributes)
    ordered = lines.repartitionByRange("seq").sortWithinPartitions("seq")
    ordered.select(F.col("text").alias("value")).write.mode("overwrite").text(folder)
