"""What several operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as the contracts define it, and a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def by_value(name: str) -> ModuleType:
    """Send a module along with the tasks, so that the package need not be installed on the executors."""
    module = sys.modules[name]
    cloudpickle.register_pickle_by_value(module)
    return module


def whole(text: Column | str) -> Column:
    """The text, null being empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
