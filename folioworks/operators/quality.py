"""Checks against a contract and between tables.

The frame-valued checks report; the ``require_*`` functions raise, having looked at one aggregated
row or at a handful of offending examples.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.contracts import Contract, Enum, ListOf, domain_of, spark_type


def _outside(name: str, declared: object) -> Column | None:
    """True where a value is outside its domain; null, also as a list element, is inside."""
    domain = domain_of(declared)
    if domain is None:
        return None
    if isinstance(declared, Enum):
        return F.coalesce(~F.col(name).isin(*domain), F.lit(False))
    if isinstance(declared, ListOf) and isinstance(declared.inner, Enum):
        return F.coalesce(F.exists(name, lambda x: x.isNotNull() & ~x.isin(*domain)), F.lit(False))
    raise NotImplementedError(f"no domain check for {declared!r}")


def rules(contract: Contract, columns: Sequence[str], extra: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """What can be wrong with a row: a condition per label.  ``extra`` adds rules of the caller."""
    found: dict[str, Column] = {}
    for f in contract.fields:
        if f.name not in columns:
            continue
        if not f.nullable:
            found[f"null:{f.name}"] = F.col(f.name).isNull()
        outside = _outside(f.name, f.type)
        if outside is not None:
            found[f"domain:{f.name}"] = outside
        if isinstance(f.type, str) and f.type.startswith("uint"):
            found[f"negative:{f.name}"] = F.col(f.name) < 0
    return {**found, **(extra or {})}


def reasons(contract: Contract, columns: Sequence[str], extra: Mapping[str, Column] | None = None) -> Column:
    """The list of everything wrong with a row, empty for a good one."""
    labelled = [F.when(bad, F.lit(label)) for label, bad in rules(contract, columns, extra).items()]
    return F.array_compact(F.array(*labelled)) if labelled else F.array().cast("array<string>")


def violations(df: DataFrame, contract: Contract, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Failing rows with their reasons, in one pass.

    The reasons come out of a generator, past which the filter is not pushed: checking twice, once
    to filter and once to report, would also repeat whatever the columns are computed from.
    """
    found = df.select("*", F.explode(F.array(reasons(contract, df.columns, extra))).alias("reasons"))
    return found.filter(F.size("reasons") > 0)


def violation_counts(df: DataFrame, contract: Contract, extra: Mapping[str, Column] | None = None) -> DataFrame:
    return (
        df.select(F.explode(reasons(contract, df.columns, extra)).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reconcile(df: DataFrame, contract: Contract) -> tuple[list[str], list[str]]:
    """Columns the contract misses in the frame, and columns the frame has beyond it."""
    return (
        [n for n in contract.names if n not in df.columns],
        [c for c in df.columns if c not in contract.names],
    )


def cast(df: DataFrame, contract: Contract, *, strict: bool = True) -> DataFrame:
    """The contract's columns in its order and types.

    A value that cannot be cast is an error under ANSI rules, or null if not ``strict``.
    """
    def column(f):
        c = F.col(f.name)
        target = spark_type(f.type)
        return (c.cast(target) if strict else c.try_cast(target)).alias(f.name)

    return df.select(*[column(f) for f in contract.fields])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys without a parent; reducing them first keeps hot keys out of the join."""
    keys = child.select(F.col(foreign_key).alias("key")).filter(F.col("key").isNotNull()).distinct()
    return keys.join(parent.select(F.col(key).alias("key")), "key", "left_anti")


def multiple(df: DataFrame, keys: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Keys with more than one row, or more than one row meeting the condition."""
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return df.groupBy(*keys).agg(counted.alias("n")).filter(F.col("n") > 1)


def require_none(found: DataFrame, message: str, show: int = 5) -> None:
    examples = found.limit(show).collect()
    if examples:
        raise ValueError(f"{message}: {[r.asDict() for r in examples]}")


def require_rows(df: DataFrame, expected: int) -> None:
    rows = df.count()
    if rows != expected:
        raise ValueError(f"expected {expected} rows, found {rows}")
