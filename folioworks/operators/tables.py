"""Counting, picking and combining rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from folioworks.session import written

#: Stretches that an order is cut into for drawing, a power of two.
STRETCHES = 1024

def value_counts(df: DataFrame, column: str, *, alias: str = "n") -> DataFrame:
    """Rows per value, null being a value; ties in order of the value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(F.desc(alias), F.asc_nulls_first(column))
    )


def count_unique(column: str) -> Column:
    """Distinct values with null counted as one of them."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def head(df: DataFrame, order_by: Sequence[str], k: int = 5) -> DataFrame:
    """The first k rows of a total order."""
    return df.orderBy(*order_by).limit(k)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The first row per key as an aggregate, so that a hot key is combined before the shuffle."""
    first = F.min(F.struct(*order_by, *[v for v in values if v not in order_by]))
    return df.groupBy(*keys).agg(first.alias("_f")).select(*keys, *[F.col(f"_f.{v}").alias(v) for v in values])


def last_per_key(df: DataFrame, key: str, position: str, values: Sequence[str]) -> DataFrame:
    """Later rows overwrite earlier ones; the key keeps the position at which it was first seen."""
    return (
        df.groupBy(key)
        .agg(
            F.min(position).alias("first_pos"),
            F.max(F.struct(F.col(position).alias("_p"), *values)).alias("_last"),
        )
        .select(key, "first_pos", *[F.col(f"_last.{v}").alias(v) for v in values])
    )


def with_row_index(df: DataFrame, order_by: Sequence[str], alias: str = "idx") -> DataFrame:
    """A gapless 0-based index in a total order, without pulling the rows into one partition.

    The rows are range-partitioned and written once, in order; each row is numbered within its
    stretch of the range and shifted by the number of rows in the stretches before it.  Rows that
    tie are ordered by their hash, so that a frequent value does not fill one stretch.
    """
    spark = df.sparkSession
    df = df.withColumn("_tie", F.xxhash64(*df.columns))
    order_by = [*order_by, "_tie"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_serial", F.monotonically_increasing_id())
    )
    ranged = written(ranged, "row-index")
    stretch = F.shiftright(F.col("_serial"), 33)
    sizes = ranged.groupBy(stretch.alias("_stretch")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the range, so this window is as small as the task list.
    before = W.orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_serial").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("_stretch", stretch)
        .join(F.broadcast(offsets), "_stretch")
        .withColumn(alias, F.col("_offset") + within)
        .drop("_stretch", "_offset", "_serial", "_tie")
    )


def with_sum_before(df: DataFrame, order_by: Sequence[str], value: str, alias: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row, in a total order given by unique keys.

    As ``with_row_index``: sums within a stretch of the range, shifted by the sums of the stretches before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_by).withColumn("_stretch", F.spark_partition_id())
    ranged = written(ranged, "sum-before")
    sums = ranged.groupBy("_stretch").agg(F.sum(value).alias("_n"))
    before = W.orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)  # one row per partition of the range
    offsets = sums.select("_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = W.partitionBy("_stretch").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(offsets), "_stretch")
        .withColumn(alias, F.col("_offset") + F.col("_within"))
        .drop("_stretch", "_offset", "_within")
    )


def _stretch_of(key: Column, bounds: Column) -> Column:
    """How many of STRETCHES - 1 ascending bounds are not above the key: a binary search."""
    halves = F.array(*[F.lit(STRETCHES >> i) for i in range(1, STRETCHES.bit_length())])
    step = lambda low, half: F.when(F.get(bounds, low + half - 1) <= key, low + half).otherwise(low)
    return F.aggregate(halves, F.lit(0), step)


def _key_bounds(df: DataFrame, order_by: Sequence[str], total: int, seed: int) -> Column | None:
    """Bounds that cut the order into stretches of about equal numbers of rows, from a sample of bounded size."""
    share = min(1.0, 16 * STRETCHES / total)
    keys = df.select(*order_by)
    sampled = keys.sample(fraction=share, seed=seed).orderBy(*order_by).limit(32 * STRETCHES)
    rows = [r[0] for r in sampled.select(F.to_json(F.struct(*order_by))).collect()]
    if not rows:
        return None
    chosen = ",".join(rows[len(rows) * i // STRETCHES] for i in range(1, STRETCHES))
    return F.from_json(F.lit(f"[{chosen}]"), T.ArrayType(keys.schema))  # a constant


def sample_with_replacement(df: DataFrame, order_by: Sequence[str], k: int, seed: int) -> DataFrame:
    """Exactly k seeded draws, each uniform over all rows, so a row may come up more than once.

    A draw is a place in the order of the rows.  Bounds from a sample cut the order into stretches; the
    rows are counted per stretch, so every draw is dealt to a stretch and a place within it.  Only the
    rows of drawn stretches are fetched and numbered; the table itself is neither sorted nor written.
    The sample decides how even the stretches are, not which rows are drawn.
    """
    total = df.count()
    if total == 0:
        raise ValueError("cannot draw from an empty table")
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string")))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    draws = df.sparkSession.range(k).select(F.col("id").alias("draw"), F.pmod(number, F.lit(total)).alias("_at"))
    bounds = _key_bounds(df, order_by, total, seed)
    if bounds is None:
        indexed = with_row_index(df, order_by)
        return draws.join(indexed, F.col("_at") == F.col("idx")).drop("_at", "idx")
    placed = df.withColumn("_part", _stretch_of(F.struct(*order_by), bounds))
    counts = dict(placed.groupBy("_part").count().collect())  # at most STRETCHES rows
    starts = [0, *accumulate(counts.get(i, 0) for i in range(STRETCHES))][:STRETCHES]
    numbers = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    dealt = draws.withColumn("_part", _stretch_of(F.col("_at"), F.slice(numbers, 2, STRETCHES - 1)))
    first = F.element_at(numbers, F.col("_part") + 1)
    dealt = dealt.select("draw", "_part", (F.col("_at") - first).alias("_within"))
    drawn = dealt.select("_part").distinct()  # at most STRETCHES rows
    fetched = with_row_index(placed.join(drawn, "_part", "left_semi"), ["_part", *order_by], "_place")
    heads = fetched.groupBy("_part").agg(F.min("_place").alias("_head"))
    found = fetched.join(heads, "_part").withColumn("_within", F.col("_place") - F.col("_head"))
    return dealt.join(found, ["_part", "_within"]).select("draw", *df.columns)


def add_missing(df: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Append the rows of ``extra`` whose key is absent; running it twice changes nothing."""
    return df.unionByName(extra.join(df.select(key), key, "left_anti").select(*df.columns))


def left_join(df: DataFrame, side: DataFrame, on: Column, key: str) -> DataFrame:
    """Left join in which rows without a key do not all meet in one partition.

    A null key matches nothing, so such rows may go anywhere: a second, always equal, key sends them
    by the hash of the row, maps left out.  No broadcast hint: the planner broadcasts a side it knows to be small
    and otherwise shuffles, splitting skewed keys at run time.
    """
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = df.withColumn("_on", on)
    spread = F.when(F.col("_on").isNull(), F.xxhash64(F.lit(0), *hashed)).otherwise(F.lit(0).cast("bigint"))
    # No literal: the optimiser would put it into the condition, where it is no key any more.
    zero = F.xxhash64(key).bitwiseAND(F.lit(0).cast("bigint"))
    return (
        keyed.withColumn("_spread", spread)
        .join(side.withColumn("_zero", zero), (F.col("_on") == F.col(key)) & (F.col("_spread") == F.col("_zero")), "left")
        .drop("_on", "_spread", "_zero")
    )


def lookup(df: DataFrame, dimension: DataFrame, on: str, key: str, value: str, alias: str) -> DataFrame:
    """Left lookup of one column; without a match it is null."""
    side = dimension.select(F.col(key).alias("_key"), F.col(value).alias(alias))
    return left_join(df, side, F.col(on), "_key").drop("_key")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key over all shuffle partitions of the session.

    For rows that are short where they are shuffled and long to work on behind it: left to itself the
    planner merges partitions by their bytes, down to fewer tasks than there are cores to share them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
