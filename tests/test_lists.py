from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioworks.operators.lists import gather, join_text, list_counts
from folioworks.operators.tables import (
    add_missing,
    first_per_key,
    last_per_key,
    left_join,
    sample_with_replacement,
    with_row_index,
)


def hot(spark, n=3000):
    """One key with two thirds of all rows, half of them copies of one value, and some nulls."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).cast("bigint").alias("v"),
    )


@pytest.mark.parametrize("keep_nulls", [True, False])
@pytest.mark.parametrize("distinct", [True, False])
def test_lists_of_hot_keys_are_whole(spark, keep_nulls, distinct):
    rows = hot(spark)
    expected = defaultdict(Counter)
    for r in rows.collect():
        if r.v is not None or keep_nulls:
            expected[r.k][r.v] += 1
    if distinct:
        expected = {k: Counter(dict.fromkeys(c, 1)) for k, c in expected.items()}
    lists = gather(rows, ["k"], "v", alias="vs", keep_nulls=keep_nulls, distinct=distinct, count_alias="n").collect()
    got, totals = defaultdict(Counter), Counter()
    for r in lists:
        got[r.k].update(r.vs)
        totals[r.k] += r.n
        assert r.vs == sorted(r.vs, key=lambda x: (x is not None, x or 0))
    assert got == expected
    assert totals == Counter(r.k for r in rows.collect())
    assert len({r.k for r in lists}) == len(lists)


def test_copies_of_one_entry_stay_in_one_list(spark):
    rows = spark.range(1000).select(F.lit("k").alias("k"), F.lit(7).alias("v"))
    assert [(r.k, r.vs) for r in gather(rows, ["k"], "v", alias="vs").collect()] == [("k", [7] * 1000)]


def test_null_only_and_missing_lists(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, v string")
    dropped = {r.k: r.vs for r in gather(rows, ["k"], "v", alias="vs").collect()}
    kept = {r.k: r.vs for r in gather(rows, ["k"], "v", alias="vs", keep_nulls=True).collect()}
    assert dropped == {1: [], 2: ["a"]}
    assert kept == {1: [None, None], 2: ["a"]}


def test_text_is_joined_in_order(spark):
    rows = spark.range(250).select(F.lit("t").alias("k"), F.col("id").alias("pos"), F.col("id").cast("string").alias("s"))
    joined = join_text(rows, ["k"], "pos", "s", alias="text").collect()
    assert [r.text for r in joined] == ["".join(f"{i}\n" for i in range(250))]


def test_list_counts_skip_null_lists(spark):
    rows = spark.createDataFrame([(["a", "b"],), (["a", None],), (None,), ([],)], "xs array<string>")
    assert [tuple(r) for r in list_counts(rows, "xs").collect()] == [("a", 2), (None, 1), ("b", 1)]


def test_row_index_is_gapless_and_sample_is_repeatable(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"))
    indexed = with_row_index(rows, ["x"]).collect()
    assert sorted((r.idx, r.x) for r in indexed) == [(i, i) for i in range(1000)]
    first = [tuple(r) for r in sample_with_replacement(rows, ["x"], 2000, 5).orderBy("draw").collect()]
    again = [tuple(r) for r in sample_with_replacement(rows, ["x"], 2000, 5).orderBy("draw").collect()]
    assert first == again and len(first) == 2000
    assert len({x for _, x in first}) < 1000  # with replacement
    with pytest.raises(ValueError):
        sample_with_replacement(rows.filter("x < 0"), ["x"], 1, 5)


@pytest.mark.parametrize("n", [1, 50, 30_000])
def test_draws_are_places_in_the_order(spark, n):
    """Against the sorted rows themselves; copies, nulls and two keys."""
    rows = [(None if i % 7 == 0 else i // 3, f"k{i % 3}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "x bigint, y string, id int")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    drawn = sample_with_replacement(df.select("x", "y"), ["x", "y"], 300, 5).collect()
    assert sorted(r.draw for r in drawn) == list(range(300))
    for r in drawn:
        at = int(hashlib.md5(f"5-{r.draw}".encode()).hexdigest()[:15], 16) % n
        assert (r.x, r.y) == order[at][:2]


def test_picks(spark):
    rows = spark.createDataFrame([("u", 3, "c"), ("u", 1, "a"), ("w", 2, None), ("w", 1, "x")], "k string, p int, v string")
    assert {tuple(r) for r in first_per_key(rows, ["k"], ["p"], ["v"]).collect()} == {("u", "a"), ("w", "x")}
    assert {tuple(r) for r in last_per_key(rows, "k", "p", ["v"]).collect()} == {("u", 1, "c"), ("w", 1, None)}


def test_add_missing_twice_changes_nothing(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    extra = spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string")
    once = add_missing(base, extra, "k")
    assert sorted(map(tuple, add_missing(once, extra, "k").collect())) == [(1, "a"), (2, "b")]


def test_left_join_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    side = spark.createDataFrame([("a", 10), (None, 99)], "key string, x int")
    got = left_join(rows, side, F.col("k"), "key").select("id", "x").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, 10), (3, None), (4, None)]


def test_rows_without_a_key_are_in_many_partitions(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") < 5, F.col("id")).alias("k"))
    side = spark.createDataFrame([(1, 10), (None, 99)], "key bigint, x int").groupBy("key").agg(F.min("x").alias("x"))
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = left_join(rows, side, F.col("k"), "key").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sorted((r.id, r.x) for r in got) == [(i, 10 if i == 1 else None) for i in range(2000)]
    assert len({r.part for r in got if r.k is None}) == 4


def test_left_join_takes_rows_with_maps(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', map('x', 1)), (2, NULL, map('y', 2)) AS t(id, k, m)")
    side = spark.createDataFrame([("a", 5)], "key string, x int")
    got = left_join(rows, side, F.col("k"), "key").select("id", "x", "m").collect()
    assert sorted((r.id, r.x, r.m) for r in got) == [(1, 5, {"x": 1}), (2, None, {"y": 2})]
