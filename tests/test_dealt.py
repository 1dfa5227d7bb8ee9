"""Pages that are short to shuffle and long to parse are parsed in all shuffle partitions."""

from __future__ import annotations

import pytest

from folioworks.operators.tables import dealt
from folioworks.queries import QUERIES, articles


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("orders")
    orders = spark.range(1000).selectExpr("id AS o_orderkey", "id AS o_custkey")
    lines = spark.range(3000).selectExpr("id DIV 3 AS l_orderkey", "CAST(id % 3 AS INT) AS l_linenumber", "id AS l_partkey")
    orders.write.parquet(f"{at}/orders.parquet")
    lines.write.parquet(f"{at}/lineitem.parquet")
    return str(at)


def test_dealt_rows_stay_in_all_partitions(spark):
    rows = dealt(spark.range(1000), "id").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(rows) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(rows) == 1000


def test_articles_and_navigation_are_parsed_in_all_partitions(spark, folder):
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert articles.documents(spark, folder, ("pre",)).rdd.getNumPartitions() == asked
    assert QUERIES["nav_tree"](spark, folder).rdd.getNumPartitions() == asked


@pytest.mark.parametrize("name", ["markdown_shapes", "sanitize_shapes"])
def test_shapes_are_parsed_in_all_partitions(spark, folder, name):
    rows = QUERIES[name](spark, folder).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(rows) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(rows) == 1000


def test_navigation_of_orders(spark, folder):
    found = QUERIES["nav_tree"](spark, folder).filter("page = 4 AND (node_id IN ('o404', 'o405') OR parent_id IN ('o404', 'o405'))")
    assert sorted((r.node_id, r.parent_id, r.level, r.name) for r in found.collect()) == [
        *[(f"l{o}-{n}", f"o{o}", "2", f"Line {n}") for o in (404, 405) for n in range(3)],
        ("o404", None, "1", "Order 404"), ("o405", None, "1", "Untitled"),
    ]
