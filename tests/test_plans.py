"""The shape of physical plans: no cross joins, no Python but the parser, narrow scans."""

from __future__ import annotations

import re

import pytest
from compare import data_dir

from folioworks.queries import QUERIES

# Queries that write or look at something while they are built are planned as they run; all others here.
PARSED = {
    "anchors", "area_extract", "chapter_links", "council_list", "distinct_links", "fallback_title", "headline", "link_headlines", "post_enriched",
    "glossary_terms", "guide_pages", "html_markdown", "html_nodes", "html_sanitize", "html_scope", "labelled_link", "legal_texts",
    "nav_tree", "nth_element", "page_title", "paragraph_text", "related_items", "sanitized_text", "scoped_attr", "section_counts",
    "section_orphans", "sections", "select_class", "unknown_widgets", "all_paragraphs", "title_or_folder", "enclosing_widget", "tree_from_json",
    "markdown_shapes", "sanitize_shapes",
}
# The table function is a Python step of its own kind.
IN_SQL = {"html_nodes_sql"}


def plan(spark, name):
    df = QUERIES[name](spark, data_dir("0.001"))
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python_outside_the_parser(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text.replace("ArrowEvalPythonUDTF", ""))
    assert ("ArrowEvalPythonUDTF" in text) == (name in IN_SQL)
    assert ("MapInArrow" in text) == (name in PARSED)


# Windows over a hot key would put it into one task: only these run any, over blocks or summaries.
WINDOWED = {"nav_levels", "nav_hierarchy", "guide_pages", "associated_owners", "category_owners", "preorder", "sample_k"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_windows_only_where_they_are_bounded(spark, name):
    assert ("Window" in plan(spark, name)) <= (name in WINDOWED)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("top_values", "o_custkey"),
        ("day_trunc", "ts"),
        ("expect_rows", "conv_id,turn"),
        ("graph_degree", "o_orderkey,o_custkey"),
        ("url_predicate", "o_orderkey,o_custkey,o_orderdate"),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    found = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, name))
    read = {",".join(re.sub(r"#\d+L?", "", c) for c in f.split(",")) for f in found}
    assert read == {columns}


def test_filters_reach_the_scan(spark):
    text = plan(spark, "link_filter")
    assert "StringContains(url,example.com)" in text


def test_copies_are_counted_before_the_shuffle(spark):
    text = plan(spark, "list_keep_nulls")
    assert "partial_count(1)" in text and text.index("partial_collect_list") < text.index("partial_count(1)")
