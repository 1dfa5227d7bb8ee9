"""Whole paragraphs and titles, on larger tables than the other queries."""

from __future__ import annotations

from compare import compare, data_dir

from folioworks.html.table_function import register_html_nodes
from folioworks.queries.pages import all_paragraphs, paragraph_text


def test_paragraphs_are_whole(spark):
    folder = data_dir("0.01")
    assert compare(spark, "all_paragraphs", folder) is None
    assert all_paragraphs(spark, folder).count() > paragraph_text(spark, folder).count()


def test_titles_of_all_pages(spark):
    assert compare(spark, "title_or_folder", data_dir("0.01")) is None


def test_nodes_in_sql_have_their_own_classes_and_attributes(spark):
    pages = [
        (1, "<p>one</p><div class='card big' id=d><a href='/x' class=far>to <b>x</b></a><a name=n>none</a></div><p class=card>two</p>"),
        (2, "<a href=/y>y</a><p class='card'id=q>z"),  # irregular, read by the lenient parser
        (3, "<script>1<2</script><a href='/z' title=t>z</a>"),  # token by token
        (4, ""), (5, None),
    ]
    spark.createDataFrame(pages, "page_id int, html string").createOrReplaceTempView("few_pages")
    name = register_html_nodes(spark)

    def found(columns, *arguments):
        given = ", ".join(f"'{a}'" for a in arguments)
        rows = spark.sql(f"SELECT page_id, n.pre, {columns} FROM few_pages, LATERAL {name}(html{', ' * bool(given)}{given}) n")
        return sorted(tuple(r) for r in rows.collect())

    assert found("n.text, n.attr_href, n.attr_class", "a .card", "href class") == [
        (1, 2, "to xnone", None, "card big"), (1, 3, "to x", "/x", "far"), (1, 7, "none", None, None), (1, 9, "two", None, "card"),
        (2, 0, "y", "/y", None), (2, 2, "z", None, "card"), (3, 2, "z", "/z", None),
    ]
    assert found("n.tag", ".far .big") == [(1, 2, "div"), (1, 3, "a")]
    assert len(found("n.tag")) == 11 + 4 + 4
