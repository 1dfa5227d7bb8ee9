"""Selecting in a document: all helpers are expressions over the ``nodes`` array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import strip
from folioworks.html.parser import TEXT

Test = Callable[[Column], Column]


def is_tag(*tags: str) -> Test:
    return lambda n: n["tag"].isin(*tags)


def has_class(name: str, *tags: str) -> Test:
    """One class out of the list; a name with blanks must be the whole class attribute."""
    def test(n: Column) -> Column:
        if " " in name:
            found = F.array_join(n["classes"], " ") == name
        else:
            found = F.array_contains(n["classes"], name)
        return found & n["tag"].isin(*tags) if tags else found

    return test


def has_attr(name: str, *tags: str) -> Test:
    def test(n: Column) -> Column:
        found = F.map_contains_key(n["attrs"], name)
        return found & n["tag"].isin(*tags) if tags else found

    return test


def let(value: Column, body: Test) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def subtree(nodes: Column, node: Column) -> Column:
    """The node and its descendants, given an array that holds them all."""
    start = node["pre"] - F.get(nodes, F.lit(0))["pre"] + 1
    return F.slice(nodes, start, node["last"] - node["pre"] + 1)


def descendants(nodes: Column, node: Column) -> Column:
    start = node["pre"] - F.get(nodes, F.lit(0))["pre"] + 2
    return F.slice(nodes, start, node["last"] - node["pre"])


def at(nodes: Column, pre: Column) -> Column:
    """The node at a position, null if it lies outside the array."""
    offset = pre - F.get(nodes, F.lit(0))["pre"]
    return F.when(offset >= 0, F.get(nodes, offset))


def enclosing(marked: Column, node: Column) -> Column:
    """Of some nodes in document order, the nearest that encloses a node; null if none does.

    Intervals say it: an enclosing node begins before and ends no earlier, and of those the nearest
    begins last.  So any test will do, whatever the parser was told to track.
    """
    around = F.filter(marked, lambda m: (m["pre"] < node["pre"]) & (m["last"] >= node["last"]))
    return let(around, lambda found: F.get(found, F.size(found) - 1))


def find_all(nodes: Column, test: Test) -> Column:
    return F.filter(nodes, test)


def find(nodes: Column, test: Test) -> Column:
    return F.get(F.filter(nodes, test), F.lit(0))


def text_of(nodes: Column) -> Column:
    """All visible text of a stretch of nodes."""
    return F.array_join(F.transform(F.filter(nodes, lambda n: n["tag"] == TEXT), lambda n: n["text"]), "")


def stripped_text_of(nodes: Column) -> Column:
    """The same with every piece of text stripped before joining."""
    return F.array_join(
        F.transform(F.filter(nodes, lambda n: n["tag"] == TEXT), lambda n: strip(n["text"])), ""
    )


def text_at(nodes: Column, node: Column) -> Column:
    return text_of(subtree(nodes, node))


def node_table(documents: DataFrame, doc: str) -> DataFrame:
    """One row per node."""
    return documents.select(doc, F.inline("nodes"))


def select_nodes(documents: DataFrame, keep: list[str], test: Test, skip: int = 0) -> DataFrame:
    """One row per matching ``node``, with its subtree as ``sub``; the first ``skip`` of a document left out.

    The filter runs inside the array, so only matching nodes ever become rows.
    """
    matched = F.filter("nodes", test)
    if skip:
        matched = F.slice(matched, skip + 1, F.size(matched))
    pairs = F.transform(matched, lambda n: F.struct(n.alias("node"), subtree(F.col("nodes"), n).alias("sub")))
    return documents.select(*keep, F.inline(pairs))


def anchors(documents: DataFrame, doc: str, test: Test | None = None) -> DataFrame:
    """Links with an address: position, address, text."""
    linked = has_attr("href", "a")
    rows = select_nodes(documents, [doc], linked if test is None else lambda n: linked(n) & test(n))
    return rows.select(
        doc,
        F.col("node.pre").alias("pos"),
        F.col("node.attrs")["href"].alias("href"),
        text_of(F.col("sub")).alias("text"),
    )


def page_title(nodes: Column) -> Column:
    """The stripped text of the first title element, null without one."""
    return let(find(nodes, is_tag("title")), lambda t: F.when(t.isNotNull(), strip(text_of(descendants(nodes, t)))))


def content_area(nodes: Column, area_class: Column) -> Column:
    """The subtree of the first node with the class, or of ``body`` when no class is asked for.

    Null when the document has no such area.
    """
    wanted = F.get(
        F.filter(
            nodes,
            lambda n: F.when(area_class.isNull(), n["tag"] == "body").otherwise(
                F.array_contains(n["classes"], area_class)
            ),
        ),
        F.lit(0),
    )
    return let(wanted, lambda n: F.when(n.isNotNull(), subtree(nodes, n)))
