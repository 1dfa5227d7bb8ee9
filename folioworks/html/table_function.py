"""Documents to nodes as a table function for SQL: ``SELECT ... FROM pages, LATERAL html_nodes(html, 'a')``.

The function takes a document and a list of tags or classes (``.card``) as a constant; empty means all.
It gives a row per matching node, as selecting on parsed documents does, with the text of its subtree.
Its ``analyze`` checks the arguments while the query is planned and leaves out the columns of attributes
that no list of names asks for, so the rows carry only what is wanted.
"""

from __future__ import annotations

import sys
from itertools import accumulate

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf

from folioworks.html import parser
from folioworks.html.parser import TEXT, NodeBuilder

FIXED = [("pre", T.IntegerType()), ("last", T.IntegerType()), ("parent", T.IntegerType()), ("tag", T.StringType()), ("text", T.StringType())]


def _names(argument: AnalyzeArgument | None, what: str) -> list[str]:
    if argument is None:
        return []
    if not argument.isConstantExpression or argument.dataType != T.StringType():
        raise ValueError(f"the {what} must be a constant text, names separated by blanks")
    return (argument.value or "").split()


def _by_node(entries: list, nodes: list[int], counts: list[int]) -> dict[int, list]:
    """The entries of each node that has any."""
    return {node: entries[end - n : end] for node, n, end in zip(nodes, counts, accumulate(counts), strict=True)}


class HtmlNodes:
    """``html_nodes(html, selectors, attributes)``; each attribute asked for is a column ``attr_<name>``."""

    @staticmethod
    def analyze(html: AnalyzeArgument, selectors: AnalyzeArgument | None = None, attributes: AnalyzeArgument | None = None) -> AnalyzeResult:
        if html.dataType != T.StringType():
            raise ValueError("the document must be a text")
        _names(selectors, "selectors")
        schema = T.StructType([T.StructField(n, t) for n, t in FIXED])
        for name in _names(attributes, "attributes"):
            schema.add(f"attr_{name.replace('-', '_')}", T.StringType())
        return AnalyzeResult(schema)

    def __init__(self) -> None:
        self.builder = NodeBuilder(())

    def eval(self, html: str, selectors: str = "", attributes: str = ""):
        built = self.builder
        built.clear()
        built.read(html)
        wanted = set((selectors or "").split())
        names = (attributes or "").split()
        pieces = [x if t == TEXT else "" for t, x in zip(built.tag, built.text, strict=True)]
        classes = _by_node(built.classes, built.class_at, built.class_n)
        held_names, held_values = (_by_node(x, built.attr_at, built.attr_n) for x in (built.names, built.values))
        for pre, tag in enumerate(built.tag):
            if wanted and tag not in wanted and not any(f".{c}" in wanted for c in classes.get(pre, ())):
                continue
            held = dict(zip(held_names.get(pre, ()), held_values.get(pre, ()), strict=True)) if names else {}
            last = built.last[pre]
            yield (pre, last, built.parent[pre], tag, "".join(pieces[pre : last + 1]), *[held.get(n) for n in names])


def register_html_nodes(spark: SparkSession, name: str = "html_nodes") -> str:
    """Make the function known to the session's SQL; batches go to it as Arrow."""
    spark.udtf.register(name, udtf(HtmlNodes, useArrow=True))
    return name


# Send these modules along with the tasks, so that the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(parser)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
