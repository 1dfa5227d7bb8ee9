"""Reading landed API payloads, configuration lists, files and hierarchies."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import islice
from json import loads

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.functions.links import file_type
from folioworks.operators.quality import require_none


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def missing_pages(pages: DataFrame) -> DataFrame:
    """Gaps in ``pages(page, total_pages)``: how many pages were announced, and how many of these numbers are there.

    No page at all is a gap, too: even an empty resource has a page that says so.
    """
    announced = F.max("total_pages").alias("announced")
    landed = F.count_distinct(F.when(F.col("page").between(1, F.col("total_pages")), F.col("page"))).alias("landed")
    return pages.agg(landed, announced, F.max("page").alias("last")).filter(
        F.col("announced").isNull() | (F.col("landed") != F.col("announced")) | (F.col("last") > F.col("announced"))
    ).drop("last")


def scan_paged(spark: SparkSession, path: str, item: str, *, check: bool = True) -> DataFrame:
    """Items of all pages of a resource, landed as one JSON object ``{page, total_pages, items}`` per page.

    ``item`` names the fields of an item with their types.  Pages may have been fetched more than
    once; the page numbers still have to be complete.
    """
    schema = f"page bigint, total_pages bigint, items array<struct<{item}>>"
    pages = spark.read.schema(schema).json(path)
    if check:
        require_none(missing_pages(pages.select("page", "total_pages")), "pages are missing")
    return pages.select("page", F.inline("items"))


def flatten(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Nested fields as columns: ``{"title": "title.rendered"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def child_rows(df: DataFrame, parent: str, column: str, *, keep_empty: bool = False) -> DataFrame:
    """One row per list element with its position; ``keep_empty`` keeps parents without elements."""
    expand = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(F.col(parent).alias("parent_id"), expand(column).alias("idx", "value"))


def scan_config(spark: SparkSession, path: str, outer: str, resource: str, *, multi_line: bool = False) -> DataFrame:
    """Entries ``{outer, resources: [...]}`` with their resources still nested.

    One entry per line by default; a hand-written file holding one JSON list needs ``multi_line``.
    """
    schema = f"{outer} string, resources array<struct<{resource}>>"
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def resources(config: DataFrame, outer: str) -> DataFrame:
    """One row per resource, its entry's column carried along."""
    return config.select(outer, F.inline("resources"))


def expected_resources(config: DataFrame) -> DataFrame:
    """How many resources a configuration lists in all."""
    return config.agg(F.sum(F.size("resources")).alias("expected"))


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed files with their bytes."""
    return spark.read.format("binaryFile").load(path)


def scan_sheet(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A lookup sheet saved as one CSV file, with ``pos`` for the order of its lines."""
    rows = spark.read.schema(columns).csv(path, header=True)
    return rows.withColumn("pos", F.monotonically_increasing_id())


def with_file_type(df: DataFrame, content_type: str) -> DataFrame:
    return df.withColumn("file_type", file_type(F.col(content_type)))


def tree_rows(documents: DataFrame, tree: str, json: str, attributes: list[str]) -> DataFrame:
    """Nested JSON hierarchies, one per row, as adjacency rows; the first attribute is a node's id.

    One pass over each text, token by token, for any depth: nothing recurs and no subtree is written out
    again.  A node's children wait for its id, which may stand behind them; nothing else is held.
    ``ordinal`` is the rank among siblings.  Text that is no JSON is an error that names the tree.
    """
    picked = documents.select(F.col(tree).alias("tree_id"), F.col(json).alias("json"))
    strings = [T.StructField(a, T.StringType()) for a in attributes]
    numbers = [T.StructField(n, T.IntegerType()) for n in ("depth", "ordinal")]
    schema = T.StructType([picked.schema["tree_id"], T.StructField("parent_id", T.StringType()), *numbers, *strings])
    types = [pa.string(), pa.int32(), pa.int32(), *[pa.string()] * len(attributes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                text = batch.column(1)[place].as_py()
                found = walk_tree(text, attributes, batch.column(0)[place].as_py()) if text is not None else iter(())
                while rows := list(islice(found, _ROWS)):
                    ids = batch.column(0).take(pa.array([place] * len(rows)))
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    return picked.mapInArrow(run, schema)


#: Rows of a tree that go out together.
_ROWS = 20_000
_TOKEN = re.compile(r'[ \t\r\n]*+(?:([{}\[\],:])|("(?:[^"\\]++|\\.)*+")|([^ \t\r\n{}\[\],:"]++))', re.DOTALL)


def _plain(token: str) -> str | None:
    """A scalar as text; null is null."""
    value = loads(token, strict=False)
    return value if isinstance(value, str) else None if value is None else token


def walk_tree(text: str, attributes: list[str], name: object = None) -> Iterator[tuple]:
    """``(parent id, depth, ordinal, *attributes)`` of all nodes of a nested JSON text, children once their parent is complete."""
    wanted = {a: i for i, a in enumerate(attributes)}
    opened: list[list] = []  # nodes that are open: values, rows of their children, whether in their list of children
    root: list | None = None
    at, key, start, inner = 0, None, 0, 0  # inner: brackets open in a value that is no list of children
    expected = "value"
    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            break
        sign, quoted, other = token.groups()
        begin, at = token.start(token.lastindex), token.end()
        if inner:
            inner += (sign in ("{", "[")) - (sign in ("}", "]"))
            if not inner:
                if key in wanted:
                    opened[-1][0][wanted[key]] = text[start:at]
                expected = "end"
        elif expected == "value" and (quoted or other) and opened and not opened[-1][2]:
            value = _plain(quoted or other)
            if key in wanted:
                opened[-1][0][wanted[key]] = value
            expected = "end"
        elif expected in ("value", "first") and sign == "{" and (opened and opened[-1][2] or not opened and root is None):
            opened.append([[None] * len(attributes), [], False])
            expected = "key or close"
        elif expected == "value" and sign == "[" and key == "children" and not opened[-1][2]:
            opened[-1][2], expected = True, "first"
        elif expected == "value" and sign in ("{", "[") and opened and not opened[-1][2]:
            start, inner = begin, 1
        elif expected in ("key", "key or close") and quoted:
            key, expected = loads(quoted, strict=False), "colon"
        elif expected == "colon" and sign == ":":
            expected = "value"
        elif expected == "end" and sign == ",":
            expected = "value" if opened[-1][2] else "key"
        elif sign == "]" and expected in ("end", "first") and opened and opened[-1][2]:
            opened[-1][2], expected = False, "end"
        elif sign == "}" and expected in ("end", "key or close") and opened and not opened[-1][2]:
            values, children, _ = opened.pop()
            depth = len(opened)
            for ordinal, child in enumerate(children):
                yield (values[0], depth + 1, ordinal, *child)
            if opened:
                opened[-1][1].append(values)
                expected = "end"
            else:
                root, expected = values, "nothing"
        else:
            raise ValueError(f"tree {name}: unexpected {token.group().strip()!r} at character {begin}")
    if root is None or text[at:].strip():
        raise ValueError(f"tree {name}: the text ends or cannot be read at character {at}")
    yield (None, 0, 0, *root)


# Send this module along with the tasks, so that the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
