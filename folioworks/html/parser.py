"""Documents to arrays of nodes.

``parse`` adds to every row the column ``nodes``: the elements and texts of the document in
document order.  The descendants of a node are the stretch of the array right behind it, so every
later step is a native array expression inside the row of its document and needs no shuffle.

Parsing is the one step done in Python, batch by batch.  The parser keeps the reading of
malformed markup of a lenient HTML parser: an end tag closes the nearest open element of that name
and all inside it, a stray end tag is ignored, void elements never stay open.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT = "#text"
RAW = "#raw"  # content of script and style, no part of the visible text

# Elements that have no content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont bgsound command frame "
    "image isindex nextid spacer menuitem keygen".split()
)

# The elements that are lists of items.
LISTS = ("ul", "ol")

# Elements that break the line.
BREAKS = ("br", "hr")

# Elements whose white space counts.
KEEP_BLANKS = ("pre", "textarea")

NODE = T.StructType(
    [
        T.StructField("pre", T.IntegerType()),  # position in document order
        T.StructField("last", T.IntegerType()),  # position of the last descendant, or pre
        T.StructField("parent", T.IntegerType()),  # position of the parent, -1 at the top
        T.StructField("nth", T.IntegerType()),  # 0-based rank among siblings with the same tag
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("scopes", T.MapType(T.StringType(), T.IntegerType())),  # label -> nearest enclosing node
        T.StructField("lists", T.IntegerType()),  # number of lists around the node
        # Running counts up to and including the node; what a subtree holds is the difference at its ends.
        T.StructField("texts", T.IntegerType()),  # texts that are not blank
        T.StructField("images", T.IntegerType()),  # img elements
        T.StructField("breaks", T.IntegerType()),  # br and hr elements
        T.StructField("chars", T.IntegerType()),  # characters of text
    ]
)

# Regular markup, which is nearly all there is: words, end tags, start tags with plain attributes,
# simple comments, declarations.  The quantifiers never give back, so a scan is linear.
TOKEN = re.compile(
    r"""(?P<words>[^<]++)
    | </(?P<closed>[a-zA-Z][-a-zA-Z0-9:_]*+)[ \t\n\r\f]*+>
    | <(?P<name>[a-zA-Z][-a-zA-Z0-9:_]*+)
       (?P<attrs>(?:[ \t\n\r\f]++[^\s"'<>/=]++
         (?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>=`]++))?+)*+)
       [ \t\n\r\f]*+(?P<slash>/?+)>
    | (?P<aside><!--(?:[^-]|-(?!-))*+-->|<!(?i:doctype)[^>]*+>)""",
    re.VERBOSE,
)
# A tag or an aside with the words behind it, over which TOKEN then decides.  What is neither takes the rest of the
# document, without a match for the tag, so a scan stays linear.
PIECE = re.compile(r"""<([^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+)>([^<]*+)|<[\s\S]*+""")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>=`]++)))?""")
# What is visible: anything but white space and the blanks that `strip` knows.
VISIBLE = re.compile("[^\\s\u00a0\u2000-\u200a\u202f\u3000]", re.ASCII)
RAW_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.I) for tag in ("script", "style")}


def _value(text: str) -> str:
    return unescape(text) if "&" in text else text


_FLUSH_NODES = 50_000
# Tags written alike are taken apart once, as long as they are short; so many are remembered.
_KNOWN_TAGS = 4_096
_KNOWN_CHARS = 200


class NodeBuilder(HTMLParser):
    """Collects the nodes of any number of documents as flat columns.

    Regular documents go through one regular expression; irregular ones are read again by the
    library's lenient parser, which gives the same nodes for regular ones, only slower.
    """

    CDATA_CONTENT_ELEMENTS = tuple(RAW_END)
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self, track: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.tracked_tags = {t for t in track if not t.startswith(".")}
        self.tracked_classes = {t[1:] for t in track if t.startswith(".")}
        self.known: dict[str, tuple | None] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all documents."""
        self.ends: list[int] = []
        # One entry per node.
        self.last, self.parent, self.nth, self.tag, self.text, self.lists = [], [], [], [], [], []
        # The lists and maps of all nodes one after the other, and which nodes have how many entries.
        self.classes, self.class_at, self.class_n = [], [], []
        self.names, self.values, self.attr_at, self.attr_n = [], [], [], []
        self.labels, self.places, self.scope_at, self.scope_n = [], [], [], []

    def columns(self) -> tuple[list, ...]:
        return (
            self.last, self.parent, self.nth, self.tag, self.text, self.lists, self.classes, self.class_at, self.class_n,
            self.names, self.values, self.attr_at, self.attr_n, self.labels, self.places, self.scope_at, self.scope_n,
        )

    def _begin(self) -> None:
        # Open elements as (position, tag, scopes inside, counts of child tags, lists open inside); the bottom is the document.
        self.open = [(-1, None, {}, {}, 0)]
        self.standing = Counter()  # open elements by tag
        self.in_text = False

    def read(self, html: str | None) -> None:
        """Append one document."""
        self.first = len(self.tag)
        lengths = [len(c) for c in self.columns()]
        self._begin()
        if html and not self._scan(html):
            for column, length in zip(self.columns(), lengths, strict=True):
                del column[length:]
            self._begin()
            self.reset()
            self.feed(html)
            self.close()
        while len(self.open) > 1:
            self._close_top()
        self._end_text()
        self.ends.append(len(self.tag))

    def _taken_apart(self, markup: str) -> tuple | None:
        """What stands between ``<`` and ``>``: name of an end tag, parts of a start tag, empty for an aside.

        None for what is irregular, and for tags whose content is no markup.
        """
        token = TOKEN.fullmatch(f"<{markup}>")
        kind = token and token.lastgroup
        if kind == "slash":
            tag, attrs = token["name"].lower(), token["attrs"]
            if tag in RAW_END:
                return None
            values = {n.lower(): _value(a or b or c) for n, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else {}
            classes = values["class"].split() if "class" in values else None
            opens = tag not in VOID and not token["slash"]
            return tag, tuple(values), tuple(values.values()), classes, opens, self._labels(tag, classes) if opens else ()
        return (token["closed"].lower(),) if kind == "closed" else () if kind == "aside" else None

    def _pieces(self, html: str) -> list[tuple[tuple, str]] | None:
        """The document as tags, each with the words behind it; None if a piece is irregular."""
        known, pieces = self.known, []
        for markup, words in PIECE.findall(html):
            token = known.get(markup)
            if token is None:
                token = self._taken_apart(markup)
                if token is None:
                    return None
                if len(markup) <= _KNOWN_CHARS:
                    if len(known) >= _KNOWN_TAGS:
                        known.clear()
                    known[markup] = token
            pieces.append((token, words))
        return pieces

    def _scan(self, html: str) -> bool:
        """Read regular markup; give up (False) at the first irregular piece.

        Nearly all time of parsing goes by here, so nodes are appended without a call.
        """
        pieces = self._pieces(html)
        if pieces is None:
            return self._scan_tokens(html)
        first, opened, standing = self.first, self.open, self.standing
        last, parent, nth, tags, texts, lists = self.last, self.parent, self.nth, self.tag, self.text, self.lists
        pre, top = 0, opened[-1]
        before = html.partition("<")[0]
        for token, words in [((), before), *pieces] if before else pieces:
            if len(token) > 1:
                tag, names, values, classes, opens, labels = token
                around, _, scopes, counts, depth = top
                rank = counts.get(tag, 0)
                counts[tag] = rank + 1
                last.append(pre)
                parent.append(around)
                nth.append(rank)
                tags.append(tag)
                texts.append(None)
                lists.append(depth)
                if names:
                    self.names.extend(names)
                    self.values.extend(values)
                    self.attr_at.append(first + pre)
                    self.attr_n.append(len(names))
                    if classes is not None:
                        self.classes.extend(classes)
                        self.class_at.append(first + pre)
                        self.class_n.append(len(classes))
                if scopes:
                    self.labels.extend(scopes)
                    self.places.extend(scopes.values())
                    self.scope_at.append(first + pre)
                    self.scope_n.append(len(scopes))
                if opens:
                    if labels:
                        scopes = {**scopes, **dict.fromkeys(labels, pre)}
                    top = (pre, tag, scopes, {}, depth + (tag in LISTS))
                    opened.append(top)
                    standing[tag] = standing.get(tag, 0) + 1
                pre += 1
            elif token:
                tag = token[0]
                if standing.get(tag):
                    name = None
                    while name != tag:
                        place, name = opened.pop()[:2]
                        standing[name] -= 1
                        last[first + place] = pre - 1
                    top = opened[-1]
            if words:
                if "&" in words:
                    words = unescape(words)
                if not words.strip(" \t\n\r\f"):
                    words = self._blank(words)
                around, _, scopes, counts, depth = top
                rank = counts.get(TEXT, 0)
                counts[TEXT] = rank + 1
                last.append(pre)
                parent.append(around)
                nth.append(rank)
                tags.append(TEXT)
                texts.append(words)
                lists.append(depth)
                if scopes:
                    self.labels.extend(scopes)
                    self.places.extend(scopes.values())
                    self.scope_at.append(first + pre)
                    self.scope_n.append(len(scopes))
                pre += 1
        return True

    def _scan_tokens(self, html: str) -> bool:
        """The same token by token, for documents with elements whose content is no markup."""
        match, first, opened, standing = TOKEN.match, self.first, self.open, self.standing
        last, parent, nth, tags, texts, lists = self.last, self.parent, self.nth, self.tag, self.text, self.lists
        at, end, pre, top = 0, len(html), 0, opened[-1]
        while at < end:
            token = match(html, at)
            if token is None:
                return False
            at = token.end()
            kind = token.lastgroup
            if kind == "words":
                tag, values, text = TEXT, None, token["words"]
                if "&" in text:
                    text = unescape(text)
                if not text.strip(" \t\n\r\f"):
                    text = self._blank(text)
            elif kind == "closed":
                tag = token["closed"].lower()
                if standing.get(tag):
                    name = None
                    while name != tag:
                        place, name = opened.pop()[:2]
                        standing[name] -= 1
                        last[first + place] = pre - 1
                    top = opened[-1]
                continue
            elif kind == "slash":
                tag, attrs, text = token["name"].lower(), token["attrs"], None
                values = {n.lower(): _value(a or b or c) for n, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else None
            else:
                continue
            around, _, scopes, counts, depth = top
            rank = counts.get(tag, 0)
            counts[tag] = rank + 1
            last.append(pre)
            parent.append(around)
            nth.append(rank)
            tags.append(tag)
            texts.append(text)
            lists.append(depth)
            if values or scopes:
                self._entries(first + pre, values, scopes)
            if text is None and tag not in VOID and not token["slash"]:
                top = self._open(pre, tag, values)
                if tag in RAW_END:
                    close = RAW_END[tag].search(html, at)
                    if close is None:
                        return False
                    if close.start() > at:
                        self.handle_data(html[at : close.start()])
                    self.handle_endtag(tag)
                    at, pre, top = close.end(), len(tags) - first - 1, opened[-1]
            pre += 1
        return True

    def _blank(self, text: str) -> str:
        """A text of blanks alone shrinks to one newline or one space, except in preformatted text."""
        if any(self.standing.get(tag) for tag in KEEP_BLANKS):
            return text
        return "\n" if "\n" in text else " "

    def _end_text(self) -> None:
        if self.in_text:
            self.in_text = False
            text = self.text[-1]
            if not text.strip(" \t\n\r\f"):
                self.text[-1] = self._blank(text)

    def _append(self, tag, text, attrs=None) -> int:
        self._end_text()
        at, _, scopes, counts, lists = self.open[-1]
        nth = counts.get(tag, 0)
        counts[tag] = nth + 1
        pre = len(self.tag) - self.first
        self.last.append(pre)
        self.parent.append(at)
        self.nth.append(nth)
        self.tag.append(tag)
        self.text.append(text)
        self.lists.append(lists)
        self._entries(self.first + pre, attrs, scopes)
        return pre

    def _entries(self, node: int, attrs: dict | None, scopes: dict) -> None:
        """The classes, attributes and scopes of a node."""
        if attrs:
            self.names.extend(attrs)
            self.values.extend(attrs.values())
            self.attr_at.append(node)
            self.attr_n.append(len(attrs))
            if "class" in attrs:
                classes = attrs["class"].split()
                self.classes.extend(classes)
                self.class_at.append(node)
                self.class_n.append(len(classes))
        if scopes:
            self.labels.extend(scopes)
            self.places.extend(scopes.values())
            self.scope_at.append(node)
            self.scope_n.append(len(scopes))

    def _labels(self, tag: str, classes: list[str] | None) -> list[str]:
        """Which of the tracked tags and classes an element is."""
        labels = [tag] if tag in self.tracked_tags else []
        if classes and self.tracked_classes:
            labels += [f".{c}" for c in classes if c in self.tracked_classes]
        return labels

    def _open(self, pre: int, tag: str, values: dict | None) -> tuple:
        """Put an element on top of the open ones."""
        around = self.open[-1]
        scopes = around[2]
        labels = self._labels(tag, values["class"].split() if values and "class" in values else None)
        if labels:
            scopes = {**scopes, **dict.fromkeys(labels, pre)}
        top = (pre, tag, scopes, {}, around[4] + (tag in LISTS))
        self.open.append(top)
        self.standing[tag] = self.standing.get(tag, 0) + 1
        return top

    def _close_top(self) -> None:
        self._end_text()
        pre, tag = self.open.pop()[:2]
        self.standing[tag] -= 1
        self.last[self.first + pre] = len(self.tag) - self.first - 1

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        values = {name: value or "" for name, value in attrs} if attrs else None
        pre = self._append(tag, None, values)
        if tag not in VOID:
            self._open(pre, tag, values)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_top()

    def handle_endtag(self, tag):
        self._end_text()
        if self.standing[tag]:
            while self.open[-1][1] != tag:
                self._close_top()
            self._close_top()

    def handle_data(self, data):
        raw = self.open[-1][1] in self.CDATA_CONTENT_ELEMENTS
        if self.in_text and not raw:
            self.text[-1] += data  # one run of text may arrive in pieces
        else:
            self._append(RAW if raw else TEXT, data)
            self.in_text = not raw

    def handle_comment(self, data):
        self._end_text()

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()

    def _running(self, ends: np.ndarray, asked: Sequence[str]) -> dict[str, pa.Array]:
        """Running counts, each starting anew with its document."""
        n = len(self.tag)
        if not set(asked) & {"texts", "images", "breaks", "chars"}:
            return {}
        coded = pa.array(self.tag, pa.string()).dictionary_encode()
        codes, known = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()

        def tagged(*names):
            return np.isin(codes, [i for i, name in enumerate(known) if name in names])

        def of_texts(measure):
            places = np.flatnonzero(tagged(TEXT))
            counts = np.zeros(n, np.int32)
            counts[places] = np.fromiter((measure(self.text[i]) for i in places.tolist()), np.int32, len(places))
            return counts

        marks = {
            "texts": lambda: of_texts(lambda x: VISIBLE.search(x) is not None),
            "images": lambda: tagged("img"),
            "breaks": lambda: tagged(*BREAKS),
            "chars": lambda: of_texts(len),
        }
        running = {}
        for name in marks.keys() & set(asked):
            total = np.concatenate([[0], np.cumsum(marks[name](), dtype=np.int64)])
            running[name] = pa.array((total[1:] - np.repeat(total[ends[:-1]], np.diff(ends))).astype(np.int32))
        return running

    def column(self, asked: Sequence[str] = tuple(NODE.names)) -> pa.ListArray:
        """All documents as one Arrow array of node lists, with the fields asked for."""
        ends = np.asarray([0, *self.ends], dtype=np.int32)

        def offsets(nodes, counts):
            stops = np.zeros(len(self.tag) + 1, dtype=np.int32)
            stops[np.asarray(nodes, dtype=np.int64) + 1] = counts
            return pa.array(np.cumsum(stops, dtype=np.int32))

        def strings(values):
            return pa.array(values, pa.string())

        def scopes():
            places = pa.array(self.places, pa.int32())
            return pa.MapArray.from_arrays(offsets(self.scope_at, self.scope_n), strings(self.labels), places)

        running = self._running(ends, asked)
        made = {
            "pre": lambda: pa.array(np.arange(ends[-1], dtype=np.int32) - np.repeat(ends[:-1], np.diff(ends))),
            "last": lambda: pa.array(self.last, pa.int32()),
            "parent": lambda: pa.array(self.parent, pa.int32()),
            "nth": lambda: pa.array(self.nth, pa.int32()),
            "tag": lambda: strings(self.tag),
            "classes": lambda: pa.ListArray.from_arrays(offsets(self.class_at, self.class_n), strings(self.classes)),
            "attrs": lambda: pa.MapArray.from_arrays(
                offsets(self.attr_at, self.attr_n), strings(self.names), strings(self.values)
            ),
            "text": lambda: strings(self.text),
            "scopes": scopes,
            "lists": lambda: pa.array(self.lists, pa.int32()),
        }
        names = [name for name in NODE.names if name in asked]
        nodes = pa.StructArray.from_arrays([running[x] if x in running else made[x]() for x in names], names=names)
        return pa.ListArray.from_arrays(pa.array(ends), nodes)


def parse(
    df: DataFrame, html: str = "html", track: Sequence[str] = (), fields: Sequence[str] = tuple(NODE.names)
) -> DataFrame:
    """Replace the ``html`` column by ``nodes``; all other columns pass through.

    ``track`` names tags (``li``) or classes (``.tab``) whose nearest enclosing element every node
    should know, as ``scopes``.  ``fields`` are those of a node that are read later: the planner
    cannot tell, and each one is made here and moved with all nodes.
    """
    unknown = set(fields) - set(NODE.names)
    if unknown:
        raise ValueError(f"no such fields of a node: {sorted(unknown)}")
    node = T.StructType([f for f in NODE.fields if f.name in fields])
    kept = [c for c in df.columns if c != html]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField("nodes", T.ArrayType(node))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = NodeBuilder(track)
        for batch in batches:
            start = 0
            texts = batch.column(len(kept))
            for row, value in enumerate(texts):
                builder.read(value.as_py())
                # Short output batches keep memory even however long the documents are.
                if len(builder.tag) >= _FLUSH_NODES or row == len(texts) - 1:
                    columns = [batch.column(i).slice(start, row + 1 - start) for i in range(len(kept))]
                    yield pa.RecordBatch.from_arrays([*columns, builder.column(fields)], names=[*kept, "nodes"])
                    builder.clear()
                    start = row + 1

    return df.select(*kept, html).mapInArrow(run, schema)


# Send this module along with the tasks, so that the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
