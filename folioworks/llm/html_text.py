"""Main text of web pages: the page's own marks, and a suffix array over each host.

A page is cut into blocks.  What stands in scripts, styles, forms, menus, headers, footers, side bars,
notices, adverts and reader comments, by element, role or class, is never main text; class words and ids do
not drop html, body, main, article or an element that contains a marked article, and names that tell a
state, as ``has-sidebar`` does, drop nothing.  Within an article only whole class names count, no parts and no ids.  Where a page marks its article (``article``, ``main`` or an
article body; of several kinds the one with most text of its own), the rest of that is the main text.

Where it does not, the host decides.  The token streams of a host's distinct pages are laid end to end and
their suffixes sorted by their first ``RUN`` tokens; neighbours that agree in all of them are long
substrings, counted by the distinct pages they occur on.  Tokens covered by a substring of ``PAGES``
distinct pages or more, and of ``RUN_SHARE`` in a hundred of the host's, are boilerplate, unique runs stay.
A host's pages are dealt into shards of bounded size with a suffix array each.  What reaches the share on a
host reaches it in one of its shards; those substrings are then counted in all shards, so the counts are
those of the whole host.

Blocks of marked articles are judged by the same array, but whole: one goes where substrings on
``BLOCK_PAGES`` distinct pages and on ``BLOCK_SHARE`` in a hundred cover all its tokens, so passages that some
articles quote stay.  An article that would lose all its blocks keeps them: the page's own mark stands.

Defined cases: a null or empty html has an empty text and is no page that counts;
pages whose blocks have the same texts are one distinct page of their host, and each gets its text; a host
of less than ``PAGES`` distinct pages keeps all; a null url is a host of its own; other columns are
ignored; markup may be broken anywhere, unclosed elements end with the one around them.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value
from folioworks.llm.decontaminate import WordHashes, shingle_hashes
from folioworks.session import written

RUN = 8
PAGES = 3
#: A repeated run is boilerplate where so many of a hundred distinct pages of its host hold it.
RUN_SHARE = 20
#: A whole block of a marked article goes only where runs on so many distinct pages, and on so many of a
#: hundred, cover all of it: a headline that a few pages have as a teaser is no boilerplate.
BLOCK_PAGES = 12
BLOCK_SHARE = 50
SHARD_PAGES = 512

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody tfoot thead tr ul""".split()
)
_GAPS = frozenset("br td th wbr img".split())
#: Elements whose text is never main text; ``header`` only outside an article.
_NEVER = frozenset("head script style template noscript iframe object svg canvas form button select textarea nav footer aside menu dialog".split())
_NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_NEVER_CLASSES = frozenset(
    """nav navbar navigation menu menubar footer sidebar sidebars ad ads advert adverts advertisement advertising adsense sponsor
    sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription
    share sharing social breadcrumb breadcrumbs comment comments disqus related recommended pagination pager login signup
    skip masthead copyright""".split()
)
_NEVER_OUTSIDE = frozenset("header banner".split())
#: Parts of a name that tell how a page is laid out, not what the element is.
_STATES = frozenset("has have no not with without is layout open opened closed enabled disabled".split())
#: What names never drop, and the names by which an article is a reader's comment.
_WHOLE = frozenset("html body main article".split())
_COMMENT_CLASSES = frozenset("comment comments comment-body".split())
_BODY_CLASSES = frozenset("article-body article-content entry-content post-content post-body story-body articlebody".split())
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>)""", re.S)
#: A tag whose quotes do not match ends at the next bracket.
_BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_SPACE = re.compile(r"\s+")
_DROP = -1
#: Within these marks, a part of a name says nothing: an article may be about shares, notices and social history.
_ARTICLE = 1 << 3 | 1 << 1


def _names_in(words: frozenset[str], names: list[str]) -> bool:
    """Whether a name is one of the words, or else has one as a part and tells no state."""
    if not words.isdisjoint(names):
        return True
    parts = [re.split("[-_]", n) for n in names]
    return any(not words.isdisjoint(p) and _STATES.isdisjoint(p) for p in parts)


def _marks(tag: str, attrs: str) -> tuple[bool, tuple[bool, bool], bool, bool, int]:
    """Whether the element is never main text; is not by a whole class, or by a part of a name; and (both) outside an article; its rank as an article, 0 for a comment."""
    never, rank, names, classes = tag in _NEVER, {"article": 3, "main": 2}.get(tag, -1), [], []
    if attrs and not attrs.isspace():
        for name, *values in _ATTR.findall(attrs):
            name, value = name.lower(), "".join(values).lower()
            if name == "role":
                never = never or bool(_NEVER_ROLES.intersection(value.split()))
                rank = max(rank, {"article": 3, "main": 2}.get(value, -1))
            elif name in ("class", "id"):
                names += value.split()
                classes += value.split() if name == "class" else []
            elif name == "itemprop":
                rank = max(rank, 1 if value == "articlebody" else -1)
            elif name == "hidden" or value == "true":
                never = True
    if not _BODY_CLASSES.isdisjoint(names):
        rank = max(rank, 1)
    if rank > 0 and tag != "main" and not _COMMENT_CLASSES.isdisjoint(names):
        rank = 0
    free = rank >= 0 or tag in _WHOLE or not names
    return never, (not free and not _NEVER_CLASSES.isdisjoint(classes), not free and _names_in(_NEVER_CLASSES, names)), tag == "header", not free and _names_in(_NEVER_OUTSIDE, names), -1 if never else rank


def blocks(page: str | None) -> tuple[list[str], list[tuple[str, bool]]]:
    """Blocks of the marked article, and the others with whether the host may decide on them."""
    page = page or ""
    # Text, the ranks of the marks around it as bits, and the number of the innermost element that names drop.
    found: list[tuple[str, int, int]] = []
    buffers: dict[tuple[int, int], list[str]] = {}
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    opened: dict[str, int] = {}
    around, holds = [0], [True]  # of elements that names drop: the next one outside, and whether a mark stands in it
    comments = 0
    at, end, lower = 0, len(page), None

    def flush() -> None:
        for own, buffer in buffers.items():
            text = "".join(buffer)
            text = _SPACE.sub(" ", html_lib.unescape(text) if "&" in text else text).strip(" ")
            if text:
                found.append((text, *own))
        buffers.clear()

    while at < end:
        begin = page.find("<", at)
        match = (_TAG.match(page, begin) or _BROKEN.match(page, begin)) if begin >= 0 else None
        if begin < 0 or not match:
            upto = end if begin < 0 else begin + 1
            buffers.setdefault(stack[-1][1:], []).append(page[at:upto])
            at = upto
            continue
        if begin > at:
            buffers.setdefault(stack[-1][1:], []).append(page[at:begin])
        at = match.end()
        tag = match[2]
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BLOCKS:
            flush()
        elif tag in _GAPS:
            for buffer in buffers.values():
                buffer.append(" ")
        if match[1]:
            if opened.get(tag):
                while True:
                    name, *_ = stack.pop()
                    opened[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in _RAW:
            lower = page.lower() if lower is None else lower
            close = lower.find(f"</{tag}", at) if len(lower) == end else page.find(f"</{tag}", at)
            at = end if close < 0 else close
        if tag in _VOID:
            continue
        _, ranks, drop = stack[-1]
        never, named, outside, named_outside, rank = _marks(tag, match[3])
        if never or (outside and 0 <= ranks < 2):
            ranks = _DROP
        if ranks != _DROP:
            if rank > 0:
                inner = drop
                while not holds[inner]:
                    holds[inner] = True
                    inner = around[inner]
            elif named[0 if ranks & _ARTICLE else 1] or (named_outside and ranks < 2):
                around.append(drop)
                holds.append(False)
                drop = len(around) - 1
            if rank >= 0:
                comments += rank == 0
                ranks |= 1 << rank
        stack.append((tag, ranks, drop))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    # How many elements that names drop stand around, all released by a mark in them; none where one is not.
    depth: list[int | None] = [0]
    for outer, held in zip(around[1:], holds[1:], strict=True):
        depth.append(depth[outer] + 1 if held and depth[outer] is not None else None)
    kept = [(text, _DROP if depth[drop] is None else ranks, depth[drop]) for text, ranks, drop in found]
    # Comments are dropped, but one that is the page's only mark is its article.
    alone = comments == 1 and not any(ranks > 1 for _, ranks, _ in kept)
    kept = [(text, (8 if alone else _DROP) if ranks > 0 and ranks & 1 else ranks, deep) for text, ranks, deep in kept]
    amounts: dict[tuple[int, int], int] = {}
    for text, ranks, deep in kept:
        if ranks > 0:
            own = ranks.bit_length() - 1, -deep
            amounts[own] = amounts.get(own, 0) + len(text)
    if not amounts:
        return [], [(text, ranks == 0) for text, ranks, _ in kept]
    rank, deep = max(amounts, key=lambda own: (amounts[own], own))
    main = [ranks > 0 and bool(ranks >> rank & 1) and at == -deep for _, ranks, at in kept]
    return [t for (t, *_), own in zip(kept, main, strict=True) if own], [(t, False) for (t, *_), own in zip(kept, main, strict=True) if not own]


#: What the host does with a block: nothing, cut the repeated runs out of it, or judge it whole as part of a marked article.
_CLOSED, _CUT, _MARKED = "-", "?", "="
PARSED = "page_id bigint, url string, host string, content bigint, fresh boolean, deal bigint, packed binary"


def _pack(page: str | None) -> bytes:
    """All blocks of a page, each led by its kind; equal texts give equal bytes."""
    main, rest = blocks(page)
    lines = [_MARKED + t for t in main] + [(_CUT if o else _CLOSED) + t for t, o in rest]
    return zlib.compress("\n".join(lines).encode("utf-8", "replace")) if lines else b""


def _unpack(packed: bytes) -> list[tuple[str, str]]:
    """Kind and text of every block."""
    return [(line[0], line[1:]) for line in zlib.decompress(packed).decode().split("\n")] if packed else []


def parse(pages: DataFrame) -> DataFrame:
    """Pages with their blocks, a number of their content, and whether their task has not seen it on that host before.

    ``deal`` is the content's own number where it is fresh, so that the copies that several tasks hold meet in one
    shard; a task's further copies are spread.
    """
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    picked = pages.select("page_id", "url", "html", host.alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        n = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                packed = [_pack(page) for page in part.column("html").to_pylist()]
                content, fresh, deal = [], [], []
                for host, body in zip(part.column("host").to_pylist(), packed, strict=True):
                    digest = hashlib.blake2b(f"{host is None} {host}\n".encode("utf-8", "replace") + body, digest_size=16).digest()
                    n += 1
                    fresh.append(bool(body) and digest not in seen)
                    seen.add(digest)
                    content.append(int.from_bytes(digest[:8], "little", signed=True) if body else None)
                    own = digest if fresh[-1] else hashlib.blake2b(digest + n.to_bytes(8, "little"), digest_size=16).digest()
                    deal.append(int.from_bytes(own[8:], "little", signed=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        part.column("host"),
                        pa.array(content, pa.int64()),
                        pa.array(fresh, pa.bool_()),
                        pa.array(deal, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["page_id", "url", "host", "content", "fresh", "deal", "packed"],
                )

    return picked.mapInArrow(run, T.StructType([picked.schema["page_id"], *T._parse_datatype_string(PARSED).fields[1:]]))


_EDGE = "\x02"


class HostArray:
    """Token streams of some pages end to end, and their suffixes sorted by their first ``RUN`` tokens."""

    def __init__(self, pages: list[list[tuple[str, str]]], run: int = RUN) -> None:
        lines = [f" {_EDGE} ".join(text for _, text in page) for page in pages]
        words, self.lengths = WordHashes().of([line.encode("utf-8", "replace") for line in lines])
        ends = np.cumsum(self.lengths)
        self.owner = np.repeat(np.arange(len(pages)), self.lengths)
        fits = ends[self.owner] - np.arange(len(words)) >= run if len(words) else np.zeros(0, dtype=bool)
        self.words, self.run = words, run
        self.starts = np.nonzero(fits)[0]
        self.hashes = shingle_hashes(words, run).view(np.int64) if len(words) else np.zeros(0, np.int64)

    def substrings(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each distinct substring of ``RUN`` tokens and the number of pages it occurs on."""
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Ranks by the first 1, 2, 4, ... tokens; with the last doubling, suffixes agree in RUN tokens or not.
        rank = np.unique(self.words, return_inverse=True)[1].astype(np.int64)
        step = 1
        while step < self.run:
            step = min(step, self.run - step)
            behind = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.int64)])
            rank = np.unique(rank * (rank.max(initial=0) + 1) + behind, return_inverse=True)[1].astype(np.int64)
            step *= 2
        order = self.starts[np.lexsort((self.starts, rank[self.starts]))]
        rank, page = rank[order], self.owner[order]
        first = np.concatenate([[True], rank[1:] != rank[:-1]])
        fresh = first | np.concatenate([[True], page[1:] != page[:-1]])
        return self.hashes[order[first]], np.add.reduceat(fresh.astype(np.int64), np.nonzero(first)[0])

    def count(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the wanted substrings that occur, and the number of pages they occur on."""
        at = self.starts[np.isin(self.hashes[self.starts], wanted)]
        order = at[np.lexsort((self.owner[at], self.hashes[at]))]
        own, page = self.hashes[order], self.owner[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (own[1:] != own[:-1]) | (page[1:] != page[:-1])
        return np.unique(own[fresh], return_counts=True)

    def covered(self, repeated: np.ndarray) -> list[np.ndarray]:
        """For each page, which tokens stand in a repeated substring."""
        marks = np.zeros(len(self.hashes) + self.run + 1, dtype=np.int64)
        hit = self.starts[np.isin(self.hashes[self.starts], repeated)]
        np.add.at(marks, hit, 1)
        np.add.at(marks, hit + self.run, -1)
        return np.split(np.cumsum(marks)[: len(self.hashes)] > 0, np.cumsum(self.lengths)[:-1])


FOUND = "host string, hash bigint"
COUNTED = "host string, pages bigint, hash bigint, n bigint"


def _distinct(pages: pa.Table) -> list[list[tuple[str, str]]]:
    """The different contents among a shard's fresh pages."""
    packed = zip(pages.column("packed").to_pylist(), pages.column("fresh").to_pylist(), strict=True)
    return [_unpack(p) for p in dict.fromkeys(p for p, fresh in packed if fresh)]


def _found(pages: pa.Table, least_pages: int) -> pa.Table:
    """Substrings that may reach the host's share: what does so on the host does so in one of its shards at least."""
    contents = _distinct(pages)
    hashes, n = HostArray(contents).substrings()
    alone = pages.column("shards")[0].as_py() == 1
    hashes = hashes[(100 * n >= RUN_SHARE * len(contents)) & (n >= (least_pages if alone else 1))]
    return pa.table({"host": pa.array([pages.column("host")[0].as_py()] * len(hashes), pa.string()), "hash": pa.array(hashes, pa.int64())})


def _counted(pages: pa.Table, wanted: pa.Table) -> pa.Table:
    """On how many of a shard's contents the host's candidates occur."""
    hashes = n = np.zeros(0, np.int64)
    host = total = None
    if pages.num_rows and wanted.num_rows:
        host, total = pages.column("host")[0].as_py(), pages.column("pages")[0].as_py()
        hashes, n = HostArray(_distinct(pages)).count(wanted.column("hash").to_numpy())
    return pa.table(
        {
            "host": pa.array([host] * len(hashes), pa.string()),
            "pages": pa.array([total] * len(hashes), pa.int64()),
            "hash": pa.array(hashes, pa.int64()),
            "n": pa.array(n, pa.int64()),
        }
    )


def _texts(pages: pa.Table, repeated: pa.Table) -> pa.Table:
    """What the host leaves of the marked articles and of the other open blocks."""
    if not pages.num_rows:
        return pa.table({"page_id": pa.array([], pa.int64()), "url": pa.array([], pa.string()), "text": pa.array([], pa.string())})
    bodies = [_unpack(p) for p in pages.column("packed").to_pylist()]
    if repeated.num_rows:
        array = HostArray(bodies)
        hashes, wide = repeated.column("hash").to_numpy(), repeated.column("wide").to_numpy(zero_copy_only=False)
        runs, most = array.covered(hashes), array.covered(hashes[wide])
        bodies = [_left(*page) for page in zip(bodies, runs, most, strict=True)]
    texts = ["\n".join(text for kind, text in page if kind != _CLOSED) for page in bodies]
    return pa.table({"page_id": pages.column("page_id"), "url": pages.column("url"), "text": pa.array(texts, pa.string())})


def _left(page: list[tuple[str, str]], runs: np.ndarray, most: np.ndarray) -> list[tuple[str, str]]:
    """A page's blocks without repeated runs in those to be cut, and without marked ones that most pages hold."""
    kept, at = [], 0
    for kind, text in page:
        words = text.split(" ")
        end = at + len(words)
        if kind == _CUT:
            text = " ".join(w for w, gone in zip(words, runs[at:end], strict=True) if not gone)
        elif kind == _MARKED and most[at:end].all():
            text = ""
        if text:
            kept.append((kind, text))
        at = end + 1
    marked = [b for b in page if b[0] == _MARKED]
    return kept if not marked or any(kind == _MARKED for kind, _ in kept) else marked


def main_text(pages: DataFrame, least_pages: int = PAGES, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    parsed = written(parse(pages), "page-blocks")  # read for the hosts and again for the texts
    hosts = parsed.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / shard_pages).alias("shards"), F.count_distinct("content").alias("pages"))
    hosts = written(hosts.withColumnRenamed("host", "_host"), "page-hosts")
    # One deal serves all three passes; the passes hand on substrings only.
    dealt = parsed.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    dealt = dealt.select("page_id", "url", "host", "fresh", "packed", "shards", "pages", F.pmod("deal", "shards").alias("shard"))
    shards = hosts.select("_host", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"))

    def everywhere(found: DataFrame) -> DataFrame:
        """A host's substrings, once for each of its shards."""
        return found.join(shards, F.col("host").eqNullSafe(F.col("_host"))).drop("_host").groupBy("host", "shard")

    def found(part: pa.Table) -> pa.Table:
        return _found(part, least_pages)

    by_shard = dealt.groupBy("host", "shard")
    wanted = by_shard.applyInArrow(found, FOUND).distinct()
    counted = by_shard.cogroup(everywhere(wanted)).applyInArrow(_counted, COUNTED).groupBy("host", "pages", "hash").agg(F.sum("n").alias("n"))
    repeated = counted.filter((F.col("n") >= least_pages) & (100 * F.col("n") >= RUN_SHARE * F.col("pages")))
    wide = (F.col("n") >= BLOCK_PAGES) & (100 * F.col("n") >= BLOCK_SHARE * F.col("pages"))
    repeated = repeated.select("host", "hash", wide.alias("wide"))
    schema = T.StructType([pages.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    decided = by_shard.cogroup(everywhere(repeated)).applyInArrow(_texts, schema)
    return decided.select("*", F.length("text").cast("bigint").alias("n_chars"))


by_value(__name__)
