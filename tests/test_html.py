from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioworks.functions.links import Site, absolute, canonical, file_type, media_key
from folioworks.functions.text import capture_number, first_filled, int_or_zero, strip, zero_pad
from folioworks.html import extract
from folioworks.html.parser import RAW, TEXT, VOID, NodeBuilder, parse
from folioworks.html.render import markdown, sanitize
from folioworks.html.select import (
    anchors,
    content_area,
    has_class,
    page_title,
    select_nodes,
    stripped_text_of,
    text_of,
)

pieces = st.sampled_from(
    ["<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "<div class='x y'>", "</div>", "<li>", "</ul>", "<ul>", "text", "&amp;", "&nbsp;",
     " ", "\n", "<", ">", "</", "<a href=1>", "</a>", "<!-- c -->", "<!DOCTYPE html>", "<script>1<2</script>", "<p/>", "<img src=q>", "é"]
)


def built(*documents, track=(), builder=NodeBuilder):
    """The nodes of the last document, read after the others."""
    b = builder(track)
    for d in documents:
        b.read(d)
    nodes = b.column().to_pylist()[-1]
    return [{**n, "attrs": dict(n["attrs"]), "scopes": dict(n["scopes"])} for n in nodes]


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=25).map("".join) | st.text(max_size=60))
def test_nodes_nest_properly(html):
    nodes = built("<p>before", html, track=("p", ".x"))
    for i, n in enumerate(nodes):
        assert n["pre"] == i <= n["last"] < len(nodes)
        assert -1 <= n["parent"] < i
        # A node is inside all nodes whose stretch covers it, and its parent is the nearest of them.
        around = [m for m in nodes[:i] if m["last"] >= i]
        assert all(m["last"] >= n["last"] for m in around)
        assert n["parent"] == (around[-1]["pre"] if around else -1)
        assert n["scopes"].get("p") == next((m["pre"] for m in reversed(around) if m["tag"] == "p"), None)
        assert n["lists"] == sum(m["tag"] in ("ul", "ol") for m in around)
        assert n["nth"] == sum(m["tag"] == n["tag"] and m["parent"] == n["parent"] for m in nodes[:i])
        if n["tag"] in (TEXT, RAW) or n["tag"] in VOID:
            assert n["last"] == i


class Lenient(NodeBuilder):
    def _scan(self, html):
        return False


irregular = st.sampled_from(
    ["<p>", "</p >", "<B>", "</ b>", "<br/>", "<div class='x y' id=q hidden>", "</div>", "<a href=/x/>", "<a b=1/>", "<a x=\"1\"y=2>", "<a x = '&amp;<'>",
     "<!-- a -- b -->", "<!-- -->", "<!---->", "<!doctype html PUBLIC \"x\">", "<!x>", "<?php ?>", "<script>a<b</script >", "<style>x", "</x y>", "<p/ >",
     "<script src=x/>", "<", "&", "&lt", "&copy;", "t", " ", "\n", "\xa0", "<a\x0cb>", "<a =b>", "<a b==c>", "<a b=\"\">", "<textarea> </textarea>", "<pre>\n"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(irregular, max_size=12).map("".join) | st.lists(pieces, max_size=12).map("".join))
def test_both_readings_agree(html):
    fast, slow = NodeBuilder(("p", ".x")), Lenient(("p", ".x"))
    for builder in (fast, slow):
        builder.read("<p>first")
        builder.read(html)
        builder.read("<p>last")
    assert fast.ends == slow.ends
    for got, expected in zip(fast.columns(), slow.columns(), strict=True):
        assert got == expected


def test_regular_pages_take_the_fast_reading():
    page = '<!DOCTYPE html><html lang="en"><head><script>var t="</p>";</script></head><body><!-- ad --><p class=x>a&amp;b<br></body></html>'
    builder = NodeBuilder(())
    builder.first = 0
    builder._begin()
    assert builder._scan(page)


def test_lenient_reading():
    nodes = built('<div class=" a  b "></i>x<p>y<b>z</div>w&lt;<script>"</p>"</script>')
    assert [n["tag"] for n in nodes] == ["div", TEXT, "p", TEXT, "b", TEXT, TEXT, "script", RAW]
    assert [n["last"] for n in nodes] == [5, 1, 5, 3, 5, 5, 6, 8, 8]
    assert nodes[0]["classes"] == ["a", "b"] and nodes[0]["attrs"] == {"class": " a  b "}
    assert nodes[6]["text"] == "w<" and nodes[8]["text"] == '"</p>"'


def test_blank_texts_shrink_outside_pre():
    nodes = built("<p> \n </p><p>   </p><pre> \n </pre>a<!-- c -->b")
    assert [n["text"] for n in nodes if n["text"] is not None] == ["\n", " ", " \n ", "a", "b"]


def test_empty_documents(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x")], "id int, html string")
    assert {r.id: r.n for r in parse(df).select("id", F.size("nodes").alias("n")).collect()} == {1: 0, 2: 0, 3: 2}


def test_long_documents_are_kept_whole(spark):
    df = spark.range(3).select("id", F.repeat(F.lit("<p>x</p>"), 40_000).alias("html"))
    rows = parse(df).select(F.size("nodes").alias("n")).collect()
    assert [r.n for r in rows] == [80_000] * 3


@pytest.fixture(scope="module")
def one(spark):
    def make(html, track=("li", "pre", "code", "nav")):
        return parse(spark.createDataFrame([(1, html)], "id int, html string"), track=track)

    return make


def value(df, column):
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<div><p>Klassensprecher_innen</p></div>", r"Klassensprecher\_innen"),
        ('<p>Text<br>  <a href="/u">Ladet <b>gern</b></a></p>', "Text  [Ladet **gern**](/u)"),
        ("<p>a <b> bold </b>b</p>", "a  **bold** b"),
        ("<h1>Top</h1><h2>Two</h2><h3>Three</h3>", "Top===Two---### Three"),
        ("<ul><li>one</li><li>two<ul><li>in</li></ul></li></ul>", "* one* two  + in"),
        ("<ol><li>x</li><li>y</li></ol>", "1. x2. y"),
        ('<ol start="4"><li>x</li></ol>', "4. x"),
        ('<a href="http://x">http://x</a><b></b><a>bare</a>', "<http://x>bare"),
        ('<img src="i.png" alt="alt" title="t">', '![alt](i.png "t")'),
        ("<p>one\n  two</p>", "onetwo"),
        ("<p>a\xa0b&nbsp;</p>", "a\xa0b\xa0"),
        ("<blockquote>q</blockquote><hr>", "> q---"),
        ("<table><tr><th>h</th><th>k</th></tr><tr><td>1</td><td>2</td></tr></table>", "| h | k || --- | --- || 1 | 2 |"),
        ("<script>var x</script><p>t</p>", "t"),
        ("<pre>a  b_</pre><code>x_y</code>", "```a  b_```" + "`x_y`"),
    ],
)
def test_markdown(one, html, expected):
    assert value(one(html), markdown(F.col("nodes"))) == expected


def test_markdown_of_a_long_list_takes_the_time_of_its_length(one):
    """With a search among all lists per item, this would take minutes."""
    inner = "<ul>" + "".join(f"<li>in {i}</li>" for i in range(4)) + "</ul>"
    html = "<ol>" + "".join(f"<li>item {i}{inner}</li>" for i in range(8_000)) + "</ol>"
    began = time.monotonic()
    text = value(one(html), markdown(F.col("nodes")))
    assert time.monotonic() - began < 60
    assert text.startswith("1. item 0  + in 0  + in 1") and "8000. item 7999" in text


def nest(tags, inner, close=True):
    return "".join(f"<{t}>" for t in tags) + inner + ("".join(f"</{t.split()[0]}>" for t in reversed(tags)) if close else "")


@pytest.mark.parametrize(
    ("html", "start", "end"),
    [
        (nest(["b"] * 100_000, " x "), "**" * 20, "**" * 20),
        (nest(["b"] * 100_000, " x", close=False), "**" * 20, "**" * 20),
        (nest(["b", "a href='u'"] * 50_000, "x"), "**[**[", "](u)**](u)**"),
        ("<b> x </b>" * 100_000, "**x** ", "**x**"),
        ("<pre>" + " " * 100_000 + "x</pre><p>" + "&nbsp;<i></i>" * 50_000 + "</p>", "```", "\xa0"),
    ],
)
def test_markdown_of_very_many_marks_takes_the_time_of_their_number(one, html, start, end):
    began = time.monotonic()
    text = value(one(html), markdown(F.col("nodes")))
    assert time.monotonic() - began < 60
    assert text.startswith(start) and text.endswith(end.strip(" "))


@pytest.mark.parametrize("seed", range(3))
def test_markdown_moves_blanks_out_of_marks_as_plain_patterns_do(one, seed):
    """The same by patterns over marks of several signs, which need as much stack as there are marks."""
    rng = random.Random(seed)
    html, stack = [], []
    for _ in range(120):
        move = rng.random()
        if move < 0.35:
            tag = rng.choice(["b", "i", "del", "code", 'a href="/u" title="t"'])
            html.append(f"<{tag}>")
            stack.append(tag.split()[0])
        elif move < 0.6 and stack:
            html.append(f"</{stack.pop()}>")
        else:
            html.append(rng.choice([" ", "x", " x", "x ", " x "]))
    html = "".join(html) + "z" + "".join(f"</{t}>" for t in reversed(stack))
    marks = {"b": "**", "i": "*", "del": "~~", "code": "`", "a": "["}
    text, opened = "", []
    tree = plain_events(html)
    for kind, item in tree:
        if kind == "open":
            text += "\ufdd0" + marks[item] if item else ""
        elif kind == "close":
            text += ("](/u \"t\")" if item == "a" else marks[item]) + "\ufdd1" if item else ""
        else:
            text += re.sub(" +", " ", item)
    text = re.sub(r"((?:\ufdd0(?:\*\*|\*|~~|`|\[))+)( +)", r"\2\1", text)
    text = re.sub(r"( +)((?:(?:\*\*|\*|~~|`|\]\([^\n]*?\))\ufdd1)+)", r"\2\1", text)
    assert value(one("<p>" + html + "</p>"), markdown(F.col("nodes"))) == re.sub("[\ufdd0\ufdd1]", "", text).strip(" ")


def plain_events(html):
    """Opening, closing and text events of well-formed markup; elements without text have no name."""
    parts = re.findall(r"<(/?)(\w+)[^>]*>|([^<]+)", html)
    out, stack = [], []
    for closing, tag, text in parts:
        if text:
            out.append(["text", text])
            if text.strip():
                for at in stack:
                    out[at][1] = out[at][2]
        elif not closing:
            stack.append(len(out))
            out.append(["open", None, tag])
        else:
            at = stack.pop()
            out.append(["close", out[at][1]])
    return [(e[0], e[1]) for e in out]


def test_markdown_counts_lists_inside_the_stretch_only(one):
    html = "<ul><li><div class='x'><ol start='3'><li>a<ul><li>b</li></ul></li></ol></div></li></ul>"
    area = content_area(F.col("nodes"), F.lit("x"))
    assert value(one(html), markdown(area)) == "3. a  + b"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<div><p>x <b>y</b><i>z</i><span>w</span></p></div>", "<p>x <strong>y</strong><em>z</em>w</p>"),
        ('<a href="/h" title="t" onclick="x">k</a>', '<a title="t">k</a>'),
        ('<a target="_blank">k</a>', '<a target="_blank" rel="noopener">k</a>'),
        ("<p></p><p> </p><p>a<br></p><script>s</script><!-- c -->", "<p>a<br></p>"),
        ("<p>1 &lt; 2 &amp; 3</p>", "<p>1 &lt; 2 &amp; 3</p>"),
        ("<p>a \n b</p>", "<p>a b</p>"),
    ],
)
def test_sanitize(one, html, expected):
    out = value(one(html), sanitize(F.col("nodes")))
    assert " ".join(out.split()) == expected


def test_selection(one):
    doc = one('<title> T </title><div class="a b"><p> x </p>y<a href="/1">l</a></div><div class="b a">z</div><body>w</body>')
    assert [r.t for r in select_nodes(doc, ["id"], has_class("a")).select(text_of(F.col("sub")).alias("t")).collect()] == [" x yl", "z"]
    assert select_nodes(doc, ["id"], has_class("a b")).count() == 1
    assert select_nodes(doc, ["id"], has_class("a", "p")).count() == 0
    assert [(r.href, r.text) for r in anchors(doc, "id").collect()] == [("/1", "l")]
    assert value(doc, page_title(F.col("nodes"))) == "T"
    assert value(doc, stripped_text_of(F.col("nodes"))) == "Txylzw"
    assert value(doc, text_of(content_area(F.col("nodes"), F.lit("b")))) == " x yl"
    assert value(doc, text_of(content_area(F.col("nodes"), F.lit(None).cast("string")))) == "w"
    assert value(doc, text_of(content_area(F.col("nodes"), F.lit("c")))) is None


SITE = Site("site.example", "/archive")


def test_article_facts(one):
    doc = one(
        '<ul class="elementor-icon-list-items"><li class="elementor-icon-list-item"><a href="https://site.example/archive/#1-42">d</a></li>'
        '<li class="elementor-icon-list-item"><a>no</a></li></ul>'
        '<div class="elementor-toggle-item"><ul class="elementor-icon-list-items"><li><a href="/archive/#1-42">d</a><a href="/archive/">e</a></li></ul></div>'
        '<div class="elementor-widget-text-editor"><a href="https://site.example/p/1/">a</a><a href="https://other.example/">b</a>'
        '<a href="https://site.example/wp/uploads/x.pdf">c</a></div>'
        '<div class="wp-embed type-post"><a class="wp-embed-more" href="https://elsewhere.example/">m</a></div>'
        '<div class="elementor-widget-button"><a href="/b">Zum VOLLTEXT</a></div>'
        '<div class="elementor-widget-wpfd_choose_category"><i class="wpfd-content-tree" data-category="7"></i></div>'
        '<div class="elementor-widget-wpfd_choose_category"><i class="wpfd-content-tree" data-category="9"></i></div>'
    )
    nodes = F.col("nodes")
    assert value(doc, extract.chapter_links(nodes, SITE)) == [42, 42, 42]
    assert value(doc, extract.labelled_link(nodes)) == "/b"
    assert value(doc, extract.dedicated_category(nodes)) == 7
    assert value(doc, extract.related_links(nodes, SITE)) == ["https://elsewhere.example/", "https://site.example/p/1/"]
    empty = one("<p>x</p>")
    assert value(empty, extract.chapter_links(nodes, SITE)) == []
    assert value(empty, extract.labelled_link(nodes)) is None
    assert value(empty, extract.dedicated_category(nodes)) is None
    assert value(empty, extract.related_links(nodes, SITE)) == []


def test_article_errors(one):
    button = '<div class="elementor-widget-button"><a href="/b">Volltext</a></div>'
    with pytest.raises(Exception, match="more than one button"):
        one(button * 2).select(extract.labelled_link(F.col("nodes"))).collect()
    with pytest.raises(Exception, match="without a category"):
        one('<div class="elementor-widget-wpfd_choose_category"><i class="wpfd-content-tree"></i></div>').select(
            extract.dedicated_category(F.col("nodes"))
        ).collect()


def test_category_list(one):
    doc = one(
        '<ol class="dd-list"><li data-id="1" data-level="0"><span class="title"> Top </span><ol class="dd-list">'
        '<li data-id="2" data-level="1" data-parent-id="1"></li><li data-id="3" data-level="1" data-parent-id="1"><span class="title">Leaf</span></li>'
        "</ol></li></ol>"
    )
    got = [(r.node_id, r.parent_id, r.data_parent_id, r.level, r.name) for r in extract.category_nodes(doc, "id").orderBy("ordinal").collect()]
    assert got == [("1", None, "", "0", "Top"), ("2", "1", "1", "1", "Untitled"), ("3", "1", "1", "1", "Leaf")]


def test_file_links_are_distinct(one):
    link = '<a class="wpfd-file-link" data-id="5" data-category_id="2" title="t">x</a>'
    doc = one(link * 2 + '<a class="wpfd-file-link">y</a>')
    assert sorted(tuple(r) for r in extract.file_links(doc, "id").collect()) == [(0, 0, ""), (5, 2, "t")]


def test_scalar_rules(spark):
    def run(expr, value, type_="string"):
        return spark.createDataFrame([(value,)], f"v {type_}").select(expr(F.col("v")).alias("r")).first().r

    assert run(strip, "\xa0 \n a b \xa0") == "a b"
    assert run(media_key, "https://youtu.be/ZqFnl5") == "ZqFnl5"
    assert run(media_key, "https://www.youtube.com/embed/ZqFnl5?si=x") == "ZqFnl5"
    assert run(media_key, "https://www.youtube.com/watch?v=lhRnk") == "lhRnk"
    assert run(media_key, "prezi.com/view/GWG/") == run(media_key, "https://prezi.com/view/GWG/") == "prezi.com/view/GWG/"
    assert run(file_type, "application/pdf") == "pdf"
    assert run(file_type, "") == run(file_type, None) == "unknown"
    assert run(canonical, "HTTPS://X.org/A/b/?q=1#f") == "x.org/A/b"
    assert run(canonical, "https://x.org/") == run(canonical, "X.ORG#top") == "x.org"
    assert run(int_or_zero, None) == 0 and run(int_or_zero, "12") == 12
    assert run(zero_pad, "7") == "07" and run(zero_pad, "2024") == "2024"
    assert run(lambda c: capture_number(c, r"#\d+-(\d+)"), "/a/#36-41") == 41
    assert run(lambda c: capture_number(c, r"#\d+-(\d+)"), "/a/") is None
    assert run(lambda c: first_filled(c, F.lit(""), F.lit("z")), "") == "z"
    assert run(lambda c: absolute(c, "https://g.example"), "/x") == "https://g.example/x"
    assert run(lambda c: absolute(c, "https://g.example"), "https://g.example/y") == "https://g.example/y"
    for bad in ("/", "https://g.example/", "mailto:x", None):
        with pytest.raises(Exception, match="leaves the site"):
            run(lambda c: absolute(c, "https://g.example"), bad)


def test_regular_markup_is_read_without_a_call_per_node(monkeypatch):
    def called(*_):
        raise AssertionError("a call per node")

    for name in ("_append", "handle_starttag", "handle_endtag", "handle_data"):
        monkeypatch.setattr(NodeBuilder, name, called)
    builder = NodeBuilder((".x",))
    builder.read('<ul class="x y"><li>a &amp; b<br><img src="i"></li> <li/></ul>')
    nodes = builder.column().to_pylist()[0]
    assert [(n["pre"], n["last"], n["parent"], n["nth"], n["tag"], n["text"], n["lists"]) for n in nodes] == [
        (0, 6, -1, 0, "ul", None, 0), (1, 4, 0, 0, "li", None, 1), (2, 2, 1, 0, "#text", "a & b", 1), (3, 3, 1, 0, "br", None, 1),
        (4, 4, 1, 0, "img", None, 1), (5, 5, 0, 0, "#text", " ", 1), (6, 6, 0, 1, "li", None, 1),
    ]
    assert [dict(n["scopes"]) for n in nodes] == [{}] + [{".x": 0}] * 6
    assert [n["classes"] for n in nodes[:2]] == [["x", "y"], []]
    assert [n["texts"] for n in nodes] == [0, 0, 1, 1, 1, 1, 1] and [n["breaks"] for n in nodes][-1] == 1


def test_only_the_fields_asked_for_are_made(spark):
    html = '<ul class="a"><li title="t">x<br></li><li>y</li></ul>'
    df = spark.createDataFrame([(1, html)], "id int, html string")
    whole = parse(df, track=("li",)).head().nodes
    for fields in (("pre", "tag"), ("text", "last", "breaks"), ("scopes", "attrs", "chars", "classes")):
        nodes = parse(df, track=("li",), fields=fields).head().nodes
        assert {*nodes[0].asDict()} == {*fields}
        assert [n.asDict() for n in nodes] == [{f: n[f] for f in fields} for n in whole]
    with pytest.raises(ValueError, match="no such fields"):
        parse(df, fields=("pre", "colour"))


def test_tags_written_alike_are_taken_apart_once(monkeypatch):
    taken = []
    real = NodeBuilder._taken_apart
    monkeypatch.setattr(NodeBuilder, "_taken_apart", lambda self, markup: taken.append(markup) or real(self, markup))
    nodes = built(*['<p class="x">a<br>b</p><!-- c -->'] * 5, track=(".x",))
    assert taken == ['p class="x"', "br", "/p", "!-- c --"]
    assert [n["tag"] for n in nodes] == ["p", TEXT, "br", TEXT] and [n["scopes"] for n in nodes[1:]] == [{".x": 0}] * 3


def test_open_quotes_take_the_time_of_their_number():
    start = time.perf_counter()
    builder = NodeBuilder(())
    assert builder._pieces('<a "' * 200_000) is None
    assert time.perf_counter() - start < 5
