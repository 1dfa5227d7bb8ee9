"""Typed sections of an article: every content widget becomes one or more rows.

One expression per widget kind, evaluated inside the row of the widget and exploded in document
order, so the section number is known without a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.links import media_key
from folioworks.functions.text import present, strip
from folioworks.html.render import markdown
from folioworks.html.select import (
    at,
    descendants,
    find,
    find_all,
    has_class,
    is_tag,
    let,
    subtree,
    text_at,
)
from folioworks.operators.tables import left_join

# Class names of the page builder whose output is read.
WIDGET = "elementor-widget"
TEXT_EDITOR = "elementor-widget-text-editor"
TOGGLE = "elementor-widget-toggle"
PANELS = "elementor-widget-htmega-accordion-addons"
SHORTCODE = "elementor-widget-shortcode"
FLIPCARD = "elementor-widget-htmega-flipbox-addons"
IMAGE = "elementor-widget-image"
PLAIN_VIDEO = "elementor-video"
VIDEO = "elementor-widget-video"
TAB = "elementor-tab-content"
QUIZ = "qsm-before-message"
ACTIVITY = "h5p-iframe"

# Widgets that carry no section of their own; other kinds are counted as unknown.
NO_SECTION = (
    "elementor-widget-wpfd_choose_category",
    "elementor-widget-icon-list",
    "elementor-widget-spacer",
    "elementor-widget-heading",
)
HANDLED = (TEXT_EDITOR, TOGGLE, PANELS, SHORTCODE, FLIPCARD, IMAGE, PLAIN_VIDEO, VIDEO)

# What ``parse`` must track for this module.
TRACK = (f".{TAB}", "pre", "code")

_SECTIONS = "array<struct<type:string,title:string,text:string,external_link:string,media:string>>"


def _section(kind: str, title=None, text=None, link=None, transcript: bool = False) -> Column:
    def column(value):
        return (F.lit(None) if value is None else value).cast("string")

    media = media_key(link) if transcript else F.lit(None)
    return F.struct(
        F.lit(kind).alias("type"),
        column(title).alias("title"),
        column(text).alias("text"),
        column(link).alias("external_link"),
        media.cast("string").alias("media"),
    )


def _none() -> Column:
    return F.array().cast(_SECTIONS)


def _is_video_link(src: Column) -> Column:
    return F.contains(src, F.lit("youtube")) | F.contains(src, F.lit("youtu.be"))


def _accordion_frames(content: Column, title: Column) -> Column:
    def frame(n):
        src = n["attrs"]["src"]
        linked_title = find(descendants(content, n), has_class("ytp-title-link", "a"))
        video_title = F.when(F.map_contains_key(n["attrs"], "title"), n["attrs"]["title"]).otherwise(
            let(linked_title, lambda a: F.when(a.isNotNull(), text_at(content, a)))
        )
        return (
            F.when(
                F.array_contains(n["classes"], ACTIVITY),
                F.array(_section("accordion_section_h5p", n["attrs"]["title"])),
            )
            .when(
                F.contains(src, F.lit("prezi")),
                F.array(_section("accordion_section_prezi", title, link=src, transcript=True)),
            )
            .when(
                _is_video_link(src),
                F.array(_section("accordion_section_youtube", video_title, link=src, transcript=True)),
            )
            .otherwise(_none())
        )

    return F.flatten(F.transform(find_all(content, is_tag("iframe")), frame))


def _accordion_images(widget: Column, content: Column, title: Column) -> Column:
    def image(n):
        def by_parent(p):
            href = p["attrs"]["href"]
            return (
                F.when(p["tag"] != "a", _section("accordion_section_image", title, link=n["attrs"]["src"]))
                .when(
                    F.contains(href, F.lit("prezi")),
                    _section("accordion_section_prezi", title, link=href, transcript=True),
                )
                .otherwise(_section("accordion_section_image", title, link=href))
            )

        return let(at(widget, n["parent"]), by_parent)

    return F.transform(find_all(content, is_tag("img")), image)


def _accordion_item(widget: Column, item: Column, title_test, content_test) -> Column:
    def with_content(inside, title, content):
        def paragraphs():
            texts = F.transform(find_all(content, is_tag("p")), lambda p: strip(text_at(content, p)))
            return F.transform(
                F.filter(texts, present), lambda t: _section("accordion_section_text", title, t)
            )

        quiz = find(content, has_class(QUIZ))
        message = F.when(
            quiz.isNotNull(), F.array(_section("accordion_section_quiz", title, text_at(content, quiz)))
        ).otherwise(_none())
        return F.concat(
            paragraphs(), _accordion_frames(content, title), _accordion_images(widget, content, title), message
        )

    return let(
        subtree(widget, item),
        lambda inside: let(
            F.struct(
                text_at(inside, find(inside, title_test)).alias("title"),
                descendants(inside, find(inside, content_test)).alias("content"),
            ),
            lambda s: F.when(s["content"].isNull(), _none()).otherwise(with_content(inside, s["title"], s["content"])),
        ),
    )


def _accordion(widget: Column, item_test, title_test, content_test) -> Column:
    items = F.filter(descendants(widget, F.get(widget, F.lit(0))), item_test)
    return F.flatten(F.transform(items, lambda i: _accordion_item(widget, i, title_test, content_test)))


def _shortcode(inside: Column) -> Column:
    quiz = find(inside, has_class(QUIZ))

    def frame(n):
        # The activity frames of one widget all carry the title of its first.
        first = find(inside, has_class(ACTIVITY, "iframe"))
        return (
            F.when(
                F.contains(n["attrs"]["src"], F.lit("prezi")),
                F.array(_section("prezi", link=n["attrs"]["src"], transcript=True)),
            )
            .when(F.array_contains(n["classes"], ACTIVITY), F.array(_section("h5p", first["attrs"]["title"])))
            .otherwise(_none())
        )

    frames = F.flatten(F.transform(find_all(inside, is_tag("iframe")), frame))
    return F.when(quiz.isNotNull(), F.array(_section("quiz", text=text_at(inside, quiz)))).otherwise(frames)


def _flipcard(inside: Column) -> Column:
    def face(name):
        return text_at(inside, find(inside, has_class(name)))

    link = F.when(F.exists(inside, has_class("flp-btn")), find(inside, is_tag("a"))["attrs"]["href"])
    return let(
        face("front-container"),
        lambda front: F.array(
            _section("flipcard", front, F.concat(front, F.lit("\n"), face("back-container")), link)
        ),
    )


def _video(widget: Column) -> Column:
    def by_settings(settings):
        link = F.replace(settings["youtube_url"], F.lit("\\/"), F.lit("/"))
        return F.when(
            settings["video_type"] == "youtube", F.array(_section("youtube", link=link, transcript=True))
        ).otherwise(_none())

    return let(F.from_json(widget["attrs"]["data-settings"], "video_type string, youtube_url string"), by_settings)


def widget_sections(widget: Column, sub: Column) -> Column:
    """The sections of one widget, given its node and subtree."""
    def is_kind(name):
        return F.array_contains(widget["classes"], name)

    inside = descendants(sub, widget)
    return (
        F.when(
            is_kind(TEXT_EDITOR),
            F.when(F.exists(inside, has_class(TEXT_EDITOR)), _none()).otherwise(
                F.array(_section("plain_text", text=markdown(sub)))
            ),
        )
        .when(
            is_kind(PANELS),
            _accordion(
                sub,
                has_class("single_accourdion", "div"),
                has_class("htmega-accourdion-title"),
                has_class("accordion-content", "div"),
            ),
        )
        .when(
            is_kind(TOGGLE),
            _accordion(
                sub,
                has_class("elementor-toggle-item", "div"),
                has_class("elementor-toggle-title", "a"),
                has_class(TAB, "div"),
            ),
        )
        .when(is_kind(SHORTCODE), let(inside, _shortcode))
        .when(is_kind(FLIPCARD), let(inside, _flipcard))
        .when(is_kind(IMAGE), F.array(_section("image", link=find(inside, is_tag("img"))["attrs"]["src"])))
        .when(is_kind(PLAIN_VIDEO), F.array(_section("video", link=find(inside, is_tag("iframe"))["attrs"]["src"])))
        .when(is_kind(VIDEO), _video(widget))
        .otherwise(_none())
    )


def widgets(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Outermost widgets, numbered, one row each: those inside an accordion tab belong to the accordion."""
    outer = F.filter(
        "nodes", lambda n: F.array_contains(n["classes"], WIDGET) & ~F.map_contains_key(n["scopes"], f".{TAB}")
    )
    pairs = F.transform(outer, lambda n: F.struct(n.alias("widget"), subtree(F.col("nodes"), n).alias("sub")))
    numbered = documents.select(*keep, F.posexplode(pairs).alias("widget_no", "_w"))
    return numbered.select(*keep, "widget_no", "_w.widget", "_w.sub")


def sections(documents: DataFrame, doc: str) -> DataFrame:
    """Sections in document order, before transcripts are looked up.

    ``widget_no`` and ``section_no``, the rank inside the widget, order them within the document.
    """
    found = F.posexplode(widget_sections(F.col("widget"), F.col("sub"))).alias("section_no", "s")
    rows = widgets(documents, [doc]).select(F.col(doc).alias("post_id"), "widget_no", found)
    return rows.select("post_id", "widget_no", "section_no", "s.*")


def unknown_widgets(documents: DataFrame, doc: str) -> DataFrame:
    """How often each unhandled combination of widget classes occurs."""
    known = F.array(*[F.lit(c) for c in (*HANDLED, *NO_SECTION)])
    return (
        widgets(documents, [doc])
        .filter(~F.arrays_overlap(F.col("widget.classes"), known))
        .groupBy(F.array_join("widget.classes", " ").alias("classes"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def with_transcripts(found: DataFrame, media: DataFrame) -> DataFrame:
    """Add ``transcript_url`` from ``media(pos, url_medium, url_transkript)``, the first by position.

    Both sides are reduced to the media id; ``operators.containment`` has the looser match by
    containment.
    """
    by_id = (
        media.select(media_key(strip(F.col("url_medium"))).alias("_id"), "pos", "url_transkript")
        .groupBy("_id")
        .agg(F.min(F.struct("pos", "url_transkript")).alias("_first"))
    )
    return (
        left_join(found, by_id, F.col("media"), "_id")
        .withColumn("transcript_url", F.col("_first.url_transkript"))
        .drop("_id", "_first", "media")
    )
