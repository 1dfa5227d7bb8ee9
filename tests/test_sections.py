from __future__ import annotations

import pytest

from folioworks.html.parser import parse
from folioworks.html.sections import TRACK, sections, unknown_widgets, with_transcripts


def widget(kind, inner, extra=""):
    return f'<div class="elementor-widget {kind}" {extra}>{inner}</div>'


def toggle(*items):
    body = "".join(
        f'<div class="elementor-toggle-item"><a class="elementor-toggle-title">{t}</a><div class="elementor-tab-content">{c}</div></div>'
        for t, c in items
    )
    return widget("elementor-widget-toggle", body)


@pytest.fixture(scope="module")
def cut(spark):
    media = spark.createDataFrame(
        [(2, "https://youtu.be/abc ", "late.pdf"), (1, "https://youtu.be/abc", "abc.pdf"), (3, "https://prezi.com/view/q/", "q.pdf")],
        "pos int, url_medium string, url_transkript string",
    )

    def run(html):
        documents = parse(spark.createDataFrame([(5, html)], "id bigint, html string"), track=TRACK)
        found = with_transcripts(sections(documents, "id"), media).orderBy("widget_no", "section_no")
        return [(r.type, r.title, r.text, r.external_link, r.transcript_url) for r in found.collect()]

    return run


def test_mixed_accordion_in_order(cut):
    html = widget("elementor-widget-text-editor", "<p>Hello <b>you</b></p>") + toggle(
        ("One", '<p>a</p><p>&nbsp;</p><img src="i.png"><iframe src="https://prezi.com/view/q/"></iframe>'),
        ("Two", '<iframe src="https://www.youtube.com/embed/abc?x" title="Clip"></iframe><p> b </p>'
                '<iframe src="https://youtu.be/zzz"></iframe><iframe src="https://else.example"></iframe>'),
    )
    assert cut(html) == [
        ("plain_text", None, "Hello **you**", None, None),
        ("accordion_section_text", "One", "a", None, None),
        ("accordion_section_prezi", "One", None, "https://prezi.com/view/q/", "q.pdf"),
        ("accordion_section_image", "One", None, "i.png", None),
        ("accordion_section_text", "Two", "b", None, None),
        ("accordion_section_youtube", "Clip", None, "https://www.youtube.com/embed/abc?x", "abc.pdf"),
        ("accordion_section_youtube", None, None, "https://youtu.be/zzz", None),
    ]


def test_panels_with_thumbnails(cut):
    html = widget(
        "elementor-widget-htmega-accordion-addons",
        '<div class="single_accourdion"><h3 class="htmega-accourdion-title">P</h3><div class="accordion-content">'
        '<a href="https://prezi.com/view/q/"><img src="t.png"></a><a href="/big.png"><img src="s.png"></a>'
        '<iframe class="h5p-iframe" title="Game"></iframe><div class="qsm-before-message">Quiz?</div></div></div>',
    )
    assert cut(html) == [
        ("accordion_section_h5p", "Game", None, None, None),
        ("accordion_section_prezi", "P", None, "https://prezi.com/view/q/", "q.pdf"),
        ("accordion_section_image", "P", None, "/big.png", None),
        ("accordion_section_quiz", "P", "Quiz?", None, None),
    ]


def test_widgets_inside_tabs_belong_to_the_accordion(cut):
    inner = widget("elementor-widget-image", '<img src="n.png">') + widget("elementor-widget-text-editor", "<p>t</p>")
    assert [s[0] for s in cut(toggle(("A", inner)))] == ["accordion_section_text", "accordion_section_image"]


def test_nested_text_editor_counts_once(cut):
    html = widget("elementor-widget-text-editor", "x" + widget("elementor-widget-text-editor", "<p>inner</p>"))
    assert cut(html) == [("plain_text", None, "inner", None, None)]


def test_shortcodes(cut):
    quiz = widget("elementor-widget-shortcode", '<div class="qsm-before-message">\nQ\n</div><iframe src="https://prezi.com/x"></iframe>')
    frames = widget(
        "elementor-widget-shortcode",
        '<iframe src="https://prezi.com/view/q/"></iframe><iframe class="h5p-iframe" src="about:blank" title="G"></iframe>'
        '<iframe class="h5p-iframe" title="H"></iframe><iframe src="/other"></iframe>',
    )
    assert cut(quiz + frames + widget("elementor-widget-shortcode", "nothing")) == [
        ("quiz", None, "\nQ\n", None, None),
        ("prezi", None, None, "https://prezi.com/view/q/", "q.pdf"),
        ("h5p", "G", None, None, None),
        ("h5p", "G", None, None, None),
    ]


def test_single_widgets(cut):
    settings = '{&quot;video_type&quot;:&quot;youtube&quot;,&quot;youtube_url&quot;:&quot;https:\\/\\/youtu.be\\/abc&quot;}'
    html = (
        widget("elementor-widget-image", '<img src="a.png"><img src="b.png">')
        + widget("elementor-widget-video", "", f'data-settings="{settings}"')
        + widget("elementor-widget-video", "", "data-settings='{\"video_type\":\"hosted\"}'")
        + widget("elementor-widget-video", "")
        + widget("elementor-video", '<iframe src="v.mp4"></iframe>')
        + widget("elementor-widget-htmega-flipbox-addons",
                 '<div class="front-container">F</div><div class="back-container">B</div><a href="/go" class="flp-btn">x</a>')
        + widget("elementor-widget-spacer", "")
    )
    assert cut(html) == [
        ("image", None, None, "a.png", None),
        ("youtube", None, None, "https://youtu.be/abc", "abc.pdf"),
        ("video", None, None, "v.mp4", None),
        ("flipcard", "F", "F\nB", "/go", None),
    ]


def test_unknown_widgets_are_counted(spark):
    html = widget("elementor-widget-new", "x") * 2 + widget("elementor-widget-spacer", "") + widget("elementor-widget-image", "")
    documents = parse(spark.createDataFrame([(1, html)], "id int, html string"), track=TRACK)
    assert [tuple(r) for r in unknown_widgets(documents, "id").collect()] == [("elementor-widget elementor-widget-new", 2)]
