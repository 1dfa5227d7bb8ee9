"""Queries on generated articles, whose every section is known from the rows they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.links import Site
from folioworks.html import extract
from folioworks.html.parser import NODE, parse
from folioworks.html.render import MARKDOWN_FIELDS, SANITIZE_FIELDS, markdown, sanitize
from folioworks.html.sections import TEXT_EDITOR, TRACK, WIDGET, unknown_widgets
from folioworks.html.sections import sections as cut_sections
from folioworks.html.select import has_class, select_nodes
from folioworks.operators.hierarchy import Associations, interval_labels
from folioworks.operators.quality import orphans
from folioworks.operators.tables import dealt, value_counts
from folioworks.plans.posts import enrich, owners_of, read_facts, related_posts, resolve_links, sections, with_headlines
from folioworks.queries.registry import query, view
from folioworks.queries.relations import NORMALISED, NORMALISED_VIEWS, joined, normalised
from folioworks.session import written
from folioworks.sources.landing import table

SITE = Site(host="site.example", archive="/archive")


def _widget(classes: str, inner: str) -> str:
    return f'<div class="elementor-widget {classes}">{inner}</div>'


def _toggle(inner: str) -> str:
    return _widget(
        "elementor-widget-toggle",
        '<div class="elementor-toggle-item"><a class="elementor-toggle-title">Acc @</a>'
        f'<div class="elementor-tab-content">{inner}</div></div>',
    )


_VIDEO_SETTINGS = (
    "{&quot;video_type&quot;:&quot;youtube&quot;,&quot;youtube_url&quot;:&quot;https:\\/\\/youtu.be\\/v@&quot;}"
)

# The HTML of each kind of widget; @ stands for its number.  A pair differs by odd and even numbers.
HTML = {
    0: _widget(TEXT_EDITOR, '<p>Text <b>@</b> <a href="https://site.example/p/@/">more</a></p>'),
    1: _widget("elementor-widget-image", '<img src="https://site.example/uploads/@.jpg">'),
    2: _toggle('<p>Body @</p><p>&nbsp;</p><iframe src="https://prezi.com/view/v@/"></iframe>'),
    3: f'<div class="elementor-widget elementor-widget-video" data-settings="{_VIDEO_SETTINGS}"></div>',
    4: _widget("elementor-widget-shortcode", '<div class="qsm-before-message">Quiz @</div>'),
    5: (
        _widget(
            "elementor-widget-htmega-flipbox-addons",
            '<div class="front-container">F @</div><div class="back-container">B @</div>'
            '<a class="flp-btn" href="https://site.example/flip/@">go</a>',
        ),
        _widget(
            "elementor-widget-htmega-flipbox-addons",
            '<div class="front-container">F @</div><div class="back-container">B @</div>',
        ),
    ),
    6: _widget("elementor-widget-shortcode", '<iframe class="h5p-iframe" src="about:blank" title="H5P @"></iframe>'),
    7: _widget(
        "elementor-widget-icon-list",
        '<ul class="elementor-icon-list-items">'
        '<li class="elementor-icon-list-item"><a href="https://site.example/archive/#36-@">files</a></li>'
        '<li class="elementor-icon-list-item"><a href="https://site.example/p/@/">post</a></li></ul>',
    ),
    8: (
        _toggle('<iframe src="https://www.youtube.com/embed/v@?si=x" title="Clip @"></iframe><img src="@.png">'),
        _toggle(
            '<iframe src="https://www.youtube.com/embed/v@?si=x"><a class="ytp-title-link">Inner clip @</a></iframe>'
            '<img src="@.png">'
        ),
    ),
    9: _widget(
        "elementor-widget-htmega-accordion-addons",
        '<div class="single_accourdion"><div class="htmega-accourdion-title">Panel @</div><div class="accordion-content">'
        '<a href="https://site.example/big/@.png"><img src="s.png"></a>'
        '<a href="https://prezi.com/view/v@/"><img src="t.png"></a></div></div>',
    ),
    10: _toggle(
        _widget(TEXT_EDITOR, "<p>Inner @</p>")
        + '<div class="qsm-before-message">Ask @</div><iframe class="h5p-iframe" title="Play @"></iframe>'
    ),
    11: _widget("elementor-widget-shortcode", '<iframe src="https://prezi.com/view/v@/"></iframe>'),
    12: _widget("elementor-video", '<iframe src="https://video.example/@"></iframe>'),
    13: _widget("elementor-widget-button", '<a href="https://site.example/book/@.pdf">Zum Volltext</a>'),
    14: (
        _widget(
            "elementor-widget-wpfd_choose_category",
            '<div class="wpfd-content"><ul class="wpfd-content-tree" data-category="@"></ul></div>',
        ),
        _widget("elementor-widget-wpfd_choose_category", '<div class="wpfd-content"></div>'),
    ),
    15: _widget(
        "elementor-widget-wp-embed",
        '<div class="wp-embed type-post"><a class="wp-embed-more" href="https://site.example/p/@/">more</a></div>',
    ),
    16: _widget("elementor-widget-heading", "<h2>Part @</h2>"),
}


def articles(spark, folder) -> DataFrame:
    """One article per order that has lines, one widget per line number."""
    def fragment(w):
        template = None
        for kind, html in HTML.items():
            even, odd = html if isinstance(html, tuple) else (html, html)
            choice = F.when(w["k"] % 2 == 0, F.lit(even)).otherwise(F.lit(odd))
            here = w["kind"] == kind
            template = F.when(here, choice) if template is None else template.when(here, choice)
        return F.replace(template, F.lit("@"), w["k"].cast("string"))

    # Only numbers are gathered; the HTML is written behind the shuffle.
    gathered = dealt(view(spark, folder, "v_widget"), "doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("w", "kind", "k")).alias("f"))
    html = F.array_join(F.transform(F.array_sort("f"), fragment), "")
    return gathered.select(F.col("doc_id").alias("id"), html.alias("html"))


def documents(spark, folder, fields=NODE.names) -> DataFrame:
    return parse(articles(spark, folder), track=TRACK, fields=fields)


def _section(kind, sub, type_, title="NULL", text="NULL", link="NULL", media="NULL", where="true"):
    return f"""SELECT doc_id, w, {sub} AS sub, '{type_}' AS type, {title} AS title, {text} AS text, {link} AS external_link, {media} AS media
               FROM v_widget WHERE kind = {kind} AND {where}"""


def _c(before: str, after: str = "") -> str:
    return f"concat('{before}', k, '{after}')"


_PREZI_LINK, _PREZI_KEY = _c("https://prezi.com/view/v", "/"), _c("prezi.com/view/v", "/")
_ROWS = " UNION ALL ".join(
    [
        _section(0, 0, "plain_text", text="concat('Text **', k, '** [more](https://site.example/p/', k, '/)')"),
        _section(1, 0, "image", link=_c("https://site.example/uploads/", ".jpg")),
        _section(2, 0, "accordion_section_text", _c("Acc "), _c("Body ")),
        _section(2, 1, "accordion_section_prezi", _c("Acc "), link=_PREZI_LINK, media=_PREZI_KEY),
        _section(3, 0, "youtube", link=_c("https://youtu.be/v"), media=_c("v")),
        _section(4, 0, "quiz", text=_c("Quiz ")),
        _section(5, 0, "flipcard", _c("F "), "concat('F ', k, chr(10), 'B ', k)",
                 f"CASE WHEN k % 2 = 0 THEN {_c('https://site.example/flip/')} END"),
        _section(6, 0, "h5p", _c("H5P ")),
        _section(8, 0, "accordion_section_youtube",
                 f"CASE WHEN k % 2 = 0 THEN {_c('Clip ')} ELSE {_c('Inner clip ')} END",
                 link=_c("https://www.youtube.com/embed/v", "?si=x"), media=_c("v")),
        _section(8, 1, "accordion_section_image", _c("Acc "), link=_c("", ".png")),
        _section(9, 0, "accordion_section_image", _c("Panel "), link=_c("https://site.example/big/", ".png")),
        _section(9, 1, "accordion_section_prezi", _c("Panel "), link=_PREZI_LINK, media=_PREZI_KEY),
        _section(10, 0, "accordion_section_text", _c("Acc "), _c("Inner ")),
        _section(10, 1, "accordion_section_h5p", _c("Play ")),
        _section(10, 2, "accordion_section_quiz", _c("Acc "), _c("Ask ")),
        _section(11, 0, "prezi", link=_PREZI_LINK, media=_PREZI_KEY),
        _section(12, 0, "video", link=_c("https://video.example/")),
    ]
)


@query(
    "sections",
    f"""WITH s AS ({_ROWS}), m AS (
          SELECT CASE pos % 3 WHEN 1 THEN concat('v', pos) WHEN 2 THEN concat('prezi.com/view/v', pos, '/') ELSE concat('prezi.com/view/none', pos, '/') END AS media, url_transkript FROM v_lookup)
        SELECT doc_id AS post_id, CAST(n AS INT) AS widget_no, sub AS section_no, type, title, text, external_link, url_transkript AS transcript_url
        FROM s LEFT JOIN m USING (media)
        JOIN (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY w) - 1 AS n FROM v_widget) USING (doc_id, w)""",
    ("v_widget", "v_lookup"),
)
def all_sections(spark, folder):
    return sections(documents(spark, folder), view(spark, folder, "v_lookup"))


@query("section_counts", f"SELECT type, count(*) AS n FROM ({_ROWS}) GROUP BY type", ("v_widget",))
def section_counts(spark, folder):
    return value_counts(cut_sections(documents(spark, folder, MARKDOWN_FIELDS), "id"), "type")


@query("section_orphans", f"SELECT DISTINCT doc_id AS key FROM ({_ROWS}) WHERE doc_id % 10 = 3", ("v_widget",))
def section_orphans(spark, folder):
    found = cut_sections(documents(spark, folder, MARKDOWN_FIELDS), "id")
    return orphans(found, "post_id", view(spark, folder, "v_post").filter(F.col("id") % 10 != 3), "id")


@query(
    "unknown_widgets",
    """SELECT CASE kind WHEN 13 THEN 'elementor-widget elementor-widget-button' ELSE 'elementor-widget elementor-widget-wp-embed' END AS classes,
              count(*) AS n FROM v_widget WHERE kind IN (13, 15) GROUP BY kind""",
    ("v_widget",),
)
def unknown(spark, folder):
    return unknown_widgets(documents(spark, folder), "id")


@query(
    "html_scope",
    "SELECT doc_id AS id, CAST(count(*) AS INT) AS outermost, CAST(count(*) FILTER (kind = 10) AS INT) AS inside FROM v_widget GROUP BY doc_id",
    ("v_widget",),
)
def html_scope(spark, folder):
    tab = F.filter("nodes", has_class(WIDGET))
    return documents(spark, folder).select(
        "id",
        F.size(F.filter(tab, lambda n: ~F.map_contains_key(n["scopes"], ".elementor-tab-content"))).alias("outermost"),
        F.size(F.filter(tab, lambda n: F.map_contains_key(n["scopes"], ".elementor-tab-content"))).alias("inside"),
    )


_EDITORS = "SELECT doc_id AS id, {} AS text FROM v_widget WHERE kind = 0 UNION ALL SELECT doc_id, {} FROM v_widget WHERE kind = 10"


@query(
    "html_markdown",
    _EDITORS.format("concat('Text **', k, '** [more](https://site.example/p/', k, '/)')", "concat('Inner ', k)"),
    ("v_widget",),
)
def html_markdown(spark, folder):
    return select_nodes(documents(spark, folder, MARKDOWN_FIELDS), ["id"], has_class(TEXT_EDITOR)).select(
        "id", markdown(F.col("sub")).alias("text")
    )


@query(
    "html_sanitize",
    _EDITORS.format("concat('<p>Text <strong>', k, '</strong> <a>more</a></p>')", "concat('<p>Inner ', k, '</p>')"),
    ("v_widget",),
)
def html_sanitize(spark, folder):
    return select_nodes(documents(spark, folder, SANITIZE_FIELDS), ["id"], has_class(TEXT_EDITOR)).select(
        "id", sanitize(F.col("sub")).alias("text")
    )


_CHAPTERS = "coalesce(string_agg(CAST(k AS VARCHAR), '|' ORDER BY w) FILTER (kind = 7), '')"
_BOOK = "max(concat('https://site.example/book/', k, '.pdf')) FILTER (kind = 13)"
_DEDICATED = "CASE WHEN arg_min(k, w) FILTER (kind = 14) % 2 = 0 THEN arg_min(k, w) FILTER (kind = 14) END"


def facts(spark, folder):
    return read_facts(documents(spark, folder), SITE)


@query("chapter_links", f"SELECT doc_id AS id, {_CHAPTERS} AS chapters FROM v_widget GROUP BY doc_id", ("v_widget",))
def chapters(spark, folder):
    found = extract.chapter_links(F.col("nodes"), SITE).cast("array<string>")
    return documents(spark, folder, extract.LINK_FIELDS).select("id", F.array_join(found, "|").alias("chapters"))


@query("labelled_link", f"SELECT doc_id AS id, {_BOOK} AS book_chapter FROM v_widget GROUP BY doc_id", ("v_widget",))
def labelled(spark, folder):
    return documents(spark, folder).select("id", extract.labelled_link(F.col("nodes")).alias("book_chapter"))


@query("scoped_attr", f"SELECT doc_id AS id, {_DEDICATED} AS category FROM v_widget GROUP BY doc_id", ("v_widget",))
def scoped_attr(spark, folder):
    return documents(spark, folder).select("id", extract.dedicated_category(F.col("nodes")).alias("category"))


@query(
    "headline",
    "SELECT id, CASE WHEN id % 6 > 0 THEN title END AS headline FROM v_post",
    ("v_post",),
)
def headlines(spark, folder):
    return targets(spark, folder).select("id", extract.headline(F.col("nodes")).alias("headline"))


def targets(spark, folder) -> DataFrame:
    """The page of every post under a second address, with a headline on five in six.

    Posts are short on disk and long to parse, so they are dealt out to tasks first.
    """
    shown = F.when(
        F.col("id") % 6 > 0, F.concat(F.lit('<h1 class="big gb-headline"> '), F.col("title"), F.lit(" </h1>"))
    ).otherwise("")
    pages = view(spark, folder, "v_post").select("id", "title").repartition("id").select(
        "id",
        F.concat(F.lit("https://site.example/go/"), F.col("id").cast("string")).alias("url"),
        F.concat(F.lit("<body><h1>Site</h1>"), shown, F.lit("</body>")).alias("html"),
    )
    return parse(pages)


@query(
    "link_headlines",
    """SELECT l_orderkey AS id, concat('https://site.example/go/', l_orderkey, '/?from=', l_linenumber) AS href,
              CASE WHEN l_orderkey % 6 > 0 THEN title END AS link_title, CASE WHEN l_orderkey % 6 > 0 THEN p.id END AS target_id
       FROM lineitem LEFT JOIN v_post p ON p.id = l_orderkey""",
    ("v_post",),
)
def link_headlines(spark, folder):
    """Links that no address of a post explains are found by the headline of the page behind them."""
    key = F.col("l_orderkey")
    links = table(spark, folder, "lineitem").select(
        key.alias("id"),
        F.concat(
            F.lit("https://site.example/go/"), key.cast("string"), F.lit("/?from="), F.col("l_linenumber").cast("string")
        ).alias("href"),
    )
    return resolve_links(with_headlines(links, targets(spark, folder)), view(spark, folder, "v_post"))


_RELATED = """SELECT doc_id AS id, string_agg(DISTINCT k, '|' ORDER BY k) AS related_posts, count(*) AS n_links
              FROM v_widget JOIN v_post p ON p.id = k WHERE kind IN (0, 7, 15) AND k <> doc_id GROUP BY doc_id"""


@query("related_items", f"SELECT * FROM ({_RELATED})", ("v_widget", "v_post"))
def related_items(spark, folder):
    links = facts(spark, folder).select("id", F.explode("links").alias("href")).withColumn(
        "link_title", F.lit(None).cast("string")
    )
    return related_posts(links, view(spark, folder, "v_post")).withColumn(
        "related_posts", F.array_join(F.col("related_posts").cast("array<string>"), "|")
    )


@query(
    "post_enriched",
    f"""WITH RECURSIVE closure AS (
          SELECT node_id AS ancestor_id, node_id FROM v_chapter
          UNION ALL SELECT c.ancestor_id, n.node_id FROM closure c JOIN v_chapter n ON n.parent_id = c.node_id),
        fact AS (SELECT doc_id, {_CHAPTERS} AS chapters, {_BOOK} AS book, {_DEDICATED} AS category FROM v_widget GROUP BY doc_id),
        files AS (SELECT ancestor_id, string_agg(CAST(item_id AS VARCHAR), '|' ORDER BY item_id) AS items
                  FROM closure JOIN v_filed ON category_id = node_id GROUP BY ancestor_id)
        SELECT n.id, date, n.title, stage, tool_types, topics, chapters AS download_chapters_further, book AS book_chapter,
               category AS download_chapter_dedicated, coalesce(related_posts, '') AS related_posts, items AS associated_downloads
        FROM ({NORMALISED}) n LEFT JOIN fact f ON f.doc_id = n.id LEFT JOIN ({_RELATED}) r ON r.id = n.id
        LEFT JOIN files ON ancestor_id = category""",
    (*NORMALISED_VIEWS, "v_widget", "v_chapter", "v_filed"),
)
def post_enriched(spark, folder):
    tree_nodes = view(spark, folder, "v_chapter").withColumn("ordinal", F.col("node_id"))
    found = written(facts(spark, folder), "facts")
    associations = Associations(owners_of(found), view(spark, folder, "v_filed"), interval_labels(tree_nodes))
    enriched = enrich(normalised(spark, folder), found, targets(spark, folder), view(spark, folder, "v_post"), associations)
    return enriched.select(
        "id", "date", "title", "stage", joined("tool_types", "none"), joined("topics"),
        joined("download_chapters_further"), "book_chapter", "download_chapter_dedicated",
        joined("related_posts"), joined("associated_downloads"),
    )
