"""Queries on the raw web pages, on links and on scalar text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.functions import bibliography as bib
from folioworks.functions import links, text
from folioworks.html.extract import nth_text
from folioworks.html.parser import TEXT, parse
from folioworks.html.render import sanitize
from folioworks.html.select import (
    anchors,
    content_area,
    descendants,
    has_class,
    is_tag,
    node_table,
    page_title,
    select_nodes,
    text_of,
)
from folioworks.operators.containment import contains_pairs, first_containing
from folioworks.operators.lists import join_text
from folioworks.operators.tables import first_per_key
from folioworks.plans.bibliography import records, split_tags
from folioworks.plans.catalogue import area_class, fixed_table, label_pivot, legal_texts
from folioworks.plans.posts import resolve_links
from folioworks.queries.registry import query, view
from folioworks.sources.landing import table


def parsed(spark, folder, *keep):
    return parse(table(spark, folder, "pages").select("page_id", *keep, "html"))


def decoded(sql: str) -> str:
    """Character references as they occur in the pages; a cut-off title may lack the semicolon."""
    for ref, char in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        sql = f"regexp_replace({sql}, '{ref}', '{char}', 'g')"
    return sql


def _plain(sql: str) -> str:
    """HTML without comments, tags and character references."""
    return decoded(f"regexp_replace(regexp_replace({sql}, '<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')")


def _spaced(sql: str) -> str:
    """One space for every run of blanks, none at the ends."""
    return f"trim(regexp_replace({sql}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"


@query(
    "html_nodes",
    """SELECT page_id, tag, n FROM (
         SELECT page_id, tag, len(regexp_extract_all(html, concat('<', tag, '[ >]'))) AS n
         FROM pages, (VALUES ('p'), ('a'), ('b'), ('br'), ('li'), ('ul'), ('div'), ('h1'), ('article'), ('title')) AS t(tag)) WHERE n > 0""",
)
def html_nodes(spark, folder):
    nodes = node_table(parsed(spark, folder), "page_id")
    tags = ("p", "a", "b", "br", "li", "ul", "div", "h1", "article", "title")
    return nodes.filter(F.col("tag").isin(*tags)).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "select_class",
    f"""SELECT page_id, {decoded("unnest(regexp_extract_all(html, '<div class=\"ad\">([^<]*)</div>', 1))")} AS text FROM pages""",
)
def select_class(spark, folder):
    rows = select_nodes(parsed(spark, folder), ["page_id"], has_class("ad", "div"))
    return rows.select("page_id", text_of(F.col("sub")).alias("text"))


ANCHORS = f"""SELECT page_id, {decoded("a[1]")} AS href, {decoded("a[2]")} AS text FROM (
    SELECT page_id, unnest(list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
                                    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2))) AS a FROM pages)"""


@query("anchors", ANCHORS)
def all_anchors(spark, folder):
    return anchors(parsed(spark, folder), "page_id").drop("pos")


@query("distinct_links", f"SELECT href, count(*) AS n FROM (SELECT DISTINCT page_id, href FROM ({ANCHORS})) GROUP BY href")
def distinct_links(spark, folder):
    found = anchors(parsed(spark, folder), "page_id").select("page_id", "href").distinct()
    return found.groupBy("href").agg(F.count(F.lit(1)).alias("n"))


@query("page_title", f"""SELECT page_id, trim({decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")}) AS title FROM pages""")
def titles(spark, folder):
    return parsed(spark, folder).select("page_id", page_title(F.col("nodes")).alias("title"))


@query(
    "fallback_title",
    f"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN trim({decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")})
                             ELSE coalesce(nullif(split_part(url, '/', -2), ''), 'Unknown') END AS title
        FROM pages""",
)
def fallback_title(spark, folder):
    title = F.when(F.col("page_id") % 3 == 0, page_title(F.col("nodes")))
    return parsed(spark, folder, "url").select(
        "page_id", F.coalesce(title, text.first_filled(links.last_folder(F.col("url")), F.lit("Unknown"))).alias("title")
    )


TITLES = f"""SELECT page_id, coalesce(nullif(trim({decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")}), ''),
                                nullif(split_part(url, '/', -2), ''), 'Unknown') AS title
        FROM (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN html ELSE regexp_replace(html, '<title>[^<]*</title>', '') END AS html FROM pages
              UNION ALL SELECT -1 - page_id, url, html FROM pages)"""


def title_or_folder(spark, folder):
    """Titles of all pages; pages without one are made of the same pages."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    untitled = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(F.regexp_replace("html", "<title>[^<]*</title>", ""))
    both = pages.withColumn("html", untitled).unionByName(pages.withColumn("page_id", -1 - F.col("page_id")))
    title = F.coalesce(text.first_filled(page_title(F.col("nodes"))), text.first_filled(links.last_folder(F.col("url")), F.lit("Unknown")))
    return parse(both).select("page_id", title.alias("title"))


@query(
    "paragraph_text",
    f"""SELECT page_id, trim({decoded("p")}) AS text
        FROM (SELECT page_id, unnest(regexp_extract_all(html, '<p>([^<]+)</p>', 1)) AS p FROM pages) WHERE trim({decoded("p")}) <> ''""",
)
def paragraph_text(spark, folder):
    """Texts of the paragraphs that hold no other element."""
    rows = select_nodes(parsed(spark, folder), ["page_id"], is_tag("p"))
    plain = F.forall(F.slice("sub", 2, F.size("sub")), lambda n: n["tag"] == TEXT) & (F.size("sub") > 1)
    found = rows.filter(plain).select("page_id", text.strip(text_of(F.col("sub"))).alias("text"))
    return found.filter(text.present(F.col("text")))


_P = _plain("regexp_replace(p, '</p>.*$', '', 's')")
PARAGRAPHS = f"""SELECT page_id, trim({_P}) AS text
        FROM (SELECT page_id, unnest(string_split(regexp_replace(html, '</article>.*$', '', 's'), '<p>')[2:]) AS p FROM pages) WHERE trim({_P}) <> ''"""


def all_paragraphs(spark, folder):
    """Texts of all paragraphs, whatever they hold; one that is not closed ends where the next begins."""
    rows = select_nodes(parsed(spark, folder), ["page_id"], is_tag("p"))
    ends = F.array_position(F.transform(F.slice("sub", 2, F.size("sub")), lambda n: n["tag"] == "p"), True).cast("int")
    own = F.when(ends > 0, F.slice("sub", F.lit(1), ends)).otherwise(F.col("sub"))
    found = rows.select("page_id", text.strip(text_of(own)).alias("text"))
    return found.filter(text.present(F.col("text")))


@query(
    "nth_element",
    f"""SELECT page_id, {decoded("regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)[4]")} AS text FROM pages""",
)
def nth_element(spark, folder):
    return parsed(spark, folder).select("page_id", nth_text(F.col("nodes"), is_tag("nav"), "li", 3).alias("text"))


_BODY = _plain("regexp_extract(html, '<body>(.*)</body>', 1, 's')")
_AD = decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")


@query(
    "area_extract",
    f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN {_AD} WHEN 1 THEN {_BODY} END AS text FROM
        (SELECT page_id, concat(regexp_replace(html, '</body>.*$', '', 's'), '</body>') AS html FROM pages)""",
)
def area_extract(spark, folder):
    strategy = F.element_at(
        F.array(*[F.lit(s) for s in ("soup", "direct", "selenium", "wait_jportal_load")]), (F.col("page_id") % 4 + 1).cast("int")
    )
    wanted = area_class(strategy, F.lit("ad"), F.col("url"))
    return parsed(spark, folder, "url").select(
        "page_id", text_of(content_area(F.col("nodes"), wanted)).alias("text")
    )


@query(
    "sanitized_text",
    f"""SELECT page_id, {_spaced(_plain("regexp_extract(html, '<article>(.*)</article>', 1, 's')"))} AS text FROM pages""",
)
def sanitized_text(spark, folder):
    """Sanitised articles with the remaining tags taken out again: no text may be lost."""
    article = sanitize(F.get(F.transform(F.filter("nodes", is_tag("article")), lambda n: descendants(F.col("nodes"), n)), F.lit(0)))
    bare = F.regexp_replace(article, "<[^>]*>", "")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(ref), F.lit(char))
    return parsed(spark, folder).select("page_id", F.trim(bare).alias("text"))


@query(
    "legal_texts",
    f"""SELECT url, CASE WHEN page_id % 2 = 0 THEN 'act' ELSE 'order' END AS type, concat('Law ', page_id) AS title, code AS jurisdiction,
               CASE page_id % 3 WHEN 0 THEN {_spaced(_AD)} WHEN 1 THEN {_spaced(_BODY)} END AS text
        FROM (SELECT page_id, url, concat(regexp_replace(html, '</body>.*$', '', 's'), '</body>') AS html FROM pages)
        JOIN v_jurisdiction ON num = page_id % 17""",
    ("v_jurisdiction",),
)
def legal(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("source_url"))
    number = F.col("page_id")
    configured = pages.join(view(spark, folder, "v_jurisdiction"), F.col("num") == number % 17).select(
        F.col("code").alias("jurisdiction"),
        F.concat(F.lit("Law "), number.cast("string")).alias("title"),
        F.when(number % 2 == 0, F.lit("act")).otherwise("order").alias("type"),
        F.when(number % 5 > 0, F.col("source_url")).alias("permalink"),
        F.col("source_url").alias("url"),
        F.element_at(F.array(F.lit("soup"), F.lit("direct"), F.lit("wait_jportal_load")), (number % 3 + 1).cast("int")).alias("strategy"),
        F.lit("ad").alias("area_class"),
        "source_url",
    )
    found = legal_texts(configured, parsed(spark, folder, "url").withColumnRenamed("url", "source_url"))
    bare = F.regexp_replace("html", "<[^>]*>", "")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(ref), F.lit(char))
    return found.withColumn("text", F.trim(bare)).drop("html")


_SITE = links.Site(host="example.com", archive="/en/6")


@query(
    "link_filter",
    """SELECT page_id, url FROM pages WHERE contains(url, 'example.com') AND NOT contains(url, '/en/6') AND NOT contains(url, 'uploads')
       AND NOT contains(url, 'download') AND NOT contains(url, '?s') AND NOT contains(url, 'feedback_geben')""",
)
def link_filter(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url").filter(_SITE.is_article(F.col("url")))


@query(
    "abs_url",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('https://guide.example/u/', user_id) ELSE concat('https://guide.example/e/', event_id) END AS url
       FROM events""",
)
def abs_url(spark, folder):
    base = "https://guide.example"
    href = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("/u/"), F.col("user_id").cast("string"))).otherwise(
        F.concat(F.lit(f"{base}/e/"), F.col("event_id").cast("string"))
    )
    return table(spark, folder, "events").select("event_id", links.absolute(href, base).alias("url"))


@query(
    "int_attr",
    "SELECT page_id, coalesce(CAST(nullif(regexp_extract(url, '/([0-9]+)(?:[?#].*)?$', 1), '') AS BIGINT), 0) AS number FROM pages",
)
def int_attr(spark, folder):
    digits = F.nullif(F.regexp_extract("url", r"/([0-9]+)(?:[?#].*)?$", 1), F.lit(""))
    return table(spark, folder, "pages").select("page_id", text.int_or_zero(digits).alias("number"))


@query(
    "regex_capture",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN o_custkey END AS category,
              CASE WHEN o_orderkey % 4 = 0 THEN concat('p', o_custkey) END AS presentation
       FROM orders""",
)
def regex_capture(spark, folder):
    key = F.col("o_custkey").cast("string")
    href = F.when(F.col("o_orderkey") % 9 > 0, F.concat(F.lit("https://site.example/archive/#36-"), key)).otherwise("/archive/")
    media = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("https://prezi.com/p/embed/p"), key, F.lit("/"))).otherwise("/x")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.capture_number(href, links.CATEGORY_PATTERN).alias("category"),
        F.nullif(F.regexp_extract(media, links.PRESENTATION_ID, 1), F.lit("")).alias("presentation"),
    )


@query("title_key", "SELECT page_id, replace(replace(title, '&', ''), '–', '') AS title FROM v_page", ("v_page",))
def title_keys(spark, folder):
    return view(spark, folder, "v_page").select("page_id", text.title_key(F.col("title")).alias("title"))


_BARE = "regexp_replace(regexp_replace({}, '[?#].*$', ''), '^[a-zA-Z]+://', '')"
_CANON = f"concat(lower(split_part({_BARE}, '/', 1)), regexp_replace(regexp_replace({_BARE}, '^[^/]*', ''), '/+$', ''))"


@query(
    "resolve_links",
    f"""SELECT link_id, href, link_title, coalesce(u.id, t.id) AS target_id FROM v_href
        LEFT JOIN (SELECT {_CANON.format("url", "url")} AS k, min(page_id) AS id FROM v_page GROUP BY 1) u ON u.k = {_CANON.format("href", "href")}
        LEFT JOIN (SELECT replace(title, '&', '') AS k, min(page_id) AS id FROM v_page GROUP BY 1) t
               ON u.id IS NULL AND t.k = replace(link_title, '&', '')""",
    ("v_page", "v_href"),
)
def resolved(spark, folder):
    items = view(spark, folder, "v_page").withColumnRenamed("page_id", "id")
    return resolve_links(view(spark, folder, "v_href"), items)


_MEDIA_KEY = """CASE WHEN contains(u, 'youtu.be') THEN split_part(u, '/', -1)
    WHEN contains(u, 'youtube') THEN CASE WHEN contains(u, 'embed') THEN split_part(split_part(u, '/', -1), '?', 1) ELSE split_part(u, 'v=', -1) END
    ELSE u END"""


@query("media_key", f"SELECT event_id, {_MEDIA_KEY} AS media FROM (SELECT event_id, replace(media_url, 'https://', '') AS u FROM v_media)", ("v_media",))
def media_keys(spark, folder):
    return view(spark, folder, "v_media").select("event_id", links.media_key(F.col("media_url")).alias("media"))


@query(
    "media_lookup",
    f"""SELECT event_id, url_transkript AS transcript_url
        FROM (SELECT event_id, {_MEDIA_KEY} AS media FROM (SELECT event_id, replace(media_url, 'https://', '') AS u FROM v_media))
        LEFT JOIN (SELECT {_MEDIA_KEY} AS media, url_transkript FROM (SELECT replace(trim(url_medium), 'https://', '') AS u, url_transkript FROM v_lookup)) USING (media)""",
    ("v_media", "v_lookup"),
)
def media_lookup(spark, folder):
    media = view(spark, folder, "v_media").select("event_id", links.media_key(F.col("media_url")).alias("media"))
    by_id = first_per_key(
        view(spark, folder, "v_lookup").withColumn("_id", links.media_key(text.strip(F.col("url_medium")))),
        ["_id"], ["pos"], ["url_transkript"],
    )
    return media.join(by_id, F.col("media") == F.col("_id"), "left").select(
        "event_id", F.col("url_transkript").alias("transcript_url")
    )


@query(
    "media_contains",
    f"""WITH keyed AS (SELECT event_id, {_MEDIA_KEY} AS media FROM (SELECT event_id, replace(media_url, 'https://', '') AS u FROM v_media)),
        found AS (SELECT media, min(pos) AS pos FROM (SELECT DISTINCT media FROM keyed) JOIN v_lookup ON contains(trim(url_medium), media) GROUP BY media)
        SELECT event_id, url_transkript AS transcript_url FROM keyed LEFT JOIN found USING (media) LEFT JOIN v_lookup USING (pos)""",
    ("v_media", "v_lookup"),
)
def media_contains(spark, folder):
    media = view(spark, folder, "v_media").select("event_id", links.media_key(F.col("media_url")).alias("media"))
    lookup = view(spark, folder, "v_lookup")
    return first_containing(media, "media", lookup, "pos", "url_medium", "url_transkript", "transcript_url").drop("media")


@query("contains_join", "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def contains_join(spark, folder):
    return contains_pairs(
        table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text"
    )


_DATE = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN CAST(year(o_orderdate) AS VARCHAR)
                ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
_AUTHORS = "concat(CASE WHEN o_custkey % 6 = 0 THEN '' ELSE concat('G', o_custkey, ' ') END, 'F', o_custkey, '|A B')"
_BIB = f"""SELECT concat('K', o_orderkey) AS key, CASE WHEN o_orderkey % 2 = 0 THEN 'book' ELSE 'report' END AS type, concat('T', o_custkey) AS title,
             CASE WHEN o_orderkey % 3 = 0 THEN 'About' END AS abstract, {_DATE} AS date, {_AUTHORS} AS authors,
             concat(CASE WHEN o_orderkey % 50 = 0 THEN 'http' ELSE 'https' END, '://x.example/', o_orderkey) AS url FROM orders"""


@query("bib_records", _BIB)
def bib_records(spark, folder):
    return records(view(spark, folder, "v_bib"), []).withColumn("authors", F.array_join("authors", "|"))


@query("date_parts", f"SELECT o_orderkey AS id, {_DATE} AS date FROM orders")
def date_parts(spark, folder):
    parts = F.from_json("doc", "issued struct<`date-parts`: array<array<int>>>")["issued"]["date-parts"]
    return view(spark, folder, "v_bib").select("id", bib.date_text(parts).alias("date"))


@query("person_names", f"SELECT o_orderkey AS id, {_AUTHORS} AS authors FROM orders")
def person_names(spark, folder):
    people = F.from_json("doc", "author array<struct<given: string, family: string>>")["author"]
    return view(spark, folder, "v_bib").select("id", F.array_join(bib.person_names(people), "|").alias("authors"))


@query(
    "tag_split",
    """SELECT id, upper(nullif(regexp_extract(tags, 'jurisdiction:([^|]*)', 1), '')) AS jurisdiction,
              nullif(regexp_extract(tags, 'school_type:([^|]*)', 1), '') AS school_type,
              CASE WHEN tags <> '' THEN array_to_string(list_filter(string_split(tags, '|'), lambda t: NOT starts_with(t, 'jurisdiction:') AND NOT starts_with(t, 'school_type:')), '|') END AS tags
       FROM v_tags""",
    ("v_tags",),
)
def tag_split(spark, folder):
    listed = F.when(F.col("tags") != "", F.split("tags", r"\|")).otherwise(F.array().cast("array<string>"))
    return split_tags(view(spark, folder, "v_tags").withColumn("tags", listed)).withColumn("tags", F.array_join("tags", "|"))


@query(
    "doc_text",
    "SELECT conv_id, string_agg(concat(text, chr(10)), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
)
def doc_text(spark, folder):
    return join_text(table(spark, folder, "conversations"), ["conv_id"], "turn", "text", alias="text")


_LABELS = {"user": "DE_BE", "assistant": "DE_NW", "Berlin": "DE_BB"}


@query(
    "label_pivot",
    """WITH split AS (
         SELECT term_id, pos, trim(lower(regexp_extract(line, '^([^:=]*)[:=]', 1))) AS label, line FROM v_line),
       body AS (
         SELECT term_id, pos, CASE label WHEN 'user' THEN 'DE_BE' WHEN 'assistant' THEN 'DE_NW' WHEN 'berlin' THEN 'DE_BB' ELSE 'definition' END AS code,
                CASE WHEN label IN ('user', 'assistant', 'berlin') THEN regexp_replace(line, '^[^:=]*[:=]', '') ELSE line END AS raw FROM split),
       clean AS (SELECT term_id, pos, code, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS body FROM body)
       SELECT t.term_id, string_agg(body, chr(10) ORDER BY pos) FILTER (code = 'definition') AS definition,
              string_agg(body, chr(10) ORDER BY pos) FILTER (code = 'DE_BB') AS "DE_BB",
              string_agg(body, chr(10) ORDER BY pos) FILTER (code = 'DE_BE') AS "DE_BE",
              string_agg(body, chr(10) ORDER BY pos) FILTER (code = 'DE_NW') AS "DE_NW"
       FROM (SELECT DISTINCT term_id FROM v_line) t LEFT JOIN (SELECT * FROM clean WHERE body <> '') c ON c.term_id = t.term_id GROUP BY t.term_id""",
    ("v_line",),
)
def pivoted(spark, folder):
    aliases = fixed_table(spark, _LABELS, "label", "code")
    return label_pivot(view(spark, folder, "v_line"), ["term_id"], "pos", "line", aliases, ["DE_BB", "DE_BE", "DE_NW"])
