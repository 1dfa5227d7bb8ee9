"""Queries for whole jobs: navigation, category lists, downloads, councils, guides, glossary, publications."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.contracts import PUBLICATIONS
from folioworks.html.extract import CATEGORY_FIELDS, category_nodes
from folioworks.html.parser import parse
from folioworks.operators.navigation import fill_levels, url_hierarchy
from folioworks.operators.quality import orphans, reasons
from folioworks.operators.tables import dealt
from folioworks.plans import bibliography, catalogue
from folioworks.queries.registry import STATE_OF_CUSTOMER, query, view
from folioworks.session import written
from folioworks.sources.landing import table

# Runs of each list: the last level 1 before a link, and the last level 2 after that.
_FILLED = """WITH cats AS (
    SELECT *, max(CASE WHEN lvl = 1 THEN pos END) OVER run AS p1, max(CASE WHEN lvl = 2 THEN pos END) OVER run AS p2
    FROM v_nav WINDOW run AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  filled AS (
    SELECT c.doc_id, c.pos, c.lvl, c.url, a.txt AS category, CASE WHEN c.lvl = 3 THEN b.txt END AS subcategory
    FROM cats c LEFT JOIN v_nav a ON a.doc_id = c.doc_id AND a.pos = c.p1
    LEFT JOIN v_nav b ON b.doc_id = c.doc_id AND b.pos = c.p2 AND c.p2 > c.p1
    WHERE c.lvl = 1 OR (c.lvl = 2 AND a.txt IS NOT NULL) OR (c.lvl = 3 AND a.txt IS NOT NULL AND b.txt IS NOT NULL))"""


@query("nav_levels", f"{_FILLED} SELECT doc_id, pos, category, subcategory FROM filled", ("v_nav",))
def nav_levels(spark, folder):
    # Short blocks, so that lists of this size cross their borders.
    filled = fill_levels(view(spark, folder, "v_nav"), "doc_id", "pos", "lvl", "txt", block=512)
    return filled.select("doc_id", "pos", "category", "subcategory")


@query(
    "nav_hierarchy",
    f"""{_FILLED} SELECT url, min(pos) AS first_pos, arg_max(category, pos) AS category, arg_max_null(subcategory, pos) AS subcategory
        FROM filled GROUP BY url""",
    ("v_nav",),
)
def nav_hierarchy(spark, folder):
    return url_hierarchy(view(spark, folder, "v_nav"), "doc_id", "pos", "lvl", "txt", "url")


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pages(rows, block, order, html, before="", after=""):
    """One page per block of at most a few hundred rows, its pieces in order."""
    pieces = F.transform(F.array_sort(F.collect_list(F.struct(order, html.alias("html")))), lambda p: p["html"])
    return rows.groupBy(block).agg(_text(before, F.array_join(pieces, ""), after).alias("html"))


@query(
    "nav_tree",
    """WITH line AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
       SELECT o_orderkey // 100 AS page, concat('o', o_orderkey) AS node_id, NULL AS parent_id, '1' AS level,
              CASE WHEN o_orderkey % 9 = 0 THEN 'Untitled' ELSE concat('Order ', o_orderkey) END AS name FROM orders
       UNION ALL
       SELECT l_orderkey // 100, concat('l', l_orderkey, '-', l_linenumber), concat('o', l_orderkey), '2', concat('Line ', l_linenumber) FROM line""",
)
def nav_tree(spark, folder):
    """Orders and their line numbers as nested lists, a hundred orders to a page."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    nested = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 100).alias("page"))

    def item(key, line):
        return _text(
            '<li class="dd-item" data-id="l', key, "-", line, '" data-level="2" data-parent-id="o', key,
            '"><span class="title"> Line ', line, " </span></li>",
        )

    def entry(order):
        key = order["o_orderkey"]
        # A title of its own comes first; an order without one must not borrow that of a line.
        title = F.when(key % 9 == 0, F.lit('<span class="title">Untitled</span>')).otherwise(
            _text('<span class="title">Order ', key, "</span>")
        )
        inner = _text('<ol class="dd-list">', F.array_join(F.transform(order["lines"], lambda line: item(key, line)), ""), "</ol>")
        return _text('<li data-id="o', key, '" data-level="1">', title, F.coalesce(inner, F.lit("")), "</li>")

    # Only numbers are gathered; the HTML is written behind the shuffle.
    listed = orders.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    gathered = dealt(listed, "page").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "lines"))).alias("orders"))
    html = _text('<ol class="dd-list">', F.array_join(F.transform("orders", entry), ""), "</ol>")
    pages = gathered.select("page", html.alias("html"))
    return category_nodes(parse(pages, track=("li",), fields=CATEGORY_FIELDS), "page").drop("ordinal", "data_parent_id")


@query(
    "download_catalogue",
    """SELECT o_orderkey AS data_id, o_custkey AS data_category_id, concat('File ', o_orderkey) AS title, c_name AS category_title,
              concat('https://site.example/download/', o_custkey, '/cat-id/', o_orderkey, '/data-id') AS download_link,
              CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE 'pdf' END AS file_type, o_orderkey % 9 > 0 AS landed
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 9 > 0
       UNION ALL
       SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, false FROM orders WHERE o_orderkey % 9 = 0""",
)
def download_catalogue(spark, folder):
    """Category pages with a hundred file links each, every link on the page twice."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    key = F.col("o_orderkey")

    def link(o):
        return _text(
            '<a class="wpfd-file-link" data-id="', o["o_orderkey"], '" data-category_id="', o["o_custkey"], '" title="File ', o["o_orderkey"], '">get</a>'
        )

    # Numbers are gathered; what they are written as comes after the shuffle.
    linked = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_custkey")))
    html = F.array_join(F.transform(linked, lambda o: _text(link(o), link(o))), "")
    pages = orders.groupBy(F.floor(key / 100).alias("page")).agg(html.alias("html"))
    documents = parse(pages)
    categories = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    payloads = orders.filter(key % 9 > 0).select(
        key.alias("data_id"),
        F.when(key % 4 > 0, F.lit("application/pdf")).otherwise("").alias("content_type"),
        key.cast("string").cast("binary").alias("file_binary"),
    )
    files = written(catalogue.downloads(documents, "page", categories, "https://site.example"), "files")
    found = catalogue.with_payloads(files, payloads).drop("file_binary")
    missing = orphans(files, "data_id", payloads, "data_id").select(F.col("key").alias("data_id"))
    return found.withColumn("landed", F.lit(True)).unionByName(
        missing.withColumn("landed", F.lit(False)), allowMissingColumns=True
    )


@query(
    "council_list",
    """SELECT label AS name, concat('About ', s_name) AS description, concat('https://s', s_suppkey, '.example/') AS website, code AS jurisdiction
       FROM supplier JOIN v_jurisdiction ON num = s_suppkey % 17""",
    ("v_jurisdiction",),
)
def council_list(spark, folder):
    """Every supplier as a council with an overview page and a detail page."""
    dimension = catalogue.jurisdiction_table(spark)
    key = F.col("s_suppkey")
    names = view(spark, folder, "v_jurisdiction").select("num", "label")
    rows = table(spark, folder, "supplier").join(names, F.col("num") == key % 17)
    overview = rows.select(
        key.alias("id"),
        _text(
            '<section class="a5-section-linklist"><h4>All councils</h4></section><section class="a5-section-linklist"><h4>', F.col("label"),
            '</h4><a class="a5-theme-linklist-item-headline-link" href="https://s', key, '.example/">site</a><a title="Mehr Info" href="/d/', key,
            '">more</a></section>',
        ).alias("html"),
    )
    detail = rows.select(
        _text("/d/", key).alias("url"),
        _text('<div class="ym-gbox-left"><p>1</p><p>2</p><p>3</p><p>About ', F.col("s_name"), "</p></div>").alias("html"),
    )
    return catalogue.councils(parse(overview), "id", parse(detail), dimension)


@query(
    "guide_pages",
    """SELECT concat('https://guide.example/n/', page_id) AS url,
              CASE page_id % 5 WHEN 4 THEN concat('Top ', page_id - 4) ELSE concat('Top ', page_id - page_id % 5) END AS category,
              CASE WHEN page_id % 5 IN (2, 3) THEN concat('Sub ', page_id - page_id % 5 + 1) END AS subcategory,
              CASE WHEN page_id % 2 = 0 THEN concat('Guide ', page_id) ELSE 'n' END AS title,
              concat('<p>Page <strong>', page_id, '</strong></p>') AS html_content
       FROM pages WHERE page_id % 5 < 4""",
)
def guide_pages(spark, folder):
    """A navigation page per fifty pages, of levels 1, 2, 3, 3 and an excluded link, and the pages it leads to."""
    number = F.col("page_id")
    rows = table(spark, folder, "pages").select("page_id", F.floor(number / 50).alias("start"))
    rank = number % 5
    level = F.when(rank == 0, 1).when(rank == 1, 2).otherwise(3)
    label = (
        F.when(rank == 0, _text("Top ", number)).when(rank == 1, _text("Sub ", number)).when(rank == 4, F.lit("Downloads")).otherwise(_text("Leaf ", number))
    )
    href = F.when(number % 3 == 0, _text("https://guide.example/n/", number)).otherwise(_text("/n/", number))
    link = _text('<li><a data-level="', level, '" href="', href, '"> ', label, " </a></li>")
    start = _pages(rows, "start", "page_id", link, "<nav><ul>", "</ul></nav>")
    title = F.when(number % 2 == 0, _text("<title> Guide ", number, " </title>")).otherwise("")
    pages = rows.select(
        _text("https://guide.example/n/", number).alias("url"),
        _text("<html><head>", title, '</head><body><div id="content"><div><p>Page <b>', number, "</b></p></div><script>x</script></div></body></html>").alias("html"),
    )
    return catalogue.guide_pages(
        parse(start, track=("nav",)), "start", parse(pages), "https://guide.example"
    ).drop("first_pos")


@query(
    "glossary_terms",
    """WITH line AS (
         SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
         FROM conversations),
       clean AS (
         SELECT conv_id, turn, n, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS line, role = 'user' AND n = 1 AS state FROM line)
       SELECT concat('Term ', conv_id) AS term,
              string_agg(line, chr(10) ORDER BY turn, n) FILTER (NOT state AND line <> '') AS definition,
              string_agg(line, chr(10) ORDER BY turn, n) FILTER (state AND line <> '') AS "DE_BE"
       FROM clean GROUP BY conv_id""",
)
def glossary_terms(spark, folder):
    """Glossary entries with a paragraph per turn; those of users name a state."""
    turns = table(spark, folder, "conversations")
    body = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    marked = F.when(F.col("role") == "user", _text("Berlin: ", body)).otherwise(body)
    entry = _text("Term ", F.col("conv_id"))
    head = _text('<div class="elementor-toggle-item"><a class="elementor-toggle-title">', F.col("id"), "</a>")
    entries = _pages(turns.withColumn("id", entry), "id", "turn", _text("<p>", marked, "</p>")).select(
        "id", _text(head, F.col("html"), "</div>").alias("html")
    )
    return catalogue.glossary(parse(entries), "id", catalogue.jurisdiction_aliases(spark), ["DE_BE"]).drop("id", "entry")


@query(
    "publications",
    f"""SELECT concat('K', o_orderkey) AS key, concat('T', o_custkey) AS title,
              CASE WHEN o_orderkey % 3 = 0 THEN concat('DE_', upper({STATE_OF_CUSTOMER})) END AS jurisdiction,
              o_orderkey % 11 <> 0 AND NOT (o_orderkey % 3 = 0 AND o_custkey % 18 > 15) AND NOT (o_orderkey % 41 = 0 AND o_orderkey % 5 <> 0) AND o_orderkey % 50 <> 0 AS valid
       FROM orders WHERE o_orderkey % 8 <> 0""",
)
def publications(spark, folder):
    """Records joined with their landed files; those without a file are skipped."""
    items = view(spark, folder, "v_bib").join(view(spark, folder, "v_tags"), "id").withColumn("tags", F.split("tags", r"\|"))
    payloads = table(spark, folder, "orders").filter(F.col("o_orderkey") % 8 != 0).select(
        _text(F.when(F.col("o_orderkey") % 50 == 0, F.lit("http")).otherwise("https"), "://x.example/", F.col("o_orderkey")).alias("url"),
        F.lit("x").cast("binary").alias("pdf_binary"),
    )
    found = bibliography.publications(items, payloads)
    wrong = reasons(PUBLICATIONS, found.columns, {"insecure:url": bibliography.is_insecure(F.col("url"))})
    return found.select("key", "title", "jurisdiction", (F.size(wrong) == 0).alias("valid"))
