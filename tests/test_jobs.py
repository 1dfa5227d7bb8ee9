"""The steps end to end on a small landed folder, and the rules of single jobs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from folioworks import contracts as C
from folioworks.functions.links import Site
from folioworks.html.parser import parse
from folioworks.plans import bibliography, catalogue, posts
from folioworks.plans.runner import STEPS, Run, run_steps

HTML = {
    1: '<div class="elementor-widget elementor-widget-text-editor"><p>Hi <a href="https://site.example/two/">two</a></p></div>'
       '<div class="elementor-widget elementor-widget-wpfd_choose_category"><ul class="wpfd-content-tree" data-category="36"></ul></div>'
       '<div class="elementor-widget elementor-widget-video" data-settings=\'{"video_type":"youtube","youtube_url":"https://youtu.be/abc"}\'></div>',
    2: '<div class="elementor-widget elementor-widget-image"><img src="/i.png"></div>'
       '<ul class="elementor-icon-list-items"><li class="elementor-icon-list-item"><a href="https://site.example/archive/#36-41">x</a></li>'
       '<li class="elementor-icon-list-item"><a href="https://site.example/two">self</a></li></ul>'
       '<div class="elementor-widget elementor-widget-button"><a href="/book.pdf">Volltext</a></div>',
    3: '<div class="elementor-widget elementor-widget-text-editor"><a href="https://site.example/go/2">by headline</a></div>',
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    def pages(name, items):
        (folder / name).mkdir()
        for n, item in enumerate(items, 1):
            (folder / name / f"{n}.json").write_text(json.dumps({"page": n, "total_pages": len(items), "items": [item]}))

    cards, details = [], []
    for n, (code, label) in enumerate(C.JURISDICTIONS.items()):
        if code != "DE_SL":
            cards.append(
                f'<section class="a5-section-linklist"><h4>{label}</h4><a class="a5-theme-linklist-item-headline-link" href="https://c{n}.example">w</a>'
                f'<a title="Mehr Info" href="/d/{n}">i</a></section>'
            )
            details.append((f"/d/{n}", f'<div class="ym-gbox-left"><p>a</p><p>b</p><p>c</p><p>About {label}</p></div>'))
    put("council_pages", [(1, '<section class="a5-section-linklist">All</section>' + "".join(cards))], "id int, html string")
    put("council_details", details, "url string, html string")
    (folder / "council_supplement.json").write_text(
        json.dumps({"name": "Saarland", "website": "https://sl.example", "description": "By hand", "jurisdiction": "DE_SL"}, indent=1)
    )

    nav = ('<nav><ul><li><a data-level="1" href="/a/">A</a></li><li><a data-level="2" href="/b/">B</a></li>'
           '<li><a data-level="3" href="https://guide.example/c/">C</a></li><li><a href="/d/">Downloads</a></li></ul></nav>')
    put("guide_start", [(1, nav)], "id int, html string")
    put("guide_sources", [(f"https://guide.example/{x}/", f'<title>{x}!</title><div id="content"><p>{x}</p></div>') for x in "abc"],
        "url string, html string")

    config = [{"jurisdiction": "DE_BB", "resources": [
                  {"title": "S", "permalink": "https://law.example/1", "type": "Schulgesetz", "strategy": "soup", "area_class": "box"},
                  {"title": "D", "permalink": "https://law.example/2", "type": "Verordnung", "strategy": "direct", "html_url": "https://law.example/2.html"}]},
              {"jurisdiction": "DE_BE", "resources": [
                  {"title": "B", "permalink": "https://law.example/3", "type": "Schulgesetz", "strategy": "selenium"}]}]
    (folder / "legal_resources.json").write_text(json.dumps(config, indent=2))
    put("legal_sources", [("https://law.example/1", '<div class="box"><p>one</p></div>'), ("https://law.example/2.html", "<body><b>two</b></body>"),
                          ("https://law.example/3", '<div class="docbody"><h2>three</h2></div>')], "source_url string, html string")

    def record(key, **more):
        return json.dumps({"id": key, "type": "book", "title": f"T{key}", "URL": f"https://x.example/{key}", "issued": {"date-parts": [[2024, 3]]},
                           "author": [{"given": "A", "family": "B"}], **more})

    put("publication_items", [("k1", record("k1"), ["jurisdiction:de_bb", "free"]), ("k2", record("k2", abstract="x"), []), ("k3", record("k3"), None)],
        "key string, doc string, tags array<string>")
    put("publication_files", [("https://x.example/k1", b"1"), ("https://x.example/k2", b"2")], "url string, pdf_binary binary")

    tree = ('<ol class="dd-list"><li data-id="36" data-level="0"><span class="title">Root</span><ol class="dd-list">'
            '<li data-id="41" data-level="1" data-parent-id="36"><span class="title">Sub</span></li></ol></li></ol>')
    put("category_list", [(1, tree)], "id int, html string")
    link = '<a class="wpfd-file-link" data-id="{}" data-category_id="{}" title="F{}">x</a>'
    put("category_pages", [(36, link.format(7, 36, 7) + link.format(8, 41, 8)), (41, link.format(8, 41, 8))], "id int, html string")
    put("download_files", [(7, "application/pdf", b"7"), (8, None, b"8")], "data_id bigint, content_type string, file_binary binary")
    (folder / "transcripts.csv").write_text("url_medium,url_transkript\nhttps://youtu.be/abc ,abc.pdf\nhttps://youtu.be/abc,later.pdf\n")
    names = {1: "one", 2: "two", 3: "three"}
    pages("posts", [
        {"id": i, "date": "2024-05-06T07:08:09", "link": f"https://site.example/{names[i]}/", "title": {"rendered": f"Post {i}"},
         "content": {"rendered": html}, "stufe": [5] if i < 3 else [], "categories": [1, 2] if i == 1 else [], "tags": [9] if i == 1 else []}
        for i, html in HTML.items()
    ])
    pages("categories", [{"id": 1, "slug": "video"}, {"id": 2, "slug": "methode"}])
    pages("tags", [{"id": 9, "slug": "antraege"}])
    pages("stufe", [{"id": 5, "slug": "profis"}])
    put("link_targets", [("https://site.example/go/2/", '<h1 class="gb-headline"> Post 2 </h1>')], "url string, html string")
    put("glossary_pages", [(1, '<div class="elementor-toggle-item"><a class="elementor-toggle-title">Antrag</a><p>Ein Vorschlag.</p></div>'
                               '<div class="elementor-toggle-item"><a class="elementor-toggle-title">BSV</a><p>Deutschland: BSK\nNRW:  BSV und LSV</p><p>Mehr</p></div>')],
        "id int, html string")
    return str(folder)


def make_run(spark, landed, target, **more):
    return Run(spark, landed, str(target), Site("site.example", "/archive"), "https://site.example", "https://guide.example", **more)


def test_all_steps(spark, landed, tmp_path):
    assert run_steps(make_run(spark, landed, tmp_path)) == list(STEPS)

    def rows(name):
        df = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        assert df.columns == C.CONTRACTS[name].names
        return df.collect()

    assert len(rows("student_council_committees")) == 17
    assert {(r.name, r.description) for r in rows("student_council_committees")} >= {("Saarland", "By hand"), ("Bayern", "About Bayern")}
    assert {(r.title, r.category, r.subcategory, r.html_content) for r in rows("guide_pages")} == {
        ("a!", "A", None, "<p>a</p>"), ("b!", "A", None, "<p>b</p>"), ("c!", "A", "B", "<p>c</p>")}
    assert {(r.title, r.html, r.url) for r in rows("legal_resources")} == {
        ("S", "<p>one</p>", "https://law.example/1"), ("D", "<strong>two</strong>", "https://law.example/2"),
        ("B", "<h2>three</h2>", "https://law.example/3")}
    assert {(r.key, r.jurisdiction, r.date, tuple(r.tags) if r.tags is not None else None) for r in rows("publications")} == {
        ("k1", "DE_BB", "2024-03", ("free",)), ("k2", None, "2024-03", None)}

    published = {r.id: r for r in rows("posts")}
    one, two, three = published[1], published[2], published[3]
    assert (one.stage, one.tool_types, one.topics) == ("profis", ["methode", "video"], ["antraege"])
    assert (one.download_chapter_dedicated, one.associated_downloads, one.related_posts) == (36, [7, 8], [2])
    assert (two.download_chapters_further, two.book_chapter, two.related_posts) == ([41], "/book.pdf", [])
    assert (three.stage, three.tool_types, three.topics, three.associated_downloads) == (None, [None], [], None)
    assert three.related_posts == [2]
    downloads = {r.data_id: r for r in rows("downloads")}
    assert (downloads[8].category_title, downloads[8].file_type, downloads[8].associated_posts) == ("Sub", "unknown", [1])
    assert downloads[7].download_link == "https://site.example/download/36/cat-id/7/data-id"
    assert {(r.post_id, r.type, r.transcript_url) for r in rows("sections")} == {
        (1, "plain_text", None), (1, "youtube", "abc.pdf"), (2, "image", None), (3, "plain_text", None)}
    terms = {r.term: r for r in rows("glossary_terms")}
    assert terms["Antrag"].definition == "Ein Vorschlag."
    assert (terms["BSV"].definition, terms["BSV"].DE, terms["BSV"].DE_NW, terms["BSV"].DE_BY) == ("Mehr", "BSK", "BSV und LSV", None)
    tree = json.loads("\n".join(p.read_text() for p in sorted((tmp_path / "downloads_tree.json").glob("part-*"))))
    assert tree["data_id"] == "36" and tree["children"][0]["data_parent_id"] == "36"


def test_some_steps_and_trial_names(spark, landed, tmp_path):
    run = make_run(spark, landed, tmp_path, smoke=True, smoke_rows=2)
    steps = ["guide_pages", "legal_resources", "publications", "downloads_and_posts_and_sections", "glossary_terms"]
    assert run_steps(run, reversed(steps)) == steps
    pages = spark.read.parquet(f"{tmp_path}/smoke_test_guide_pages.parquet").collect()
    assert {r.title for r in pages} == {"a!", "b!"}  # the first of the navigation
    assert 1 <= spark.read.parquet(f"{tmp_path}/smoke_test_posts.parquet").count() <= 2
    assert all(p.name.startswith("smoke_test_") for p in tmp_path.glob("*.parquet"))


def test_unknown_steps_stop_before_the_first(spark, landed, tmp_path):
    with pytest.raises(ValueError, match="no such steps"):
        run_steps(make_run(spark, landed, tmp_path), ["publications", "nope"])
    assert list(tmp_path.iterdir()) == []


def test_publications_stop_at_bad_records(spark, tmp_path):
    for name, url, tags in (("a", "http://x", []), ("b", "https://x", ["school_type:elementary", "school_type:other"])):
        folder = tmp_path / name
        folder.mkdir()
        doc = json.dumps({"id": name, "URL": url})
        spark.createDataFrame([(name, doc, tags)], "key string, doc string, tags array<string>").write.parquet(f"{folder}/publication_items.parquet")
        with pytest.raises(ValueError, match="valid address" if name == "a" else "allows one"):
            run_steps(make_run(spark, str(folder), tmp_path), ["publications"])


def test_guide_without_level_or_area(spark):
    def pages(nav, html):
        start = spark.createDataFrame([(1, f"<nav><ul>{nav}</ul></nav>")], "id int, html string")
        page = spark.createDataFrame([("https://g.example/a/", html)], "url string, html string")
        return catalogue.guide_pages(parse(start, track=("nav",)), "id", parse(page), "https://g.example").collect()

    link = '<a data-level="1" href="/a/">A</a>'
    assert [r.title for r in pages(link, '<div id="content">x</div>')] == ["a"]  # no title: the last folder
    assert [r.title for r in pages(link, '<title> </title><div id="content">x</div>')] == [""]
    with pytest.raises(Exception, match="without a level"):
        pages('<a href="/a/">A</a>', '<div id="content">x</div>')
    with pytest.raises(Exception, match="no content area"):
        pages(link, "<div>x</div>")


def test_councils_must_be_complete(spark):
    found = spark.createDataFrame([("X", "d", "w", None)], "name string, description string, website string, jurisdiction string")
    with pytest.raises(ValueError, match="without a jurisdiction"):
        catalogue.complete_councils(found, found.limit(0), 1)


def test_unknown_strategy_is_an_error(spark):
    df = spark.createDataFrame([("ftp", "c", "https://x")], "s string, c string, p string")
    with pytest.raises(Exception, match="no such strategy"):
        df.select(catalogue.area_class(F.col("s"), F.col("c"), F.col("p"))).collect()


def test_area_by_strategy(spark):
    df = spark.createDataFrame(
        [("soup", "c", "u"), ("direct", "c", "u"), ("selenium", "c", "u"), ("selenium", "c", "https://x.wolterskluwer-online.de"),
         ("wait_jportal_load", None, "u")], "s string, c string, p string")
    got = [r[0] for r in df.select(catalogue.area_class(F.col("s"), F.col("c"), F.col("p"))).collect()]
    assert got == ["c", None, "docbody", "block-system-main-block", "docbody"]


def test_several_stages_are_an_error(spark):
    posts.check_stages(spark.createDataFrame([(1, 2), (2, 2)], "post_id int, value int"))
    with pytest.raises(ValueError, match="several stages"):
        posts.check_stages(spark.createDataFrame([(1, 2), (1, 3)], "post_id int, value int"))


def test_sections_need_their_post(spark):
    found = spark.createDataFrame([(1, "quiz"), (2, "quiz")], "post_id int, type string")
    with pytest.raises(ValueError, match="without a post"):
        posts.check_sections(found, spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ValueError, match="without a type"):
        posts.check_sections(spark.createDataFrame([(1, None)], "post_id int, type string"), spark.createDataFrame([(1,)], "id int"))


def test_links_resolve_by_address_then_title(spark):
    links = spark.createDataFrame(
        [(1, "https://S.example/two/?x#y", None), (1, "https://s.example/gone", "A & B – C"), (1, "https://s.example/gone", "??"),
         (2, "http://s.example/two", None), (2, "https://s.example/one", None), (2, "https://s.example/one/", None)],
        "id bigint, href string, link_title string")
    items = spark.createDataFrame(
        [(1, "https://s.example/one/", "One"), (2, "https://s.example/two/", "Two"), (3, "https://s.example/three/", "A  B  C")],
        "id bigint, url string, title string")
    got = {r.id: (r.related_posts, r.n_links) for r in posts.related_posts(links, items).collect()}
    assert got == {1: ([2, 3], 2), 2: ([1], 2)}  # no self-reference; two links to one post


def test_bibliographic_records(spark):
    docs = ['{"id":"a","URL":"https://x","issued":{"date-parts":[[2024]]},"author":[{"given":"","family":"F"},{"family":"G"},{"given":"H","family":"I"}]}',
            '{"id":"b","abstract":"","issued":{"date-parts":[[]]},"author":"nobody"}',
            '{"id":"c","issued":{"date-parts":[[2024,3,9]]},"author":[]}', '{"id":"d"}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = {r.key: (r.date, r.authors, r.abstract, r.title) for r in bibliography.records(df, []).collect()}
    assert got == {"a": ("2024", ["F", "G", "H I"], None, ""), "b": (None, None, None, ""), "c": ("2024-03-09", [], None, ""), "d": (None, None, None, "")}


def test_tags(spark):
    df = spark.createDataFrame([(1, ["jurisdiction:de_bb", "x", "school_type:elementary"]), (2, []), (3, None), (4, ["y:z"]), (5, ["jurisdiction:a", "jurisdiction:b"])],
                               "id int, tags array<string>")
    got = {r.id: (r.jurisdiction, r.school_type, r.tags) for r in bibliography.split_tags(df).filter("id < 5").collect()}
    assert got == {1: ("DE_BB", "elementary", ["x"]), 2: (None, None, None), 3: (None, None, None), 4: (None, None, ["y:z"])}
    assert [tuple(r) for r in bibliography.repeated_tags(df, "id").collect()] == [(5, "jurisdiction", 2)]
