"""Masks by place, rows without an id, repositories, and article texts that names or small hosts must not take."""

from __future__ import annotations

import duckdb
import pytest

from folioworks.llm import html_text, mixing, secret_scan, simhash_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, _digest string, _spans string, _row_a string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "y", "z") for i, t, lang, source in rows], SCHEMA)


def test_masks_change_their_places_only(spark):
    rows = [
        (1, "token: string\nthe string of stringent strings", "en", "a"),
        (2, "password=hunter2 hunter2277 é😀 secret: 'hunter2'", "en", "b"),
        (None, "token: abcdef99", "en", "c"),
        (None, "token: abcdef99 and more", "de", "c"),
        (5, "api_key = " + "0123456789abcdef" * 2 + "\\E tail", "en", "d"),
        (6, "nothing here", None, None),
        (7, None, "en", "a"),
        (8, "", "en", "a"),
    ]
    masked = secret_scan.mask_live(frame(spark, rows))
    assert masked.columns == frame(spark, rows).columns and masked.schema["n_chars"].dataType.simpleString() == "int"
    got = masked.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        [
            (1, "token: [SECRET]\nthe string of stringent strings"),
            (2, "password=[SECRET] hunter2277 é😀 secret: '[SECRET]'"),
            (0, "token: [SECRET]"),
            (0, "token: [SECRET] and more"),
            (5, "api_key = [SECRET]\\E tail"),
            (6, "nothing here"),
            (7, ""),
            (8, ""),
        ]
    )
    assert all(r.n_chars == len(r.text or "") for r in got)
    assert secret_scan.mask_live(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize(("languages", "live"), [(1, 1), (4, 1), (5, 0)])
def test_a_value_in_many_repositories_is_an_example(spark, languages, live):
    rows = [(i, "secret: 0123456789", f"l{i}", "one owner") for i in range(languages)]
    found = secret_scan.scan(frame(spark, rows)).collect()
    assert {(r.n_live, r.n_example, r.most_owners, r.most_repositories) for r in found} == {(live, 1 - live, 1, languages)}


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    same, other = "one two three four five six seven", "quite another text of some eight or nine words"
    rows = [(None, same, "en", "a")] * 3 + [(4, same, "en", "a"), (9, other, "en", "a"), (4, other, "en", "b"), (None, "a lone text without an id", "en", "a"), (None, "a lone text without an id", "de", "a")]
    kept = simhash_dedup.keep_first(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "a lone text without an id"), (4, same), (4, other)]
    assert simhash_dedup.keep_first(frame(spark, rows).limit(0)).count() == 0


def test_names_within_an_article_count_whole_only():
    page = """<html><body><nav>menu</nav><article><h1>Title</h1><div class="social-history">of towns</div><p class="notice-board">boards</p>
        <h2 id="related-work">Related work</h2><p id="comment-on-method">A comment</p><p>how to <span class="share-price">42</span>\u2003or\u3000so</p>
        <div class="share">tweet</div><div class="comments">first!</div></article><div class="sidebar-left">side</div></body></html>"""
    main, _ = html_text.blocks(page)
    assert main == ["Title", "of towns", "boards", "Related work", "A comment", "how to 42 or so"]


@pytest.mark.parametrize("n", [3, 5, 11])
def test_small_hosts_take_no_block_of_an_article(spark, n):
    lead = "The same headline of eight words stands on all pages here"
    pages = [
        (i, "https://one.example/" + str(i), f"<article><h1>{lead}</h1><p>{lead}</p><p>own text number {i} {'x' * i}</p></article><div class='ad'>{lead}</div>")
        for i in range(n)
    ]
    rows = html_text.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in rows} == {i: f"{lead}\n{lead}\nown text number {i} {'x' * i}".strip() for i in range(n)}


def test_frequent_fingerprints_are_dealt_out_whole(spark, monkeypatch):
    docs = [(i, "one text that a third of all rows hold") for i in range(50)] + [(None, "") for _ in range(20)] + [(i, f"text {i} of its {i * 7} own {i}") for i in range(100, 130)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    read = lambda: sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id or -1) for r in simhash_dedup.near_duplicates(frame).collect())
    want = read()
    monkeypatch.setattr(simhash_dedup, "HOT_ROWS", 3)
    assert read() == want and len(want) == len(docs)


def test_rows_without_an_id_are_mixed_one_by_one(spark):
    docs = [(None if i % 3 else 5, f"word {i} " * (40 + i % 7), f"s{i % 2}") for i in range(300)] + [(None, None, None), (None, "", "s0")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    rows = mixing.mix(frame).collect()
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    want = con.sql(mixing.SQL)
    assert sorted(map(repr, (tuple(r[c] for c in want.columns) for r in rows))) == sorted(map(repr, want.fetchall()))
    assert len(rows) == len(docs) and all(r.taken <= 3 * r.size for r in rows)


def test_no_keys_and_no_rows_of_documents_go_through_the_driver(spark, monkeypatch):
    """However small the planner takes them for: of the tables joined, only the frequent fingerprints are broadcast."""
    docs = frame(spark, [(i, f"text {i % 40} of its {i % 40 * 7} own {i % 40}", "en", "a") for i in range(80)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    linked, components = [], simhash_dedup.components
    monkeypatch.setattr(simhash_dedup, "components", lambda links: linked.append(plan(links)) or components(links))
    rows = simhash_dedup.near_duplicates(docs)
    assert len(linked) == 2 and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in linked)
    assert plan(rows).count("BroadcastHashJoin") == 2 and plan(rows).count("[_hot#") == 2
    assert "BroadcastHashJoin" not in plan(simhash_dedup.keep_first(docs))
    assert rows.count() == 80 and simhash_dedup.keep_first(docs).count() == 40
