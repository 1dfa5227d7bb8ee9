"""The operators on small tables, against plain versions of the same and on odd rows."""

from __future__ import annotations

import collections
import math
import random
import re
import uuid
import zlib

import duckdb
import pytest
import xxhash

from folioworks.llm import chat_format, context_tree, decontaminate, html_text, mixing, quality_rules, secret_scan, simhash_dedup, token_counts, warc_zip
from folioworks.llm.golay import Golay, _remainder

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, kind string, hash string"
LONG = " ".join(f"w{i}" for i in range(30_000))
GOOD = "the cat and the dog of this house were at the old door with a man that I was told to be from the sea and "
ODD = [
    (1, None, "en", "a", 0, "x", "y", "z"),
    (2, "", None, None, None, None, None, None),
    (3, " \t\n ", "en", "a", 3, "x", "y", "z"),
    (4, LONG, "en", "b", 5, "x", "y", "z"),
    (5, "Same words here again", "en", "b", 5, "x", "y", "z"),
    (5, "Same words here again", "en", "b", 5, "x", "y", "z"),
    (None, "one two three four five", "de", "c", 5, "x", "y", "z"),
    (7, 'token = "abcdef123456" password=abc <|user|> \\### é😀', "de", "c", 5, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    return con.sql(sql)


def same_rows(df, sql, **tables):
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    relation = duck(sql, **tables)
    names = relation.columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in relation.fetchall())
    assert got == want


def test_quality_on_odd_rows(odd):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == len(ODD) and sorted(r.n_words for r in rows)[:3] == [0, 0, 0]
    assert [r.n_words for r in rows if r.doc_id == 4] == [30_000]
    assert quality_rules.keep_good(odd).columns == odd.columns
    assert quality_rules.judge(odd.limit(0)).count() == 0


def test_quality_counts_repeats_as_brute_force(spark):
    texts = ["a b c d e f g h " * 3, "x " * 30, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(12))), GOOD]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for row in quality_rules.judge(docs).collect():
        ws = words(texts[row.doc_id])
        grams = collections.Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
        covered = {k for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for k in range(i, i + 8)}
        assert row.n_repeat_words == len(covered)
    assert [r.kept for r in quality_rules.judge(docs).orderBy("doc_id").collect()] == [False, False, False, True]


def test_other_languages_pass_the_stop_words(spark):
    polish = "Wczoraj rano nasza mała grupa poszła przez stary las nad cichą rzekę, gdzie ptaki śpiewały głośno, słońce grzało mocno, dzieci zbierały kamienie"
    russian = "Вчера утром наша группа прошла через старый лес над тихой рекой, где птицы пели громко, солнце грело сильно, дети собирали красивые белые камни"
    thai = " ".join(["เมื่อวานนี้ตอนเช้ากลุ่มเล็กของเราเดินผ่านป่าเก่า" + "กขคงจฉ"[i % 6] * (i // 6 + 1) for i in range(24)])
    plain = "wirrel dom tassen lurge pommer kelt ranno brill sopper hund marle test quolle birn zamt foller gritt nasch welm torre pux"
    rows = [
        (1, polish, "pl", True), (2, russian, "ru", True), (3, russian, None, True), (4, thai, "th", True), (5, thai, " ", True), (6, plain, "en", False),
        (7, plain, "en-US", False), (8, plain, None, False), (9, plain, "fi", True), (10, GOOD + GOOD.upper(), None, True), (11, russian, "und", True),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, want boolean")
    got = {r.doc_id: (r.kept, r.broken_rules) for r in quality_rules.judge(docs).collect()}
    assert got == {i: (want, "" if want else "few_stop_words") for i, _, _, want in rows}
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {r[0] for r in rows if r[3]}
    same_rows(quality_rules.judge(docs), quality_rules.SQL, documents=docs)
    bare = {r.doc_id: r.kept for r in quality_rules.judge(docs.drop("lang")).collect()}
    assert bare[2] and bare[4] and not bare[6]


def test_chat_round_trip(spark):
    texts = ["<|end|>\n", "<\\|", "a<", "|>", "", None, chat_format.PROBE, "<\\\\|user|>"]
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    turns += [(2, 0, "assistant", "x"), (3, 0, None, "y"), (3, None, "to|ol<%", "z"), (4, 0, "user", "q"), (4, 0, "user", "q")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat_format.format_chats(frame)
    read = {r.conv_id: (r.turns, r.valid) for r in formatted.select("conv_id", "valid", chat_format.read_turns(formatted["formatted"]).alias("turns")).collect()}
    assert [(t.role, t.text) for t in read[1][0]] == [(r, t or "") for _, _, r, t in turns[:8]]
    assert [(t.role, t.text) for t in read[3][0]] == [("to|ol<%", "z"), ("", "y")]
    assert {k: v[1] for k, v in read.items()} == {1: True, 2: False, 3: False, 4: False}
    digests = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    assert digests[1].loss_chars == sum(len(t or "") for t in texts[1::2]) and digests[4].n_turns == 2


@pytest.mark.parametrize(
    "template",
    [
        chat_format.TEMPLATE,
        chat_format.Template(open="[[", close="]]\n", end="[[end]]\n"),
        chat_format.Template(open="### ", close=": ", end=" </turn>\n"),
        chat_format.Template(open="aa", close="a", end="ab"),
        chat_format.Template(open="<|", close="\n", end="|<"),
        chat_format.Template(open="$(", close=")", end="^]-"),
    ],
)
def test_chat_marks_of_any_template_read_back(spark, template):
    rng = random.Random(6)
    marks = [template.open, template.close, template.end, "end", "\\", "\\\\", "%", "%3C;", "x", "\n", "$1", " "]
    signs = sorted(set("".join(marks)))
    text = lambda: "".join(rng.choice(marks if rng.random() < 0.4 else signs) for _ in range(rng.randrange(9)))
    turns = [(c, t, rng.choice(["user", "assistant", "end", text()]), text()) for c in range(150) for t in range(rng.randrange(1, 7))]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat_format.format_chats(frame, template)
    read = formatted.select("conv_id", "segments", "formatted", chat_format.read_turns(formatted["formatted"], template).alias("turns"))
    read = read.select("*", chat_format.loss_text(read["turns"], template).alias("loss"))
    for row in read.collect():
        want = [(r, t) for c, _, r, t in turns if c == row.conv_id]
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == "".join(t for r, t in want if r == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
        assert [s.loss for s in row.segments] == [flag for r, _ in want for flag in (False, r == "assistant", False)]


def test_chat_marks_that_cannot_be_escaped_are_refused():
    for marks in ({"open": "<"}, {"end": "\\|"}, {"end": "x\\"}, {"close": ""}, {"close": "%"}):
        with pytest.raises(ValueError):
            chat_format.Template(**marks)


def test_chat_digests_match_their_sql(spark):
    turns = [(1, 0, "user", "a<"), (1, 1, "assistant", "<\\"), (2, 0, "us<|er%", "<<|end|>\n<"), (3, None, None, None), (None, 0, "user", "x"), (None, 1, "assistant", "<|")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    for rows in (frame, frame.limit(0)):
        same_rows(chat_format.digests(chat_format.format_chats(chat_format.with_probe(rows))), chat_format.SQL, conversations=rows)


def test_secrets_on_odd_rows(odd, spark):
    rows = secret_scan.scan(odd).collect()
    assert len(rows) == len(ODD)
    hit = next(r for r in rows if r.doc_id == 7)
    text = ODD[7][1]
    begin = text.index("token")
    assert hit.spans == f"assign:{begin}:{begin + len('token = ' + chr(34) + 'abcdef123456')}" and hit.n_live == 1
    masked = {r.doc_id: r.text for r in secret_scan.mask_live(odd).collect()}
    assert "abcdef123456" not in masked[7] and "password=abc" in masked[7] and masked[4] == LONG
    copied = spark.createDataFrame([(i, "secret: 0123456789", "en", f"s{i}") for i in range(3)], "doc_id bigint, text string, lang string, source string")
    assert {(r.n_live, r.n_example) for r in secret_scan.scan(copied).collect()} == {(0, 1)}
    assert all("0123456789" in r.text for r in secret_scan.mask_live(copied).collect())
    same_rows(secret_scan.scan(odd.select("doc_id", "text", "lang", "source")), secret_scan.SQL, documents=odd)


def test_mix_follows_its_sql_and_its_bounds(odd):
    mixed = mixing.mix(odd)
    rows = mixed.collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 3 * r.size for r in rows)
    same_rows(mixed, mixing.SQL, documents=odd)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_golay_words_two_bits_apart_share_a_key():
    import numpy as np

    code, rng = Golay(), np.random.default_rng(5)
    some = rng.integers(0, 1 << 23, 300).astype(np.uint32)
    index = np.arange(1 << 12, dtype=np.uint32)
    codewords = np.array([i << 11 | _remainder(i << 11) for i in index.tolist()], dtype=np.uint32)
    for error in (0, 1, 0b101, 0b10000000000000000000011):
        assert (code.index(codewords ^ np.uint32(error)) == index).all()
    for a, b in rng.integers(0, 23, (20, 2)):
        other = some ^ np.uint32(1 << a) ^ np.uint32(1 << b)
        for x, y in zip(code.around(some), code.around(other), strict=True):
            assert set(x) & set(y)


def brute_print(text):
    ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_are_those_of_brute_force(spark, odd):
    import random

    rng = random.Random(4)
    base = [[f"{rng.randrange(500)}" for _ in range(200)] for _ in range(20)]
    docs = [(i, " ".join(w if rng.random() > 0.004 else "new" for w in base[i % 20])) for i in range(200)]
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    prints = {i: brute_print(t) for i, t in docs}
    label = {i: i for i, _ in docs}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a], changed = label[b], True
    assert {i: r.component_id for i, r in got.items()} == label
    assert all(got[i].fingerprint == f"{p:016x}" for i, p in prints.items())
    rows = simhash_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    kept = simhash_dedup.keep_first(odd)
    assert kept.columns == odd.columns and sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 4), (False, 5), (False, 7), (True, None)]
    assert simhash_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_leaks_are_found_and_clean_texts_left(spark, odd):
    items = [(i, " ".join(f"i{i}x{k}" for k in range(15 + i))) for i in range(30)] + [(90, None), (91, "two words"), (92, "i3x0")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(i, f"{LONG[: 40 * i]} {items[i][1].upper()} tail {LONG[: 50 * i]}") for i in range(30)]
    docs += [(50, "say two words aloud"), (51, items[20][1].replace("i20x9 ", "other ")), (52, None), (53, LONG + " " + items[7][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_leaks(frame, benchmark).collect()}
    for i in range(30):
        assert found[i, i] == 1.0
    assert (50, 91) in found and (53, 7) in found and not any(d == 52 for d, _ in found)
    assert all(d == i or (d, i) in {(50, 91), (53, 7), (51, 20), (3, 92)} for d, i in found)
    assert {r.doc_id for r in decontaminate.drop_leaks(frame, benchmark).collect()} <= {51, 52}
    assert decontaminate.find_leaks(odd, benchmark).count() == 0 and decontaminate.drop_leaks(odd, benchmark).count() == len(ODD)
    assert decontaminate.find_leaks(frame, benchmark.limit(0)).count() == 0


def test_leaks_are_found_in_any_case_of_any_script():
    item = " ".join(f"é{k}à ñ{k}ö" for k in range(15))
    found = list(decontaminate.Matcher([(1, item)]).find([f"before it {item.upper()} behind it", item.title(), LONG]))
    assert [(place, similarity) for place, _, similarity, *_ in found] == [(0, 1.0), (1, 1.0)]


def test_leaks_just_above_the_threshold_are_those_of_brute_force():
    rng = random.Random(0)

    def similarity(a, b):
        x, y = (collections.Counter(tuple(t[k : k + 5]) for k in range(len(t) - 4)) for t in (a, b))
        return (x & y).total() / (x | y).total()

    items, docs = [], []
    for i in range(200):
        item = [f"i{i}w{k}" for k in range(rng.randrange(100, 300))]
        near = item
        while True:
            edited = list(near)
            edited[rng.randrange(len(item))] = f"n{rng.random()}"
            if similarity(item, edited) < 0.8:
                break
            near = edited
        pad = [f"p{i}w{k}" for k in range(rng.randrange(5, 400))]
        cut = rng.randrange(len(pad))
        items.append((i, " ".join(item)))
        docs.append(" ".join(pad[:cut] + near + pad[cut:]))
    found = {(place, item) for place, item, *_ in decontaminate.Matcher(items).find(docs)}
    assert found == {(k, k) for k in range(len(docs))}


def test_hamming_tables_find_all_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 63, 70).astype(np.uint64)
    group = np.repeat([0, 1, 2], [1, 60, 9])
    number = rng.integers(0, 70, 4000)
    near = prints[number].copy()
    for _ in range(24):
        near ^= np.where(rng.random(4000) < 0.8, np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64), np.uint64(0))
    tables = decontaminate.HammingTables(np.split(prints, [1, 61]), decontaminate.RADIUS)
    rows, items = tables.within(near, group[number])
    want = {
        (i, j) for i in range(4000) for j in np.nonzero((np.bitwise_count(prints ^ near[i]) <= decontaminate.RADIUS) & (group == group[number[i]]))[0].tolist()
    }
    assert len(rows) == len(want) and set(zip(rows.tolist(), items.tolist(), strict=True)) == want


def test_hamming_tables_select():
    import numpy as np

    rng = np.random.default_rng(3)
    prints, queries = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (3000, 1000))
    rows, items = decontaminate.HammingTables([prints], decontaminate.RADIUS).candidates(queries, np.zeros(1000, np.int64))
    assert len(rows) < 0.16 * 3000 * 1000


def test_tokens_are_those_of_a_plain_search(odd):
    pieces = token_counts.read_pieces()
    counting = token_counts.Counting(pieces)

    def plain(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            best.append(max((best[b][0] + pieces[word[b:end]], -best[b][1] - 1) for b in range(end) if word[b:end] in pieces))
            best[-1] = (best[-1][0], -best[-1][1])
        return best[-1][1]

    for text in ("Hello there, général 123!", "aaaaaaaaaaaa ======\n\n\n x", "😀é", "therethethere"):
        assert counting.count([text])[1] == [sum(plain(w.encode()) for w in counting.cut.findall(text))]
    rows = token_counts.count_tokens(odd).collect()
    assert len(rows) == len(ODD) and [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]


def test_context_trees_on_odd_rows(odd):
    rows = context_tree.score(odd).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    for r in rows:
        key = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.held_out == (zlib.crc32(key) % 5 == 1)
    assert context_tree.score(odd.limit(0)).count() == 0


def test_main_text_of_pages(spark):
    host = "https://h.example/"
    foot = "all rights are reserved by the keepers of this place since long ago"
    pages = [
        (1, host + "1", "<body><nav>menu</nav><article><h1>T &amp; x</h1><p>one\n two<br>three<p>four <b>bold</b><aside>side</aside><div class=comments>no</div></article><footer>f</footer>"),
        (2, host + "2", None),
        (3, None, "plain <text"),
        *[(10 + i, host + str(i), f"<div><p>own{i} words{i} stand{i} here{i}</p><p>{foot}</p></div>") for i in range(4)],
        (20, host, "<p>a<script>if (a < b) '</p>'</script><style>x</style>b &lt;c&gt; <!-- no --><form>f</form></p><div hidden>h</div>"),
        (21, host, '<a href="' + '"x ' * 2000),
    ]
    rows = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert rows[1].text == "T & x\none two three\nfour bold" and rows[2].text == "" and rows[2].n_chars == 0
    assert rows[20].text == "ab <c>"
    assert all(rows[10 + i].text == f"own{i} words{i} stand{i} here{i}" for i in range(4))
    assert len(rows) == len(pages)


def html_rows(spark, pages, **how):
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_text.main_text(frame, **how).collect()}


def test_copies_of_a_page_are_one_page_of_their_host(spark):
    text = "a b c d e f g h i j k l"
    pages = [(i, f"https://c.example/{i}", f"<div><p>{text}</p></div>") for i in range(5)] + [(10 + i, None, f"<p>{text}</p>") for i in range(3)]
    assert set(html_rows(spark, pages, shard_pages=2).values()) == {text}


def test_runs_are_cut_by_the_share_of_distinct_pages(spark):
    phrase, foot = "to be or not to be that is the question", "all rights are reserved by the keepers of this place"
    own = {i: " ".join(f"own{i}x{k}" for k in range(12)) for i in range(40)}
    pages = [(i, f"https://s.example/{i}", f"<p>{own[i]} {phrase if i < 5 else ''} end{i}</p><p>{foot}</p>") for i in own]
    for shard_pages in (512, 7):
        rows = html_rows(spark, pages, shard_pages=shard_pages)
        assert rows == {i: f"{own[i]} {phrase + ' ' if i < 5 else ''}end{i}" for i in own}


def test_repeated_runs_are_those_of_brute_force(spark):
    rng = random.Random(5)
    pages = []
    for i in range(60):
        tokens = [rng.choice("abcd") for _ in range(rng.randrange(30))] + ["common", "run", "of", "eight", "words", "on", "many", "pages"] * (i % 3 == 0) + [f"own{i % 50}"]
        pages.append((i, "https://b.example/x", "<p>" + " ".join(tokens) + "</p>"))
    pages += [(100 + i, url, page) for i, _, page in pages[:20] for url in ["https://b.example/copy"]]
    contents = {page[3:-4] for _, _, page in pages}
    grams = collections.Counter(g for t in contents for g in {tuple(t.split()[k : k + 8]) for k in range(len(t.split()) - 7)})
    often = {g for g, n in grams.items() if n >= 3 and 100 * n >= html_text.RUN_SHARE * len(contents)}
    assert often

    def left(tokens):
        gone = {k + j for k in range(len(tokens) - 7) if tuple(tokens[k : k + 8]) in often for j in range(8)}
        return " ".join(w for k, w in enumerate(tokens) if k not in gone)

    want = {i: left(page[3:-4].split()) for i, _, page in pages}
    assert html_rows(spark, pages) == html_rows(spark, pages, shard_pages=9) == want


def test_blocks_of_marked_articles_are_judged_whole(spark):
    note, quote = "read all our news in the app that you can load for free", "to be or not to be that is the question"
    own = {i: " ".join(f"own{i}x{k}" for k in range(12)) for i in range(20)}

    def page(i):
        return f"<article><p>{own[i]}</p>{f'<blockquote>{quote}</blockquote>' if i < 7 else ''}<p>{note}</p><p>{note} now{i}</p></article>"

    pages = [(i, f"https://a.example/{i}", page(i)) for i in own]
    want = {i: own[i] + (f"\n{quote}" if i < 7 else "") + f"\n{note} now{i}" for i in own}
    assert html_rows(spark, pages) == html_rows(spark, pages, shard_pages=6) == want
    gone = [(i, f"https://g.example/{i}", f"<nav>n{i}</nav><article><p>{note}</p></article>") for i in range(4)]
    assert set(html_rows(spark, gone).values()) == {note}


@pytest.mark.parametrize(
    "page, text",
    [
        ('<body class="single no-sidebar"><article>long text</article></body>', "long text"),
        ('<body class="sidebar"><p>long text</p></body>', "long text"),
        ('<div id="page" class="has-sidebar"><p>long text</p><div class="sidebar">s</div></div>', "long text"),
        ('<div class="layout-with-sidebar"><main class="promo">long text<div class="site-footer">f</div></main></div>', "long text"),
        ('<div class="sidebar"><article>long text</article> other</div>', "long text"),
        ('<article class="post comments-open">long text<div class="share">s</div></article>', "long text"),
        ('<main><h1>head</h1>long text of the page</main><article>teaser</article>', "head\nlong text of the page"),
        ('<article>teaser</article><div class="related"><article>card</article></div><main><p>long text of the page</p></main>', "long text of the page"),
        ('<main><h1>head</h1><article>the long article</article></main>', "the long article"),
        ('<div class="sidebar"><article>long text</article><div class="related"><article>card</article></div></div>', "long text"),
        ('<article>post<p>a <span class="share">s</span>b</p></article><div class="comments"><article class="comment">a comment</article></div>', "post\na b"),
        ('<article class="comment">the only article</article>', "the only article"),
        ('<div role="main" class="notice">long text</div><div class="cookie-notice">c</div>', "long text"),
    ],
)
def test_names_drop_no_marked_article(page, text):
    main, rest = html_text.blocks(page)
    assert "\n".join(main + [t for t, may in rest if may]) == text


def test_packages_round_trip(spark, tmp_path, monkeypatch):
    pages = [(1, "u", "same"), (2, None, "same"), (3, "a\r\nb", ""), (4, "v", None), (None, "w", "lone é"), (7, "x", "y" * 300_000), (7, "x", "y" * 300_000)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    same_rows(warc_zip.round_trip(frame), warc_zip.SQL, pages=frame)
    assert warc_zip.round_trip(frame.limit(0)).count() == 0
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 1)
    assert warc_zip.round_trip(frame).count() == len(pages)


def test_zip64_directory_is_read(tmp_path):
    import zipfile

    files, folder = warc_zip.open_folder(f"file://{tmp_path}")
    path = f"{folder}/{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        for i in range(66_000):
            out.writestr(f"m{i}", str(i))
    archive = warc_zip.Archive(files, path)
    at, size = archive.stored("m65999")
    assert len(archive.members) == 66_000 and archive.read(at, size) == b"65999"
