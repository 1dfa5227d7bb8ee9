from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from folioworks.operators import graph, hierarchy
from folioworks.operators import containment
from folioworks.operators.containment import contains_pairs, first_containing
from folioworks.operators.navigation import fill_levels, url_hierarchy
from folioworks.sinks.publish import export_tree_json
from folioworks.sources.landing import tree_rows, walk_tree


def random_tree(n, seed):
    rng = random.Random(seed)
    return [(i, None if i == 0 else rng.randrange(max(0, i - 4), i), i) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "node_id bigint, parent_id bigint, ordinal int")


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_matches_walking_up(spark, seed):
    rows = random_tree(120, seed)
    parent = {n: p for n, p, _ in rows}
    expected = set()
    for node in parent:
        up, distance = node, 0
        while up is not None:
            expected.add((up, node, distance))
            up, distance = parent[up], distance + 1
    paths = hierarchy.root_paths(frame(spark, rows))
    got = {tuple(r) for r in hierarchy.closure(paths).collect()}
    assert got == expected
    near = {tuple(r) for r in hierarchy.closure(paths, max_distance=1).collect()}
    assert near == {e for e in expected if e[2] <= 1}


def test_cycle_is_an_error_and_orphan_parent_a_root(spark):
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.root_paths(frame(spark, [(1, 2, 0), (2, 1, 0)]))
    paths = hierarchy.root_paths(frame(spark, [(1, 77, 0), (2, 1, 0)])).collect()
    assert sorted((r.node_id, [s.node_id for s in r.path]) for r in paths) == [(1, [1]), (2, [1, 2])]


def brute_force(nodes, owners, items):
    parent = {n: p for n, p, _ in nodes}

    def covers(chapter, category):
        while category is not None:
            if category == chapter:
                return True
            category = parent.get(category)
        return False

    return {(o, i) for o, ch in owners for i, cat in items if ch is not None and cat is not None and covers(ch, cat)}


def test_association_both_ways_with_hot_chapters(spark):
    rng = random.Random(3)
    nodes = random_tree(60, 4)
    # A third of the owners sits at the root, a third of the items in one category; some ids are unknown.
    owners = [(o, rng.choice([0, rng.randrange(60), rng.choice([None, 900])])) for o in range(90)]
    items = [(i, rng.choice([59, rng.randrange(60), rng.choice([None, 900])])) for i in range(120)]
    expected = brute_force(nodes, owners, items)
    tree_nodes = frame(spark, nodes)
    o = spark.createDataFrame(owners, "owner_id bigint, chapter_id bigint")
    i = spark.createDataFrame(items, "item_id bigint, category_id bigint")
    both = hierarchy.Associations(o, i, hierarchy.interval_labels(tree_nodes))
    forward = both.associated_items().collect()
    assert {(r.owner_id, x) for r in forward for x in r["items"] or []} == expected
    assert sum(len(r["items"] or []) for r in forward) == len(expected)
    assert {r.owner_id for r in forward} == {k for k, _ in owners}
    assert all(r["items"] is None or r["items"] for r in forward)  # none at all is null
    backward = both.associated_owners().collect()
    assert {(x, r.item_id) for r in backward for x in r.owners or []} == expected
    assert sum(len(r.owners or []) for r in backward) == len(expected)
    assert len(forward) == len(owners) and len(backward) == len(items)


def test_lists_are_written_once_and_not_sent_through_the_driver(spark):
    tree_nodes = spark.createDataFrame([("r", None, 0, "r"), ("a", "r", 0, "a")], "node_id string, parent_id string, ordinal int, name string")
    owners = spark.createDataFrame([(i, "r") for i in range(50)] + [(99, None)], "owner_id bigint, chapter_id string")
    items = spark.createDataFrame([(i % 3000, "a") for i in range(4000)], "item_id bigint, category_id string")
    both = hierarchy.Associations(owners, items, hierarchy.interval_labels(tree_nodes))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), "|")
    expected = "|".join(str(i) for i in sorted(i % 3000 for i in range(4000)))
    assert {(r.owner_id, r["items"]) for r in both.associated_items(text).collect()} == {*((i, expected) for i in range(50)), (99, None)}
    backward = both.associated_owners(text)
    assert {r.owners for r in backward.collect()} == {"|".join(map(str, range(50)))}
    assert "Broadcast" not in backward._jdf.queryExecution().sparkPlan().toString()


def test_deep_chain_resolves(spark):
    chain = spark.range(3000).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN id - 1 END AS parent_id", "0 AS ordinal")
    assert hierarchy.root_paths(chain).selectExpr("max(size(path))", "count(*)").first() == (3000, 3000)


def walked(rows):
    """Labels by a plain walk; siblings by ordinal, then id."""
    ids = {n for n, _, _ in rows}
    below = {}
    for n, p, o in rows:
        below.setdefault(p if p in ids else None, []).append((o, n))
    out, stack, number = {}, [(n, 0) for _, n in sorted(below[None], reverse=True)], 0
    order = []
    while stack:
        node, depth = stack.pop()
        out[node] = [number, number, depth]
        order.append(node)
        number += 1
        stack += [(n, depth + 1) for _, n in sorted(below.get(node, []), reverse=True)]
    parent = {n: p for n, p, _ in rows}
    for node in reversed(order):
        up = parent[node]
        if up in out:
            out[up][1] = max(out[up][1], out[node][1])
    return {(n, *v) for n, v in out.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_labels_match_a_walk(spark, seed):
    rng = random.Random(seed)
    # Ordinals of 15 digits, negative ones and ties; several roots, one under a parent that is not there.
    rows = [(i, rng.choice([None, 77_000, 0]) if i < 4 else rng.randrange(0, i), rng.choice([-5, 0, 0, 10**14 + i, -(10**14) - i])) for i in range(150)]
    rows[0] = (0, None, 3)
    nodes = spark.createDataFrame(rows, "node_id bigint, parent_id bigint, ordinal bigint")
    assert {tuple(r) for r in hierarchy.interval_labels(nodes).collect()} == walked(rows)
    sizes = {r.node_id: r.size for r in hierarchy.subtree_sizes(nodes).collect()}
    assert sizes == {n: last - first + 1 for n, first, last, _ in walked(rows)}
    assert hierarchy.interval_labels(nodes.limit(0)).count() == 0


def test_chain_and_star(spark):
    chain = spark.range(2000).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN id - 1 END AS parent_id", "0 AS ordinal")
    assert hierarchy.interval_labels(chain).filter("first = node_id AND depth = node_id AND last = 1999").count() == 2000
    star = spark.range(1_000_000).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN 0L END AS parent_id", "-id AS ordinal")
    labels = hierarchy.interval_labels(star)
    assert labels.filter("node_id > 0 AND first = 1000000 - node_id AND last = first AND depth = 1").count() == 999_999
    assert hierarchy.root_paths(star).filter("size(path) = 2").count() == 999_999


def test_cycles_name_their_nodes(spark):
    rows = [(1, None, 0), (2, 4, 0), (3, 2, 0), (4, 3, 0), (5, 4, 0), (6, 5, 0)]
    for labelled in (hierarchy.interval_labels, hierarchy.root_paths):
        with pytest.raises(ValueError, match="cycle.*2, 3, 4$"):
            labelled(frame(spark, rows))


def test_stabbing_matches_brute_force(spark):
    rng = random.Random(5)
    points = [(i, rng.randrange(0, 300)) for i in range(80)] + [(90, 2**40)]
    intervals = [(i, *sorted((rng.randrange(0, 300), rng.randrange(0, 300)))) for i in range(60)] + [(70, 0, 2**41), (71, 2**40, 2**40)]
    got = hierarchy.stabbed(
        spark.createDataFrame(points, "p bigint, at bigint"), "at", spark.createDataFrame(intervals, "i bigint, a bigint, b bigint"), "a", "b"
    ).select("p", "i").collect()
    expected = {(p, i) for p, at in points for i, a, b in intervals if a <= at <= b}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_long_lists_do_not_come_owner_after_owner_behind_short_ones(spark):
    """A writer of files looks at its memory after so many rows as would have filled it, were they like those before."""
    tree = [("r", None, 0), ("n", "r", 0), *[(f"c{i}", "n", i) for i in range(600)]]
    tree_nodes = spark.createDataFrame(tree, "node_id string, parent_id string, ordinal int")
    owners = spark.createDataFrame([(i, "n" if i % 4 == 0 else f"c{i}") for i in range(600)], "owner_id bigint, chapter_id string")
    items = spark.createDataFrame([(i, f"c{i}") for i in range(600)], "item_id bigint, category_id string")
    both = hierarchy.Associations(owners, items, hierarchy.interval_labels(tree_nodes))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if the lists were long in all
    try:
        parts = both.associated_items().select("owner_id", F.size("items").alias("n")).rdd.glom().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    rows = [r for part in parts for r in part]
    assert {(r.owner_id, r.n) for r in rows} == {(i, 600 if i % 4 == 0 else 1) for i in range(600)} and len(rows) == 600
    part = next(part for part in parts if any(r.n == 600 for r in part))
    runs = "".join("n" if r.n == 600 else " " for r in part).split()
    assert max(map(len, runs)) < 75, "all 150 owners of one chapter in a row, or nearly so"


def test_owners_and_categories_in_the_ten_thousands_make_no_pairs(spark):
    n = 10_000
    nodes = spark.range(n).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN 0L END AS parent_id", "id AS ordinal")
    owners = spark.range(n).selectExpr("id AS owner_id", "0L AS chapter_id")
    items = spark.range(n).selectExpr("id AS item_id", "id AS category_id")
    both = hierarchy.Associations(owners, items, hierarchy.interval_labels(nodes))
    assert both.category_chapter_rows().count() == n
    assert both.chapter_owners().selectExpr("size(owners)").first()[0] == n
    assert both.owner_ranges().filter(f"items_from = 0 AND items_to = {n}").count() == n
    plan = both.owner_ranges()._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_levels(spark):
    nodes = frame(spark, [(0, None, 0), (1, 0, 0), (2, 0, 1), (3, 1, 0)])
    got = {tuple(r) for r in hierarchy.levels(nodes, hierarchy.root_paths(nodes)).collect()}
    assert [r.node_id for r in hierarchy.children(nodes, 0).collect()] == [1, 2]
    assert got == {(0, 0, 2, False), (1, 1, 1, False), (2, 1, 0, True), (3, 2, 0, True)}


def test_tree_json_round_trip(spark, tmp_path):
    rows = [("0", None, 0, 'ro"ot'), ("1", "0", 0, "a\nb"), ("2", "0", 1, None), ("3", "1", 5, "ü"), ("4", "1", 9, "")]
    nodes = spark.createDataFrame(rows, "node_id string, parent_id string, ordinal int, name string")
    path = str(tmp_path / "tree.json")
    export_tree_json(nodes, path, ["node_id", "name"])
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "tree.json").glob("part-*")) if p.stat().st_size)
    tree = json.loads(text)
    assert text.strip() == json.dumps(tree, indent=2, sort_keys=True, ensure_ascii=False)
    assert [c["node_id"] for c in tree["children"]] == ["1", "2"]
    landed = spark.createDataFrame([(1, json.dumps(tree))], "tree int, json string")
    back = tree_rows(landed, "tree", "json", ["node_id", "name"]).collect()
    assert {(r.node_id, r.parent_id, r.name) for r in back} == {(n, p, name) for n, p, _, name in rows}


def flat(node, names, parent=None, depth=0, ordinal=0):
    yield (parent, depth, ordinal, *[None if node.get(n) is None else str(node[n]) for n in names])
    for i, child in enumerate(node.get("children", [])):
        yield from flat(child, names, node.get(names[0]), depth + 1, i)


@pytest.mark.parametrize("seed", range(3))
def test_tree_text_in_one_pass(spark, seed):
    rng = random.Random(seed)
    odd = ['a"b', "{", "]}", "\\", "ü\n", "", None, "children", 'x\\"']

    def grow(depth):
        node = {"children": [grow(depth - 1) for _ in range(rng.randrange(0, 4))]} if depth and rng.random() < 0.8 else {}
        node |= {"other": {"children": [{"id": "no"}], "t": ["]", "}"]}, "name": rng.choice(odd), "id": str(rng.randrange(10**6))}
        return dict(rng.sample(list(node.items()), len(node)))

    trees = [grow(5) for _ in range(8)]
    rows = [(i, json.dumps(t, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)) for i, t in enumerate(trees)] + [(99, None)]
    got = tree_rows(spark.createDataFrame(rows, "t int, j string"), "t", "j", ["id", "name"]).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, *r)) for i, t in enumerate(trees) for r in flat(t, ["id", "name"]))


def test_deep_and_broken_tree_texts():
    deep = '{"id":"0","children":[' * 3000 + '{"id":"x"}' + "]}" * 3000
    rows = list(walk_tree(deep, ["id"]))
    assert len(rows) == 3001 and max(r[1] for r in rows) == 3000
    wide = '{"children":[' + ",".join(f'{{"id":{i},"f":true}}' for i in range(5)) + '],"id":"top","f":null}'
    assert list(walk_tree(wide, ["id", "f"])) == [("top", 1, i, str(i), "true") for i in range(5)] + [(None, 0, 0, "top", None)]
    for broken in ("", "[]", "{", '{"id":1', '{"id":1}}', '{"id" 1}', '{"children":[1]}', '{"id":1,}', '{"id":tru}', '{"a":"b}', '{"children":[{}', '{}{}'):
        with pytest.raises(ValueError):
            list(walk_tree(broken, ["id"], 7))


def walk_nav(links):
    category = subcategory = None
    out = {}
    for pos, level, text, url in links:
        place = None
        if level == 1:
            category, subcategory = text, None
            place = (text, None)
        elif level == 2 and category:
            subcategory = text
            place = (category, None)
        elif level == 3 and category and subcategory:
            place = (category, subcategory)
        if place:
            out[url] = (out.get(url, (pos,))[0], *place)
    return out


@pytest.mark.parametrize("block", [1, 3, 1000])
@pytest.mark.parametrize("seed", range(3))
def test_navigation_matches_a_walk(spark, block, seed):
    rng = random.Random(seed)
    links = [(p, rng.choice([1, 2, 2, 3, 3, 3]), rng.choice(["", "a", "b", "c"]), f"/{rng.randrange(25)}") for p in range(80)]
    df = spark.createDataFrame([("d", *l) for l in links], "doc string, pos int, lvl int, txt string, url string")
    got = {r.url: (r.first_pos, r.category, r.subcategory) for r in url_hierarchy(df, "doc", "pos", "lvl", "txt", "url").collect()}
    assert got == walk_nav(links)
    rows = {(r.pos, r.category, r.subcategory) for r in fill_levels(df, "doc", "pos", "lvl", "txt", block=block).collect()}
    whole = {(r.pos, r.category, r.subcategory) for r in fill_levels(df, "doc", "pos", "lvl", "txt").collect()}
    assert rows == whole


def test_graph(spark):
    df = spark.createDataFrame([(1, [2, 2, 3, 1]), (2, [3]), (3, None), (4, [])], "id int, to array<int>")
    edges = graph.edges_from_lists(df, "id", "to")
    assert {tuple(r) for r in edges.collect()} == {(1, 2), (1, 3), (1, 1), (2, 3)}
    assert {r.node for r in graph.vertices(df, "id", edges).collect()} == {1, 2, 3, 4}
    assert {tuple(r) for r in graph.degree(edges).collect()} == {(1, 4), (2, 2), (3, 2)}
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 4)], "src int, dst int")
    assert {tuple(r) for r in graph.prune(chain).collect()} == {(2, 3), (3, 4), (4, 4)}  # one pass only
    assert [r.node for r in graph.self_loops(chain).collect()] == [4]
    titles = spark.createDataFrame([(1, "A long title, cut"), (2, None)], "id int, title string")
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "node int")
    got = {r.node: r.label for r in graph.labels(nodes, titles, "id", "title").collect()}
    assert got == {1: "A long title,...", 2: None, 3: None}


@pytest.mark.parametrize("seed", range(4))
def test_containment_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    alphabet = "abü \n𝄞"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 200))) for _ in range(60)]
    keys = ["".join(rng.choices(alphabet, k=rng.choice([1, 2, 3, 4, 6, 7, 8]))) for _ in range(25)]
    for n in (1, 2, 3, 7, 14, 15, 31, 63, 64, 90):
        source = rng.choice([t for t in texts if len(t) >= n])
        start = rng.randrange(0, len(source) - n + 1)
        keys.append(source[start : start + n])
    expected = {(i, j) for i, t in enumerate(texts) for j, k in enumerate(keys) if k in t}
    got = contains_pairs(
        spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "i", "t",
        spark.createDataFrame(list(enumerate(keys)), "j int, k string"), "j", "k",
    ).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


@pytest.mark.parametrize("hot", [1 << 20, 7])
def test_keys_with_a_common_start_meet_by_their_rarest_grams(spark, monkeypatch, hot):
    monkeypatch.setattr(containment, "HOT", hot)
    start = "https://www.example.com/watch/video?id="
    rng = random.Random(9)
    names = [f"{rng.randrange(10**12):012d}" for _ in range(40)]
    texts = [(i, " ".join([start * 20, rng.choice(["", "x", "ab"]), start + names[i % 50] if i % 50 < 40 else start])) for i in range(200)]
    keys = [(j, start + n) for j, n in enumerate(names)] + [(99, start)]
    t, k = spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame(keys, "j int, k string")
    got = contains_pairs(t, "i", "t", k, "j", "k").collect()
    assert {tuple(r) for r in got} == {(i, j) for i, text in texts for j, key in keys if key in text}
    grams = containment.key_grams(k.filter("j < 99"), "k")
    blocks = containment.text_blocks(t, "i", "t", grams)
    chosen = containment.anchors(grams, blocks)
    # The blocks met by the chosen grams against those that the grams at the start would meet.
    met = blocks.join(chosen.select("_q", "_gram").distinct(), ["_q", "_gram"]).count()
    first = blocks.join(grams.filter("_r = _class").select("_q", "_gram").distinct(), ["_q", "_gram"]).count()
    assert met < first / 5


def test_first_containing(spark):
    media = spark.createDataFrame([(1, "v1"), (2, "v10"), (3, "zz"), (4, None), (5, "v1")], "id int, k string")
    table = spark.createDataFrame([(7, "u/v10 ", "b"), (3, "u/v1 ", "a"), (9, "u/v1", "c")], "pos int, url string, x string")
    got = {r.id: r.found for r in first_containing(media, "k", table, "pos", "url", "x", "found").collect()}
    assert got == {1: "a", 2: "b", 3: None, 4: None, 5: "a"}
