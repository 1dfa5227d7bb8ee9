"""Queries on joins, lists, counts, hierarchies and link graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.operators import graph, hierarchy, tables
from folioworks.operators.lists import gather, list_counts
from folioworks.plans.catalogue import profile
from folioworks.plans.posts import labels_per_post, normalise
from folioworks.queries.registry import query, view
from folioworks.sources.landing import table

_TOOLS = """SELECT post_id, string_agg(coalesce(slug, 'none'), '|' ORDER BY slug NULLS FIRST) AS tool_types
            FROM v_category_bridge LEFT JOIN v_category ON value = id GROUP BY post_id"""
_TOPICS = """SELECT post_id, coalesce(string_agg(slug, '|' ORDER BY slug), '') AS topics
             FROM v_tag_bridge LEFT JOIN v_tag ON value = id GROUP BY post_id"""

# What each post looks like after normalising; shared with the enrichment query.
NORMALISED = f"""SELECT p.id, CAST(date AS DATE) AS date, title, s.slug AS stage,
                        coalesce(tool_types, 'none') AS tool_types, coalesce(topics, '') AS topics
                 FROM v_post p LEFT JOIN v_stage s ON p.stage_id = s.id
                 LEFT JOIN ({_TOOLS}) t ON t.post_id = p.id LEFT JOIN ({_TOPICS}) u ON u.post_id = p.id"""
NORMALISED_VIEWS = ("v_post", "v_stage", "v_category", "v_category_bridge", "v_tag", "v_tag_bridge")


def normalised(spark, folder):
    posts = view(spark, folder, "v_post").select("id", "title", "date", "stage_id")
    return normalise(posts, *[view(spark, folder, v) for v in (
        "v_stage", "v_category_bridge", "v_category", "v_tag_bridge", "v_tag"
    )])


def joined(column, null: str = ""):
    return F.array_join(F.col(column).cast("array<string>"), "|", null).alias(column)


@query("post_dims", NORMALISED, NORMALISED_VIEWS)
def post_dims(spark, folder):
    return normalised(spark, folder).select(
        "id", "date", "title", "stage", joined("tool_types", "none"), joined("topics")
    )


@query("list_keep_nulls", f"SELECT post_id, tool_types FROM ({_TOOLS})", NORMALISED_VIEWS)
def list_keep_nulls(spark, folder):
    lists = labels_per_post(
        view(spark, folder, "v_category_bridge"), view(spark, folder, "v_category"), "id", "slug",
        alias="tool_types", keep_nulls=True,
    )
    return lists.select("post_id", joined("tool_types", "none"))


@query("list_drop_nulls", f"SELECT post_id, topics FROM ({_TOPICS})", NORMALISED_VIEWS)
def list_drop_nulls(spark, folder):
    lists = labels_per_post(
        view(spark, folder, "v_tag_bridge"), view(spark, folder, "v_tag"), "id", "slug",
        alias="topics", keep_nulls=False,
    )
    return lists.select("post_id", joined("topics"))


@query(
    "full_join",
    "SELECT post_id, value, id, slug FROM v_category_bridge FULL JOIN v_category ON value = id",
    ("v_category_bridge", "v_category"),
)
def full_join(spark, folder):
    return view(spark, folder, "v_category_bridge").join(
        view(spark, folder, "v_category"), F.col("value") == F.col("id"), "full"
    )


@query("value_counts", """SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def value_counts(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return tables.value_counts(rows, "quality")


@query("top_values", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def top_values(spark, folder):
    counts = tables.value_counts(table(spark, folder, "orders"), "o_custkey")
    return tables.head(counts, [F.desc("n"), "o_custkey"], 10)


@query("head_sample", "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def head_sample(spark, folder):
    return tables.head(table(spark, folder, "events"), ["ts", "event_id"], 5).select("event_id", "event_type")


@query(
    "sample_k",
    """WITH numbered AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
       draws AS (SELECT i AS draw, CAST(('0x' || substr(md5(concat('7-', i)), 1, 15)) AS BIGINT) % (SELECT count(*) FROM orders) AS idx
                 FROM range(100) t(i))
       SELECT draw, o_orderkey FROM draws JOIN numbered USING (idx)""",
)
def sample_k(spark, folder):
    return tables.sample_with_replacement(
        table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 100, seed=7
    )


@query("list_value_counts", "SELECT slug, count(*) AS n FROM v_category_bridge JOIN v_category ON value = id GROUP BY slug",
       NORMALISED_VIEWS)
def list_value_counts(spark, folder):
    lists = labels_per_post(
        view(spark, folder, "v_category_bridge"), view(spark, folder, "v_category"), "id", "slug",
        alias="slug", keep_nulls=False,
    )
    return list_counts(lists, "slug")


@query(
    "catalogue_profile",
    """SELECT 'documents' AS "table", 'rows' AS figure, count(*) AS n FROM documents
       UNION ALL SELECT 'documents', 'unique lang', count(DISTINCT lang) FROM documents
       UNION ALL SELECT 'documents', 'unique source', count(DISTINCT source) FROM documents
       UNION ALL SELECT 'events', 'rows', count(*) FROM events
       UNION ALL SELECT 'events', 'unique event_type', count(DISTINCT event_type) FROM events
       UNION ALL SELECT 'bridge', 'rows', count(*) FROM v_category_bridge
       UNION ALL SELECT 'bridge', 'unique value', count(DISTINCT value) + max(CAST(value IS NULL AS INT)) FROM v_category_bridge""",
    ("v_category_bridge",),
)
def catalogue_profile(spark, folder):
    return profile(
        {
            "documents": table(spark, folder, "documents"),
            "events": table(spark, folder, "events"),
            "bridge": view(spark, folder, "v_category_bridge"),
        },
        {"documents": ["lang", "source"], "events": ["event_type"], "bridge": ["value"]},
    )


@query(
    "first_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def first_per_key(spark, folder):
    first = tables.first_per_key(
        table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"]
    )
    return first.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("day_trunc", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def day_trunc(spark, folder):
    return table(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "category_title",
    "SELECT item_id, category_id, name AS category_title FROM v_download LEFT JOIN v_node ON category_id = node_id",
    ("v_download", "v_node"),
)
def category_title(spark, folder):
    return tables.lookup(
        view(spark, folder, "v_download"), view(spark, folder, "v_node"), "category_id", "node_id", "name", "category_title"
    ).drop("title")


@query(
    "label_to_code",
    "SELECT c_custkey, coalesce(label, concat('Land ', c_custkey)) AS label, code FROM customer LEFT JOIN v_jurisdiction ON num = c_custkey % 19",
    ("v_jurisdiction",),
)
def label_to_code(spark, folder):
    dimension = view(spark, folder, "v_jurisdiction")
    labelled = (
        table(spark, folder, "customer")
        .select("c_custkey", (F.col("c_custkey") % 19).alias("_num"))
        .join(dimension.select(F.col("num").alias("_n"), "label"), F.col("_num") == F.col("_n"), "left")
        .select("c_custkey", F.coalesce("label", F.concat(F.lit("Land "), F.col("c_custkey").cast("string"))).alias("label"))
    )
    return tables.lookup(labelled, dimension.select("label", "code").withColumnRenamed("label", "l"), "label", "l", "code", "code")


_CLOSURE = """WITH RECURSIVE closure AS (
    SELECT node_id AS ancestor_id, node_id, 0 AS distance FROM v_node
    UNION ALL
    SELECT c.ancestor_id, n.node_id, c.distance + 1 FROM closure c JOIN v_node n ON n.parent_id = c.node_id)"""


def closure_of(nodes):
    return hierarchy.closure(hierarchy.root_paths(nodes))


@query("tree_closure", f"{_CLOSURE} SELECT ancestor_id, node_id, distance FROM closure", ("v_node",))
def tree_closure(spark, folder):
    return closure_of(view(spark, folder, "v_node"))


@query("tree_children", "SELECT node_id, ordinal, name FROM v_node WHERE parent_id = 'root'", ("v_node",))
def tree_children(spark, folder):
    return hierarchy.children(view(spark, folder, "v_node"), "root").drop("parent_id")


@query(
    "tree_levels",
    f"""{_CLOSURE} SELECT node_id, CAST(max(distance) AS INT) AS depth,
           (SELECT count(*) FROM v_node c WHERE c.parent_id = closure.node_id) AS n_children,
           (SELECT count(*) FROM v_node c WHERE c.parent_id = closure.node_id) = 0 AS is_leaf
        FROM closure GROUP BY node_id""",
    ("v_node",),
)
def tree_levels(spark, folder):
    nodes = view(spark, folder, "v_node")
    return hierarchy.levels(nodes, hierarchy.root_paths(nodes))


@query(
    "preorder",
    """WITH RECURSIVE p AS (
         SELECT node_id, lpad(CAST(ordinal AS VARCHAR), 12, '0') AS seq, 0 AS depth FROM v_node WHERE parent_id IS NULL
         UNION ALL
         SELECT n.node_id, concat(p.seq, '/', lpad(CAST(n.ordinal AS VARCHAR), 12, '0')), p.depth + 1
         FROM v_node n JOIN p ON n.parent_id = p.node_id)
       SELECT node_id, depth, row_number() OVER (ORDER BY seq) - 1 AS idx FROM p""",
    ("v_node",),
)
def preorder(spark, folder):
    nodes = view(spark, folder, "v_node").filter(F.col("node_id").isNotNull() & (F.col("node_id") != ""))
    return hierarchy.interval_labels(nodes).select("node_id", "depth", F.col("first").alias("idx"))


_LABELS = f"""{_CLOSURE}, path AS (
    SELECT node_id, lpad(CAST(ordinal AS VARCHAR), 12, '0') AS seq FROM v_node WHERE parent_id IS NULL
    UNION ALL SELECT n.node_id, concat(p.seq, '/', lpad(CAST(n.ordinal AS VARCHAR), 12, '0')) FROM v_node n JOIN path p ON n.parent_id = p.node_id),
  numbered AS (SELECT node_id, row_number() OVER (ORDER BY seq) - 1 AS first FROM path),
  label AS (SELECT n.node_id, first, first + size - 1 AS last FROM numbered n
    JOIN (SELECT ancestor_id, count(*) AS size FROM closure GROUP BY ancestor_id) s ON s.ancestor_id = n.node_id)"""


@query("tree_labels", f"{_LABELS} SELECT node_id, first, last FROM label", ("v_node",))
def tree_labels(spark, folder):
    return hierarchy.interval_labels(view(spark, folder, "v_node")).drop("depth")


_PAIRS = f"""{_CLOSURE}, scope AS (
    SELECT ancestor_id, node_id FROM closure
    UNION ALL SELECT DISTINCT chapter_id, chapter_id FROM v_owner
    WHERE chapter_id IS NOT NULL AND chapter_id NOT IN (SELECT node_id FROM v_node))"""


def associations(spark, folder):
    labels = hierarchy.interval_labels(view(spark, folder, "v_node"))
    return hierarchy.Associations(view(spark, folder, "v_owner"), view(spark, folder, "v_download"), labels)


@query(
    "chapter_item_rows",
    f"""{_PAIRS} SELECT ancestor_id AS chapter_id, item_id FROM scope JOIN v_download ON category_id = node_id
        WHERE ancestor_id IN (SELECT chapter_id FROM v_owner)""",
    ("v_node", "v_owner", "v_download"),
)
def chapter_item_rows(spark, folder):
    return associations(spark, folder).chapter_item_rows()


@query(
    "category_chapter_rows",
    f"""{_PAIRS} SELECT node_id AS category_id, ancestor_id AS chapter_id FROM scope
        WHERE ancestor_id IN (SELECT chapter_id FROM v_owner) AND node_id IN (SELECT category_id FROM v_download)""",
    ("v_node", "v_owner", "v_download"),
)
def category_chapter_rows(spark, folder):
    return associations(spark, folder).category_chapter_rows()


@query(
    "owner_item_ranges",
    f"""{_LABELS}, known AS (
          SELECT * FROM label UNION ALL
          SELECT id, n, n FROM (SELECT id, (SELECT count(*) FROM v_node) + row_number() OVER (ORDER BY id) - 1 AS n
            FROM (SELECT category_id AS id FROM v_download UNION SELECT chapter_id FROM v_owner)
            WHERE id IS NOT NULL AND id NOT IN (SELECT node_id FROM v_node))),
        filed AS (SELECT first, count(*) AS n FROM v_download JOIN known ON node_id = category_id GROUP BY first),
        chapter AS (SELECT DISTINCT chapter_id, first, last FROM v_owner JOIN known ON node_id = chapter_id),
        ranges AS (SELECT chapter_id, coalesce(sum(n) FILTER (f.first < c.first), 0)::BIGINT AS items_from,
                     coalesce(sum(n) FILTER (f.first <= c.last), 0)::BIGINT AS items_to FROM chapter c CROSS JOIN filed f GROUP BY chapter_id)
        SELECT owner_id, chapter_id, items_from, items_to FROM v_owner LEFT JOIN ranges USING (chapter_id)""",
    ("v_node", "v_owner", "v_download"),
)
def owner_item_ranges(spark, folder):
    """The items of an owner as a range of places among all items in order of the tree."""
    return associations(spark, folder).owner_ranges()


@query(
    "associated_items",
    f"""{_PAIRS} SELECT owner_id, chapter_id, string_agg(CAST(item_id AS VARCHAR), '|' ORDER BY item_id) AS items
        FROM v_owner LEFT JOIN (SELECT ancestor_id, item_id FROM scope JOIN v_download ON category_id = node_id) ON ancestor_id = chapter_id
        GROUP BY owner_id, chapter_id""",
    ("v_node", "v_owner", "v_download"),
)
def associated_items(spark, folder):
    return associations(spark, folder).associated_items(joined)


@query(
    "associated_owners",
    f"""{_PAIRS} SELECT item_id, category_id, string_agg(CAST(owner_id AS VARCHAR), '|' ORDER BY owner_id) AS owners
        FROM v_download LEFT JOIN (SELECT node_id, owner_id FROM scope JOIN v_owner ON chapter_id = ancestor_id) ON node_id = category_id
        GROUP BY item_id, category_id""",
    ("v_node", "v_owner", "v_download"),
)
def associated_owners(spark, folder):
    return associations(spark, folder).associated_owners(joined)


@query(
    "chapter_items",
    f"""{_PAIRS} SELECT ancestor_id AS chapter_id, string_agg(CAST(item_id AS VARCHAR), '|' ORDER BY item_id) AS items
        FROM scope JOIN v_download ON category_id = node_id WHERE ancestor_id IN (SELECT chapter_id FROM v_owner) GROUP BY ancestor_id""",
    ("v_node", "v_owner", "v_download"),
)
def chapter_items(spark, folder):
    return associations(spark, folder).chapter_items().select("chapter_id", joined("items"))


@query(
    "category_owners",
    f"""{_PAIRS} SELECT category_id, string_agg(CAST(owner_id AS VARCHAR), '|' ORDER BY owner_id) AS owners
        FROM (SELECT DISTINCT category_id FROM v_download) JOIN scope ON node_id = category_id JOIN v_owner ON chapter_id = ancestor_id
        GROUP BY category_id""",
    ("v_node", "v_owner", "v_download"),
)
def category_owners(spark, folder):
    return associations(spark, folder).category_owners(joined)


def _edges(spark, folder):
    return view(spark, folder, "v_edge")


@query(
    "graph_edges",
    """SELECT src, dst, 'edge' AS kind FROM v_edge
       UNION ALL SELECT node, NULL, 'vertex' FROM (SELECT c_custkey AS node FROM customer UNION SELECT dst FROM v_edge)""",
    ("v_edge",),
)
def graph_edges(spark, folder):
    linked = gather(view(spark, folder, "v_link"), ["src"], "dst", alias="related")
    records = table(spark, folder, "customer").join(linked, F.col("c_custkey") == F.col("src"), "left")
    edges = graph.edges_from_lists(records, "c_custkey", "related")
    nodes = graph.vertices(records, "c_custkey", edges)
    return edges.withColumn("kind", F.lit("edge")).unionByName(
        nodes.select(F.col("node").alias("src"), F.lit(None).cast("bigint").alias("dst"), F.lit("vertex").alias("kind"))
    )


_DEGREE = "SELECT node, count(*) AS degree FROM (SELECT src AS node FROM v_edge UNION ALL SELECT dst FROM v_edge) GROUP BY node"
_PRUNED = f"""SELECT src, dst FROM v_edge WHERE src NOT IN (SELECT node FROM ({_DEGREE}) WHERE degree < 2)
              AND dst NOT IN (SELECT node FROM ({_DEGREE}) WHERE degree < 2)"""


@query("graph_degree", _DEGREE, ("v_edge",))
def graph_degree(spark, folder):
    return graph.degree(_edges(spark, folder))


@query("graph_prune", _PRUNED, ("v_edge",))
def graph_prune(spark, folder):
    return graph.prune(_edges(spark, folder))


@query("self_loops", f"SELECT src AS node FROM ({_PRUNED}) WHERE src = dst", ("v_edge",))
def self_loops(spark, folder):
    return graph.self_loops(graph.prune(_edges(spark, folder)))


@query(
    "graph_labels",
    f"""SELECT node, CASE WHEN title IS NOT NULL THEN concat(substr(title, 1, 13), '...') END AS label
        FROM (SELECT src AS node FROM ({_PRUNED}) UNION SELECT dst FROM ({_PRUNED})) LEFT JOIN v_post ON id = node""",
    ("v_edge", "v_post"),
)
def graph_labels(spark, folder):
    kept = graph.prune(_edges(spark, folder))
    nodes = kept.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return graph.labels(nodes, view(spark, folder, "v_post"), "id", "title")
