"""Queries on scans, contracts and table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.contracts import PUBLICATIONS, Contract, Enum, Field, ListOf
from folioworks.functions.links import file_type
from folioworks.operators import quality
from folioworks.operators.hierarchy import interval_labels, tree_json_lines
from folioworks.operators.tables import add_missing
from folioworks.plans.bibliography import is_insecure, records, repeated_tags, split_tags
from folioworks.queries.registry import query, view
from folioworks.session import fresh_path
from folioworks.sinks.publish import publish, target_path
from folioworks.sinks.versions import publish_version, read_current, versions
from folioworks.sources.landing import (
    child_rows,
    expected_resources,
    flatten,
    resources,
    scan_config,
    scan_paged,
    scan_sheet,
    table,
    tree_rows,
)


@query(
    "scan_table",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def scan_table(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )


@query(
    "scan_paged",
    "SELECT o_orderkey // 20 + 1 AS page, o_orderkey AS id, concat('Order ', o_orderkey) AS title FROM orders",
)
def paged(spark, folder):
    orders = table(spark, folder, "orders").select(
        (F.floor(F.col("o_orderkey") / 20) + 1).alias("page"),
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("rendered")).alias("title"),
        ).alias("item"),
    )
    total = orders.agg(F.max("page")).first()[0]
    path = fresh_path(spark, "pages")
    landed = orders.groupBy("page").agg(F.collect_list("item").alias("items")).withColumn("total_pages", F.lit(total))
    landed.write.json(path)
    landed_pages = scan_paged(spark, path, "id bigint, title struct<rendered: string>")
    return flatten(landed_pages, {"page": "page", "id": "id", "title": "title.rendered"})


@query(
    "flatten_struct",
    "SELECT event_id AS id, event_type AS title, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def flatten_struct(spark, folder):
    payload = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("rendered")).alias("title"),
        F.from_json("props", "k int").alias("props"),
    )
    return flatten(payload, {"id": "id", "title": "title.rendered", "k": "props.k"})


@query(
    "json_attr",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_attr(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@query(
    "unnest_child",
    """SELECT doc_id AS parent_id, CAST(i - 1 AS INT) AS idx, lines[i] AS value
       FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
             FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
def unnest_child(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return child_rows(documents, "doc_id", "lines")


@query(
    "explode_config",
    """SELECT concat('J', o_orderkey // 20) AS jurisdiction, concat('Law ', o_orderkey) AS title, o_orderstatus AS type,
              CASE WHEN o_orderkey % 3 = 0 THEN concat('/h/', o_orderkey) ELSE concat('/p/', o_orderkey) END AS source_url,
              (SELECT count(*) FROM orders) AS expected
       FROM orders""",
)
def explode_config(spark, folder):
    key = F.col("o_orderkey").cast("string")
    entries = (
        table(spark, folder, "orders")
        .select(
            F.concat(F.lit("J"), F.floor(F.col("o_orderkey") / 20).cast("string")).alias("jurisdiction"),
            F.struct(
                F.concat(F.lit("Law "), key).alias("title"),
                F.col("o_orderstatus").alias("type"),
                F.concat(F.lit("/p/"), key).alias("permalink"),
                F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("/h/"), key)).alias("html_url"),
            ).alias("resource"),
        )
        .groupBy("jurisdiction")
        .agg(F.collect_list("resource").alias("resources"))
    )
    path = fresh_path(spark, "config")
    entries.write.json(path)
    config = scan_config(spark, path, "jurisdiction", "title string, type string, permalink string, html_url string")
    return resources(config, "jurisdiction").select(
        "jurisdiction",
        "title",
        "type",
        F.coalesce("html_url", "permalink").alias("source_url"),
        F.lit(expected_resources(config).first()[0]).alias("expected"),
    )


@query(
    "file_type",
    """SELECT doc_id, CASE WHEN doc_id % 5 < 2 THEN 'unknown' ELSE split_part(concat(source, '/', lang), '/', -1) END AS file_type
       FROM documents""",
)
def file_types(spark, folder):
    content_type = F.when(F.col("doc_id") % 5 == 0, F.lit("")).when(
        F.col("doc_id") % 5 > 1, F.concat("source", F.lit("/"), "lang")
    )
    return table(spark, folder, "documents").select("doc_id", file_type(content_type).alias("file_type"))


def _numbered(column):
    return F.transform(F.array_sort(F.collect_list(column)), lambda s: s["json"])


@query(
    "tree_from_json",
    """WITH line AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT o_orderkey // 50 AS tree_id, concat('b', o_orderkey // 50) AS node_id, NULL AS parent_id, 0 AS depth, 0 AS ordinal,
              concat('Block ', o_orderkey // 50) AS name
       FROM orders GROUP BY o_orderkey // 50
       UNION ALL
       SELECT o_orderkey // 50, concat('o', o_orderkey), concat('b', o_orderkey // 50), 1,
              CAST(row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey) - 1 AS INT), o_orderstatus FROM orders
       UNION ALL
       SELECT l_orderkey // 50, concat('l', l_orderkey, '-', l_linenumber), concat('o', l_orderkey), 2,
              CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INT), concat('Line ', l_linenumber)
       FROM line""",
)
def tree_from_json(spark, folder):
    """Blocks of fifty orders with their line numbers, one nested JSON document per block."""
    block = F.floor(F.col("o_orderkey") / 50)
    orders = table(spark, folder, "orders").select(block.alias("block"), "o_orderkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").distinct()

    def text(*columns):
        return F.concat(*[c.cast("string") for c in columns])

    def node(id_, name, children=None):
        inner = F.lit("") if children is None else F.concat(F.lit(',"children":['), F.array_join(children, ","), F.lit("]"))
        return F.concat(F.lit('{"node_id":"'), id_, F.lit('","name":"'), name, F.lit('"'), inner, F.lit("}"))

    leaf = node(
        text(F.lit("l"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")), text(F.lit("Line "), F.col("l_linenumber"))
    )
    per_order = lines.groupBy("l_orderkey").agg(
        _numbered(F.struct("l_linenumber", leaf.alias("json"))).alias("children")
    )
    branch = node(
        text(F.lit("o"), F.col("o_orderkey")),
        F.col("o_orderstatus"),
        F.coalesce("children", F.array().cast("array<string>")),
    )
    trees = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("block")
        .agg(_numbered(F.struct("o_orderkey", branch.alias("json"))).alias("children"))
        .select("block", node(text(F.lit("b"), F.col("block")), text(F.lit("Block "), F.col("block")), F.col("children")).alias("json"))
    )
    return tree_rows(trees, "block", "json", ["node_id", "name"])


@query(
    "tree_to_json",
    """WITH RECURSIVE p AS (
         SELECT node_id, parent_id, name, ordinal, lpad(CAST(ordinal AS VARCHAR), 12, '0') AS seq, 0 AS depth
         FROM v_node WHERE parent_id IS NULL
         UNION ALL
         SELECT n.node_id, n.parent_id, n.name, n.ordinal, concat(p.seq, '/', lpad(CAST(n.ordinal AS VARCHAR), 12, '0')), p.depth + 1
         FROM v_node n JOIN p ON n.parent_id = p.node_id),
       last AS (SELECT parent_id, max(ordinal) AS last FROM v_node GROUP BY parent_id),
       q AS (SELECT p.*, repeat('    ', depth) AS pad, last,
                    EXISTS (SELECT 1 FROM v_node c WHERE c.parent_id = p.node_id) AS inner_node
             FROM p LEFT JOIN last ON p.parent_id = last.parent_id)
       SELECT node_id, row_number() OVER (ORDER BY seq) - 1 AS seq, text FROM (
       SELECT node_id, concat(seq, '/') AS seq,
              concat(pad, '{', CASE WHEN inner_node THEN concat(chr(10), pad, '  "children": [') ELSE '' END) AS text FROM q
       UNION ALL
       SELECT node_id, concat(seq, '/~'),
              concat(CASE WHEN inner_node THEN concat(pad, '  ],', chr(10)) ELSE '' END, pad, '  "name": "', name, '",', chr(10),
                     pad, '  "node_id": "', node_id, '"', chr(10), pad, '}',
                     CASE WHEN ordinal < last THEN ',' ELSE '' END) FROM q)""",
    ("v_node",),
)
def tree_to_json(spark, folder):
    nodes = view(spark, folder, "v_node")
    return tree_json_lines(nodes, interval_labels(nodes), ["node_id", "name"])


@query(
    "conditional_union",
    """SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 17 = 0 THEN 'supplement' ELSE 'listed' END AS origin FROM supplier""",
)
def conditional_union(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    listed = suppliers.filter(F.col("s_suppkey") % 17 != 0).withColumn("origin", F.lit("listed"))
    return add_missing(listed, suppliers.withColumn("origin", F.lit("supplement")), "s_suppkey")


def _bib_reasons() -> str:
    return """SELECT concat('K', id) AS key, concat_ws('|',
                CASE WHEN id % 11 = 0 THEN 'null:date' END,
                CASE WHEN id % 3 = 0 AND o_custkey % 18 > 15 THEN 'domain:jurisdiction' END,
                CASE WHEN id % 5 <> 0 AND id % 41 = 0 THEN 'domain:school_type' END,
                CASE WHEN id % 50 = 0 THEN 'insecure:url' END) AS reasons
              FROM (SELECT o_orderkey AS id, o_custkey FROM orders)"""


@query("contract_violations", f"SELECT * FROM ({_bib_reasons()}) WHERE reasons <> ''")
def contract_violations(spark, folder):
    items = view(spark, folder, "v_bib").join(view(spark, folder, "v_tags"), "id")
    parsed = split_tags(records(items.withColumn("tags", F.split("tags", r"\|")), ["tags"]))
    bad = quality.violations(parsed, PUBLICATIONS, {"insecure:url": is_insecure(F.col("url"))})
    return bad.select("key", F.array_join("reasons", "|").alias("reasons"))


@query(
    "violation_counts",
    f"""SELECT unnest(string_split(reasons, '|')) AS reason, count(*) AS n FROM ({_bib_reasons()})
        WHERE reasons <> '' GROUP BY 1""",
)
def violation_counts(spark, folder):
    items = view(spark, folder, "v_bib").join(view(spark, folder, "v_tags"), "id")
    parsed = split_tags(records(items.withColumn("tags", F.split("tags", r"\|")), ["tags"]))
    return quality.violation_counts(parsed, PUBLICATIONS, {"insecure:url": is_insecure(F.col("url"))})


_PRIORITY = Contract(
    "priorities",
    (
        Field("id", "int64"),
        Field("priority", Enum(("1-URGENT", "2-HIGH", "3-MEDIUM"))),
        Field("marks", ListOf(Enum(("O", "F", "1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")))),
    ),
)


@query(
    "enum_domain",
    """SELECT * FROM (SELECT o_orderkey AS id, concat_ws('|',
         CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'domain:priority' END,
         CASE WHEN o_orderstatus NOT IN ('O', 'F') OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 'domain:marks' END) AS reasons
       FROM orders) WHERE reasons <> ''""",
)
def enum_domain(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.array("o_orderstatus", "o_orderpriority").alias("marks"),
    )
    return quality.violations(rows, _PRIORITY).select("id", F.array_join("reasons", "|").alias("reasons"))


_CAST = Contract(
    "events",
    (Field("event_id", "int32"), Field("day", "date"), Field("k", "int64", True), Field("event_type", "int64", True)),
)


@query(
    "cast_contract",
    """SELECT CAST(event_id AS INT) AS event_id, CAST(ts AS DATE) AS day, TRY_CAST(event_type AS BIGINT) AS event_type,
              TRY_CAST(CASE WHEN event_id % 6 = 0 THEN props ELSE json_extract_string(props, '$.k') END AS BIGINT) AS k
       FROM events""",
)
def cast_contract(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_type",
        F.when(F.col("event_id") % 6 == 0, F.col("props")).otherwise(F.get_json_object("props", "$.k")).alias("k"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("day"),
    )
    return quality.cast(rows, _CAST, strict=False)


@query(
    "null_counts",
    """SELECT count(*) FILTER (text IS NULL) AS text, count(*) FILTER (quality IS NULL) AS quality,
              count(*) FILTER (toxic IS NULL) AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_counts(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return quality.null_counts(rows, ["text", "quality", "toxic"])


@query(
    "orphan_keys",
    "SELECT DISTINCT value AS key FROM v_tag_bridge WHERE value NOT IN (SELECT id FROM v_tag)",
    ("v_tag", "v_tag_bridge"),
)
def orphan_keys(spark, folder):
    return quality.orphans(view(spark, folder, "v_tag_bridge"), "value", view(spark, folder, "v_tag"), "id")


@query(
    "lookup_misses",
    "SELECT DISTINCT category_id AS key FROM v_download WHERE category_id NOT IN (SELECT node_id FROM v_node)",
    ("v_node", "v_download"),
)
def lookup_misses(spark, folder):
    return quality.orphans(view(spark, folder, "v_download"), "category_id", view(spark, folder, "v_node"), "node_id")


@query(
    "expect_rows",
    """SELECT conv_id, CAST(max(turn) + 1 AS BIGINT) AS expected, count(*) AS found, max(turn) + 1 = count(*) AS ok
       FROM conversations GROUP BY conv_id""",
)
def expect_rows(spark, folder):
    return (
        table(spark, folder, "conversations")
        .groupBy("conv_id")
        .agg((F.max("turn") + 1).alias("expected"), F.count(F.lit(1)).alias("found"))
        .withColumn("ok", F.col("expected") == F.col("found"))
    )


@query(
    "url_predicate",
    "SELECT concat('K', o_orderkey) AS key, concat('http://x.example/', o_orderkey) AS url FROM orders WHERE o_orderkey % 50 = 0",
)
def url_predicate(spark, folder):
    return records(view(spark, folder, "v_bib"), []).filter(is_insecure(F.col("url"))).select("key", "url")


@query(
    "multiplicity",
    """SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS VARCHAR) AS kind, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
       UNION ALL
       SELECT CAST(o_orderkey AS VARCHAR), 'school_type', 2 FROM orders WHERE o_orderkey % 205 = 0""",
)
def multiplicity(spark, folder):
    lines = quality.multiple(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("kind"), "n"
    )
    tags = view(spark, folder, "v_tags").select(F.col("id").cast("string").alias("id"), F.split("tags", r"\|").alias("tags"))
    return lines.unionByName(repeated_tags(tags, "id").withColumn("n", F.col("n").cast("bigint")))


_PUBLISHED = Contract(
    "published_posts",
    (
        Field("id", "int64"),
        Field("date", "date"),
        Field("title", "utf8"),
        Field("stage", Enum(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))),
        Field("words", ListOf("utf8"), True),
    ),
)


@query(
    "publish_roundtrip",
    """SELECT id, CAST(date AS DATE) AS date, title, stage_id AS stage, CAST(len(string_split(title, ' ')) AS INT) AS n_words
       FROM v_post""",
    ("v_post",),
)
def publish_roundtrip(spark, folder):
    rows = view(spark, folder, "v_post").select(
        F.split("title", " ").alias("words"), F.col("stage_id").alias("stage"), "title", "date", "id"
    )
    path = publish(rows, _PUBLISHED, fresh_path(spark, "published"))
    return spark.read.parquet(path).withColumn("n_words", F.size("words")).drop("words")


@query(
    "publish_replace",
    """SELECT 'full' AS name, id, title, stage_id AS stage FROM v_post
       UNION ALL SELECT 'trial', id, 'trial', stage_id FROM v_post""",
    ("v_post",),
)
def publish_replace(spark, folder):
    """The second publication takes the place of the first; the trial after it goes under a name of its own."""
    target = fresh_path(spark, "published")
    rows = view(spark, folder, "v_post").select(
        "id", "date", "title", F.col("stage_id").alias("stage"), F.split("title", " ").alias("words")
    )
    publish(rows.withColumn("title", F.lit("old")), _PUBLISHED, target)
    full = publish(rows, _PUBLISHED, target)
    trial = publish(rows.withColumn("title", F.lit("trial")), _PUBLISHED, target, smoke=True)
    read = [spark.read.parquet(p).select(F.lit(n).alias("name"), "id", "title", "stage") for n, p in (("full", full), ("trial", trial))]
    return read[0].unionByName(read[1])


@query(
    "publish_versions",
    """SELECT 'read before' AS name, id, 'old' AS title, stage_id AS stage FROM v_post
       UNION ALL SELECT 'current', id, title, stage_id FROM v_post
       UNION ALL SELECT 'version', v, CAST((SELECT count(*) FROM orders) AS VARCHAR), '' FROM (VALUES (1), (2)) AS t(v)""",
    ("v_post",),
)
def publish_versions(spark, folder):
    """Two versions: whoever began with the first goes on reading it, the pointer names the second."""
    target = fresh_path(spark, "versions")
    rows = view(spark, folder, "v_post").select(
        "id", "date", "title", F.col("stage_id").alias("stage"), F.split("title", " ").alias("words")
    )
    publish_version(rows.withColumn("title", F.lit("old")), _PUBLISHED, target)
    before = read_current(spark, target, _PUBLISHED.name)
    publish_version(rows, _PUBLISHED, target)
    shown = [df.select(F.lit(n).alias("name"), "id", "title", "stage") for n, df in (("read before", before), ("current", read_current(spark, target, _PUBLISHED.name)))]
    log = versions(spark, target_path(target, _PUBLISHED.name))
    log = log.select(F.lit("version").alias("name"), F.col("version").alias("id"), F.col("rows").cast("string").alias("title"), F.lit("").alias("stage"))
    return shown[0].unionByName(shown[1]).unionByName(log)


@query("sheet_scan", "SELECT url_medium, url_transkript, 1 AS places FROM v_lookup", ("v_lookup",))
def sheet_scan(spark, folder):
    """The lookup sheet, landed as CSV; every line has a place of its own."""
    path = fresh_path(spark, "sheet")
    landed = view(spark, folder, "v_lookup").select("url_medium", "url_transkript")
    landed.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    sheet = scan_sheet(spark, path, "url_medium string, url_transkript string")
    return sheet.groupBy("url_medium", "url_transkript").agg(F.count_distinct("pos").cast("int").alias("places"))


@query("required_rows", "SELECT l_orderkey, l_linenumber FROM lineitem")
def required_rows(spark, folder):
    """Nested entries as rows; their number must be the one that the nested form announces."""
    lines = F.collect_list(F.struct("l_linenumber")).alias("resources")
    config = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(lines)
    rows = resources(config, "l_orderkey")
    quality.require_rows(rows, expected_resources(config).first()["expected"])
    return rows
