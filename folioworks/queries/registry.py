"""Registration of queries and the input views they share.

``VIEWS`` hold SQL that reads the given tables and means the same in Spark and in DuckDB, so a
query and its counterpart start from the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioworks.contracts import JURISDICTIONS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_JURISDICTION_ROWS = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(JURISDICTIONS.items()))

#: The state of an order's customer, by the customer's number; two of eighteen numbers have none.
STATE_OF_CUSTOMER = "CASE o_custkey % 18 " + " ".join(
    f"WHEN {i} THEN '{c.partition('_')[2].lower()}'" for i, c in enumerate(c for c in JURISDICTIONS if "_" in c)
) + " ELSE '' END"

VIEWS = {
    # A hierarchy of regions, nations, market segments and customers.
    "v_node": """
        SELECT 'root' AS node_id, CAST(NULL AS STRING) AS parent_id, 0 AS ordinal, 'root' AS name
        UNION ALL SELECT concat('r', r_regionkey), 'root', r_regionkey, r_name FROM region
        UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), n_nationkey, n_name FROM nation
        UNION ALL SELECT DISTINCT concat('n', c_nationkey, '-', c_mktsegment), concat('n', c_nationkey),
                         ascii(c_mktsegment), c_mktsegment FROM customer
        UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey, '-', c_mktsegment),
                         CAST(c_custkey AS INT), c_name FROM customer""",
    # Downloads filed under customers, some under regions, some under categories nobody knows.
    "v_download": """
        SELECT o_orderkey AS item_id, concat('File ', o_orderkey) AS title,
               CASE WHEN o_orderkey % 101 = 0 THEN concat('x', o_custkey % 50)
                    WHEN o_orderkey % 7 = 0 THEN concat('r', o_custkey % 5)
                    ELSE concat('c', o_custkey) END AS category_id
        FROM orders""",
    # Posts with a chapter at any level of the hierarchy, or none.
    "v_owner": """
        SELECT c_custkey AS owner_id,
               CASE WHEN c_custkey < 5 THEN concat('r', c_custkey)
                    WHEN c_custkey % 31 = 30 THEN NULL
                    WHEN c_custkey % 50 = 7 THEN concat('n', c_nationkey, '-', c_mktsegment)
                    WHEN c_custkey % 97 = 11 THEN concat('x', c_custkey % 50)
                    ELSE concat('c', c_custkey) END AS chapter_id
        FROM customer""",
    "v_post": """
        SELECT o_orderkey AS id, concat('Post ', o_orderkey, ' of ', o_custkey) AS title, o_orderdate AS date,
               o_orderpriority AS stage_id, concat('https://site.example/p/', o_orderkey, '/') AS url
        FROM orders""",
    "v_stage": "SELECT DISTINCT o_orderpriority AS id, lower(substr(o_orderpriority, 3)) AS slug FROM orders",
    "v_category": "SELECT p_partkey AS id, p_brand AS slug FROM part",
    "v_category_bridge": """
        SELECT l_orderkey AS post_id, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_partkey END AS value
        FROM lineitem""",
    "v_tag": "SELECT CASE WHEN s_suppkey % 4 = 0 THEN -s_suppkey ELSE s_suppkey END AS id, s_name AS slug FROM supplier",
    "v_tag_bridge": "SELECT l_orderkey AS post_id, l_suppkey AS value FROM lineitem",
    "v_jurisdiction": f"SELECT * FROM (VALUES {_JURISDICTION_ROWS}) AS t(num, code, label)",
    "v_nav": """
        SELECT user_id AS doc_id, event_id AS pos,
               CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS lvl,
               concat(event_type, '-', event_id) AS txt, concat('/u/', user_id, '/', event_id % 40) AS url
        FROM events""",
    "v_link": """
        SELECT o_custkey AS src,
               CASE WHEN o_orderkey % 997 = 0 THEN o_custkey ELSE (o_orderkey * 31) % 20011 END AS dst FROM orders""",
    "v_edge": "SELECT DISTINCT src, dst FROM v_link",
    "v_tags": f"""
        SELECT o_orderkey AS id, concat_ws('|',
               CASE WHEN o_orderkey % 3 = 0 THEN concat('jurisdiction:de_', {STATE_OF_CUSTOMER}) END,
               CASE WHEN o_orderkey % 5 = 0 THEN 'school_type:elementary' END,
               CASE WHEN o_orderkey % 41 = 0 THEN 'school_type:other' END,
               CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END) AS tags
        FROM orders""",
    # Bibliographic records: dates of one, three or no parts, empty given names, some links without https.
    "v_bib": """
        SELECT o_orderkey AS id, concat('{"id":"K', o_orderkey, '","type":"', CASE WHEN o_orderkey % 2 = 0 THEN 'book' ELSE 'report' END,
          '","title":"T', o_custkey, '"', CASE WHEN o_orderkey % 3 = 0 THEN ',"abstract":"About"' ELSE '' END, ',"URL":"',
          CASE WHEN o_orderkey % 50 = 0 THEN 'http' ELSE 'https' END, '://x.example/', o_orderkey, '","issued":{"date-parts":[[',
          CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN concat('', year(o_orderdate))
               ELSE concat_ws(',', concat('', year(o_orderdate)), concat('', month(o_orderdate)), concat('', day(o_orderdate))) END,
          ']]},"author":[{"given":"', CASE WHEN o_custkey % 6 = 0 THEN '' ELSE concat('G', o_custkey) END,
          '","family":"F', o_custkey, '"},{"given":"A","family":"B"}]}') AS doc
        FROM orders""",
    "v_media": """
        SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('https://youtu.be/v', user_id)
          WHEN 1 THEN concat('https://www.youtube.com/embed/v', user_id, '?si=a', event_id)
          WHEN 2 THEN concat('https://www.youtube.com/watch?v=v', user_id)
          ELSE concat('https://prezi.com/view/v', user_id, '/') END AS media_url
        FROM events""",
    "v_lookup": """
        SELECT DISTINCT user_id AS pos,
               concat(CASE user_id % 3 WHEN 1 THEN 'https://youtu.be/v' WHEN 2 THEN 'https://prezi.com/view/v' ELSE 'https://prezi.com/view/none' END, user_id,
                      CASE WHEN user_id % 3 = 1 THEN ' ' ELSE '/ ' END) AS url_medium,
               concat('https://x.example/t/', user_id, '.pdf') AS url_transkript
        FROM events""",
    "v_line": """
        SELECT conv_id AS term_id, turn AS pos,
               CASE WHEN turn % 5 = 4 THEN text ELSE concat(role, ': ', text) END AS line
        FROM conversations""",
    # Content widgets of seventeen kinds, the rows behind the generated articles.
    "v_widget": """
        SELECT doc_id, w, k, CASE WHEN (doc_id + k + w) % 16 = 13 AND w > 1 THEN 16 ELSE (doc_id + k + w) % 16 END AS kind
        FROM (SELECT l_orderkey AS doc_id, l_linenumber AS w, min(l_partkey) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber) AS line""",
    # A ten-fold hierarchy of numbered categories.
    "v_chapter": """
        SELECT p_partkey AS node_id, CASE WHEN p_partkey >= 10 THEN CAST(floor(p_partkey / 10) AS BIGINT) END AS parent_id
        FROM part""",
    "v_filed": "SELECT c_custkey AS item_id, c_custkey AS category_id FROM customer",
    "v_page": """
        SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""",
    "v_href": """
        SELECT page_id * 5 AS link_id, concat('https://nowhere.example/', page_id) AS href, CAST(NULL AS STRING) AS link_title FROM v_page
        UNION ALL SELECT page_id * 5 + 1, concat(url, '#part', page_id), NULL FROM v_page
        UNION ALL SELECT page_id * 5 + 2, replace(url, 'http', 'HTTP'), 'no such title' FROM v_page
        UNION ALL SELECT page_id * 5 + 3, concat('https://nowhere.example/', page_id), title FROM v_page
        UNION ALL SELECT page_id * 5 + 4, url, title FROM v_page""",
}

_NEEDS = {
    "v_edge": ["v_link"],
    "v_href": ["v_page"],
}


def _closed(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in out:
                out.append(needed)
    return out


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the parquet files of a folder; nothing is registered in the session."""
    base = folder.rstrip("/")
    views = _closed((name,))
    words = set(re.findall(r"\w+", " ".join(VIEWS[v] for v in views)))
    parts = [f"{t} AS (SELECT * FROM parquet.`{base}/{t}.parquet`)" for t in TABLES if t in words]
    parts += [f"{v} AS ({VIEWS[v]})" for v in views]
    return spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}")


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register a query, with the SQL that must give the same rows."""
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            parts = ", ".join(f"{v} AS ({VIEWS[v]})" for v in _closed(views))
            ORACLES[name] = f"WITH {parts} SELECT * FROM ({oracle})" if parts else oracle
        return function

    return add
