"""Secret scans: patterns find candidates, corpus-wide ownership tells copied examples from live ones.

Every candidate value is hashed and counted over the distinct repositories and owners it appears in.
A value that several owners share, or that stands in many repositories, is an example that people copy;
one that stays with its owner in few places looks live.  Long mixed tokens of no known form are reported only if one owner alone has them.

Defined cases: a null text is empty; a null owner or repository is one nameless owner or repository;
rows that repeat are scanned one by one, each giving a row; other columns are ignored.  Positions
count code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioworks.llm.common import fresh_name, let, whole
from folioworks.session import written


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either_case('api')}_?{_either_case('key')}"
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in their fixed order.  Runs start where nothing of their own class stands before them, so
#: every run is looked at once.
KINDS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}",
    "mixed": "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}",
}
ORDER = {kind: i for i, kind in enumerate(KINDS)}
#: From so many owners, or so many repositories, on, a value is a copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 5


def _hits(text: Column, kind: str) -> Column:
    """Matches of one kind with the length of what stands between each and the one before."""
    pattern = KINDS[kind]

    def found(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
        pairs = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(hits)),
            hits,
            lambda gap, hit: F.struct(F.lit(kind).alias("kind"), gap.alias("gap"), hit.alias("hit")),
        )
        return F.transform(pairs, lambda p, i: F.struct(p["kind"].alias("kind"), i.alias("nth"), p["gap"].alias("gap"), p["hit"].alias("hit")))

    none = F.array().cast("array<struct<kind:string,nth:int,gap:int,hit:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda h: F.when(F.size(h) > 0, found(h)).otherwise(none))


def candidates(docs: DataFrame, keys: Sequence[str], owner: str, repository: Sequence[str], text: str = "text") -> DataFrame:
    """One row per match, and one without a kind for a text without any; written once, so ``_row`` is fixed."""
    hits = F.concat(*[_hits(whole(text), kind) for kind in KINDS])
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*keys).alias("_keys"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("_owner"),
        F.xxhash64(*repository).alias("_repository"),
        hits.alias("_hits"),
    )
    # Numbered before the matches are spread, so that all of a document's rows share its number.
    rows = rows.select("_row", "_keys", "_owner", "_repository", F.explode_outer("_hits").alias("_hit"))
    # Written before anything else, so texts are scanned once.
    rows = written(rows.select("_row", "_keys", "_owner", "_repository", "_hit.*"), "secret-matches")
    place = W.partitionBy("_row", "kind").orderBy("nth")
    begin = F.sum("gap").over(place) + F.sum(F.length("hit")).over(place) - F.length("hit")
    value = F.when(F.col("kind") == "assign", F.regexp_extract("hit", ASSIGN, 2)).otherwise(F.col("hit"))
    mixed = F.col("hit").rlike("[0-9]") & F.col("hit").rlike("[A-Z]") & F.col("hit").rlike("[a-z]")
    real = (
        F.when(F.col("kind") == "assign", F.length("value") >= 6)
        .when(F.col("kind") == "mixed", mixed)
        .otherwise(F.col("kind").isNotNull())
    )
    # Documents without a match would all be windows of one row; only matches are counted through.
    bare = rows.filter("kind IS NULL").select(
        "_row", "_keys", "_owner", "_repository", "kind", *[F.lit(None).cast(t).alias(c) for c, t in (("begin", "bigint"), ("end", "bigint"), ("value", "string"), ("hash", "string"))]
    )
    placed = (
        rows.filter("kind IS NOT NULL")
        .select("*", begin.alias("begin"), value.alias("value"))
        .select(
            "_row", "_keys", "_owner", "_repository",
            F.when(real, F.col("kind")).alias("kind"),
            "begin", (F.col("begin") + F.length("hit")).alias("end"), "value", F.sha2("value", 256).alias("hash"),
        )
    )
    return bare.unionByName(placed)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories per candidate hash.

    Rows are reduced to distinct triples first, in the tasks that hold them, so a value copied into
    very many documents costs one row per owner, repository and task.
    """
    return (
        found.filter("kind IS NOT NULL")
        .groupBy("hash", "_owner", "_repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash")
        .agg(F.count_distinct("_owner").alias("n_owners"), F.count_distinct("_repository").alias("n_repositories"), F.sum("n").alias("n_uses"))
    )


def classified(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    owner: str = "source",
    repository: Sequence[str] = ("source", "lang"),
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """Candidates with their owners and repositories and ``live``: in fewer of both than an example is."""
    found = written(candidates(docs, keys, owner, repository), "secret-candidates")
    lone = (F.col("kind") != "mixed") | (F.col("n_owners") == 1)
    # Rows without a candidate have no hash, and would all meet in one task of the join.
    counted = found.filter("kind IS NOT NULL").join(ownership(found), "hash")
    few = (F.col("n_owners") < example_owners) & (F.col("n_repositories") < example_repositories)
    counted = counted.withColumn("live", few).withColumn("kind", F.when(lone, F.col("kind")))
    shown = [*found.columns, "n_owners", "n_repositories", "live"]
    return counted.select(*shown).unionByName(found.filter("kind IS NULL"), allowMissingColumns=True)


def scan(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    owner: str = "source",
    repository: Sequence[str] = ("source", "lang"),
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """One row per document: counts, spans in order, how many of them look live and how many are examples.

    ``most_owners`` and ``most_repositories`` are those of its most widely used value, 0 without any.
    """
    found = classified(docs, keys, owner, repository, example_owners, example_repositories)
    order = F.create_map(*[x for k, i in ORDER.items() for x in (F.lit(k), F.lit(i))])
    span = F.when(
        F.col("kind").isNotNull(),
        F.struct(F.col("begin").alias("at"), order[F.col("kind")].alias("no"), F.concat_ws(":", "kind", "begin", "end").alias("span")),
    )
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS]
    spans = F.sort_array(F.col("_spans"))

    def joined(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: s["span"]), ",")

    return (
        found.groupBy("_row")
        .agg(
            F.first("_keys").alias("_keys"),
            *counts,
            F.collect_list(span).alias("_spans"),
            F.count(F.when(F.col("kind").isNotNull() & F.col("live"), 1)).alias("n_live"),
            F.count(F.when(F.col("kind").isNotNull() & ~F.col("live"), 1)).alias("n_example"),
            *[F.coalesce(F.max(F.when(F.col("kind").isNotNull(), F.col(f"n_{c}"))), F.lit(0)).alias(f"most_{c}") for c in ("owners", "repositories")],
        )
        .select(
            "_keys.*",
            *[f"n_{k}" for k in KINDS],
            F.sha2(joined(F.filter(spans, lambda s: s["no"] < ORDER["mixed"])).cast("binary"), 256).alias("base_sha256"),
            joined(spans).alias("spans"),
            "n_live",
            "n_example",
            "most_owners",
            "most_repositories",
        )
    )


MASK = "[SECRET]"


def mask_live(docs: DataFrame, owner: str = "source", repository: Sequence[str] = ("source", "lang")) -> DataFrame:
    """The documents with live-looking values masked in ``text`` and ``n_chars`` brought up to date.

    A value is masked at the places where it was found and nowhere else.  Whether it looks live is said of
    the value, so equal texts are masked alike and a text's digest is what brings its places back to it;
    keys, null or repeated, play no part.  No row is dropped; texts without a candidate are not moved.
    """
    own = fresh_name(docs, "_digest")
    held = F.coalesce(reduce(lambda a, b: a | b, [F.col("text").rlike(pattern) for pattern in KINDS.values()]), F.lit(False))
    some = docs.filter(held).withColumn(own, F.md5("text"))
    # The value is the end of its match.
    span = F.struct((F.col("end") - F.length("value")).alias("begin"), F.col("end").alias("end"))
    live = classified(some, (own,), owner, repository).filter("kind IS NOT NULL AND live")
    live = live.groupBy(F.col(f"_keys.{own}").alias("_of")).agg(F.array_sort(F.collect_set(span)).alias("_spans"))
    spans, of = fresh_name(some, "_spans"), fresh_name(some, "_of")
    joined = some.join(live.select(F.col("_of").alias(of), F.col("_spans").alias(spans)), F.col(own) == F.col(of), "left")
    text = F.col("text")
    part = lambda low, high: F.substring(text, (low + 1).cast("int"), (high - low).cast("int"))
    # Spans of several kinds may overlap; together they are one mask.
    done = F.aggregate(
        F.col(spans),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.struct(
            F.when(s["begin"] >= acc["at"], F.concat(acc["out"], part(acc["at"], s["begin"]), F.lit(MASK))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], part(acc["at"], F.length(text))),
    )
    masked = fresh_name(joined, "_masked")
    joined = joined.withColumn(masked, F.when(F.col(spans).isNotNull(), done).otherwise(text))
    changes = {"text": F.col(masked)}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.col(spans).isNotNull(), F.length(masked).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    joined = joined.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in docs.columns])
    return joined.unionByName(docs.filter(~held))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS own, concat(coalesce(source, '-'), '/', coalesce(lang, '-')) AS repo,
           coalesce(text, '') AS text FROM documents),
p AS (SELECT * FROM (VALUES ('assign', 0), ('access', 1), ('hex', 2), ('mixed', 3)) AS t(kind, no)),
h AS (SELECT r, doc_id, own, repo, text, kind, no, CASE kind
        WHEN 'assign' THEN regexp_extract_all(text, '{ASSIGN.replace("'", "''")}') WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]{{16,}}')
        WHEN 'hex' THEN regexp_extract_all(text, '[0-9a-f]{{24,}}') ELSE regexp_extract_all(text, '[A-Za-z0-9+/_-]{{32,}}') END AS hits FROM d, p),
-- Places: walk through the text, looking for each match behind the one before.
pos AS (
  WITH RECURSIVE walk AS (
    SELECT r, doc_id, own, repo, kind, no, text, hits, 1 AS k, CAST(instr(text, hits[1]) - 1 AS BIGINT) AS b FROM h WHERE len(hits) > 0
    UNION ALL
    SELECT r, doc_id, own, repo, kind, no, text, hits, k + 1, b + length(hits[k]) + instr(substr(text, CAST(b + length(hits[k]) + 1 AS BIGINT)), hits[k + 1]) - 1
    FROM walk WHERE k < len(hits))
  SELECT r, doc_id, own, repo, kind, no, hits[k] AS hit, b, b + length(hits[k]) AS e FROM walk),
v AS (SELECT *, CASE WHEN kind = 'assign' THEN regexp_extract(hit, '{ASSIGN.replace("'", "''")}', 2) ELSE hit END AS val FROM pos),
ok AS (SELECT * FROM v WHERE CASE kind WHEN 'assign' THEN length(val) >= 6
        WHEN 'mixed' THEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') ELSE true END),
f AS (SELECT val, count(DISTINCT own) AS owners, count(DISTINCT repo) AS repos FROM ok GROUP BY val),
x AS (SELECT r, kind, no, b, concat(kind, ':', b, ':', e) AS span, owners, repos, owners < {EXAMPLE_OWNERS} AND repos < {EXAMPLE_REPOSITORIES} AS live FROM ok JOIN f USING (val) WHERE kind <> 'mixed' OR owners = 1),
a AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex, count(*) FILTER (WHERE kind = 'mixed') AS n_mixed,
        string_agg(span, ',' ORDER BY b, no) FILTER (WHERE no < 3) AS base, string_agg(span, ',' ORDER BY b, no) AS spans,
        count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example,
        max(owners) AS owners, max(repos) AS repos FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_mixed, 0) AS n_mixed,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(owners, 0) AS most_owners, coalesce(repos, 0) AS most_repositories
FROM d LEFT JOIN a USING (r)
"""
