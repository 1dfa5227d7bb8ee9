"""The six steps that turn a folder of landed inputs into the published tables.

Landed inputs are parquet tables with the columns named in ``INPUTS``.  JSON are the folders of API
pages ``posts``, ``categories``, ``tags`` and ``stufe``, the hand-written list ``legal_resources.json``
and the hand-written record ``council_supplement.json``; ``transcripts.csv`` is a saved sheet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks import contracts
from folioworks.functions.links import Site
from folioworks.html.extract import category_nodes
from folioworks.html.parser import parse
from folioworks.html.sections import TRACK
from folioworks.operators.hierarchy import Associations, interval_labels
from folioworks.operators.quality import orphans, require_none
from folioworks.operators.tables import head, sample_with_replacement
from folioworks.plans import bibliography, catalogue, posts
from folioworks.session import written
from folioworks.sinks.publish import export_tree_json, publish, target_path
from folioworks.sources.landing import child_rows, flatten, resources, scan_config, scan_paged, scan_sheet, table

INPUTS = {
    "council_pages": "id, html",
    "council_details": "url, html",
    "guide_start": "id, html",
    "guide_sources": "url, html",
    "legal_sources": "source_url, html",
    "publication_items": "key, doc, tags",
    "publication_files": "url, pdf_binary",
    "category_list": "id, html",
    "category_pages": "id, html",
    "download_files": "data_id, content_type, file_binary",
    "link_targets": "url, html",
    "glossary_pages": "id, html",
}

# The fields of landed JSON that are used.
POST = (
    "id bigint, date timestamp_ntz, link string, title struct<rendered: string>, content struct<rendered: string>, "
    "stufe array<bigint>, categories array<bigint>, tags array<bigint>"
)
TERM = "id bigint, slug string"
RESOURCE = "title string, type string, permalink string, url string, strategy string, area_class string, html_url string"

EXPECTED_COUNCILS = 17


@dataclass(frozen=True)
class Run:
    """Where to read, where to publish, and what the site looks like."""

    spark: SparkSession
    source: str
    target: str
    site: Site
    site_url: str
    guide_url: str
    smoke: bool = False
    smoke_rows: int = 3
    seed: int = 0

    def read(self, name: str) -> DataFrame:
        return table(self.spark, self.source, name)

    def publish(self, df: DataFrame, contract: contracts.Contract) -> str:
        return publish(df, contract, self.target, smoke=self.smoke)

    def trial(self, df: DataFrame, key: str) -> DataFrame:
        """All rows, or for a trial run some drawn at random."""
        if not self.smoke:
            return df
        drawn = sample_with_replacement(df.select(key), [key], self.smoke_rows, self.seed).select(key).distinct()
        return df.join(drawn, key, "left_semi")


def councils(run: Run) -> None:
    found = catalogue.councils(
        parse(run.read("council_pages")),
        "id",
        parse(run.read("council_details")),
        catalogue.jurisdiction_table(run.spark),
    )
    supplement = run.spark.read.schema(contracts.COUNCILS.spark_schema()).json(
        f"{run.source}/council_supplement.json", multiLine=True
    )
    whole = catalogue.complete_councils(found, supplement, EXPECTED_COUNCILS)
    run.publish(whole, contracts.COUNCILS)


def guides(run: Run) -> None:
    pages = catalogue.guide_pages(
        parse(run.read("guide_start"), track=("nav",)), "id", parse(run.read("guide_sources")), run.guide_url
    )
    chosen = head(pages, ["first_pos", "url"], run.smoke_rows) if run.smoke else pages
    run.publish(chosen.drop("first_pos"), contracts.GUIDE_PAGES)


def legal(run: Run) -> None:
    config = scan_config(run.spark, f"{run.source}/legal_resources.json", "jurisdiction", RESOURCE, multi_line=True)
    listed = resources(run.trial(config, "jurisdiction"), "jurisdiction").withColumn(
        "source_url", catalogue.source_url(F.col("html_url"), F.col("permalink"))
    )
    run.publish(catalogue.legal_texts(listed, parse(run.read("legal_sources"))), contracts.LEGAL_RESOURCES)


def publications(run: Run) -> None:
    items = run.trial(run.read("publication_items"), "key")
    require_none(bibliography.repeated_tags(items, "key"), "tags of a kind that allows one")
    insecure = bibliography.records(items.drop("key"), []).filter(bibliography.is_insecure(F.col("url")))
    require_none(insecure.select("key", "url"), "not a valid address")
    run.publish(bibliography.publications(items.drop("key"), run.read("publication_files")), contracts.PUBLICATIONS)


def _number(text: str):
    return F.col(text).cast("bigint").alias(text)


def articles(run: Run) -> None:
    """Downloads, posts and sections, which need each other; every HTML text is parsed once."""
    spark = run.spark
    categories = written(category_nodes(parse(run.read("category_list"), track=("li",)), "id").drop("id"), "categories")
    nodes = categories.select(_number("node_id"), _number("parent_id"), "ordinal", "name")

    names = nodes.select(F.col("node_id").alias("id"), "name")
    downloads = written(catalogue.downloads(parse(run.read("category_pages")), "id", names, run.site_url), "downloads")
    payloads = run.read("download_files")
    require_none(orphans(downloads, "data_id", payloads, "data_id"), "downloads without a file")
    filed = downloads.select(F.col("data_id").alias("item_id"), F.col("data_category_id").alias("category_id"))

    def terms(name: str) -> DataFrame:
        return scan_paged(spark, f"{run.source}/{name}", TERM).drop("page").distinct()

    landed = flatten(
        scan_paged(spark, f"{run.source}/posts", POST),
        {"id": "id", "date": "date", "url": "link", "title": "title.rendered", "html": "content.rendered",
         "stufe": "stufe", "categories": "categories", "tags": "tags"},
    ).dropDuplicates(["id"])
    chosen = written(run.trial(landed, "id"), "posts")

    def bridge(column: str) -> DataFrame:
        return child_rows(chosen, "id", column).select(F.col("parent_id").alias("post_id"), "value")

    posts.check_stages(bridge("stufe"))
    plain = posts.normalise(
        chosen.select("id", "date", "title", F.get("stufe", F.lit(0)).alias("stage_id")),
        terms("stufe"),
        child_rows(chosen, "id", "categories", keep_empty=True).select(F.col("parent_id").alias("post_id"), "value"),
        terms("categories"),
        bridge("tags"),
        terms("tags"),
    )
    documents = written(parse(chosen.select("id", "html"), track=TRACK), "documents")
    facts = written(posts.read_facts(documents, run.site), "facts")
    known = landed.select("id", "url", "title")
    targets = parse(run.read("link_targets"))
    associations = Associations(posts.owners_of(facts), filed, interval_labels(nodes))
    run.publish(posts.enrich(plain, facts, targets, known, associations), contracts.POSTS)

    listed = associations.associated_owners().select(
        F.col("item_id").alias("data_id"), F.col("category_id").alias("data_category_id"), F.col("owners").alias("associated_posts")
    )
    complete = catalogue.with_payloads(downloads.join(listed, ["data_id", "data_category_id"]), payloads)
    run.publish(complete, contracts.DOWNLOADS)

    media = scan_sheet(spark, f"{run.source}/transcripts.csv", "url_medium string, url_transkript string")
    found = written(posts.sections(documents, media), "sections")
    posts.check_sections(found, chosen)
    run.publish(found.drop("widget_no", "section_no"), contracts.SECTIONS)

    shaped = categories.select(
        "node_id", "parent_id", "ordinal", "name", F.col("node_id").alias("data_id"),
        F.col("level").alias("data_level"), "data_parent_id",
    )
    path = target_path(run.target, "downloads_tree", smoke=run.smoke).replace(".parquet", ".json")
    export_tree_json(shaped, path, ["data_id", "data_level", "data_parent_id", "name"])


def glossary(run: Run) -> None:
    rows = catalogue.glossary(
        parse(run.read("glossary_pages")),
        "id",
        catalogue.jurisdiction_aliases(run.spark),
        list(contracts.JURISDICTIONS),
    )
    chosen = head(rows, ["id", "entry"], run.smoke_rows) if run.smoke else rows
    run.publish(chosen.drop("id", "entry"), contracts.GLOSSARY_TERMS)


STEPS: dict[str, Callable[[Run], None]] = {
    "student_council_committees": councils,
    "guide_pages": guides,
    "legal_resources": legal,
    "publications": publications,
    "downloads_and_posts_and_sections": articles,
    "glossary_terms": glossary,
}


def run_steps(run: Run, steps: Iterable[str] | None = None) -> list[str]:
    """Run the named steps, or all, in their fixed order; an unknown name stops before the first."""
    wanted = set(STEPS if steps is None else steps)
    unknown = wanted - set(STEPS)
    if unknown:
        raise ValueError(f"no such steps: {sorted(unknown)}; there are {list(STEPS)}")
    done = [name for name in STEPS if name in wanted]
    for name in done:
        STEPS[name](run)
    return done
