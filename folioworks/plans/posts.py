"""Articles: normalising the landed payload, enriching it from the HTML, cutting it into sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.links import Site, canonical
from folioworks.functions.text import title_key
from folioworks.html.extract import chapter_links, dedicated_category, headline, labelled_link, related_links
from folioworks.html.sections import sections as cut_sections
from folioworks.html.sections import with_transcripts
from folioworks.operators.hierarchy import Associations
from folioworks.operators.lists import gather
from folioworks.operators.quality import multiple, orphans, require_none
from folioworks.operators.tables import left_join, lookup


def labels_per_post(
    bridge: DataFrame, dimension: DataFrame, key: str, slug: str, *, alias: str, keep_nulls: bool
) -> DataFrame:
    """The slugs behind the ids of ``bridge(post_id, value)``, one list per post."""
    named = lookup(bridge, dimension, "value", key, slug, alias).select("post_id", alias)
    return gather(named, ["post_id"], alias, alias=alias, keep_nulls=keep_nulls)


def normalise(
    posts: DataFrame,
    stages: DataFrame,
    category_bridge: DataFrame,
    categories: DataFrame,
    tag_bridge: DataFrame,
    tags: DataFrame,
) -> DataFrame:
    """``posts(id, date, title, stage_id, ...)`` with stage name and two label lists.

    Lists come from the bridges alone, so a post with several stages cannot repeat them.  Tool
    types keep nulls, a post without any having ``[null]``; topics drop them, giving ``[]``.  The
    date is cut to the day.
    """
    tools = labels_per_post(category_bridge, categories, "id", "slug", alias="tool_types", keep_nulls=True)
    topics = labels_per_post(tag_bridge, tags, "id", "slug", alias="topics", keep_nulls=False)
    lists = tools.join(topics, "post_id", "full")
    staged = lookup(posts, stages, "stage_id", "id", "slug", "stage").drop("stage_id")
    return (
        staged.withColumn("date", F.to_date("date"))
        .join(lists, F.col("id") == F.col("post_id"), "left")
        .withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))
        .withColumn("tool_types", F.coalesce("tool_types", F.array(F.lit(None).cast("string"))))
        .drop("post_id")
    )


def resolve_links(links: DataFrame, items: DataFrame) -> DataFrame:
    """``links(..., href, link_title)`` with the ``target_id`` of ``items(id, url, title)``.

    The address decides; links that match no address are tried by title.
    """
    by_url = items.select(canonical(F.col("url")).alias("_url"), "id").groupBy("_url").agg(F.min("id").alias("_by_url"))
    by_title = (
        items.select(title_key(F.col("title")).alias("_title"), "id").groupBy("_title").agg(F.min("id").alias("_by_title"))
    )
    keyed = links.withColumn("_u", canonical(F.col("href")))
    by_address = left_join(keyed, by_url, F.col("_u"), "_url").withColumn(
        "_t", F.when(F.col("_by_url").isNull(), title_key(F.col("link_title")))
    )
    return (
        left_join(by_address, by_title, F.col("_t"), "_title")
        .withColumn("target_id", F.coalesce("_by_url", "_by_title"))
        .drop("_u", "_t", "_url", "_title", "_by_url", "_by_title")
    )


def with_headlines(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``link_title``, the headline of the page a link leads to, from the parsed ``targets(url, nodes)``."""
    shown = targets.select(canonical(F.col("url")).alias("_target"), headline(F.col("nodes")).alias("_shown"))
    by_url = shown.filter(F.col("_shown") != "").groupBy("_target").agg(F.min("_shown").alias("link_title"))
    return left_join(links, by_url, canonical(F.col("href")), "_target").drop("_target")


def related_posts(links: DataFrame, items: DataFrame) -> DataFrame:
    """``links(id, href, link_title)`` to the sorted distinct ids each post links to, itself left out.

    ``n_links`` counts the resolved links before duplicates are merged.
    """
    found = resolve_links(links, items).filter(F.col("target_id").isNotNull() & (F.col("target_id") != F.col("id")))
    return gather(
        found, ["id"], "target_id", alias="related_posts", distinct=True, count_alias="n_links"
    )


def read_facts(documents: DataFrame, site: Site, doc: str = "id") -> DataFrame:
    """All facts read from the HTML of a post, in one pass over its nodes."""
    nodes = F.col("nodes")
    return documents.select(
        doc,
        chapter_links(nodes, site).alias("download_chapters_further"),
        labelled_link(nodes).alias("book_chapter"),
        dedicated_category(nodes).alias("download_chapter_dedicated"),
        related_links(nodes, site).alias("links"),
    )


def enrich(
    posts: DataFrame,
    facts: DataFrame,
    targets: DataFrame,
    items: DataFrame,
    associations: Associations,
    *,
    lists: bool = True,
) -> DataFrame:
    """Posts with chapters, book link, related posts and associated downloads.

    ``targets(url, nodes)`` are the pages links lead to, as far as they were landed.  The downloads of a post
    are a range of the ``places`` of its ``associations``, whose owners are the posts by their chapter; without
    ``lists`` a post keeps that range, ``downloads_from`` and ``downloads_to``, in place of a list.
    """
    links = with_headlines(facts.select("id", F.explode("links").alias("href")), targets)
    related = related_posts(links, items).select(F.col("id").alias("_rid"), "related_posts")
    if lists:
        associated = associations.associated_items().select(F.col("owner_id").alias("_aid"), F.col("items").alias("associated_downloads"))
    else:
        places = [F.col("items_from").alias("downloads_from"), F.col("items_to").alias("downloads_to")]
        associated = associations.owner_ranges().select(F.col("owner_id").alias("_aid"), *places)
    return (
        posts.join(facts.drop("links"), "id", "left")
        .join(related, F.col("id") == F.col("_rid"), "left")
        .join(associated, F.col("id") == F.col("_aid"), "left")
        .withColumn("related_posts", F.coalesce("related_posts", F.array().cast("array<bigint>")))
        .drop("_rid", "_aid")
    )


def owners_of(facts: DataFrame) -> DataFrame:
    """``(owner_id, chapter_id)``: posts as the owners of what is filed under their chapter."""
    return facts.select(F.col("id").alias("owner_id"), F.col("download_chapter_dedicated").alias("chapter_id"))


def sections(documents: DataFrame, media: DataFrame, doc: str = "id") -> DataFrame:
    return with_transcripts(cut_sections(documents, doc), media)


def check_sections(found: DataFrame, posts: DataFrame) -> None:
    """Every section belongs to a post and has a type."""
    require_none(orphans(found, "post_id", posts, "id"), "sections without a post")
    require_none(found.filter(F.col("type").isNull()).select("post_id"), "sections without a type")


def check_stages(stage_bridge: DataFrame) -> None:
    require_none(multiple(stage_bridge, ["post_id"]), "posts with several stages")
