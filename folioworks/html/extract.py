"""Single facts read from an article or a navigation page, as expressions over ``nodes``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.links import CATEGORY_PATTERN, Site
from folioworks.functions.text import strip
from folioworks.html.select import (
    at,
    descendants,
    find,
    find_all,
    has_attr,
    has_class,
    is_tag,
    let,
    select_nodes,
    stripped_text_of,
    subtree,
    text_of,
)


# The fields of a node that are read for links by the class of what holds them.
LINK_FIELDS = ("pre", "last", "tag", "classes", "attrs")

# The fields of a node that `category_nodes` reads.
CATEGORY_FIELDS = ("pre", "last", "tag", "classes", "attrs", "text", "scopes")


def _linked(nodes: Column, container) -> Column:
    """Addresses of all links inside each container, container by container."""
    return F.flatten(
        F.transform(
            find_all(nodes, container),
            lambda c: F.transform(
                F.filter(descendants(nodes, c), has_attr("href", "a")), lambda a: a["attrs"]["href"]
            ),
        )
    )


def chapter_links(nodes: Column, site: Site) -> Column:
    """Download categories linked from icon lists and toggle items, duplicates kept, ``[]`` for none.

    A link to the archive that names no category is left out.
    """
    hrefs = F.concat(
        _linked(nodes, has_class("elementor-icon-list-items")),
        _linked(nodes, has_class("elementor-toggle-item")),
    )
    numbers = F.transform(
        F.filter(hrefs, site.is_archive),
        lambda h: F.nullif(F.regexp_extract(h, CATEGORY_PATTERN, 1), F.lit("")).cast("bigint"),
    )
    return F.array_compact(numbers)


def labelled_buttons(nodes: Column, label: str = "volltext") -> Column:
    """Button widgets whose text holds the label."""
    return F.filter(
        nodes,
        lambda n: has_class("elementor-widget-button")(n)
        & F.contains(F.lower(text_of(subtree(nodes, n))), F.lit(label)),
    )


def labelled_link(nodes: Column, label: str = "volltext") -> Column:
    """The address behind the one labelled button; null without one, an error for several."""
    def single(buttons):
        link = find(descendants(nodes, F.get(buttons, F.lit(0))), is_tag("a"))["attrs"]["href"]
        several = F.raise_error(F.lit(f"more than one button labelled {label}")).cast("string")
        return F.when(F.size(buttons) > 1, several).when(F.size(buttons) == 1, link)

    return let(labelled_buttons(nodes, label), single)


def dedicated_category(nodes: Column) -> Column:
    """The category of the file tree in the first download widget; null where no tree is shown."""
    missing = F.raise_error(F.lit("file tree without a category")).cast("bigint")

    def in_widget(widget):
        tree = find(descendants(nodes, widget), has_class("wpfd-content-tree"))
        return let(
            tree,
            lambda t: F.when(t.isNull(), F.lit(None)).otherwise(
                F.coalesce(t["attrs"]["data-category"].cast("bigint"), missing)
            ),
        )

    return let(find(nodes, has_class("elementor-widget-wpfd_choose_category")), in_widget)


def related_links(nodes: Column, site: Site) -> Column:
    """Addresses of related articles: icon lists, embedded articles, text editors; duplicates kept."""
    first_in_item = F.transform(
        find_all(nodes, has_class("elementor-icon-list-item")),
        lambda i: find(descendants(nodes, i), has_attr("href", "a"))["attrs"]["href"],
    )
    embedded = F.transform(
        find_all(nodes, has_class("wp-embed type-post", "div")),
        lambda e: find(descendants(nodes, e), has_class("wp-embed-more", "a"))["attrs"]["href"],
    )
    in_text = _linked(nodes, has_class("elementor-widget-text-editor", "div"))
    return F.array_compact(
        F.concat(F.filter(first_in_item, site.is_article), embedded, F.filter(in_text, site.is_article))
    )


def category_nodes(documents: DataFrame, doc: str) -> DataFrame:
    """The nested list of download categories as adjacency rows.

    Parse with ``li`` tracked: the enclosing item, which is the parent, is then known per node.
    Items without a title are named ``Untitled``.
    """
    def attr(node, name):
        return F.coalesce(node["attrs"][name], F.lit(""))

    def item(n):
        title = find(subtree(F.col("nodes"), n), has_class("title", "span"))
        return F.struct(
            attr(n, "data-id").alias("node_id"),
            let(at(F.col("nodes"), n["scopes"]["li"]), lambda p: F.when(p.isNotNull(), attr(p, "data-id"))).alias("parent_id"),
            attr(n, "data-parent-id").alias("data_parent_id"),
            attr(n, "data-level").alias("level"),
            n["pre"].alias("ordinal"),
            let(
                title, lambda t: F.when(t.isNull(), F.lit("Untitled")).otherwise(stripped_text_of(subtree(F.col("nodes"), t)))
            ).alias("name"),
        )

    return documents.select(doc, F.inline(F.transform(find_all(F.col("nodes"), is_tag("li")), item)))


def file_links(documents: DataFrame, doc: str) -> DataFrame:
    """Distinct file links of all category pages: category, file, title, media type."""
    rows = select_nodes(documents, [doc], has_class("wpfd-file-link", "a"))
    attrs = F.col("node.attrs")

    def number(name):
        return F.coalesce(attrs[name].cast("bigint"), F.lit(0).cast("bigint"))

    return rows.select(
        number("data-id").alias("data_id"),
        number("data-category_id").alias("data_category_id"),
        F.coalesce(attrs["title"], F.lit("")).alias("title"),
    ).distinct()


def nav_links(documents: DataFrame, doc: str, skip: tuple[str, ...] = ("Downloads",)) -> DataFrame:
    """Links of the first list of the navigation, with level and text; excluded labels left out.

    A link without a level is an error, unless it is excluded.
    """
    def level(a, label):
        missing = F.raise_error(F.concat(F.lit("link without a level: "), a["attrs"]["href"])).cast("string")
        return F.when(~label.isin(*skip), F.coalesce(a["attrs"]["data-level"], missing)).cast("int")

    nav = F.filter(
        F.col("nodes"), lambda n: is_tag("ul")(n) & F.map_contains_key(n["scopes"], "nav")
    )
    first = F.get(nav, F.lit(0))

    def link(a):
        return let(
            stripped_text_of(subtree(F.col("nodes"), a)),
            lambda label: F.struct(
                a["pre"].alias("pos"), a["attrs"]["href"].alias("href"), level(a, label).alias("lvl"), label.alias("txt")
            ),
        )

    links = F.transform(F.filter(descendants(F.col("nodes"), first), has_attr("href", "a")), link)
    return documents.select(doc, F.inline(links)).filter(~F.col("txt").isin(*skip))


def nth_text(nodes: Column, scope, tag: str, n: int) -> Column:
    """Text of the n-th (0-based) element of a tag inside the first node matching ``scope``."""
    inside = descendants(nodes, find(nodes, scope))
    return let(
        F.get(find_all(inside, is_tag(tag)), F.lit(n)),
        lambda e: F.when(e.isNotNull(), text_of(subtree(inside, e))),
    )


def headline(nodes: Column) -> Column:
    """The title an article shows, null without one."""
    shown = find(nodes, has_class("gb-headline", "h1"))
    return let(shown, lambda n: F.when(n.isNotNull(), strip(text_of(subtree(nodes, n)))))
