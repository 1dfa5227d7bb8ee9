"""Hierarchies as adjacency rows: interval labels, root paths, closure, and items found through them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.operators.lists import gather
from folioworks.operators.tables import dealt, left_join, with_row_index, with_sum_before
from folioworks.session import written

#: Places that a range of items is spelt out by, pieces that a list of items is put together from, and powers of two that an interval is cut into.
PLACES = 1024
PIECES = 256
LEVELS = 62


def _rounds(nodes: DataFrame) -> int:
    """After so many doublings, every walk upwards is over, or goes round a cycle."""
    return max(nodes.count(), 1).bit_length() + 1


def _cycle(state: DataFrame, pointer: str) -> ValueError:
    """Walks of more steps than there are nodes end on a cycle, so where they point to are its nodes."""
    on_it = [str(r[0]) for r in state.select(pointer).distinct().orderBy(pointer).limit(10).collect()]
    return ValueError(f"the hierarchy has a cycle, among others through {', '.join(on_it)}")


def _with_parents(nodes: DataFrame, *columns) -> DataFrame:
    """``(node_id, jump, ...)``, ``jump`` being the parent if the table has it, else null."""
    parents = nodes.select(F.col("parent_id").alias("_parent")).filter("_parent IS NOT NULL").distinct()
    there = parents.join(nodes.select(F.col("node_id").alias("_parent")), "_parent", "left_semi")
    linked = left_join(nodes, there, F.col("parent_id"), "_parent")
    return written(linked.select("node_id", F.col("_parent").alias("jump"), *columns), "tree-parents")


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """``(node_id, size)``: how many nodes each subtree has, its root included.

    Doubling: a node knows the sum over all nodes less than 2^k steps below, and the ancestor 2^k steps
    above; that ancestor adds the sums of all nodes that point to it, and everyone moves on to the
    pointer of the pointer.  Sums are combined before they are shuffled, and a pointer shared by many
    is looked up once.
    """
    return _sizes(_with_parents(nodes))


def _sizes(linked: DataFrame) -> DataFrame:
    state, rounds = linked.select("node_id", "jump", F.lit(1).cast("bigint").alias("size")), _rounds(linked)
    while True:
        moving = state.filter("jump IS NOT NULL")
        if moving.isEmpty():
            return state.select("node_id", "size")
        if rounds < 0:
            raise _cycle(moving, "jump")
        rounds -= 1
        sums = moving.groupBy("jump").agg(F.sum("size").alias("_more"))
        known = state.select(F.col("node_id").alias("_top"), F.col("jump").alias("_next"))
        tops = written(sums.join(known, F.col("jump") == F.col("_top")).select("_top", "_next", "_more"), "tree-tops")
        added = state.join(tops.select(F.col("_top").alias("node_id"), "_more"), "node_id", "left")
        moved = left_join(added, tops.select("_top", "_next"), F.col("jump"), "_top")
        state = written(
            moved.select("node_id", F.col("_next").alias("jump"), (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size")), "tree-sizes"
        )


def interval_labels(nodes: DataFrame) -> DataFrame:
    """``(node_id, first, last, depth)``: the pre-order numbers of each subtree, which are without a gap.

    Siblings are in order of ``ordinal`` and then of their id; trees follow one another in the same way.
    A node comes one place behind its parent and the subtrees of the siblings before it; the sum of these
    steps from the root down is its number.  The sums of sizes among siblings are taken along one global
    order, so a node with very many children is no single task's work, and those from the root down by
    doubling.  A cycle is an error that names nodes on it.
    """
    linked = _with_parents(nodes, "ordinal")  # a parent that is not in the table makes a root
    linked = linked.join(_sizes(linked), "node_id")
    ordered = with_sum_before(linked.withColumn("_inner", F.col("jump").isNotNull()), ["_inner", "jump", "ordinal", "node_id"], "size", "_before")
    ordered = written(ordered.drop("_inner"), "tree-siblings")
    eldest = ordered.filter("jump IS NOT NULL").groupBy("jump").agg(F.min("_before").alias("_start")).withColumnRenamed("jump", "_parent")
    step = F.col("_before") + 1 - F.col("_start")
    placed = left_join(ordered, eldest, F.col("jump"), "_parent")
    depth = F.when(F.col("jump").isNull(), 0).otherwise(1)
    state = written(placed.select("node_id", "jump", "size", F.coalesce(step, F.col("_before")).alias("first"), depth.alias("depth")), "tree-steps")
    done, state = state.filter("jump IS NULL"), state.filter("jump IS NOT NULL")
    while not state.isEmpty():
        tops = state.select(F.col("jump").alias("_top")).distinct()
        known = done.unionByName(state).select(F.col("node_id").alias("_top"), F.col("jump").alias("_next"), F.col("first").alias("_first"), F.col("depth").alias("_depth"))
        moved = left_join(state, tops.join(known, "_top"), F.col("jump"), "_top").select(
            "node_id", F.col("_next").alias("jump"), "size", (F.col("first") + F.col("_first")).alias("first"), (F.col("depth") + F.col("_depth")).alias("depth")
        )
        moved = written(moved, "tree-steps")
        done, state = done.unionByName(moved.filter("jump IS NULL")), moved.filter("jump IS NOT NULL")
    return written(done.select("node_id", "first", (F.col("first") + F.col("size") - 1).alias("last"), "depth"), "tree-labels")


def root_paths(nodes: DataFrame) -> DataFrame:
    """``nodes(node_id, parent_id, ordinal)`` to ``(node_id, path)``, the path running root to node.

    Each round appends to every open path the path of its top node, so paths double in length and
    a tree of depth d takes log2(d) joins; finished rows are written once.  A top shared by many is
    looked up once.  A node whose parent is not in the table is a root; a cycle is an error that names
    nodes on it.
    """
    step = F.array(F.struct(F.col("ordinal").alias("ordinal"), F.col("node_id").alias("node_id"))).alias("path")
    state, rounds = _with_parents(nodes, step), _rounds(nodes)
    done, state = state.filter("jump IS NULL"), state.filter("jump IS NOT NULL")
    while not state.isEmpty():
        if rounds < 0:
            raise _cycle(state, "jump")
        rounds -= 1
        tops = state.select(F.col("jump").alias("_top")).distinct()
        known = done.unionByName(state).select(F.col("node_id").alias("_top"), F.col("jump").alias("_next"), F.col("path").alias("_path"))
        grown = left_join(state, tops.join(known, "_top"), F.col("jump"), "_top")
        grown = written(grown.select("node_id", F.col("_next").alias("jump"), F.concat("_path", "path").alias("path")), "paths")
        done, state = done.unionByName(grown.filter("jump IS NULL")), grown.filter("jump IS NOT NULL")
    return done.select("node_id", "path")


def closure(paths: DataFrame, max_distance: int | None = None) -> DataFrame:
    """``(ancestor_id, node_id, distance)``, every node being its own ancestor at distance 0."""
    rows = paths.select("node_id", F.size("path").alias("_n"), F.posexplode("path").alias("_i", "_a")).select(
        F.col("_a.node_id").alias("ancestor_id"),
        "node_id",
        (F.col("_n") - 1 - F.col("_i")).alias("distance"),
    )
    return rows if max_distance is None else rows.filter(F.col("distance") <= max_distance)


def children(nodes: DataFrame, parent: object) -> DataFrame:
    """The nodes right below one node, in order."""
    return nodes.filter(F.col("parent_id") == F.lit(parent)).orderBy("ordinal")


def levels(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Depth, number of children and leaf flag per node."""
    children = nodes.filter(F.col("parent_id").isNotNull()).groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("n_children")
    )
    return (
        paths.select("node_id", (F.size("path") - 1).alias("depth"))
        .join(children, F.col("node_id") == F.col("parent_id"), "left")
        .select(
            "node_id",
            "depth",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("n_children").isNull().alias("is_leaf"),
        )
    )


def _with_unknown(labels: DataFrame, *ids: DataFrame) -> DataFrame:
    """``(node_id, first, last)`` with ids that the tree does not know added behind it; these cover only themselves."""
    asked = reduce(DataFrame.unionByName, [i.select(F.col(i.columns[0]).alias("node_id")) for i in ids]).filter("node_id IS NOT NULL").distinct()
    unknown = asked.join(labels.select("node_id"), "node_id", "left_anti")
    behind = labels.agg(F.coalesce(F.max("last") + 1, F.lit(0))).first()[0]
    number = F.col("_n") + behind
    added = with_row_index(unknown, ["node_id"], "_n").select("node_id", number.alias("first"), number.alias("last"))
    return written(labels.select("node_id", "first", "last").unionByName(added), "tree-known")


class Associations:
    """Owners of chapters and items filed under categories, associated through the tree without a row per pair.

    ``owners(owner_id, chapter_id)``, ``items(item_id, category_id)`` and the ``labels`` of the tree.  Items
    are put in order of the label of their category, so what is filed at or below a chapter is one range of
    places; ranges come from running counts by equi-joins.  A category meets the chapters above it, of which
    there are at most as many as the tree is deep, by a stabbing join of labels and intervals.  Rows and
    lists of associated items or owners are made on request from these.
    """

    def __init__(self, owners: DataFrame, items: DataFrame, labels: DataFrame) -> None:
        self.owners, self.items = owners, items
        self.labels = _with_unknown(labels, owners.select("chapter_id"), items.select("category_id"))

    @cached_property
    def places(self) -> DataFrame:
        """``(item_id, category_id, place)``: filed items in order of label and id."""
        label = self.labels.select(F.col("node_id").alias("_node"), F.col("first").alias("_label"))
        labelled = left_join(self.items.filter("category_id IS NOT NULL"), label, F.col("category_id"), "_node")
        return written(with_row_index(labelled.select("item_id", "category_id", "_label"), ["_label", "item_id"], "place").drop("_label"), "item-places")

    @cached_property
    def ranges(self) -> DataFrame:
        """``(chapter_id, items_from, items_to)``: the places of what is filed at or below each chapter in use."""
        filed = self.items.groupBy("category_id").agg(F.count(F.lit(1)).alias("_own")).withColumnRenamed("category_id", "node_id")
        counted = self.labels.join(filed, "node_id", "left").withColumn("_own", F.coalesce("_own", F.lit(0)))
        before = written(with_sum_before(counted, ["first"], "_own", "_before"), "label-counts")
        chapters = self.owners.select(F.col("chapter_id").alias("node_id")).filter("node_id IS NOT NULL").distinct()
        ends = before.select(F.col("first").alias("last"), (F.col("_before") + F.col("_own")).alias("items_to"))
        found = before.join(chapters, "node_id", "left_semi").join(ends, "last")
        return written(found.select(F.col("node_id").alias("chapter_id"), F.col("_before").alias("items_from"), "items_to"), "chapter-ranges")

    def owner_ranges(self) -> DataFrame:
        """``(owner_id, chapter_id, items_from, items_to)``: all that is to be said about an owner's items; null without a chapter."""
        return left_join(self.owners, self.ranges.withColumnRenamed("chapter_id", "_chapter"), F.col("chapter_id"), "_chapter").drop("_chapter")

    def chapter_item_rows(self) -> DataFrame:
        """``(chapter_id, item_id)``: the ranges spelt out, block of places by block."""
        first, last = F.expr(f"items_from div {PLACES}"), F.expr(f"(items_to - 1) div {PLACES}")
        blocks = self.ranges.filter("items_from < items_to").select("*", F.explode(F.sequence(first, last)).alias("_block"))
        places = self.places.withColumn("_block", F.expr(f"place div {PLACES}"))
        inside = (F.col("place") >= F.col("items_from")) & (F.col("place") < F.col("items_to"))
        return blocks.join(places, "_block").filter(inside).select("chapter_id", "item_id")

    def chapter_items(self) -> DataFrame:
        """``(chapter_id, items)``, the same as one list per chapter."""
        return gather(self.chapter_item_rows(), ["chapter_id"], "item_id", alias="items", pieces=PIECES)

    def associated_items(self, form: Callable[[str], Column] = F.col) -> DataFrame:
        """``(owner_id, chapter_id, items)``; owners without items have a null list.

        ``form`` may write a list in another way, which is then done once per chapter, not once per owner.
        Owners come in no order of their chapters: a writer of files takes the rows to come for as long as those it
        has seen, and a long list repeated by owner after owner, behind many short ones, would fill its memory.
        """
        lists = self.chapter_items().select(F.col("chapter_id").alias("_chapter"), form("items").alias("items"))
        mixed = dealt(self.owners, "owner_id", "chapter_id")
        return left_join(mixed, lists.hint("shuffle_hash"), F.col("chapter_id"), "_chapter").select("owner_id", "chapter_id", "items")

    def category_chapter_rows(self) -> DataFrame:
        """``(category_id, chapter_id)``: the chapters in use at or above each category with items."""
        categories = self.items.select(F.col("category_id").alias("node_id")).filter("node_id IS NOT NULL").distinct()
        points = self.labels.join(categories, "node_id", "left_semi").select(F.col("node_id").alias("category_id"), "first")
        chapters = self.owners.select(F.col("chapter_id").alias("node_id")).filter("node_id IS NOT NULL").distinct()
        intervals = self.labels.join(chapters, "node_id", "left_semi").select(F.col("node_id").alias("chapter_id"), "first", "last")
        return stabbed(points, "first", intervals, "first", "last").select("category_id", "chapter_id")

    def chapter_owners(self) -> DataFrame:
        """``(chapter_id, owners)``: who has exactly this chapter, once per chapter."""
        return gather(self.owners.filter("chapter_id IS NOT NULL"), ["chapter_id"], "owner_id", alias="owners")

    def category_owners(self, form: Callable[[str], Column] = F.col) -> DataFrame:
        """``(category_id, owners)``: the lists of the chapters above, merged; categories under the same chapters share one list.

        ``form`` may write a list in another way, which is then done once for all that share it.
        """
        above = self.category_chapter_rows().groupBy("category_id").agg(F.sort_array(F.collect_list("chapter_id")).alias("_chapters"))
        above = written(above, "category-chapters")
        chains = above.select("_chapters").distinct().select("_chapters", F.explode("_chapters").alias("chapter_id"))
        # The planner knows the compressed size of a written frame alone and would send what it grows to through the driver.
        owned = chains.hint("merge").join(self.chapter_owners(), "chapter_id")
        merged = owned.groupBy("_chapters").agg(F.sort_array(F.flatten(F.collect_list("owners"))).alias("owners"))
        return above.hint("merge").join(merged.select("_chapters", form("owners").alias("owners")), "_chapters").select("category_id", "owners")

    def associated_owners(self, form: Callable[[str], Column] = F.col) -> DataFrame:
        """``(item_id, category_id, owners)``, the inverse of ``associated_items``."""
        lists = self.category_owners(form).withColumnRenamed("category_id", "_category").hint("merge")
        return left_join(self.items, lists, F.col("category_id"), "_category").select("item_id", "category_id", "owners")


def stabbed(points: DataFrame, at: str, intervals: DataFrame, first: str, last: str) -> DataFrame:
    """All pairs of a point and an interval that holds it, by an equi-join; columns must not clash but for ``at``.

    An interval is cut into aligned stretches whose lengths are powers of two, at most two of each
    length; a point lies in one aligned stretch of each length.  Only lengths that some interval has are
    looked up.
    """
    # At level k lie the stretches of length 2^k that no longer aligned stretch of the interval holds.
    bounds = F.expr(
        f"""transform(sequence(0, {LEVELS - 1}), k -> struct(k AS k,
              ({first} + shiftleft(1L, k) - 1) div shiftleft(1L, k) AS low, ({last} + 1) div shiftleft(1L, k) AS high))"""
    )
    own = F.expr(
        """flatten(transform(filter(_bounds, s -> s.low < s.high), s -> concat(
              if(s.low % 2 = 1, array(struct(s.k AS _k, s.low AS _i)), array()),
              if(s.high % 2 = 1, array(struct(s.k AS _k, s.high - 1 AS _i)), array()))))"""
    )
    kept = [c for c in intervals.columns if c != at]
    cut = intervals.withColumn("_bounds", bounds).select(*kept, F.inline(own))
    cut = written(cut, "stretches")
    levels = sorted(r[0] for r in cut.select("_k").distinct().collect())  # at most LEVELS
    stretches = F.explode(F.array(*[F.struct(F.lit(k).alias("_k"), F.shiftright(F.col(at), k).alias("_i")) for k in levels or [0]]))
    return points.select("*", stretches.alias("_p")).select(*points.columns, "_p._k", "_p._i").join(cut, ["_k", "_i"]).drop("_k", "_i")


def tree_json_lines(nodes: DataFrame, labels: DataFrame, attributes: list[str], indent: int = 2) -> DataFrame:
    """The tree as pretty-printed JSON, one row per piece of text, to be read in order of ``seq``.

    Every node opens before and closes after its subtree, so no subtree is ever held in one cell;
    ordering the rows and writing them out as text gives the file.  ``seq`` is the step of a walk around
    the tree: before a node opens, all nodes with smaller numbers have opened, and all of these but its
    ancestors have closed.  Keys are in sorted order, with ``children`` left out at leaves.
    """
    ends = labels.select(F.col("node_id").alias("_parent"), F.col("last").alias("_last"))
    flagged = left_join(nodes.join(labels, "node_id"), ends, F.col("parent_id"), "_parent")
    opens = 2 * F.col("first") - F.col("depth")
    closes = opens + 2 * (F.col("last") - F.col("first")) + 1
    pad = F.repeat(F.lit(" " * (2 * indent)), F.col("depth"))
    inner_pad = F.concat(pad, F.lit(" " * indent))
    names = sorted([*attributes, "children"])
    before = names[: names.index("children")]
    after = names[names.index("children") + 1 :]

    def fields(columns: list[str]):
        return [
            F.concat(
                inner_pad,
                F.lit(f'"{c}": '),
                F.when(F.col(c).isNull(), F.lit("null")).otherwise(
                    F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
                ),
            )
            for c in columns
        ]

    has_children = F.col("last") > F.col("first")
    opening = F.array_join(
        F.array_compact(
            F.array(
                F.concat(pad, F.lit("{")),
                *[F.concat(f, F.lit(",")) for f in fields(before)],
                F.when(has_children, F.concat(inner_pad, F.lit('"children": ['))),
            )
        ),
        "\n",
    )
    closing_fields = F.array_join(F.array(*fields(after)), ",\n")
    comma = F.when(F.col("last") < F.col("_last"), F.lit(",")).otherwise(F.lit(""))
    closing = F.concat(
        F.when(has_children, F.concat(inner_pad, F.lit("],\n"))).otherwise(F.lit("")),
        closing_fields,
        F.lit("\n"),
        pad,
        F.lit("}"),
        comma,
    )
    lines = F.array(F.struct(opens.alias("seq"), opening.alias("text")), F.struct(closes.alias("seq"), closing.alias("text")))
    return flagged.select("node_id", F.explode(lines).alias("_l")).select("node_id", "_l.seq", "_l.text")
