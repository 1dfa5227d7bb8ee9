"""Bibliographic fields: dates in parts, person names, typed tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks.functions.text import zero_pad


def date_text(date_parts: Column) -> Column:
    """``[[year, month, day]]`` as ``year-month-day``; a lone year stays as it is, nothing is null."""
    parts = F.transform(F.get(date_parts, F.lit(0)), lambda p: p.cast("string"))
    return (
        F.when(F.coalesce(F.size(parts), F.lit(0)) <= 0, F.lit(None))
        .when(F.size(parts) == 1, F.get(parts, F.lit(0)))
        .otherwise(F.array_join(F.transform(parts, lambda p: zero_pad(p)), "-"))
    )


def person_names(people: Column) -> Column:
    """``given family`` per person, or the family name alone; the order of the list is kept."""
    return F.transform(
        people,
        lambda p: F.when(
            F.coalesce(p["given"], F.lit("")) != "",
            F.concat_ws(" ", p["given"], F.nullif(p["family"], F.lit(""))),
        ).otherwise(F.coalesce(p["family"], F.lit(""))),
    )


def tags_of(tags: Column, kind: str) -> Column:
    return F.filter(tags, lambda t: F.startswith(t, F.lit(f"{kind}:")))


def tag_value(tags: Column, kind: str) -> Column:
    """What follows ``kind:`` in the one tag of that kind; null without one."""
    return F.get(F.split(F.get(tags_of(tags, kind), F.lit(0)), ":"), F.lit(1))


def plain_tags(tags: Column, kinds: list[str]) -> Column:
    """Tags of none of the given kinds; an empty list of tags gives null."""
    def is_plain(tag: Column) -> Column:
        keep = F.lit(True)
        for kind in kinds:
            keep = keep & ~F.startswith(tag, F.lit(f"{kind}:"))
        return keep

    return F.when(F.size(tags) > 0, F.filter(tags, is_plain))
