"""Publications from bibliographic records and their tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.bibliography import date_text, person_names, plain_tags, tag_value, tags_of

# The part of a bibliographic record that is used.
RECORD = (
    "id string, type string, title string, abstract string, URL string, "
    "issued struct<`date-parts`: array<array<string>>>, author array<struct<given: string, family: string>>"
)

# The tags that become columns of their own.
TYPED_TAGS = ["jurisdiction", "school_type"]


def records(df: DataFrame, keep: list[str], doc: str = "doc") -> DataFrame:
    """JSON records as rows; absent texts are empty, an absent abstract or date is null."""
    r = F.from_json(doc, RECORD)
    parsed = df.select(*keep, r.alias("r"))
    return parsed.select(
        *keep,
        F.coalesce("r.id", F.lit("")).alias("key"),
        F.coalesce("r.type", F.lit("")).alias("type"),
        F.coalesce("r.title", F.lit("")).alias("title"),
        F.nullif(F.col("r.abstract"), F.lit("")).alias("abstract"),
        date_text(F.col("r.issued.date-parts")).alias("date"),
        F.coalesce("r.URL", F.lit("")).alias("url"),
        person_names(F.col("r.author")).alias("authors"),
    )


def split_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Typed tags to columns, the jurisdiction in capitals, the rest left in ``tags``."""
    column = F.col(tags)
    return (
        df.withColumn("jurisdiction", F.upper(tag_value(column, "jurisdiction")))
        .withColumn("school_type", tag_value(column, "school_type"))
        .withColumn(tags, plain_tags(column, TYPED_TAGS))
    )


def repeated_tags(df: DataFrame, key: str, tags: str = "tags") -> DataFrame:
    """Records with more than one tag of a kind that allows one."""
    counts = [F.struct(F.lit(k).alias("kind"), F.size(tags_of(F.col(tags), k)).alias("n")) for k in TYPED_TAGS]
    return df.select(key, F.inline(F.array(*counts))).filter(F.col("n") > 1)


def is_insecure(url: Column) -> Column:
    return ~F.contains(url, F.lit("https"))


def publications(items: DataFrame, payloads: DataFrame) -> DataFrame:
    """``items(id, doc, tags)`` with the landed ``payloads(url, pdf_binary)``; records without one are skipped."""
    return split_tags(records(items, ["tags"])).join(payloads, "url")
