"""Nested registry and metadata records as flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_SCHEMA = (
    "DOI string, score double, title array<string>, "
    "published struct<`date-parts`: array<array<int>>>, "
    "author array<struct<given: string, family: string>>, "
    "`container-title` array<string>, publisher string"
)
RECORD_SCHEMA = (
    "key string, doi string, "
    "metadata array<struct<title: string, author: string, year: string, source_title: string>>"
)


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def flatten_registry_item(items: DataFrame, column: str = "item") -> DataFrame:
    """(doi, score, title, year, authors, venue) of nested registry items in a struct column."""
    item = F.col(column)
    people = F.transform(item["author"], lambda a: F.concat_ws(" ", a["given"], a["family"]))
    return items.select(
        item["DOI"].alias("doi"),
        F.coalesce(item["score"], F.lit(0.0)).alias("score"),
        F.coalesce(_first(item["title"]), F.lit("")).alias("title"),
        _first(_first(item["published"]["date-parts"])).alias("year"),
        F.coalesce(
            F.filter(people, lambda p: p != ""), F.array().cast("array<string>")
        ).alias("authors"),
        F.coalesce(_first(item["container-title"]), item["publisher"], F.lit("")).alias("venue"),
    )


def parse_registry_items(lines: DataFrame, column: str = "value") -> DataFrame:
    """Registry items held as JSON text."""
    return flatten_registry_item(
        lines.select(F.from_json(column, ITEM_SCHEMA).alias("item")), "item"
    )


def flatten_enrichment_record(records: DataFrame) -> DataFrame:
    """First metadata element of each record with a key: (key, doi, title, author, year, source_title)."""
    meta = _first(F.col("metadata"))
    texts = [F.coalesce(meta[n], F.lit("")).alias(n) for n in ("title", "author", "year", "source_title")]
    return records.where(
        (F.coalesce("key", F.lit("")) != "") & (F.coalesce(F.size("metadata"), F.lit(0)) > 0)
    ).select("key", "doi", *texts)
