"""Joins against registry and lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.errors import is_retryable
from citeweave.functions.fixed_values import (
    DEFAULT_YEAR,
    ERROR_EMPTY_ANSWER,
    ERROR_NO_TITLE,
    ERROR_NOT_CACHED,
)
from citeweave.functions.identifiers import normalize_doi
from citeweave.functions.text import is_blank
from citeweave.functions.titles import coalesce_title
from citeweave.session import by_key


def last_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Keep the last record per key; combines before the shuffle, so hot keys stay cheap.

    Of records with the same order the largest counts, so that every run keeps the same one.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(order.alias("by"), row.alias("row"))).alias("last"))
    return last.select(*keys, *[F.col("last")[c].alias(c) for c in rest])


def one_per(df: DataFrame, key: str) -> DataFrame:
    """One record per key, the largest; for tables that should not, but may, repeat a key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(*rest)).alias("last")).select(key, *[F.col("last")[c].alias(c) for c in rest])


def latest_lookup(lookups: DataFrame) -> DataFrame:
    """Latest answer per DOI."""
    return last_wins(lookups, ["doi"], F.col("ts"))


def attach_metadata(
    gold: DataFrame, publications: DataFrame, order: Column | None = None
) -> DataFrame:
    """Give labelled rows the title and year to search with.

    ``gold`` has (key, title, ...), ``publications`` (key, title, year).  Adds csv_title,
    meta_title, meta_year (the metadata as it is, null without a record) and has_metadata;
    title and year become the ones to search with.  Of publications with one key the last by
    ``order`` counts, without it the largest.
    """
    by = F.lit(0) if order is None else order
    last = last_wins(publications.select("key", "title", "year", by.alias("_by")), ["key"], F.col("_by"))
    meta = last.select(
        "key",
        F.col("title").alias("meta_title"),
        F.col("year").alias("meta_year"),
        F.lit(True).alias("has_metadata"),
    )
    known = F.coalesce("has_metadata", F.lit(False))
    return (
        gold.withColumnRenamed("title", "csv_title")
        .join(by_key(meta), "key", "left")
        .withColumn("has_metadata", known)
        .withColumn("title", coalesce_title(F.col("meta_title"), F.col("csv_title")))
        .withColumn(
            "year", F.when(F.col("has_metadata"), F.col("meta_year")).otherwise(str(DEFAULT_YEAR))
        )
    )


def lookup_join(rows: DataFrame, answers: DataFrame, key_title: str = "title") -> DataFrame:
    """Join rows to cached answers on (title, year) and say what is missing.

    ``key_title`` names the title column of the key: tuning looks up the metadata title,
    hold-out evaluation the title of the CSV file.  Of several answers to one (title, year)
    the largest (doi, score) counts.
    """
    cached = last_wins(answers.select("title", "year", "doi", "score"), ["title", "year"], F.lit(0)).select(
        F.col("title").alias("_title"),
        F.col("year").alias("_year"),
        F.col("doi").alias("registry_doi"),
        "score",
        F.lit(True).alias("cached"),
    )
    on = (rows[key_title] == cached["_title"]) & rows["year"].eqNullSafe(cached["_year"])
    miss = (
        F.when(is_blank(F.col(key_title)), ERROR_NO_TITLE)
        .when(F.col("cached").isNull(), ERROR_NOT_CACHED)
        .when(F.col("registry_doi").isNull(), ERROR_EMPTY_ANSWER)
    )
    return (
        rows.join(cached, on, "left")
        .withColumn("error", miss)
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .drop("_title", "_year", "cached")
    )


def registry_exists(rows: DataFrame, registry: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Add on_registry and lookup_error by DOI membership; rows without a DOI are not on it.

    ``rows`` has doi, ``registry`` doi; ``failed`` lists the DOIs whose check failed.
    """
    asked = rows.withColumn("_doi", normalize_doi(F.col("doi")))
    # Rows without a DOI would all meet under one key of the joins.
    blank = asked.where("_doi IS NULL").drop("_doi")
    blank = blank.withColumn("lookup_error", F.lit(False)).withColumn("on_registry", F.lit(False))
    known = registry.select(normalize_doi(F.col("doi")).alias("_doi")).distinct()
    out = asked.where("_doi IS NOT NULL").join(known.withColumn("_known", F.lit(True)), "_doi", "left")
    if failed is None:
        error = F.lit(False)
    else:
        bad = failed.select(normalize_doi(F.col("doi")).alias("_doi")).distinct()
        out = out.join(bad.withColumn("_failed", F.lit(True)), "_doi", "left")
        error = F.coalesce("_failed", F.lit(False))
    checked = (
        out.withColumn("lookup_error", error)
        .withColumn("on_registry", F.coalesce("_known", F.lit(False)) & ~F.col("lookup_error"))
        .drop("_doi", "_known", "_failed")
    )
    return checked.unionByName(blank)


def uncached(entries: DataFrame, lookups: DataFrame, retry_http: bool = False) -> DataFrame:
    """Entries that need a lookup: no answer yet, or one with an error worth another try."""
    settled = lookups.where(~is_retryable(F.col("error_type"), retry_http)).select("doi")
    return entries.join(settled, "doi", "left_anti")


def merge_lookups(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new answers, the latest per DOI."""
    return latest_lookup(old.unionByName(new, allowMissingColumns=True))


def answer(dois: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """Answers of the registry table for some DOIs: (doi, exists, error_type, ts).

    A registry row may carry an error_type of its own, else a miss has none, and a failure, the
    text of what its lookup raised; then the answers have that column as well.
    """
    may_fail = ["failure"] if "failure" in registry.columns else []
    own_error = F.col("error_type") if "error_type" in registry.columns else F.lit(None)
    answers = registry.select("doi", own_error.cast("string").alias("error_type"), *may_fail)
    known = one_per(answers, "doi").withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False)) & F.col("error_type").isNull()
    for c in may_fail:
        hit = hit & F.col(c).isNull()
    return dois.join(known, "doi", "left").select(
        "doi", hit.alias("exists"), "error_type", now.alias("ts"), *may_fail
    )


def replay_retries(
    retries: DataFrame, registry: DataFrame, lookups: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Ask again for the retry set, whatever the lookup table says.

    Gives the merged lookup table and the part of the retry set that still fails.
    """
    fresh = answer(retries.select("doi").distinct(), registry, now)
    failing = fresh.where(is_retryable(F.col("error_type"))).select("doi")
    return merge_lookups(lookups, fresh), retries.join(failing, "doi", "left_semi")
