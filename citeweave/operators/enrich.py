"""Metadata enrichment by DOI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.dates import parse_year
from citeweave.functions.errors import is_retryable
from citeweave.functions.identifiers import normalize_doi
from citeweave.functions.names import parse_author_string
from citeweave.functions.titles import keywords_distinct

from .lookup import last_wins, one_per


def enrich_by_doi(entries: DataFrame, lookups: DataFrame) -> DataFrame:
    """Status of each (key, doi) entry: found, not found or error, with its error and retryable.

    ``lookups`` has one answer per DOI: (doi, exists, error_type), and where lookups can break
    off, failure, the text of what was raised; such an entry has the status error.
    """
    asked = entries.select("key", normalize_doi(F.col("doi"), trim_end=True).alias("doi")).where(
        F.col("doi").isNotNull()
    )
    failure = F.col("failure") if "failure" in lookups.columns else F.lit(None).cast("string")
    answers = lookups.select("doi", "exists", "error_type", failure.alias("failure"))
    found = F.coalesce("exists", F.lit(False)) & F.col("failure").isNull()
    error = F.when(~found, F.coalesce("failure", "error_type"))
    return asked.join(answers, "doi", "left").select(
        "key",
        "doi",
        F.when(F.col("failure").isNotNull(), "error").when(found, "found").otherwise("not found").alias("status"),
        error.alias("error_type"),
        is_retryable(error).alias("retryable"),
    )


def convert_metadata(metadata: DataFrame) -> DataFrame:
    """Metadata per DOI in the target format; ``metadata`` has doi and the raw fields.

    Parsing comes before any join to entries, so a DOI asked for often is parsed once.
    """
    return metadata.select(
        "doi",
        F.coalesce("title", F.lit("")).alias("title"),
        F.lit("").alias("abstract"),
        keywords_distinct(F.col("title")).alias("keywords"),
        parse_author_string(F.col("author")).alias("authors"),
        F.coalesce("source_title", F.lit("")).alias("venue"),
        parse_year(F.col("year")).alias("year"),
    )


def convert_records(results: DataFrame, metadata: DataFrame) -> DataFrame:
    """Converted record of each found key, the last entry (largest DOI) per key winning."""
    found = results.where((F.col("status") == "found") & (F.coalesce("key", F.lit("")) != ""))
    wanted = last_wins(found.select("key", "doi"), ["key"], F.col("doi"))
    one = convert_metadata(one_per(metadata, "doi"))
    return wanted.join(one, "doi").withColumn("id", F.col("key"))


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of an enrichment run; the share is a raw ratio next to a rounded percentage."""
    total, success = F.count(F.lit(1)), F.count_if(F.col("status") == "found")
    ratio = F.when(total > 0, success / total).otherwise(0.0)
    return results.agg(
        total.alias("total"),
        success.alias("success"),
        (total - success).alias("failure"),
        F.round(ratio, 6).alias("success_ratio"),
        F.round(ratio * 100, 2).alias("success_percentage"),
        F.count_if(F.col("retryable")).alias("retry_candidates"),
    )
