"""Title and year checks on a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.dates import year_difference, year_valid
from citeweave.functions.matching import is_valid_match
from citeweave.functions.similarity import title_similarity, title_valid


def add_match_details(
    matched: DataFrame,
    title: str = "meta_title",
    year: str = "meta_year",
    only_if: Column | None = None,
) -> DataFrame:
    """Add the struct ``details`` and is_valid_match to rows with cr_title and cr_year.

    Rows without a registry DOI (or outside ``only_if``) are not compared and not valid.  A
    row whose ``has_metadata`` is false has no publication record to hold authors against.
    """
    applies = F.col("registry_doi").isNotNull()
    if only_if is not None:
        applies = applies & only_if
    similar = matched.withColumn(
        "title_similarity", title_similarity(F.col(title), F.col("cr_title"), applies)
    )
    checked = similar.withColumn("title_valid", title_valid(F.col("title_similarity"))).withColumn(
        "year_valid", applies & year_valid(F.col(year), F.col("cr_year"))
    )
    details = F.struct(
        "title_similarity",
        "title_valid",
        "year_valid",
        (applies & F.col("has_metadata") if "has_metadata" in matched.columns else applies).alias(
            "author_valid"
        ),
        F.when(applies, year_difference(F.col(year), F.col("cr_year"))).alias("year_difference"),
    )
    return (
        checked.withColumn(
            "is_valid_match", is_valid_match(F.col("title_valid"), F.col("year_valid"))
        )
        .withColumn("details", details)
        .drop("title_similarity", "title_valid", "year_valid")
    )


def expand_details(matched: DataFrame) -> DataFrame:
    """Details as flat columns, with defaults where a row has none."""
    flags = [
        F.coalesce(F.col(f"details.{n}"), F.lit(False)).alias(n)
        for n in ("title_valid", "year_valid", "author_valid")
    ]
    similarity = F.coalesce("details.title_similarity", F.lit(0.0)).alias("title_similarity")
    return matched.select("*", similarity, *flags).drop("details")
