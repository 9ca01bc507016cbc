"""Composite jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.dates import lookup_year
from citeweave.functions.fixed_values import (
    ERROR_EMPTY_ANSWER,
    ERROR_NO_HIT,
    ERROR_NO_TITLE,
    TRAIN_SIZE,
)
from citeweave.functions.matching import (
    accepted_doi,
    exceeds,
    is_correct_direct,
    is_correct_for_holdout,
    is_correct_for_tuning,
)
from citeweave.functions.text import is_blank
from citeweave.operators.bulk import bulk_outcomes
from citeweave.operators.candidates import attach_candidate, best_candidate, registry_details
from citeweave.operators.enrich import convert_records, enrich_by_doi, run_summary
from citeweave.operators.evaluate import (
    best_cutoff,
    cutoff_sweep,
    evaluate_direct,
    evaluate_holdout,
    wrong_matches,
)
from citeweave.operators.extract import (
    citation_lists,
    edges_touching,
    merge_citations,
    publications,
    short_ids,
    with_short_ids,
)
from citeweave.operators.lists import PART_SIZE
from citeweave.operators.lookup import (
    answer,
    attach_metadata,
    last_wins,
    latest_lookup,
    merge_lookups,
    registry_exists,
    uncached,
)
from citeweave.operators.sampling import seeded_split
from citeweave.operators.validate import add_match_details
from citeweave.session import by_key, materialize


def prepare_gold(
    gold: DataFrame, registry: DataFrame, failed: DataFrame | None = None, n: int = TRAIN_SIZE
) -> DataFrame:
    """Labelled rows with on_registry, lookup_error and their split."""
    return seeded_split(registry_exists(gold, registry, failed), n=n)


def search(
    rows: DataFrame, registry: DataFrame, title: str, answers: DataFrame | None = None, **options
) -> DataFrame:
    """Rows with the best registry record for (title, year).

    Equal searches are made once; rows without a title are not searched for.  ``answers``
    holds earlier ones as (title, year, doi, score): what it has is not searched again.
    """
    if answers is None:
        return _searched(rows, registry, title, **options)
    cached = last_wins(answers.select("title", "year", "doi", "score"), ["title", "year"], F.lit(0)).select(
        F.col("title").alias("_title"),
        F.col("year").alias("_year"),
        F.col("doi").alias("registry_doi"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.lit(True).alias("_cached"),
    )
    on = (rows[title] == cached["_title"]) & rows["year"].eqNullSafe(cached["_year"])
    marked = rows.join(by_key(cached), on, "left").drop("_title", "_year")
    known = marked.where("_cached").drop("_cached").join(by_key(registry_details(registry)), "registry_doi", "left")
    others = marked.where("_cached IS NULL").select(rows.columns)
    return _searched(others, registry, title, **options).unionByName(known)


def answers_of(found: DataFrame, title: str) -> DataFrame:
    """Answers of a search, (title, year, doi, score), to be kept for later runs."""
    return (
        found.where(~is_blank(F.col(title)))
        .select(F.col(title).alias("title"), "year", F.col("registry_doi").alias("doi"), "score")
        .distinct()
    )


def _searched(rows: DataFrame, registry: DataFrame, title: str, **options) -> DataFrame:
    asked = rows.withColumn("_title", F.col(title)).withColumn(
        "lookup_year", lookup_year(F.col("year"))
    )
    wanted = asked.where(~is_blank(F.col("_title"))).select(
        F.col("_title").alias("title"), "lookup_year"
    )
    best = best_candidate(wanted, registry, by_words=True, **options)
    renamed = asked.withColumnRenamed("title", "_own_title").withColumnRenamed("_title", "title")
    found = attach_candidate(renamed, best, registry)
    return found.drop("title", "lookup_year").withColumnRenamed("_own_title", "title")


def training_matches(gold: DataFrame, pubs: DataFrame, registry: DataFrame, **options) -> DataFrame:
    """Scored and validated matches of the labelled rows that have a title to search with."""
    rows = attach_metadata(gold, pubs).where(~is_blank(F.col("title")))
    matched = add_match_details(search(rows, registry, "title", **options))
    right = is_correct_for_tuning(F.col("doi"), F.col("registry_doi"))
    return matched.withColumn("is_correct", right).withColumn(
        "is_correct_with_validation", right & F.col("is_valid_match")
    )


@dataclass
class Tuning:
    matches: DataFrame
    sweep: DataFrame
    best: DataFrame

    @property
    def cutoff(self) -> Column:
        """The cutoff as a scalar to use in other queries."""
        return self.best.select("cutoff").scalar()


def tune_cutoff(
    gold: DataFrame,
    pubs: DataFrame,
    registry: DataFrame,
    manual: float | None = None,
    **options,
) -> Tuning:
    """Match the labelled rows and find the score cutoff of the highest accuracy."""
    matches = materialize(training_matches(gold, pubs, registry, **options), "training-matches")
    sweep = cutoff_sweep(matches)
    return Tuning(matches, sweep, best_cutoff(sweep, manual))


def holdout_matches(
    gold: DataFrame,
    pubs: DataFrame,
    registry: DataFrame,
    cutoff: Column,
    no_hit: str = ERROR_EMPTY_ANSWER,
    **options,
) -> DataFrame:
    """Hold-out rows searched by the title of the CSV file, one row per labelled row.

    ``no_hit`` is the error of rows whose search finds nothing.
    """
    rows = attach_metadata(gold, pubs)
    matched = add_match_details(search(rows, registry, "csv_title", **options))
    right = is_correct_for_holdout(F.col("doi"), F.col("registry_doi"))
    valid = F.col("is_valid_match")
    error = F.when(is_blank(F.col("csv_title")), ERROR_NO_TITLE).when(
        F.col("registry_doi").isNull(), no_hit
    )
    return (
        matched.withColumn("is_correct", right)
        .withColumn("is_correct_with_validation", right & valid)
        .withColumn("exceeds_cutoff", exceeds(F.col("score"), cutoff) & F.col("registry_doi").isNotNull())
        .withColumn("accepted_doi", accepted_doi(F.col("registry_doi"), F.col("score"), cutoff))
        .withColumn(
            "accepted_doi_with_validation",
            accepted_doi(F.col("registry_doi"), F.col("score"), cutoff, valid),
        )
        .withColumn("error", error)
    )


def evaluate_on_holdout(
    gold: DataFrame, pubs: DataFrame, registry: DataFrame, cutoff: Column, **options
) -> DataFrame:
    return evaluate_holdout(holdout_matches(gold, pubs, registry, cutoff, **options), cutoff)


def evaluate_by_search(
    gold: DataFrame, pubs: DataFrame, registry: DataFrame, cutoff: Column, **options
) -> DataFrame:
    """The stricter evaluation, in which an invalid match is never right."""
    matched = holdout_matches(gold, pubs, registry, cutoff, ERROR_NO_HIT, **options)
    right = is_correct_direct(F.col("doi"), F.col("registry_doi"), F.col("is_valid_match"))
    return evaluate_direct(matched.withColumn("is_correct", right), cutoff)


def bulk_validate(pubs: DataFrame, registry: DataFrame, cutoff: Column, **options) -> DataFrame:
    """Accept or reject every publication."""
    return bulk_decide(search(pubs, registry, "title", **options), cutoff)


def bulk_decide(found: DataFrame, cutoff: Column) -> DataFrame:
    """Outcomes of searched publications; titles are compared only above the cutoff."""
    checked = add_match_details(found, "title", "year", only_if=exceeds(F.col("score"), cutoff))
    return bulk_outcomes(checked, cutoff)


@dataclass
class Enrichment:
    results: DataFrame
    converted: DataFrame
    summary: DataFrame
    fresh: DataFrame


def enrich(
    entries: DataFrame,
    lookups: DataFrame,
    metadata: DataFrame,
    now: Column,
    retries: DataFrame | None = None,
) -> Enrichment:
    """Look up what the lookup table lacks, then report and convert every entry.

    ``retries`` is the retry set (key, doi) of an earlier run: its entries take part again,
    and are asked for whatever the lookup table says.  A metadata row may carry an
    ``error_type``, the error its lookup answers with, or a ``failure``, what its lookup raises:
    such entries have the status error and no answer.  ``fresh`` are the new answers, to be
    merged into the lookup table.
    """
    known = latest_lookup(lookups.select("doi", "exists", "error_type", "ts"))
    settled = known
    if retries is not None:
        settled = known.join(retries.select("doi").distinct(), "doi", "left_anti")
        entries = entries.select("key", "doi").unionByName(retries.select("key", "doi")).distinct()
    asked = entries.select("doi").distinct()
    fresh = materialize(answer(uncached(asked, settled), metadata, now), "answers")
    answers = merge_lookups(known, fresh)
    if "failure" in fresh.columns:
        # What failed is not an answer: it counts in this run and is asked again in the next.
        failed = fresh.where("failure IS NOT NULL")
        fresh = fresh.where("failure IS NULL").drop("failure")
        answers = merge_lookups(known, fresh).join(failed.select("doi"), "doi", "left_anti")
        answers = answers.unionByName(failed, allowMissingColumns=True)
    results = materialize(enrich_by_doi(entries, answers), "enriched")
    return Enrichment(results, convert_records(results, metadata), run_summary(results), fresh)


def extract_community(
    rows: DataFrame,
    edges: DataFrame,
    order: Column | None = None,
    part_size: int = PART_SIZE,
    **journal,
) -> DataFrame:
    """Publications of one journal with their citations in parts, under short ids."""
    pubs = materialize(publications(rows, order, **journal), "journal")
    # Counting and listing both read the edges; they are scanned once.
    touching = materialize(edges_touching(edges, pubs), "touching")
    lists = citation_lists(touching, part_size)
    return with_short_ids(merge_citations(pubs, lists), short_ids(pubs))


def error_analysis(tuning: Tuning) -> DataFrame:
    """Accepted but wrong matches of the tuning set at the tuned cutoff."""
    return wrong_matches(tuning.matches, tuning.cutoff)


