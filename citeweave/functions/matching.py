"""Decisions taken on a scored match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import REASON_INVALID, REASON_LOW_SCORE, REASON_NO_TITLE
from .identifiers import normalize_doi
from .text import is_blank


def is_valid_match(title_valid: Column, year_valid: Column) -> Column:
    """Both checks passed; false when either record is missing."""
    return F.coalesce(title_valid & year_valid, F.lit(False))


def is_correct_for_tuning(gold_doi: Column, registry_doi: Column) -> Column:
    """Normalised DOIs agree, and the registry did give one."""
    return F.coalesce(normalize_doi(gold_doi) == normalize_doi(registry_doi), F.lit(False))


def is_correct_for_holdout(gold_doi: Column, registry_doi: Column) -> Column:
    """Normalised DOIs agree, where two missing ones agree too; needs a raw registry DOI."""
    return registry_doi.isNotNull() & normalize_doi(gold_doi).eqNullSafe(
        normalize_doi(registry_doi)
    )


def is_correct_direct(gold_doi: Column, registry_doi: Column, valid: Column) -> Column:
    """Normalised DOIs agree and the match is valid."""
    return normalize_doi(gold_doi).eqNullSafe(normalize_doi(registry_doi)) & valid


def exceeds(score: Column, cutoff: Column) -> Column:
    return score >= cutoff


def accepted_doi(doi: Column, score: Column, cutoff: Column, valid: Column | None = None) -> Column:
    """DOI when the score reaches the cutoff (and, if given, the match is valid)."""
    taken = exceeds(score, cutoff)
    return F.when(taken if valid is None else taken & valid, doi)


def reject_code(title: Column, score: Column, cutoff: Column, valid: Column) -> Column:
    """Why a record is rejected, as a short code; null when it is validated."""
    return (
        F.when(is_blank(title), "no_title")
        .when(~exceeds(score, cutoff), "low_score")
        .when(~valid, "invalid")
    )


def reject_reason(code: Column, score: Column, cutoff: Column) -> Column:
    """Report text of a reject code."""
    return (
        F.when(code == "no_title", REASON_NO_TITLE)
        .when(
            code == "low_score",
            F.format_string(REASON_LOW_SCORE, score.cast("string"), cutoff.cast("string")),
        )
        .when(code == "invalid", REASON_INVALID)
    )
