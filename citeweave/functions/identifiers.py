"""DOIs, lookup keys and short ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    DOI_LABEL,
    DOI_URL_PREFIXES,
    NO_DOI_TEXT,
    SHORT_ID_ALPHABET,
    SHORT_ID_LENGTH,
)
from .text import strip_space

_URL_PREFIX = "^(?:" + "|".join(p.replace(".", r"\.") for p in DOI_URL_PREFIXES) + ")"


def has_doi(doi: Column) -> Column:
    """False for null, the empty string and the text that stands for a missing DOI."""
    return F.coalesce((doi != "") & (doi != NO_DOI_TEXT), F.lit(False))


def normalize_doi(doi: Column, trim_end: bool = False, strict_docs: bool = False) -> Column:
    """Comparable form of a DOI, null when there is none.

    One known prefix is removed, case-sensitively, and the rest lower-cased.
    ``trim_end`` also trims the outcome (the enrichment variant).
    ``strict_docs`` goes further, as documented for users: the label is matched in
    any case and all white space goes.
    """
    if strict_docs:
        compact = F.regexp_replace(doi, r"(?U)\s+", "")
        bare = F.regexp_replace(compact, "(?i)" + _URL_PREFIX + "|(?i)^" + DOI_LABEL, "")
    else:
        bare = F.when(
            doi.startswith(DOI_LABEL), strip_space(F.substring(doi, len(DOI_LABEL) + 1, 1 << 30))
        ).otherwise(F.regexp_replace(doi, _URL_PREFIX, ""))
        if trim_end:
            bare = strip_space(bare)
    return F.when(has_doi(doi), F.lower(bare))


def clean_doi(doi: Column) -> Column:
    """Drop the https resolver prefix and leave everything else as it is."""
    prefix = DOI_URL_PREFIXES[0]
    return F.when(
        doi.startswith(prefix), F.substring(doi, len(prefix) + 1, 1 << 30)
    ).otherwise(doi)


def lookup_key(title: Column, year: Column) -> Column:
    """Text key of a lookup entry; a missing year prints as ``None``."""
    return F.concat(title, F.lit("_"), F.coalesce(year.cast("string"), F.lit("None")))


def first_token(ids: Column) -> Column:
    """First white-space separated id of a multi-id field, ``''`` if there is none."""
    return F.coalesce(F.get(F.split(strip_space(ids), r"(?U)\s+"), F.lit(0)), F.lit(""))


def short_id(ident: Column, length: int = SHORT_ID_LENGTH) -> Column:
    """Deterministic id of ``length`` base-62 characters out of 48 bits of an md5."""
    base = len(SHORT_ID_ALPHABET)
    bits = F.conv(F.substring(F.md5(ident), 1, 12), 16, 10).cast("bigint")
    digits = [
        F.pmod(F.call_function("div", bits, F.lit(base**i).cast("bigint")), F.lit(base))
        for i in range(length)
    ]
    return F.concat(
        *[F.substring(F.lit(SHORT_ID_ALPHABET), d.cast("int") + 1, F.lit(1)) for d in digits]
    )
