"""Words of a title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import ENRICHED_STOP_WORDS, EXTRACTED_STOP_WORDS, MAX_KEYWORDS
from .text import is_blank, words


def _without(tokens: Column, stop_words: tuple[str, ...], min_length: int) -> Column:
    return F.filter(tokens, lambda w: (F.length(w) >= min_length) & ~w.isin(*stop_words))


def keywords_distinct(title: Column, limit: int = MAX_KEYWORDS) -> Column:
    """First ``limit`` different plain-letter words longer than three letters, in order."""
    plain = F.filter(words(F.coalesce(title, F.lit(""))), lambda w: w.rlike("^[a-z]+$"))
    return F.slice(F.array_distinct(_without(plain, ENRICHED_STOP_WORDS, 4)), 1, limit)


def keywords_all(title: Column) -> Column:
    """All words longer than two characters, duplicates kept."""
    return _without(words(F.coalesce(title, F.lit(""))), EXTRACTED_STOP_WORDS, 3)


def coalesce_title(metadata_title: Column, csv_title: Column) -> Column:
    """Metadata title unless it is missing or empty."""
    return F.when(is_blank(metadata_title), csv_title).otherwise(metadata_title)


def title_terms(title: Column) -> Column:
    """Different words of a title, sorted: the terms a registry search works on."""
    return F.sort_array(F.array_distinct(words(F.coalesce(title, F.lit("")))))
