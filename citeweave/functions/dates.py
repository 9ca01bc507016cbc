"""Years as they appear in publication records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DEFAULT_YEAR


def to_year(text: Column) -> Column:
    """Whole number in a text, null when it is not one."""
    return text.try_cast("int")


def lookup_year(year: Column) -> Column:
    """Year to search a registry with: the default replaces missing, <= 1 and unreadable years."""
    number = to_year(year)
    return F.coalesce(F.when(number > 1, number), F.lit(DEFAULT_YEAR))


def year_difference(year: Column, other: Column) -> Column:
    """Absolute difference, null unless both years are present, readable and not zero."""
    a, b = to_year(year), to_year(other)
    return F.when((a != 0) & (b != 0), F.abs(a - b))


def year_valid(year: Column, other: Column) -> Column:
    """Both years present and equal."""
    return F.coalesce(year_difference(year, other) == 0, F.lit(False))


def parse_year(text: Column) -> Column:
    """First four-digit year from 1900 to 2099 that stands alone in a text."""
    return F.nullif(
        F.regexp_extract(text, r"(?U)\b(?:19|20)[0-9]{2}\b", 0), F.lit("")
    ).try_cast("int")


def year_prefix(date: Column) -> Column:
    """First four characters of a date when they are digits only."""
    head = F.substring(date, 1, 4)
    return F.when(head.rlike("^[0-9]+$"), head.try_cast("int"))
