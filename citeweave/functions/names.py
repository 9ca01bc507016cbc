"""Author fields and author names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    AFFILIATION_WORDS,
    MAX_AUTHOR_KEY,
    MAX_NAME_LENGTH,
    MIN_NAME_LENGTH,
    ORCID_PATTERN,
    UNKNOWN_NAME,
)
from .text import is_blank, let, strip_char, strip_space


def _entries(field: Column) -> Column:
    """Trimmed, non-empty parts of a ``;`` separated field; no entries for null."""
    parts = F.transform(F.split(F.coalesce(field, F.lit("")), ";"), strip_space)
    return F.filter(parts, lambda p: p != "")


def _given_first(name: Column) -> Column:
    """``Surname, Given`` to ``Given Surname``; other names stay as they are."""
    comma = F.instr(name, ",")
    surname = strip_space(F.substring(name, F.lit(1), comma - 1))
    given = strip_space(F.substring(name, comma + 1, F.length(name)))
    return F.when(comma == 0, name).otherwise(strip_space(F.concat_ws(" ", given, surname)))


def parse_author_string(
    field: Column, whole_word: bool = False, max_length: int = MAX_NAME_LENGTH
) -> Column:
    """Authors of an enrichment record as ``array<struct<name, org>>``.

    Entries that look like affiliations, addresses or running text are left out; an
    entry with an ORCID has four digits in a row and so counts as an address.  With
    ``whole_word`` an affiliation word must stand alone instead of occurring anywhere.
    Entries longer than ``max_length`` count as running text.
    """
    listed = "|".join(AFFILIATION_WORDS)
    affiliation = rf"(?U)\b(?:{listed})\b" if whole_word else listed
    bare = F.transform(
        _entries(field), lambda p: strip_space(F.regexp_replace(p, ",+$", ""))
    )
    people = F.filter(
        bare,
        lambda p: ~F.lower(p).rlike(affiliation)
        & ~p.rlike("[0-9]{4,}")
        & (F.length(p) <= max_length),
    )
    spaced = F.transform(people, lambda p: F.regexp_replace(p, r"(?U)\s+", " "))
    names = F.transform(spaced, _given_first)
    kept = F.filter(names, lambda n: F.length(n) >= MIN_NAME_LENGTH)
    return F.transform(kept, lambda n: F.struct(n.alias("name"), F.lit("").alias("org")))


def parse_author_orcid(field: Column) -> Column:
    """Authors of a dump record that carry an ORCID, as ``array<struct<name, orcid, org>>``."""
    identified = F.filter(_entries(field), lambda p: p.rlike(ORCID_PATTERN))
    return F.transform(
        identified,
        lambda p: F.struct(
            strip_space(F.regexp_replace(p, r"\[[^\]]+\]", "")).alias("name"),
            F.regexp_extract(p, ORCID_PATTERN, 1).alias("orcid"),
            F.lit("").alias("org"),
        ),
    )


def named_authors(authors: Column) -> Column:
    """Authors with a non-empty name; an empty array for null."""
    return F.filter(F.coalesce(authors, F.array()), lambda a: ~is_blank(a["name"]))


def normalize_author_name(name: Column, max_length: int = MAX_AUTHOR_KEY) -> Column:
    """Key ``first_last`` of a person's name, of ``max_length`` characters at most."""
    lowered = F.lower(strip_space(name))
    # Two plain words need none of the rules below.
    simple = (F.length(lowered) <= max_length) & lowered.rlike("^[a-z0-9]+ [a-z0-9]+\\z")
    plain = F.regexp_replace(lowered, r"(?U)\b([a-z])\.\s*", "$1 ")
    plain = F.regexp_replace(plain, r"(?U)[^\p{L}\p{N}_\s\-]", "")
    plain = F.regexp_replace(plain, r"(?U)\s*-\s*", "-")
    plain = strip_space(F.regexp_replace(plain, r"(?U)\s+", " "))
    joined = let(plain, _first_and_last)
    key = strip_char(F.regexp_replace(joined, "_+", "_"), "_")
    full = F.regexp_replace(F.substring(key, 1, max_length), "_+$", "")
    return F.when(simple, F.replace(lowered, F.lit(" "), F.lit("_"))).otherwise(full)


def _first_and_last(plain: Column) -> Column:
    first = F.regexp_extract(plain, "^[^ ]+", 0)
    last = F.regexp_extract(plain, "[^ ]+$", 0)
    return (
        F.when(plain == "", F.lit(f"{UNKNOWN_NAME}_{UNKNOWN_NAME}"))
        .when(F.instr(plain, " ") == 0, F.concat(F.lit(UNKNOWN_NAME + "_"), plain))
        .otherwise(F.concat_ws("_", first, last))
    )


def author_overlap(field_authors: Column, registry_authors: Column) -> Column:
    """Documented but switched-off check: a surname of one side occurs in a name of the other.

    The surname is the last word of the registry name, compared without case.
    """
    theirs = F.transform(
        F.coalesce(registry_authors, F.array().cast("array<string>")),
        lambda a: F.lower(F.regexp_extract(strip_space(a), r"[^ ]+$", 0)),
    )
    ours = F.transform(
        F.coalesce(field_authors, F.array().cast("array<string>")), lambda a: F.lower(a)
    )
    return F.exists(ours, lambda o: F.exists(theirs, lambda t: (t != "") & o.contains(t)))
