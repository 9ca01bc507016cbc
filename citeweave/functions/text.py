"""Small text helpers shared by the other expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of letters, digits and underscore in any script.
WORD = r"[\p{L}\p{N}_]+"


# White space of any kind: what ``(?U)\s`` matches.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_space(c: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` drops blanks only).

    A pattern would be tried at every blank within the text.
    """
    return F.btrim(c, F.lit(SPACE))


def strip_char(c: Column, ch: str) -> Column:
    return F.btrim(c, F.lit(ch))


def words(c: Column) -> Column:
    """Lower-cased words in reading order."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def is_blank(c: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(c == "", F.lit(True))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate an expression once although ``use`` mentions it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
