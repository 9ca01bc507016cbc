"""From papers with authors to authors with papers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.names import named_authors, normalize_author_name
from citeweave.session import materialize

from .lists import PART_SIZE, parted_lists


def author_papers(papers: DataFrame) -> DataFrame:
    """(author, key) for every named author of every paper, duplicates kept."""
    # Optimized plans would list the authors twice for a plain explode and normalise each name twice
    # for a filter on a plain column; an outer explode and an array of one name keep both at once.
    return (
        papers.select("key", F.explode_outer(named_authors(F.col("authors"))).alias("a"))
        .select(F.explode(F.array(normalize_author_name(F.col("a.name")))).alias("author"), "key")
        .where(F.col("author") != "")
    )


def author_index(papers: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """(author, part, parts, papers): papers sorted; one part unless an author has very many."""
    # Counting and listing both read the pairs; the names are normalised once.
    pairs = materialize(author_papers(papers), "author-papers")
    return parted_lists(pairs, "author", "key", "papers", part_size)


def author_stats(papers: DataFrame) -> DataFrame:
    """Number of authors and author-paper pairs, mean papers per author (0 if none)."""
    per_author = author_papers(papers).groupBy("author").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.coalesce(F.sum("n"), F.lit(0))
    return per_author.agg(
        F.count(F.lit(1)).alias("authors"),
        pairs.alias("pairs"),
        F.when(F.count(F.lit(1)) > 0, pairs / F.count(F.lit(1))).otherwise(0.0).alias("mean_papers"),
    )
