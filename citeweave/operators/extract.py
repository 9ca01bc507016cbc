"""One journal's publications and citations out of bulk dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.dates import year_prefix
from citeweave.functions.fixed_values import (
    JOURNAL_NAME,
    PRINT_ISSN,
    SHORT_ID_LENGTH,
    TARGET_ISSN,
)
from citeweave.functions.identifiers import first_token, short_id
from citeweave.functions.names import parse_author_orcid
from citeweave.functions.titles import keywords_all
from citeweave.session import materialize

from .lists import PART_SIZE, with_parts
from .lookup import last_wins


#: Rounds of hashing after which a length counts as too crowded.
CROWDED = 8


def in_journal(
    venue: Column,
    issns: tuple[str, ...] = (TARGET_ISSN, PRINT_ISSN),
    name: str = JOURNAL_NAME,
) -> Column:
    """Venue names one of the ISSNs or the journal; false for null."""
    match = F.lower(venue).contains(name)
    for issn in issns:
        match = match | venue.contains(issn)
    return F.coalesce(match, F.lit(False))


def publications(
    rows: DataFrame, order: Column | None = None, keep_order: str | None = None, **journal
) -> DataFrame:
    """Publications of the journal with at least one ORCID author, the last row per id.

    ``rows`` has id, title, author, pub_date, venue as text.  Authors are parsed only for
    rows of the journal.  ``order`` says which of several rows is last; ``keep_order`` names a
    column that keeps it.
    """
    parsed = rows.where(in_journal(F.col("venue"), **journal)).select(
        first_token(F.col("id")).alias("id"),
        "title",
        keywords_all(F.col("title")).alias("keywords"),
        parse_author_orcid(F.col("author")).alias("authors"),
        "venue",
        year_prefix(F.col("pub_date")).alias("year"),
        (F.lit(0) if order is None else order).alias("_order"),
    )
    kept = parsed.where(F.size("authors") > 0)
    last = last_wins(kept, ["id"], F.col("_order"))
    return last.withColumnRenamed("_order", keep_order) if keep_order else last.drop("_order")


def edges_touching(edges: DataFrame, pubs: DataFrame) -> DataFrame:
    """Edges of the publications as (id, direction, other), duplicates kept.

    Each edge is read once and offered from both of its ends; an edge inside the set
    counts in both directions.
    """
    ends = F.array(
        F.struct(
            F.col("citing").alias("id"),
            F.lit("outgoing").alias("direction"),
            F.col("cited").alias("other"),
        ),
        F.struct(
            F.col("cited").alias("id"),
            F.lit("incoming").alias("direction"),
            F.col("citing").alias("other"),
        ),
    )
    return edges.select(F.inline(ends)).join(pubs.select("id"), "id", "left_semi")


def citation_counts(touching: DataFrame) -> DataFrame:
    """(id, outgoing, incoming) counts, without building any list."""
    return touching.groupBy("id").agg(
        F.count_if(F.col("direction") == "outgoing").alias("outgoing"),
        F.count_if(F.col("direction") == "incoming").alias("incoming"),
    )


def citation_lists(touching: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """(id, part, parts, outgoing_citations, incoming_citations), sorted, duplicates kept.

    A publication with more than ``part_size`` citations is spread over several rows.
    """

    def listed(direction: str) -> Column:
        return F.array_sort(
            F.collect_list(F.when(F.col("direction") == direction, F.col("other")))
        )

    return (
        with_parts(touching, "id", "other", part_size)
        .groupBy("id", "part", "parts")
        .agg(
            listed("outgoing").alias("outgoing_citations"),
            listed("incoming").alias("incoming_citations"),
        )
    )


def merge_citations(pubs: DataFrame, lists: DataFrame) -> DataFrame:
    """Publications with their citation lists, empty when there are none."""
    none = F.array().cast("array<string>")
    return (
        pubs.join(lists, "id", "left")
        .withColumn("part", F.coalesce("part", F.lit(0)))
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("outgoing_citations", F.coalesce("outgoing_citations", none))
        .withColumn("incoming_citations", F.coalesce("incoming_citations", none))
    )


def pubs_with_citations(pubs: DataFrame, touching: DataFrame) -> DataFrame:
    """Publications with at least one edge, out of all."""
    cited = pubs.select("id").join(touching.select("id").distinct().withColumn("_c", F.lit(1)), "id", "left")
    return cited.agg(
        F.count("_c").alias("with_citations"), F.count(F.lit(1)).alias("publications")
    )


def short_ids(
    ids: DataFrame, length: int = SHORT_ID_LENGTH, taken: DataFrame | None = None
) -> DataFrame:
    """Unique (id, short_id) pairs.

    ``taken`` has pairs given earlier: they stay as they are and are part of the result, and
    only ids without one claim what is left.  A short id once given so never changes.

    Ids whose short form is taken by a smaller id are hashed again with a suffix, until none
    is left.  The first round shuffles all ids; the later ones handle the few losers only.
    Every ``CROWDED`` rounds the form gets one character longer, so that the search ends even
    where there are too few forms of the wanted length.
    """
    wanted = ids.select("id").distinct()
    if taken is None:
        claims = materialize(_claim(wanted, F.col("id"), length), "short-ids")
        settled, losers = claims.where("id = winner"), claims.where("id <> winner").select("id")
        attempt = 1
    else:
        settled = taken.select("id", "short_id", F.col("id").alias("winner"))
        losers, attempt = wanted.join(taken.select("id"), "id", "left_anti"), 0
    while not losers.isEmpty():
        text = F.concat("id", F.lit(f"#{attempt}")) if attempt else F.col("id")
        again = _claim(losers, text, length + attempt // CROWDED)
        attempt += 1
        taken = settled.select("short_id", F.lit(True).alias("taken"))
        again = materialize(
            again.join(taken, "short_id", "left").withColumn(
                "won", (F.col("id") == F.col("winner")) & F.col("taken").isNull()
            ),
            "short-ids",
        )
        settled = settled.unionByName(again.where("won").select("id", "short_id", "winner"))
        losers = again.where("NOT won").select("id")
    return settled.select("id", "short_id")


def _claim(ids: DataFrame, text: Column, length: int) -> DataFrame:
    """(id, short_id, winner): the winner is the smallest id of each short id."""
    claims = ids.select("id", short_id(text, length).alias("short_id"))
    winners = claims.groupBy("short_id").agg(F.min("id").alias("winner"))
    return claims.join(winners, "short_id").select("id", "short_id", "winner")


def with_short_ids(pubs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace the publication id by its short id; citations keep the original ids."""
    return pubs.join(mapping, "id").drop("id").withColumnRenamed("short_id", "id")


def remap_citations(touching: DataFrame, mapping: DataFrame) -> DataFrame:
    """Other end of each edge as short id where it has one (off by default)."""
    other = mapping.select(F.col("id").alias("other"), F.col("short_id").alias("_short"))
    return (
        touching.join(other, "other", "left")
        .withColumn("other", F.coalesce("_short", F.col("other")))
        .drop("_short")
    )


def scan_stats(rows: DataFrame, source: str) -> DataFrame:
    """Per source file: rows, matching publications and their authors.

    ``rows`` has the source, venue and author.
    """
    authors = F.when(in_journal(F.col("venue")), F.size(parse_author_orcid(F.col("author"))))
    counted = rows.select(source, F.coalesce(authors, F.lit(0)).alias("n"))
    return counted.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") > 0).alias("matches"),
        F.sum("n").alias("authors"),
    )


def first_match(stats: DataFrame, source: str) -> DataFrame:
    """Totals of a scan and the first source with a match."""
    return stats.agg(
        F.count(F.lit(1)).alias("sources"),
        F.sum("rows").alias("rows"),
        F.sum("matches").alias("matches"),
        F.sum("authors").alias("authors"),
        F.min(F.when(F.col("matches") > 0, F.col(source))).alias("first_source"),
    )
