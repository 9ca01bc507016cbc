"""Queries on lookup tables, authors, citations, samples, sources and sinks."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.errors import is_retryable
from citeweave.functions.fixed_values import (
    ENRICHED_STOP_WORDS,
    ERROR_EMPTY_ANSWER,
    ERROR_NO_TITLE,
    ERROR_NOT_CACHED,
    MAX_KEYWORDS,
    SHORT_ID_ALPHABET,
)
from citeweave.functions.identifiers import normalize_doi
from citeweave.operators import authors, bulk, enrich, evaluate, extract, lookup, sampling
from citeweave.plans import jobs, views
from citeweave.plans.registered import joined, query, six
from citeweave.plans.view_sql import (
    AUTHORS,
    DUMP,
    EDGES,
    ENTRIES,
    LOOKUPS,
    METADATA,
    PAGES,
    PAPERS,
    SCORED,
    SWEEP,
    doi_sql,
    quoted,
    retryable_sql,
    with_,
    words,
)
from citeweave.session import materialize, shared_folder, shuffles_go
from citeweave.sources import dump, lookup_store, readers, registry, writers
from citeweave.streaming import extraction


def scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _now():
    """Time of the run: later than every recorded answer."""
    return F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))


# Joins ---------------------------------------------------------------------------------


@query(
    with_(PAGES)
    + """SELECT g.key, g.title AS csv_title, p.title AS meta_title, p.year AS meta_year, p.key IS NOT NULL AS has_metadata,
      CASE WHEN coalesce(p.title, '') = '' THEN g.title ELSE p.title END AS title,
      CASE WHEN p.key IS NULL THEN '2020' ELSE p.year END AS year
    FROM gold g LEFT JOIN publications p ON g.key = p.key"""
)
def attach_metadata(spark, d):
    out = lookup.attach_metadata(views.gold(spark, d), views.publications(spark, d))
    return out.select("key", "csv_title", "meta_title", "meta_year", "has_metadata", "title", "year")


@query(
    with_(
        PAGES,
        """
labelled AS (
  SELECT g.key, g.title AS csv_title, CASE WHEN coalesce(p.title, '') = '' THEN g.title ELSE p.title END AS title,
    CASE WHEN p.key IS NULL THEN '2020' ELSE p.year END AS year
  FROM gold g LEFT JOIN publications p ON g.key = p.key)""",
    )
    + f"""SELECT l.key, a.doi AS by_metadata, b.doi AS by_csv, coalesce(b.score, 0) AS csv_score,
      CASE WHEN l.csv_title = '' THEN '{ERROR_NO_TITLE}' WHEN b.title IS NULL THEN '{ERROR_NOT_CACHED}'
        WHEN b.doi IS NULL THEN '{ERROR_EMPTY_ANSWER}' END AS csv_error
    FROM labelled l
    LEFT JOIN answers a ON l.title = a.title AND l.year IS NOT DISTINCT FROM a.year
    LEFT JOIN answers b ON l.csv_title = b.title AND l.year IS NOT DISTINCT FROM b.year"""
)
def lookup_join(spark, d):
    rows = lookup.attach_metadata(views.gold(spark, d), views.publications(spark, d))
    answers = views.answers(spark, d)
    by_csv = lookup.lookup_join(rows, answers, "csv_title").select(
        "key",
        F.col("registry_doi").alias("by_csv"),
        F.col("score").alias("csv_score"),
        F.col("error").alias("csv_error"),
    )
    by_meta = lookup.lookup_join(rows, answers).select("key", F.col("registry_doi").alias("by_metadata"))
    return by_meta.join(by_csv, "key")


@query(
    with_(PAGES, LOOKUPS)
    + f"""SELECT key, {doi_sql('doi')} IN (SELECT lower(doi) FROM registry) AND NOT failed AS on_registry, failed AS lookup_error
    FROM (SELECT *, contains(coalesce({doi_sql('doi')}, ''), '10.1005/') AS failed FROM gold)
    WHERE {doi_sql('doi')} IS NOT NULL
    UNION ALL SELECT key, false, false FROM gold WHERE {doi_sql('doi')} IS NULL"""
)
def registry_exists(spark, d):
    gold = views.gold(spark, d)
    failed = gold.where(normalize_doi(F.col("doi")).contains("10.1005/")).select("doi")
    return lookup.registry_exists(gold, views.registry(spark, d), failed).select(
        "key", "on_registry", "lookup_error"
    )


@query(
    with_(ENTRIES, LOOKUPS)
    + f"""SELECT key, doi FROM (SELECT key, {doi_sql('doi', True)} AS doi FROM entries)
    WHERE doi IS NOT NULL AND doi NOT IN (SELECT doi FROM latest WHERE NOT {retryable_sql('error_type')})"""
)
def uncached(spark, d):
    entries = readers.key_doi_rows(views.entries(spark, d))
    return lookup.uncached(entries, lookup.latest_lookup(_plain_lookups(spark, d))).select("key", "doi")


def _plain_lookups(spark, d):
    return views.lookups(spark, d).select("doi", "exists", "error_type", "ts")


@query(with_(LOOKUPS) + "SELECT doi, exists_flag AS found, error_type, ts FROM latest")
def latest_lookup(spark, d):
    return lookup.latest_lookup(_plain_lookups(spark, d)).select(
        "doi", F.col("exists").alias("found"), "error_type", "ts"
    )


@query(
    with_(LOOKUPS)
    + "SELECT doi, event_id FROM lookups QUALIFY row_number() OVER (PARTITION BY doi ORDER BY event_id DESC) = 1"
)
def last_wins(spark, d):
    rows = views.lookups(spark, d).select("doi", "event_id")
    return lookup.last_wins(rows, ["doi"], F.col("event_id"))


@query(
    with_(ENTRIES, LOOKUPS)
    + f"""SELECT key, e.doi, CASE WHEN exists_flag THEN 'found' ELSE 'not found' END AS status,
      CASE WHEN NOT coalesce(exists_flag, false) THEN error_type END AS error_type,
      NOT coalesce(exists_flag, false) AND {retryable_sql('error_type')} AS retryable
    FROM (SELECT key, {doi_sql('doi', True)} AS doi FROM entries) e LEFT JOIN latest l ON e.doi = l.doi WHERE e.doi IS NOT NULL"""
)
def enrich_by_doi(spark, d):
    latest = lookup.latest_lookup(_plain_lookups(spark, d))
    return enrich.enrich_by_doi(views.entries(spark, d), latest)


# Aggregations --------------------------------------------------------------------------


_AUTHOR_PARTS = """
sized AS (SELECT author, count(*) AS n FROM author_pairs WHERE author <> '' GROUP BY author),
parted AS (
  SELECT p.author, key, CASE WHEN n > 500 THEN ceil(n / 500.0)::BIGINT ELSE 1 END AS parts,
    ('0x' || substr(md5(key), 1, 8))::BIGINT AS h
  FROM author_pairs p JOIN sized s ON p.author = s.author)"""


@query(
    with_(AUTHORS, _AUTHOR_PARTS)
    + """SELECT author, CASE WHEN parts = 1 THEN 0 ELSE h % parts END AS part, parts, string_agg(key, '|' ORDER BY key) AS papers
    FROM parted GROUP BY ALL"""
)
def author_index(spark, d):
    """Lists of at most about 500 papers; authors with more come in several parts."""
    index = authors.author_index(views.author_lists(spark, d), part_size=500)
    return index.select("author", "part", "parts", joined("papers").alias("papers"))


@query(
    with_(AUTHORS)
    + """SELECT count(DISTINCT author) AS authors, count(*) AS pairs, round(count(*) / count(DISTINCT author)::DOUBLE, 6) AS mean_papers
    FROM author_pairs WHERE author <> ''"""
)
def author_stats(spark, d):
    stats = authors.author_stats(views.author_lists(spark, d))
    return stats.withColumn("mean_papers", six("mean_papers"))


@query(with_(EDGES) + "SELECT id, direction, other, count(*) AS n FROM touching GROUP BY ALL")
def edges_touching(spark, d):
    touching = extract.edges_touching(views.edges(spark, d), views.cited_pubs(spark, d))
    return touching.groupBy("id", "direction", "other").agg(F.count(F.lit(1)).alias("n"))


_CITED_PARTS = """
sized AS (SELECT id, count(*) AS n FROM touching GROUP BY id),
lists AS (
  SELECT t.id, CASE WHEN n > 100 THEN ceil(n / 100.0)::BIGINT ELSE 1 END AS parts,
    CASE WHEN n > 100 THEN ('0x' || substr(md5(other), 1, 8))::BIGINT % ceil(n / 100.0)::BIGINT ELSE 0 END AS part,
    direction, other
  FROM touching t JOIN sized s ON t.id = s.id),
citation_lists AS (
  SELECT id, part, parts, coalesce(string_agg(CASE WHEN direction = 'outgoing' THEN other END, '|' ORDER BY other), '') AS outgoing,
    coalesce(string_agg(CASE WHEN direction = 'incoming' THEN other END, '|' ORDER BY other), '') AS incoming
  FROM lists GROUP BY id, part, parts)"""


@query(with_(EDGES, _CITED_PARTS) + "SELECT * FROM citation_lists")
def citation_lists(spark, d):
    touching = extract.edges_touching(views.edges(spark, d), views.cited_pubs(spark, d))
    lists = extract.citation_lists(touching, part_size=100)
    return lists.select(
        "id", "part", "parts", joined("outgoing_citations").alias("outgoing"), joined("incoming_citations").alias("incoming")
    )


@query(
    with_(EDGES, _CITED_PARTS)
    + """SELECT p.id, title, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts, coalesce(outgoing, '') AS outgoing,
      coalesce(incoming, '') AS incoming FROM cited_pubs p LEFT JOIN citation_lists l ON p.id = l.id"""
)
def merge_citations(spark, d):
    pubs = views.cited_pubs(spark, d)
    lists = extract.citation_lists(extract.edges_touching(views.edges(spark, d), pubs), part_size=100)
    return extract.merge_citations(pubs, lists).select(
        "id", "title", F.col("part").cast("bigint").alias("part"), F.col("parts").cast("bigint").alias("parts"),
        joined("outgoing_citations").alias("outgoing"), joined("incoming_citations").alias("incoming"),
    )


@query(
    with_(EDGES)
    + """SELECT id, count(*) FILTER (direction = 'outgoing') AS outgoing, count(*) FILTER (direction = 'incoming') AS incoming
    FROM touching GROUP BY id"""
)
def citation_counts(spark, d):
    return extract.citation_counts(
        extract.edges_touching(views.edges(spark, d), views.cited_pubs(spark, d))
    )


@query(
    with_(EDGES)
    + "SELECT count(DISTINCT id) AS with_citations, (SELECT count(*) FROM cited_pubs) AS publications FROM touching"
)
def pubs_with_citations(spark, d):
    pubs = views.cited_pubs(spark, d)
    return extract.pubs_with_citations(pubs, extract.edges_touching(views.edges(spark, d), pubs))


_SHORTENED = " || ".join(
    f"substr('{SHORT_ID_ALPHABET}', ((h // {62**i}) % 62 + 1)::INTEGER, 1)"
    for i in range(8)
)
_PUB_IDS = f"""
pub_ids AS (
  SELECT id, title, {_SHORTENED} AS short_id FROM (SELECT id, title, ('0x' || substr(md5(id), 1, 12))::BIGINT AS h FROM cited_pubs))"""


@query(with_(EDGES, _PUB_IDS) + "SELECT short_id AS id, title FROM pub_ids")
def short_id_join(spark, d):
    pubs = views.cited_pubs(spark, d)
    return extract.with_short_ids(pubs, extract.short_ids(pubs)).select("id", "title")


@query(
    with_(EDGES, _PUB_IDS)
    + """SELECT t.id, direction, coalesce(p.short_id, other) AS other, count(*) AS n
    FROM touching t LEFT JOIN pub_ids p ON other = p.id GROUP BY ALL"""
)
def remap_citation(spark, d):
    pubs = views.cited_pubs(spark, d)
    touching = extract.edges_touching(views.edges(spark, d), pubs)
    remapped = extract.remap_citations(touching, extract.short_ids(pubs))
    return remapped.groupBy("id", "direction", "other").agg(F.count(F.lit(1)).alias("n"))


_STATS = """
stats AS (
  SELECT source, count(*) AS rows, count(*) FILTER (n > 0) AS matches, sum(n)::BIGINT AS authors FROM (
    SELECT source, CASE WHEN contains(venue, '1588-2861') OR contains(venue, '0138-9130') OR contains(lower(venue), 'scientometrics')
      THEN len(list_filter(string_split(author, ';'), lambda p: regexp_matches(p, 'orcid:[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]')))
      ELSE 0 END AS n FROM papers)
  GROUP BY source)"""


@query(with_(PAPERS, _STATS) + "SELECT * FROM stats")
def scan_stats(spark, d):
    return extract.scan_stats(views.papers(spark, d), "source")


@query(
    with_(PAPERS, _STATS)
    + """SELECT count(*) AS sources, sum(rows)::BIGINT AS rows, sum(matches)::BIGINT AS matches, sum(authors)::BIGINT AS authors,
      min(CASE WHEN matches > 0 THEN source END) AS first_source FROM stats"""
)
def first_match(spark, d):
    return extract.first_match(extract.scan_stats(views.papers(spark, d), "source"), "source")


# Samples and sets ----------------------------------------------------------------------


@query(
    with_(ENTRIES)
    + """SELECT key, CASE WHEN row_number() OVER (ORDER BY md5('42:' || key), key) <= 300 THEN 'train' ELSE 'validation' END AS split
    FROM entries"""
)
def seeded_split(spark, d):
    return sampling.seeded_split(views.entries(spark, d)).select("key", "split")


@query(with_(ENTRIES) + "SELECT key, doi FROM entries ORDER BY key LIMIT 50")
def limit_keys(spark, d):
    return sampling.limit_keys(views.entries(spark, d), n=50)


@query(
    with_(ENTRIES)
    + "SELECT key, CASE WHEN row_number() OVER (ORDER BY key) <= 100 THEN 'pilot' ELSE 'rest' END AS batch FROM entries"
)
def pilot_then_rest(spark, d):
    return sampling.pilot_then_rest(views.entries(spark, d)).select("key", "batch")


@query(with_(ENTRIES) + "SELECT key, doi FROM entries")
def combine_batches(spark, d):
    batched = sampling.pilot_then_rest(views.entries(spark, d))
    pilot, rest = batched.where("batch = 'pilot'"), batched.where("batch = 'rest'")
    return pilot.unionByName(rest).select("key", "doi")


@query(
    with_(PAGES)
    + """SELECT key, title, NULL AS doi, 'no title' AS reason FROM publications WHERE title = ''
    UNION ALL SELECT key, NULL, doi, NULL FROM gold"""
)
def combine_with_missing_columns(spark, d):
    untitled = views.publications(spark, d).where("title = ''").select(
        "key", "title", F.lit("no title").alias("reason")
    )
    return untitled.unionByName(
        views.gold(spark, d).select("key", "doi"), allowMissingColumns=True
    ).select("key", "title", "doi", "reason")


_REPLAYED = f"""
known AS (SELECT doi FROM metadata),
retries AS (SELECT doi FROM latest WHERE {retryable_sql('error_type')}),
merged AS (
  SELECT l.doi, CASE WHEN r.doi IS NULL THEN exists_flag ELSE k.doi IS NOT NULL END AS found,
    CASE WHEN r.doi IS NULL THEN error_type END AS error_type
  FROM latest l LEFT JOIN retries r ON l.doi = r.doi LEFT JOIN known k ON r.doi = k.doi)"""


@query(
    with_(PAPERS, METADATA, LOOKUPS, _REPLAYED) + "SELECT doi, found, error_type FROM merged"
)
def replay_retries(spark, d):
    latest = lookup.latest_lookup(_plain_lookups(spark, d))
    retries = latest.where(is_retryable(F.col("error_type")))
    known = views.metadata(spark, d).select("doi")
    merged, _ = lookup.replay_retries(retries, known, latest, _now())
    return merged.select("doi", F.col("exists").alias("found"), "error_type")


# Composite jobs ------------------------------------------------------------------------


@query(
    with_(PAGES)
    + f"""SELECT key, coalesce({doi_sql('doi')} IN (SELECT lower(doi) FROM registry), false) AS on_registry, false AS lookup_error,
      CASE WHEN row_number() OVER (ORDER BY md5('42:' || key), key) <= 100 THEN 'train' ELSE 'validation' END AS split FROM gold"""
)
def prepare_gold(spark, d):
    gold = jobs.prepare_gold(views.gold(spark, d), views.registry(spark, d), n=100)
    return gold.select("key", "on_registry", "lookup_error", "split")


# Some lookups of the metadata fail; remainders only vary the answers.
_FAILURE = """CASE WHEN cast(substr(doi, 9) AS bigint) % 7 = 0 THEN 'Timeout'
      WHEN cast(substr(doi, 9) AS bigint) % 11 = 0 THEN 'HTTP_404' END"""

_ENRICHED = f"""
clean AS (SELECT key, {doi_sql('doi', True)} AS doi FROM entries WHERE {doi_sql('doi', True)} IS NOT NULL),
settled AS (SELECT doi, exists_flag, error_type FROM latest WHERE NOT {retryable_sql('error_type')}),
results AS (
  SELECT key, c.doi, CASE WHEN CASE WHEN s.doi IS NULL THEN m.doi IS NOT NULL AND failure IS NULL ELSE exists_flag END
      THEN 'found' ELSE 'not found' END AS status,
    CASE WHEN s.doi IS NULL THEN failure ELSE s.error_type END AS error_type
  FROM clean c LEFT JOIN settled s ON c.doi = s.doi
  LEFT JOIN (SELECT doi, {_FAILURE} AS failure FROM metadata) m ON c.doi = m.doi)"""


def _enriched(spark, d):
    entries = readers.key_doi_rows(views.entries(spark, d))
    metadata = views.metadata(spark, d).withColumn("error_type", F.expr(_FAILURE))
    return jobs.enrich(entries, _plain_lookups(spark, d), metadata, _now())


@query(with_(PAPERS, METADATA, ENTRIES, LOOKUPS, _ENRICHED) + "SELECT key, doi, status, error_type FROM results")
def enrich_entries(spark, d):
    return _enriched(spark, d).results.select("key", "doi", "status", "error_type")


@query(
    with_(PAPERS, METADATA, ENTRIES, LOOKUPS, _ENRICHED)
    + f"""SELECT count(*) AS total, count(*) FILTER (status = 'found') AS success, count(*) FILTER (status <> 'found') AS failure,
      round(count(*) FILTER (status = 'found') / count(*)::DOUBLE, 6) AS success_ratio,
      count(*) FILTER (status <> 'found' AND {retryable_sql('error_type')}) AS retry_candidates FROM results"""
)
def run_summary(spark, d):
    return _enriched(spark, d).summary.drop("success_percentage")


_CONVERTED = rf"""
tokens AS (SELECT doi, unnest({words('title')}) AS w, generate_subscripts({words('title')}, 1) AS n FROM metadata),
firsts AS (
  SELECT doi, w, min(n) AS n FROM tokens WHERE regexp_matches(w, '^[a-z]+$') AND length(w) > 3 AND w NOT IN ({quoted(ENRICHED_STOP_WORDS)}) GROUP BY doi, w),
listed AS (
  SELECT doi, string_agg(w, '|' ORDER BY n) AS keywords FROM
    (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY n) AS r FROM firsts) WHERE r <= {MAX_KEYWORDS} GROUP BY doi),
converted AS (
  SELECT m.doi, title, coalesce(keywords, '') AS keywords, source_title AS venue,
    try_cast(nullif(regexp_extract(year, '(?:^|[^\p{{L}}\p{{N}}_])((?:19|20)[0-9]{{2}})(?:[^\p{{L}}\p{{N}}_]|$)', 1), '') AS INTEGER) AS year
  FROM metadata m LEFT JOIN listed l ON m.doi = l.doi)"""


@query(
    with_(PAPERS, METADATA, _CONVERTED)
    + "SELECT doi, title, '' AS abstract, keywords, venue, year FROM converted"
)
def convert_record(spark, d):
    return enrich.convert_metadata(views.metadata(spark, d)).select(
        "doi", "title", "abstract", joined("keywords").alias("keywords"), "venue", "year"
    )


@query(
    with_(PAPERS, METADATA, ENTRIES, LOOKUPS, _ENRICHED, _CONVERTED)
    + """SELECT r.key AS id, r.key, r.doi, c.keywords, c.venue, c.year, length(c.title) AS title_length
    FROM results r JOIN converted c ON r.doi = c.doi WHERE status = 'found'"""
)
def enrich_converted(spark, d):
    return _enriched(spark, d).converted.select(
        "id", "key", "doi", joined("keywords").alias("keywords"), "venue", "year",
        F.length("title").cast("bigint").alias("title_length"),
    )


_COMMUNITY = (
    with_(
        PAPERS, DUMP,
        f"""
journal AS (
  SELECT split_part(trim(id), ' ', 1) AS id, title, venue, list_filter(string_split(author, ';'),
      lambda p: regexp_matches(p, 'orcid:[0-9]{{4}}-[0-9]{{4}}-[0-9]{{4}}-[0-9]{{3}}[0-9X]')) AS people,
    CASE WHEN regexp_matches(substr(pub_date, 1, 4), '^[0-9]+$') THEN substr(pub_date, 1, 4)::INTEGER END AS year
  FROM (SELECT *, split_part(trim(id), ' ', 1) AS first_id FROM dump_rows)
  WHERE (contains(venue, '1588-2861') OR contains(venue, '0138-9130') OR contains(lower(venue), 'scientometrics'))
    AND regexp_matches(author, 'orcid:[0-9]{{4}}-[0-9]{{4}}-[0-9]{{4}}-[0-9]{{3}}[0-9X]')
  QUALIFY row_number() OVER (PARTITION BY first_id ORDER BY source DESC, line_no DESC) = 1),
edges AS (SELECT 'omid:br/06' || l_suppkey AS citing, 'omid:br/06' || l_partkey AS cited FROM lineitem),
shortened AS (SELECT *, ('0x' || substr(md5(id), 1, 12))::BIGINT AS h FROM journal WHERE len(people) > 0),
touching AS (
  SELECT citing AS id, 'outgoing' AS direction, cited AS other FROM edges
  UNION ALL SELECT cited, 'incoming', citing FROM edges),
parted AS (
  SELECT t.id, direction, other, greatest(ceil(n / 5.0), 1)::BIGINT AS parts,
    CASE WHEN n > 5 THEN ('0x' || substr(md5(other), 1, 8))::BIGINT % ceil(n / 5.0)::BIGINT ELSE 0 END AS part
  FROM touching t JOIN (SELECT id, count(*) AS n FROM touching GROUP BY id) k ON t.id = k.id),
cites AS (
  SELECT id, part, parts, coalesce(string_agg(CASE WHEN direction = 'outgoing' THEN other END, '|' ORDER BY other), '') AS outgoing,
    coalesce(string_agg(CASE WHEN direction = 'incoming' THEN other END, '|' ORDER BY other), '') AS incoming
  FROM parted GROUP BY id, part, parts)""",
    )
    + f"""SELECT {_SHORTENED} AS id, title, venue, year, len(people) AS authors, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts,
      coalesce(outgoing, '') AS outgoing, coalesce(incoming, '') AS incoming
    FROM shortened s LEFT JOIN cites c ON s.id = c.id"""
)


def _dump_edges(spark, d):
    return views.table(spark, d, "lineitem").selectExpr(
        "concat('omid:br/06', l_suppkey) AS citing", "concat('omid:br/06', l_partkey) AS cited"
    )


@query(_COMMUNITY)
def extract_community(spark, d):
    rows = dump.parse_wrapped(views.dump_lines(spark, d), "source", "line_no")
    out = jobs.extract_community(rows, _dump_edges(spark, d), F.struct("source", "line_no"), part_size=5)
    return _community(out)


@query(_COMMUNITY)
def extract_arrivals(spark, d):
    """From dump files to written publications, sources and edges arriving in two lots."""
    path = scratch(spark, "arrivals")
    documents, edges = views.documents(spark, d), _dump_edges(spark, d)
    early_source, early_edge = F.pmod(F.crc32("source"), F.lit(2)) == 0, F.pmod(F.crc32("cited"), F.lit(2)) == 0
    for wanted_source, wanted_edge in ((early_source, early_edge), (~early_source, ~early_edge)):
        lines = views.dump_files(documents.where(wanted_source))
        with shuffles_go(spark):
            lines.write.mode("append").partitionBy("source", "piece").text(f"{path}/dump", compression="gzip")
        edges.where(wanted_edge).write.mode("append").csv(f"{path}/edges", header=True, compression="gzip")
        extraction.extract_arrivals(spark, f"{path}/dump", f"{path}/edges", f"{path}/tables", f"{path}/out", part_size=5)
    return _community(
        spark.read.schema(
            "id string, title string, venue string, year int, authors array<struct<name: string>>, part bigint, parts bigint, "
            "outgoing_citations array<string>, incoming_citations array<string>"
        ).json(f"{path}/out/publications")
    )


def _community(out: DataFrame) -> DataFrame:
    return out.select(
        "id", "title", "venue", "year", F.size("authors").cast("bigint").alias("authors"), "part", "parts",
        joined("outgoing_citations").alias("outgoing"), joined("incoming_citations").alias("incoming"),
    )


# Sources and sinks, each written to the shared folder and read back ---------------------


@query(with_(PAGES) + """SELECT key AS "Key", trim(title) AS title, trim(coalesce(doi, '')) AS "DOI", venue AS "Cinese_title"
    FROM (SELECT g.*, r.host AS venue FROM gold g JOIN page_records r ON g.key = r.key)""")
def read_gold(spark, d):
    hosts = views.page_records(spark, d).select("key", "host")
    path = scratch(spark, "gold")
    rows = views.gold(spark, d).join(hosts, "key").select(
        F.col("key").alias(" Key"), F.col("title"), F.col("doi").alias("DOI "),
        F.concat(F.lit(" "), "host", F.lit(" ")).alias("Cinese_title"), F.lit("").alias(" "),
    )
    rows.write.csv(path, sep=";", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_gold(spark, path)


@query(
    with_(PAGES)
    + """SELECT key, title, coalesce(doi, '') AS doi, secure AS on_registry FROM (
      SELECT g.*, r.secure FROM gold g JOIN page_records r ON g.key = r.key)"""
)
def read_labelled(spark, d):
    flags = views.page_records(spark, d).select(
        "key", F.when(F.col("secure"), "TRUE").when(F.col("host").startswith("m."), "Errore API").otherwise("False").alias("ID_on_Crossref")
    )
    path = scratch(spark, "labelled")
    views.gold(spark, d).join(flags, "key").select(
        F.col("key").alias("KEY"), F.col("title").alias("Title"), F.col("doi").alias("DOI"), "ID_on_Crossref"
    ).write.csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="",
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_labelled(spark, path)


@query(with_(PAPERS) + "SELECT key, title, source AS venue, nullif(pub_date, '') AS year FROM papers")
def read_keyed_json(spark, d):
    """One JSON object per source of the documents, then JSON lines of the same records."""
    record = F.to_json(F.struct("title", F.col("source").alias("venue"), F.expr("nullif(pub_date, '')").alias("year")))
    keyed = views.papers(spark, d).select(
        F.concat(F.lit('{"'), "key", F.lit('":'), record, F.lit("}")).alias("value")
    )
    rows = readers.explode_keyed(keyed, "value")
    path = scratch(spark, "keyed")
    rows.write.json(path)
    return readers.read_keyed_lines(spark, path).select("key", "title", "venue", "year")


@query(with_(EDGES) + "SELECT citing, cited, count(*) AS n FROM edges GROUP BY ALL")
def read_citation_edges(spark, d):
    path = scratch(spark, "edges")
    views.edges(spark, d).write.csv(path, header=True)
    return readers.read_citation_edges(spark, path).groupBy("citing", "cited").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_(PAGES)
    + """SELECT doi, CASE WHEN page_id % 5 = 0 THEN 0 ELSE page_id / 2.0::DOUBLE END AS score,
      CASE WHEN page_id % 7 = 0 THEN '' ELSE full_title END AS title, CASE WHEN page_id % 4 <> 0 THEN year END AS year,
      CASE WHEN page_id % 6 = 0 THEN 'fr' ELSE 'gi fa' END AS authors,
      CASE WHEN page_id % 9 = 0 THEN 'Press' ELSE host END AS venue FROM page_records"""
)
def flatten_registry_item(spark, d):
    item = r"""to_json(named_struct('DOI', doi,
        'score', CASE WHEN page_id % 5 = 0 THEN NULL ELSE cast(page_id as double) / 2 END,
        'title', CASE WHEN page_id % 7 = 0 THEN array() ELSE array(full_title, 'other') END,
        'published', CASE WHEN page_id % 4 = 0 THEN NULL ELSE named_struct('date-parts', array(array(year, 1))) END,
        'author', CASE WHEN page_id % 6 = 0 THEN array(named_struct('given', NULL, 'family', 'fr'), named_struct('given', NULL, 'family', NULL))
                  ELSE array(named_struct('given', 'gi', 'family', 'fa')) END,
        'container-title', CASE WHEN page_id % 9 = 0 THEN array() ELSE array(host) END,
        'publisher', 'Press')) AS value"""
    flat = registry.parse_registry_items(views.page_records(spark, d).selectExpr(item))
    return flat.withColumn("authors", joined("authors"))


@query(with_(PAPERS, METADATA) + "SELECT substr(doi, 9) AS key, doi, title, author, year, source_title FROM metadata")
def flatten_enrichment_record(spark, d):
    nested = views.metadata(spark, d).select(
        F.substring("doi", 9, 100).alias("key"), "doi", F.array(F.struct("title", "author", "year", "source_title")).alias("metadata")
    )
    empty = nested.withColumn("metadata", F.slice("metadata", 1, 0))
    return registry.flatten_enrichment_record(nested.unionByName(empty))


@query(with_(LOOKUPS) + "SELECT doi, exists_flag AS found, error_type, ts FROM latest")
def upsert_lookup(spark, d):
    """Answers merged in two runs, read back from the newest version."""
    path = scratch(spark, "lookups")
    rows = _plain_lookups(spark, d)
    early = rows.agg(F.percentile_approx("ts", 0.5)).scalar()
    first = F.col("ts") < early
    lookup_store.upsert_lookup(spark, path, rows.where(first))
    lookup_store.upsert_lookup(spark, path, rows.where(~first))
    return lookup_store.load_lookup(spark, path).select("doi", F.col("exists").alias("found"), "error_type", "ts")


@query(
    with_(LOOKUPS)
    + "SELECT 'first' AS version, doi, exists_flag AS found, error_type FROM lookups WHERE exists_flag UNION ALL "
    "SELECT 'newest', doi, exists_flag, error_type FROM lookups"
)
def load_lookup(spark, d):
    """Each version holds what was merged up to it; before the first, the table is empty."""
    path = scratch(spark, "versions")
    rows = _plain_lookups(spark, d)
    before = lookup_store.load_lookup(spark, path)
    rows.where("exists").write.parquet(f"{path}/version=1")
    first = lookup_store.load_lookup(spark, path)
    rows.write.parquet(f"{path}/version=2")
    newest = lookup_store.load_lookup(spark, path)
    shown = [F.col("doi"), F.col("exists").alias("found"), "error_type"]
    out = before.select(F.lit("none").alias("version"), *shown)
    for name, version in (("first", first), ("newest", newest)):
        out = out.unionByName(version.select(F.lit(name).alias("version"), *shown))
    return out


@query(
    with_(PAGES)
    + f"""SELECT key, CASE WHEN coalesce({doi_sql('doi')} IN (SELECT lower(doi) FROM registry), false) THEN 'True' ELSE 'False' END AS flag,
      CASE WHEN row_number() OVER (ORDER BY md5('42:' || key), key) <= 100 THEN 'training_set' ELSE 'validation_set' END AS folder
    FROM gold"""
)
def write_split(spark, d):
    path = scratch(spark, "split")
    writers.write_split(jobs.prepare_gold(views.gold(spark, d), views.registry(spark, d), n=100), path)

    def read(folder):
        rows = spark.read.csv(f"{path}/{folder}", header=True, quote='"', escape='"', multiLine=True)
        return rows.select("key", F.col("ID_on_Crossref").alias("flag"), F.lit(folder).alias("folder"))

    return read("training_set").unionByName(read("validation_set"))


@query(
    with_(PAGES)
    + """SELECT CASE WHEN title = '' OR a_doi IS NULL THEN 'rejected' ELSE 'validated' END AS folder, key
    FROM (SELECT p.key, p.title, a.doi AS a_doi FROM publications p LEFT JOIN answers a ON p.title = a.title AND p.year IS NOT DISTINCT FROM a.year)"""
)
def write_outcomes(spark, d):
    path = scratch(spark, "outcomes")
    cached = lookup.lookup_join(views.publications(spark, d), views.answers(spark, d)).drop("error")
    rows = bulk.bulk_outcomes(cached.withColumn("is_valid_match", F.col("registry_doi").isNotNull()), F.lit(0.0))
    writers.write_outcomes(rows, path)
    read = [
        spark.read.csv(f"{path}/{s}", header=True, quote='"', escape='"', multiLine=True).select(F.lit(s).alias("folder"), "key")
        for s in ("validated", "rejected")
    ]
    return read[0].unionByName(read[1])


@query(
    with_(SCORED, SWEEP)
    + "SELECT cutoff, tp, fp, tn, fn, round(accuracy, 6) AS accuracy FROM sweep"
)
def write_cutoff_table(spark, d):
    path = scratch(spark, "cutoffs")
    writers.write_cutoff_table(evaluate.cutoff_sweep(views.scored(spark, d)), path)
    table = spark.read.csv(
        f"{path}/cutoff_analysis", header=True,
        schema="cutoff double, tp bigint, fp bigint, tn bigint, fn bigint, accuracy double, precision double, recall double, f1 double",
    )
    return table.select("cutoff", "tp", "fp", "tn", "fn", six("accuracy").alias("accuracy"))


@query(
    with_(SCORED, SWEEP)
    + "SELECT key, score FROM scored WHERE score >= (SELECT cutoff FROM best_cut) AND NOT is_correct AND on_registry"
)
def write_wrong_matches(spark, d):
    path = scratch(spark, "wrong")
    scored = views.scored(spark, d)
    cutoff = evaluate.best_cutoff(evaluate.cutoff_sweep(scored)).select("cutoff").scalar()
    writers.write_wrong_matches(evaluate.wrong_matches(scored, cutoff), path)
    return spark.read.csv(f"{path}/wrong_matches", header=True).select("key", F.col("score").cast("double").alias("score"))


@query(
    with_(PAPERS, METADATA, ENTRIES, LOOKUPS, _ENRICHED)
    + f"""SELECT 'found' AS output, key, doi FROM results WHERE status = 'found'
    UNION ALL SELECT 'not_found', key, doi FROM results WHERE status <> 'found'
    UNION ALL SELECT 'retry', key, doi FROM results WHERE status <> 'found' AND {retryable_sql('error_type')}
    UNION ALL SELECT 'converted', key, r.doi FROM results r JOIN metadata m ON r.doi = m.doi WHERE status = 'found'"""
)
def write_run_outputs(spark, d):
    path = scratch(spark, "run")
    run = _enriched(spark, d)
    results = materialize(run.results, "results")
    writers.write_run_outputs(results, run.converted, enrich.run_summary(results), path)
    first, *others = (
        spark.read.schema("key string, doi string").json(f"{path}/{o}").select(F.lit(o).alias("output"), "key", "doi")
        for o in ("found", "not_found", "retry", "converted")
    )
    return functools.reduce(DataFrame.unionByName, others, first)


# Lookups of some papers break off: what was raised, by the key of the paper.
_RAISED = "CASE WHEN right(doi, 1) = '3' THEN 'ReadTimeout: no answer' WHEN right(doi, 1) = '4' THEN 'KeyError: title' END"


@query(
    with_(
        PAPERS, METADATA, ENTRIES, LOOKUPS,
        f"""
clean AS (SELECT key, {doi_sql('doi', True)} AS doi FROM entries WHERE {doi_sql('doi', True)} IS NOT NULL),
settled AS (SELECT doi, exists_flag, error_type FROM latest WHERE NOT {retryable_sql('error_type')}),
results AS (
  SELECT key, c.doi, CASE WHEN s.doi IS NOT NULL THEN CASE WHEN exists_flag THEN 'found' ELSE 'not found' END
      WHEN raised IS NOT NULL THEN 'error' WHEN m.doi IS NOT NULL THEN 'found' ELSE 'not found' END AS status,
    CASE WHEN s.doi IS NOT NULL THEN s.error_type ELSE raised END AS error_type
  FROM clean c LEFT JOIN settled s ON c.doi = s.doi
  LEFT JOIN (SELECT doi, {_RAISED} AS raised FROM metadata) m ON c.doi = m.doi)""",
    )
    + f"""SELECT key, doi, status, error_type, {retryable_sql('error_type')} AS retryable,
      count(*) OVER () AS total_results, 1893456000000000 AS timestamp_micros,
      (SELECT count(DISTINCT key) FROM results r JOIN metadata m ON r.doi = m.doi WHERE r.status = 'found') AS converted_papers,
      count(*) FILTER (status <> 'found') OVER () AS failure FROM results"""
)
def enrich_failures(spark, d):
    """Entries of a run in which lookups break off, beside the written report of the run."""
    path = scratch(spark, "failures")
    entries = readers.key_doi_rows(views.entries(spark, d))
    metadata = views.metadata(spark, d).withColumn("failure", F.expr(_RAISED))
    run = jobs.enrich(entries, _plain_lookups(spark, d), metadata, _now())
    writers.write_run_outputs(run.results, run.converted, run.summary, path, _now())
    report = spark.read.schema(
        "total_results bigint, timestamp_micros bigint, converted_papers bigint, summary struct<failure: bigint>"
    ).json(f"{path}/summary")
    figures = report.select("total_results", "timestamp_micros", "converted_papers", "summary.failure")
    return run.results.select("key", "doi", "status", "error_type", "retryable").crossJoin(F.broadcast(figures))


@query(
    with_(PAPERS, METADATA, ENTRIES, LOOKUPS, _ENRICHED)
    + f"""SELECT r.key, r.doi,
      CASE WHEN m.doi IS NOT NULL THEN 'found' ELSE 'not found' END AS status
    FROM results r LEFT JOIN metadata m ON r.doi = m.doi WHERE r.status <> 'found' AND {retryable_sql('r.error_type')}"""
)
def enrich_retries(spark, d):
    """The retry set of one run, asked again in the next, when the metadata has recovered."""
    first = _enriched(spark, d)
    retries = first.results.where("retryable").select("key", "doi")
    known = lookup.merge_lookups(lookup.latest_lookup(_plain_lookups(spark, d)), first.fresh)
    again = jobs.enrich(retries.where("false"), known, views.metadata(spark, d), _now(), retries)
    return again.results.select("key", "doi", "status")


@query(
    with_(AUTHORS, _AUTHOR_PARTS)
    + """SELECT author, CASE WHEN parts = 1 THEN 0 ELSE h % parts END AS part, parts, string_agg(key, '|' ORDER BY key) AS papers
    FROM parted GROUP BY ALL"""
)
def write_author_index(spark, d):
    path = scratch(spark, "authors")
    writers.write_author_index(authors.author_index(views.author_lists(spark, d), part_size=500), path)
    written = spark.read.schema("author string, part bigint, parts bigint, papers array<string>").json(f"{path}/authors")
    return written.select("author", "part", "parts", joined("papers").alias("papers"))
