"""Queries on single fields: DOIs, years, titles, authors, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.functions import dates, errors, identifiers, matching, names, titles
from citeweave.functions.fixed_values import (
    AFFILIATION_WORDS,
    ENRICHED_STOP_WORDS,
    ERROR_NOT_CACHED,
    SHORT_ID_ALPHABET,
)
from citeweave.operators import extract, lookup
from citeweave.operators.extract import in_journal
from citeweave.plans import views
from citeweave.plans.registered import joined, query
from citeweave.plans.view_sql import (
    AUTHORS,
    DUMP,
    ENTRIES,
    LOOKUPS,
    PAGES,
    PAPERS,
    doi_sql,
    quoted,
    retryable_sql,
    whole_number,
    with_,
    words,
    year_sql,
)


@query(
    with_(PAGES)
    + rf"""SELECT key, {doi_sql('doi')} AS plain, {doi_sql('doi', trim_end=True)} AS trimmed,
      CASE WHEN doi IS NOT NULL AND doi NOT IN ('', 'None') THEN lower(regexp_replace(
        regexp_replace(doi, '\s+', '', 'g'), '^(?i:https?://doi\.org/|doi\.org/|doi:)', '')) END AS strict
    FROM gold"""
)
def normalize_doi(spark, d):
    doi = F.col("doi")
    return views.gold(spark, d).select(
        "key",
        identifiers.normalize_doi(doi).alias("plain"),
        identifiers.normalize_doi(doi, trim_end=True).alias("trimmed"),
        identifiers.normalize_doi(doi, strict_docs=True).alias("strict"),
    )


@query(with_(PAGES) + "SELECT key, replace(doi, 'https://doi.org/', '') AS cleaned FROM gold")
def clean_doi(spark, d):
    return views.gold(spark, d).select("key", identifiers.clean_doi(F.col("doi")).alias("cleaned"))


@query(with_(PAGES) + "SELECT key, doi FROM gold WHERE doi IS NOT NULL AND doi NOT IN ('', 'None')")
def valid_doi(spark, d):
    return views.gold(spark, d).where(identifiers.has_doi(F.col("doi"))).select("key", "doi")


@query(
    with_(PAGES)
    + f"""SELECT p.key, coalesce({whole_number('p.year')} <> 0 AND {whole_number('p.year')} = r.year, false) AS year_valid,
      CASE WHEN {whole_number('p.year')} <> 0 THEN abs({whole_number('p.year')} - r.year) END AS year_difference
    FROM publications p JOIN page_records r ON p.key = r.key"""
)
def year_valid(spark, d):
    recorded = views.page_records(spark, d).select("key", F.col("year").alias("cr_year"))
    both = F.col("year"), F.col("cr_year")
    return views.publications(spark, d).join(recorded, "key").select(
        "key",
        dates.year_valid(*both).alias("year_valid"),
        dates.year_difference(*both).alias("year_difference"),
    )


@query(with_(PAGES) + f"SELECT key, {year_sql('year')} AS lookup_year FROM publications")
def lookup_year(spark, d):
    return views.publications(spark, d).select(
        "key", dates.lookup_year(F.col("year")).alias("lookup_year")
    )


@query(
    with_(PAGES)
    + "SELECT title || '_' || coalesce(year, 'None') AS lookup_key, count(*) AS n FROM publications GROUP BY 1"
)
def lookup_key(spark, d):
    keyed = views.publications(spark, d).select(
        identifiers.lookup_key(F.col("title"), F.col("year")).alias("lookup_key")
    )
    return keyed.groupBy("lookup_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_(PAGES)
    + """SELECT g.key, CASE WHEN coalesce(p.title, '') = '' THEN g.title ELSE p.title END AS title
    FROM gold g LEFT JOIN publications p ON g.key = p.key"""
)
def coalesce_title(spark, d):
    meta = views.publications(spark, d).select("key", F.col("title").alias("meta"))
    return views.gold(spark, d).join(meta, "key", "left").select(
        "key", titles.coalesce_title(F.col("meta"), F.col("title")).alias("title")
    )


_GIVEN = "trim(CASE WHEN instr(p, ',') > 0 THEN substr(p, instr(p, ',') + 1) ELSE p END)"
_SURNAME = "CASE WHEN instr(p, ',') > 0 THEN trim(substr(p, 1, instr(p, ',') - 1)) ELSE '' END"


@query(
    with_(PAPERS)
    + rf"""SELECT key, array_to_string(list_filter(list_transform(list_filter(
        list_transform(string_split(author_plain, ';'), lambda p: trim(rtrim(trim(p), ','))),
        lambda p: p <> '' AND NOT regexp_matches(lower(p), '{"|".join(AFFILIATION_WORDS)}')
          AND NOT regexp_matches(p, '[0-9]{{4,}}') AND length(p) <= 50),
        lambda p: trim({_GIVEN} || ' ' || {_SURNAME})), lambda n: length(n) > 2), '|') AS names
    FROM papers"""
)
def parse_author_string(spark, d):
    parsed = names.parse_author_string(F.col("author_plain"))
    return views.papers(spark, d).select("key", joined(parsed["name"]).alias("names"))


@query(
    with_(PAPERS)
    + r"""SELECT key, array_to_string(list_transform(list_filter(
        list_transform(string_split(author, ';'), lambda p: trim(p)),
        lambda p: regexp_matches(p, 'orcid:[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]')),
        lambda p: trim(regexp_replace(p, '\[[^\]]+\]', '', 'g')) || '=' ||
          regexp_extract(p, 'orcid:([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])', 1)), '|') AS authors
    FROM papers"""
)
def parse_author_orcid(spark, d):
    parsed = F.transform(
        names.parse_author_orcid(F.col("author")), lambda a: F.concat_ws("=", a["name"], a["orcid"])
    )
    return views.papers(spark, d).select("key", joined(parsed).alias("authors"))


_STOP = f"[{quoted(ENRICHED_STOP_WORDS)}]"


@query(
    with_(
        PAPERS,
        rf"""
tokens AS (
  SELECT key, unnest({words('title')}) AS w, generate_subscripts({words('title')}, 1) AS n FROM papers),
firsts AS (
  SELECT key, w, min(n) AS n FROM tokens
  WHERE regexp_matches(w, '^[a-z]+$') AND length(w) > 3 AND NOT list_contains({_STOP}, w) GROUP BY key, w),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n) AS r FROM firsts),
listed AS (SELECT key, string_agg(w, '|' ORDER BY n) AS keywords FROM ranked WHERE r <= 15 GROUP BY key)""",
    )
    + "SELECT p.key, coalesce(keywords, '') AS keywords FROM papers p LEFT JOIN listed l ON p.key = l.key"
)
def keywords_distinct(spark, d):
    return views.papers(spark, d).select(
        "key", joined(titles.keywords_distinct(F.col("title"))).alias("keywords")
    )


@query(
    with_(PAPERS)
    + rf"""SELECT key, array_to_string(list_filter({words('title')}, lambda w: length(w) > 2 AND NOT list_contains(
      ['the','a','an','and','or','but','in','on','at','to','for','of','with','by','from'], w)), '|') AS keywords FROM papers"""
)
def keywords_all(spark, d):
    return views.papers(spark, d).select(
        "key", joined(titles.keywords_all(F.col("title"))).alias("keywords")
    )


@query(
    with_(PAPERS)
    + r"""SELECT key, try_cast(nullif(regexp_extract(pub_date, '(?:^|[^\p{L}\p{N}_])((?:19|20)[0-9]{2})(?:[^\p{L}\p{N}_]|$)', 1), '') AS INTEGER) AS from_date,
      try_cast(nullif(regexp_extract(title, '(?:^|[^\p{L}\p{N}_])((?:19|20)[0-9]{2})(?:[^\p{L}\p{N}_]|$)', 1), '') AS INTEGER) AS from_text
    FROM papers"""
)
def parse_year(spark, d):
    return views.papers(spark, d).select(
        "key",
        dates.parse_year(F.col("pub_date")).alias("from_date"),
        dates.parse_year(F.col("title")).alias("from_text"),
    )


@query(
    with_(PAPERS)
    + """SELECT key, CASE WHEN regexp_matches(substr(pub_date, 1, 4), '^[0-9]+$') THEN substr(pub_date, 1, 4)::INTEGER END AS year
    FROM papers"""
)
def year_prefix(spark, d):
    return views.papers(spark, d).select("key", dates.year_prefix(F.col("pub_date")).alias("year"))


@query(
    with_(PAPERS)
    + r"SELECT key, regexp_extract(id, '[^ ]+') AS from_id, regexp_extract(title, '[^ ]+') AS from_text FROM papers"
)
def first_token(spark, d):
    return views.papers(spark, d).select(
        "key",
        identifiers.first_token(F.col("id")).alias("from_id"),
        identifiers.first_token(F.col("title")).alias("from_text"),
    )


@query(with_(AUTHORS) + "SELECT DISTINCT name, author FROM author_pairs")
def normalize_author_name(spark, d):
    named = views.author_lists(spark, d).select(
        F.explode(names.named_authors(F.col("authors"))["name"]).alias("name")
    )
    return named.distinct().select("name", names.normalize_author_name(F.col("name")).alias("author"))


@query(with_(AUTHORS) + "SELECT key, count(*) AS named FROM author_pairs GROUP BY key")
def named_author(spark, d):
    listed = views.author_lists(spark, d).select(
        "key", F.size(names.named_authors(F.col("authors"))).cast("bigint").alias("named")
    )
    return listed.where("named > 0")


_SHORT = " || ".join(
    f"substr('{SHORT_ID_ALPHABET}', ((h // {62**i}) % 62 + 1)::INTEGER, 1)"
    for i in range(8)
)


@query(
    with_(PAPERS)
    + f"SELECT id, {_SHORT} AS short_id FROM (SELECT trim(id) AS id, ('0x' || substr(md5(trim(id)), 1, 12))::BIGINT AS h FROM papers)"
)
def short_id(spark, d):
    ids = views.papers(spark, d).select(F.trim("id").alias("id"))
    return ids.select("id", identifiers.short_id(F.col("id")).alias("short_id"))


@query(
    with_(
        """
ids AS (SELECT p_partkey::VARCHAR AS id FROM part UNION SELECT o_orderkey::VARCHAR FROM orders),
hashed AS (SELECT id, ('0x' || substr(md5(id), 1, 12))::BIGINT AS h FROM ids)"""
    )
    + f"SELECT id, {_SHORT} AS short_id FROM hashed"
)
def short_ids(spark, d):
    """Unique ids of many records; the SQL holds as long as no two ids collide."""
    parts = views.table(spark, d, "part").selectExpr("cast(p_partkey as string) AS id")
    orders = views.table(spark, d, "orders").selectExpr("cast(o_orderkey as string) AS id")
    return extract.short_ids(parts.unionByName(orders))


@query(with_(LOOKUPS) + f"""SELECT event_id, {retryable_sql('error_type')} AS by_text,
      coalesce(regexp_matches(error_type, 'Timeout|ConnectionError|HTTP_(429|500|502|503|504)'), false) AS with_http FROM lookups""")
def is_retryable(spark, d):
    error = F.col("error_type")
    return views.lookups(spark, d).select(
        "event_id",
        errors.is_retryable(error).alias("by_text"),
        errors.is_retryable(error, retry_http=True).alias("with_http"),
    )


@query(
    with_(PAPERS)
    + """SELECT key, venue FROM papers WHERE contains(venue, '1588-2861') OR contains(venue, '0138-9130')
      OR contains(lower(venue), 'scientometrics')"""
)
def venue_filter(spark, d):
    return views.papers(spark, d).where(in_journal(F.col("venue"))).select("key", "venue")


@query(
    with_(PAPERS)
    + "SELECT key FROM papers WHERE regexp_matches(author, 'orcid:[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]')"
)
def has_orcid_author(spark, d):
    authors = names.parse_author_orcid(F.col("author"))
    return views.papers(spark, d).where(F.size(authors) > 0).select("key")


@query(
    with_(PAPERS, DUMP)
    + "SELECT source, line_no, id, title, pub_date, venue, length(author) AS author_length FROM dump_rows"
)
def read_wrapped_dump(spark, d):
    from citeweave.sources.dump import parse_wrapped

    rows = parse_wrapped(views.dump_lines(spark, d), "source", "line_no")
    return rows.select(
        "source", "line_no", "id", "title", "pub_date", "venue", F.length("author").cast("bigint").alias("author_length")
    )


@query(
    with_(PAPERS, DUMP)
    + """SELECT d.source, count(*) AS body, count(r.line_no) AS kept FROM dump d
    LEFT JOIN dump_rows r ON d.source = r.source AND d.line_no = r.line_no WHERE d.line_no > 0 GROUP BY d.source"""
)
def short_row(spark, d):
    from citeweave.sources.dump import parse_wrapped

    lines = views.dump_lines(spark, d)
    kept = parse_wrapped(lines, "source", "line_no").groupBy("source").agg(F.count(F.lit(1)).alias("kept"))
    body = lines.where("line_no > 0").groupBy("source").agg(F.count(F.lit(1)).alias("body"))
    return body.join(kept, "source", "left").select("source", "body", F.coalesce("kept", F.lit(0)).alias("kept"))


@query(
    with_(PAPERS, LOOKUPS)
    + f"""SELECT doc_id, substr(doi, 1, 100) AS capped, array_to_string(({words('title')})[1:15], '|') AS words FROM papers
    JOIN (SELECT DISTINCT doi FROM lookups) ON doi = '10.1000/' || doc_id"""
)
def cap_lists(spark, d):
    asked = views.lookups(spark, d).select("doi").distinct()
    papers = views.papers(spark, d).withColumn("doi", F.concat(F.lit("10.1000/"), "key"))
    return papers.join(asked, "doi").select(
        "doc_id",
        F.substring("doi", 1, 100).alias("capped"),
        joined(F.slice(F.regexp_extract_all(F.lower("title"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), 1, 15)).alias("words"),
    )


@query(
    with_(PAGES)
    + """SELECT p.key, contains(lower(p.title), string_split(r.host, '.')[-1]) AS overlap
    FROM publications p JOIN page_records r ON p.key = r.key"""
)
def author_overlap(spark, d):
    """The switched-off author check; title words stand in for authors, hosts for names."""
    pages = views.page_records(spark, d).select(
        "key", F.array(F.replace("host", F.lit("."), F.lit(" "))).alias("theirs")
    )
    ours = views.publications(spark, d).select("key", F.split("title", " ").alias("ours"))
    return ours.join(pages, "key").select(
        "key", names.author_overlap(F.col("ours"), F.col("theirs")).alias("overlap")
    )


@query(
    with_(PAGES)
    + """SELECT key, CASE WHEN coalesce(title, '') = '' THEN 'no_title' WHEN score < 20 THEN 'low_score'
      WHEN doi IS NULL THEN 'invalid' END AS code
    FROM (SELECT p.key, p.title, a.title AS hit, a.doi, a.score FROM publications p
      LEFT JOIN answers a ON p.title = a.title AND p.year IS NOT DISTINCT FROM a.year)
    WHERE title = '' OR hit IS NOT NULL"""
)
def reject_reason(spark, d):
    answered = lookup.lookup_join(views.publications(spark, d), views.answers(spark, d))
    known = answered.where(F.coalesce(F.col("error") != ERROR_NOT_CACHED, F.lit(True)))
    return known.select(
        "key",
        matching.reject_code(
            F.col("title"), F.col("score"), F.lit(20.0), F.col("registry_doi").isNotNull()
        ).alias("code"),
    )


@query(
    with_(PAGES)
    + """SELECT p.key, a.doi AS accepted, CASE WHEN p.year IS NOT NULL THEN a.doi END AS accepted_valid
    FROM publications p JOIN answers a ON p.title = a.title AND p.year IS NOT DISTINCT FROM a.year WHERE a.score >= 20"""
)
def accept(spark, d):
    answered = lookup.lookup_join(views.publications(spark, d), views.answers(spark, d))
    taken = answered.where(matching.exceeds(F.col("score"), F.lit(20.0)))
    return taken.select(
        "key",
        matching.accepted_doi(F.col("registry_doi"), F.col("score"), F.lit(20.0)).alias("accepted"),
        matching.accepted_doi(
            F.col("registry_doi"), F.col("score"), F.lit(20.0), F.col("year").isNotNull()
        ).alias("accepted_valid"),
    )


@query(
    with_(PAGES)
    + f"""SELECT g.key,
      coalesce({doi_sql('g.doi')} = {doi_sql('a.doi')}, false) AS tuning,
      a.doi IS NOT NULL AND {doi_sql('g.doi')} IS NOT DISTINCT FROM {doi_sql('a.doi')} AS holdout,
      {doi_sql('g.doi')} IS NOT DISTINCT FROM {doi_sql('a.doi')} AND a.secure AS direct
    FROM gold g JOIN (SELECT key, secure, CASE WHEN secure THEN upper(doi) END AS doi FROM page_records) a ON g.key = a.key"""
)
def is_correct(spark, d):
    """The three DOI comparisons against the record's own registry entry."""
    own = views.page_records(spark, d).select(
        "key", "secure", F.when(F.col("secure"), F.upper("doi")).alias("registry_doi")
    )
    pair = F.col("doi"), F.col("registry_doi")
    return views.gold(spark, d).join(own, "key").select(
        "key",
        matching.is_correct_for_tuning(*pair).alias("tuning"),
        matching.is_correct_for_holdout(*pair).alias("holdout"),
        matching.is_correct_direct(*pair, F.col("secure")).alias("direct"),
    )


@query(
    with_(ENTRIES)
    + f"SELECT key, {doi_sql('doi', trim_end=True)} AS doi FROM entries WHERE {doi_sql('doi', trim_end=True)} IS NOT NULL"
)
def read_key_doi(spark, d):
    """Entries written as CSV and read back by the reader of accepted matches."""
    from citeweave.plans.table_queries import scratch
    from citeweave.sources.readers import read_key_doi as read

    path = scratch(spark, "key-doi")
    views.entries(spark, d).select("key", "doi").write.csv(path, header=True)
    return read(spark, path)
