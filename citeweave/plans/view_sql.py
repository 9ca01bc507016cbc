"""The views of ``views`` stated as SQL common table expressions, and SQL snippets."""

from __future__ import annotations

PAGES = r"""
page_records AS (
  SELECT page_id, page_id::VARCHAR AS key,
    trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[ \t\r\n]+', ' ', 'g')) AS full_title,
    (2015 + regexp_extract(url, '/([0-9]+)', 1)::INTEGER % 6)::INTEGER AS year,
    '10.' || (1000 + page_id % 50) || '/Doc.' || page_id AS doi,
    regexp_extract(url, '^https?://([^/]*)', 1) AS host,
    url LIKE 'https://%' AS secure, url
  FROM pages),
registry AS (
  SELECT doi, full_title AS title, year, string_split(host, '.') AS authors, host AS venue
  FROM page_records WHERE secure),
publications AS (
  SELECT key,
    CASE WHEN page_id % 31 = 0 THEN ''
         WHEN page_id % 3 = 0 THEN regexp_replace(full_title, ' [^ ]+$', '')
         ELSE full_title END AS title,
    CASE WHEN page_id % 17 = 0 THEN NULL
         WHEN page_id % 19 = 0 THEN '0'
         WHEN page_id % 23 = 0 THEN ' ' || year || ' '
         WHEN page_id % 29 = 0 THEN year || '.0'
         ELSE year::VARCHAR END AS year,
    host AS venue, url
  FROM page_records WHERE host NOT LIKE 'm.%'),
gold AS (
  SELECT key, CASE WHEN page_id % 37 = 0 THEN '' ELSE full_title END AS title,
    CASE page_id % 8 WHEN 0 THEN 'https://doi.org/' || doi
      WHEN 1 THEN 'http://doi.org/' || doi
      WHEN 2 THEN 'doi.org/' || doi
      WHEN 3 THEN 'DOI: ' || doi
      WHEN 4 THEN 'doi:' || doi
      WHEN 5 THEN ' ' || doi || ' '
      WHEN 6 THEN CASE WHEN page_id % 3 = 0 THEN 'None' ELSE doi END
      ELSE CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN '' ELSE doi END
    END AS doi
  FROM page_records),
answers AS (
  SELECT title, year,
    min(CASE WHEN url LIKE 'https://%' THEN '10.1000/' || key END) AS doi,
    max(length(title))::DOUBLE / 2 AS score
  FROM publications WHERE url NOT LIKE '%?%' GROUP BY title, year)"""

PAPERS = r"""
doc_words AS (
  SELECT doc_id, doc_id::VARCHAR AS key, source,
    trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) AS title,
    string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')), ' ') AS words
  FROM documents),
papers AS (
  SELECT doc_id, key, source, title,
    CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 11 = 0 THEN 'x' || (1990 + doc_id % 35)
         ELSE (1990 + doc_id % 35) || '-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') END AS pub_date,
    CASE source WHEN 'src3' THEN source || ' [issn:1588-2861]'
                WHEN 'src7' THEN source || ' [issn:0138-9130]'
                WHEN 'src11' THEN 'Scientometrics ' || source ELSE source END AS venue,
    '  omid:br/06' || doc_id || ' doi:10.1/' || doc_id AS id,
    array_to_string(list_transform(range((len(words) + 1) // 2), lambda i:
      words[2 * i + 1] || ', ' || coalesce(words[2 * i + 2], 'X.') || ' [omid:ra/' || i ||
      CASE WHEN i % 2 = 0 THEN ' orcid:0000-000' || (i % 10) || '-' || lpad((doc_id % 10000)::VARCHAR, 4, '0')
        || '-' || lpad((i % 1000)::VARCHAR, 3, '0') || CASE WHEN i % 3 = 0 THEN 'X' ELSE (i % 10)::VARCHAR END
        ELSE '' END || ']'), '; ') AS author,
    array_to_string(list_transform(range((len(words) + 1) // 2), lambda i:
      CASE WHEN i % 7 = 3 THEN 'University of ' || words[2 * i + 1]
        WHEN i % 11 = 5 THEN words[2 * i + 1] || ', ' || coalesce(words[2 * i + 2], 'X.') || ', 0000-0001-2345-6789'
        WHEN i % 5 = 4 THEN words[2 * i + 1] || ' ' || coalesce(words[2 * i + 2], 'X.') || ','
        ELSE words[2 * i + 1] || ', ' || coalesce(words[2 * i + 2], 'X.') END), ';') AS author_plain
  FROM doc_words)"""

AUTHORS = r"""
author_names AS (
  SELECT doc_id::VARCHAR AS key, i,
    CASE WHEN i % 10 = 7 THEN '' ELSE words[2 * i + 1] || ' ' || coalesce(words[2 * i + 2], 'X.') END AS name
  FROM (SELECT doc_id, words, unnest(range((len(words) + 1) // 2)) AS i FROM (
    SELECT doc_id, string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')), ' ') AS words FROM documents))),
name_text AS (
  SELECT key, i, name, lower(trim(name)) AS n0 FROM author_names WHERE name <> ''),
name_initials AS (
  SELECT key, i, name, regexp_replace(regexp_replace(regexp_replace(n0,
    '(^|[^\p{L}\p{N}_])([a-z])\.\s*', '\1\2 ', 'g'),
    '(^|[^\p{L}\p{N}_])([a-z])\.\s*', '\1\2 ', 'g'),
    '(^|[^\p{L}\p{N}_])([a-z])\.\s*', '\1\2 ', 'g') AS n1 FROM name_text),
name_parts AS (
  SELECT key, i, name, string_split(trim(regexp_replace(regexp_replace(
    regexp_replace(n1, '[^\p{L}\p{N}_\s\-]', '', 'g'), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')), ' ') AS p
  FROM name_initials),
author_pairs AS (
  SELECT key, i, name, rtrim(substr(trim(regexp_replace(
    CASE WHEN p[1] = '' THEN 'unknown_unknown'
         WHEN len(p) = 1 THEN 'unknown_' || p[1]
         ELSE p[1] || '_' || p[len(p)] END, '_+', '_', 'g'), '_'), 1, 100), '_') AS author
  FROM name_parts)"""

LINES = r"""
split_lines AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, doc_id || '-' || n AS key, title, (2015 + doc_id % 6)::INTEGER AS year
  FROM (SELECT doc_id, unnest(parts) AS title, unnest(range(len(parts))) AS n FROM split_lines)
  WHERE title <> ''),
registry AS (
  SELECT '10.1000/' || key AS doi, title, year FROM lines WHERE doc_id IN (SELECT doc_id FROM labels))"""

SCORED = """
scored AS (
  SELECT d.doc_id::VARCHAR AS key, n_chars / 100.0::DOUBLE AS score, quality = 1 AS is_correct, toxic = 0 AS on_registry
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

SCORED_LINES = """
scored AS (SELECT l_extendedprice AS score, l_returnflag = 'N' AS is_correct FROM lineitem)"""

EDGES = """
edges AS (SELECT l_partkey::VARCHAR AS citing, l_suppkey::VARCHAR AS cited FROM lineitem),
cited_pubs AS (SELECT p_partkey::VARCHAR AS id, p_name AS title FROM part WHERE p_size <= 10),
touching AS (
  SELECT citing AS id, 'outgoing' AS direction, cited AS other FROM edges WHERE citing IN (SELECT id FROM cited_pubs)
  UNION ALL
  SELECT cited, 'incoming', citing FROM edges WHERE cited IN (SELECT id FROM cited_pubs))"""

LOOKUPS = """
lookups AS (
  SELECT '10.1000/' || user_id AS doi, event_type = 'view' AS exists_flag,
    CASE event_type WHEN 'signup' THEN 'HTTP_404' WHEN 'click' THEN 'Timeout'
      WHEN 'error' THEN 'ConnectionError' WHEN 'purchase' THEN 'HTTP_429' END AS error_type,
    ts, event_id
  FROM events),
latest AS (
  SELECT doi, exists_flag, error_type, ts FROM lookups
  QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ts DESC) = 1)"""

ENTRIES = """
entries AS (
  SELECT o_orderkey::VARCHAR AS key,
    CASE WHEN o_orderkey % 7 = 0 THEN 'https://doi.org/10.1000/' || o_custkey || ' '
         WHEN o_orderkey % 11 = 0 THEN 'None' ELSE '10.1000/' || o_custkey END AS doi
  FROM orders)"""

METADATA = """
metadata AS (
  SELECT '10.1000/' || key AS doi, title, author_plain AS author, pub_date AS year, source AS source_title
  FROM papers WHERE doc_id IN (SELECT doc_id FROM labels))"""

DUMP = r"""
dump AS (
  SELECT source, doc_id + 1 AS line_no,
    '"' || id || ',' || '""' || title || '"",""' || author || '"",' || pub_date || ',""' || venue || '""' ||
    CASE WHEN doc_id % 5 = 0 THEN ',' ELSE '' END || '"' || CASE WHEN doc_id % 3 = 0 THEN ';;' ELSE '' END AS value
  FROM papers
  UNION ALL
  SELECT DISTINCT source, 0, CASE WHEN source = 'src5' THEN '"id,title,author,venue"'
    ELSE '"id,title,author,pub_date,"venue"";;' END FROM papers),
unwrapped AS (
  SELECT source, line_no, replace(CASE WHEN starts_with(v, '"') AND ends_with(v, '"')
    THEN substr(v, 2, length(v) - 2) ELSE v END, '""', '"') AS t
  FROM (SELECT source, line_no, regexp_replace(value, '[\r\n;]+$', '') AS v FROM dump)),
pieces AS (
  SELECT source, line_no, unnest(string_split(t, ',')) AS piece, generate_subscripts(string_split(t, ','), 1) AS n
  FROM unwrapped),
states AS (
  SELECT source, line_no, n, piece,
    coalesce(sum(length(piece) - length(replace(piece, '"', ''))) OVER w, 0) AS quotes,
    coalesce(sum(length(replace(piece, ']', '')) - length(replace(piece, '[', ''))) OVER w, 0) AS depth
  FROM pieces
  WINDOW w AS (PARTITION BY source, line_no ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbered AS (
  SELECT source, line_no, n, piece,
    sum(CASE WHEN n = 1 OR (quotes % 2 = 0 AND depth = 0) THEN 1 ELSE 0 END)
      OVER (PARTITION BY source, line_no ORDER BY n) AS field
  FROM states),
raw_fields AS (
  SELECT source, line_no, field, string_agg(piece, ',' ORDER BY n) AS f FROM numbered GROUP BY ALL),
kept_fields AS (
  SELECT *, field = max(field) OVER (PARTITION BY source, line_no) AS is_last FROM raw_fields),
fields AS (
  SELECT source, line_no, list(trim(trim(f), '"') ORDER BY field) AS fields
  FROM kept_fields WHERE NOT (is_last AND f = '') GROUP BY ALL),
headers AS (
  SELECT source, list_position(fields, 'id') AS a, list_position(fields, 'title') AS b, list_position(fields, 'author') AS c,
    list_position(fields, 'pub_date') AS d, list_position(fields, 'venue') AS e
  FROM fields WHERE line_no = 0),
dump_rows AS (
  SELECT f.source, line_no, fields[a] AS id, fields[b] AS title, fields[c] AS author, fields[d] AS pub_date, fields[e] AS venue
  FROM fields f JOIN headers h ON f.source = h.source
  WHERE line_no > 0 AND a > 0 AND b > 0 AND c > 0 AND d > 0 AND e > 0 AND len(fields) >= greatest(a, b, c, d, e))"""


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


def quoted(values: tuple[str, ...]) -> str:
    """Fixed values as a list of SQL texts."""
    return ", ".join(f"'{v}'" for v in values)


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"


def doi_sql(x: str, trim_end: bool = False) -> str:
    bare = rf"""CASE WHEN starts_with({x}, 'DOI:') THEN trim(substr({x}, 5))
      ELSE regexp_replace({x}, '^(?:https?://doi\.org/|doi\.org/)', '') END"""
    if trim_end:
        bare = f"trim({bare})"
    return f"CASE WHEN {x} IS NOT NULL AND {x} NOT IN ('', 'None') THEN lower({bare}) END"


def year_sql(x: str) -> str:
    return f"coalesce(CASE WHEN try_cast(CASE WHEN regexp_matches({x}, '^\\s*[+-]?[0-9]+\\s*$') THEN trim({x}) END AS INTEGER) > 1 THEN trim({x})::INTEGER END, 2020)"


def whole_number(x: str) -> str:
    """Text read as a whole number; decimals do not count."""
    return f"try_cast(CASE WHEN regexp_matches({x}, '^\\s*[+-]?[0-9]+\\s*$') THEN trim({x}) END AS INTEGER)"


def retryable_sql(x: str) -> str:
    return f"coalesce(regexp_matches({x}, 'Timeout|ConnectionError|ReadTimeout|ConnectTimeout'), false)"


# Best registry record of each (title, lookup_year) in ``wanted``; scores every pair that shares a word.
BEST = rf"""
rterm AS (SELECT doi, year, unnest(list_distinct({words('title')})) AS term FROM registry),
weight AS (
  SELECT term, round(ln(1 + ((SELECT count(*) FROM registry) - count(*) + 0.5) / (count(*) + 0.5)) * 1000000)::BIGINT AS w
  FROM rterm GROUP BY term),
qterm AS (
  SELECT title, lookup_year, unnest(list_distinct({words('title')})) AS term
  FROM (SELECT DISTINCT title, lookup_year FROM wanted)),
pair AS (
  SELECT q.title, q.lookup_year, r.doi, sum(w)::BIGINT AS s
  FROM qterm q JOIN rterm r ON q.term = r.term AND r.year BETWEEN q.lookup_year AND q.lookup_year + 1
  JOIN weight ON weight.term = q.term GROUP BY ALL),
best AS (
  SELECT title, lookup_year, doi, s / 1000000::DOUBLE AS score FROM pair
  QUALIFY row_number() OVER (PARTITION BY title, lookup_year ORDER BY s DESC, doi) = 1)"""

# Similarity of the pairs (a, b) in ``compared``, one row of the LCS table per step.
LCS = """
lcs AS (
  SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0::BIGINT) AS line
  FROM (SELECT DISTINCT a, b FROM compared WHERE a <> '' AND b <> '')
  UNION ALL
  SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j:
    list_append(acc, CASE WHEN substring(a, i + 1, 1) = substring(b, j, 1) THEN line[j] + 1
      ELSE greatest(line[j + 1], acc[len(acc)]) END), [0::BIGINT])
  FROM lcs WHERE i < length(a)),
ratios AS (
  SELECT a, b, 2.0::DOUBLE * line[len(line)] / (length(a) + length(b)) AS ratio FROM lcs WHERE i = length(a))"""


def attached(title: str) -> str:
    """Labelled rows with metadata, best record and checks; searched by the given title column."""
    return (
        f"""
labelled AS (
  SELECT g.key, g.title AS csv_title, g.doi, p.key IS NOT NULL AS has_metadata, p.title AS meta_title, p.year AS meta_year,
    CASE WHEN coalesce(p.title, '') = '' THEN g.title ELSE p.title END AS title,
    CASE WHEN p.key IS NULL THEN '2020' ELSE p.year END AS year
  FROM gold g LEFT JOIN publications p ON g.key = p.key),
asked AS (SELECT *, {title} AS search_title, {year_sql('year')} AS lookup_year FROM labelled),
wanted AS (SELECT search_title AS title, lookup_year FROM asked WHERE coalesce(search_title, '') <> ''),"""
        + BEST
        + f""",
found AS (
  SELECT a.*, best.doi AS registry_doi, coalesce(best.score, 0) AS score, r.title AS cr_title, r.year AS cr_year,
    array_to_string(r.authors, ', ') AS cr_authors, r.venue AS cr_venue
  FROM asked a LEFT JOIN best ON a.search_title = best.title AND a.lookup_year = best.lookup_year
  LEFT JOIN registry r ON r.doi = best.doi),
compared AS (SELECT lower(trim(meta_title)) AS a, lower(trim(cr_title)) AS b FROM found WHERE registry_doi IS NOT NULL),"""
        + LCS
        + f""",
checked AS (
  SELECT f.*, coalesce(s.ratio, 0) AS title_similarity, coalesce(s.ratio, 0) > 0.5 AS title_valid,
    coalesce({whole_number('meta_year')} <> 0 AND cr_year <> 0 AND {whole_number('meta_year')} = cr_year, false) AS year_valid,
    CASE WHEN {whole_number('meta_year')} <> 0 THEN abs({whole_number('meta_year')} - cr_year) END AS year_difference
  FROM found f LEFT JOIN ratios s ON lower(trim(f.meta_title)) = s.a AND lower(trim(f.cr_title)) = s.b),
matched AS (
  SELECT *, title_valid AND year_valid AS is_valid_match, registry_doi IS NOT NULL AND has_metadata AS author_valid,
    {doi_sql('doi')} AS gold_norm, {doi_sql('registry_doi')} AS registry_norm
  FROM checked)"""
    )


RATES = """
  CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn)::DOUBLE ELSE 0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall,
  CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1"""

SWEEP = f"""
per_score AS (
  SELECT score, count(*) FILTER (is_correct) AS r, count(*) FILTER (NOT is_correct) AS w FROM scored GROUP BY score),
cumulated AS (
  SELECT score AS cutoff, (sum(r) OVER d)::BIGINT AS tp, (sum(w) OVER d)::BIGINT AS fp,
    (sum(w) OVER () - sum(w) OVER d)::BIGINT AS tn, (sum(r) OVER () - sum(r) OVER d)::BIGINT AS fn
  FROM per_score WINDOW d AS (ORDER BY score DESC)),
sweep AS (SELECT *, {RATES} FROM cumulated),
best_cut AS (
  SELECT CASE WHEN tp + tn > 0 THEN cutoff ELSE 0 END AS cutoff, accuracy
  FROM sweep ORDER BY tp + tn DESC, cutoff LIMIT 1)"""
