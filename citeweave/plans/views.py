"""Record-linkage inputs derived from the given tables.

Each view uses every row of its table and the whole of its texts.  Remainders of ids only
vary values (prefixes, missing years); they never choose rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions.fixed_values import JOURNAL_NAME, PRINT_ISSN, TARGET_ISSN
from citeweave.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw columns that the views over documents start from.

    A table in fewer pieces than there are cores is spread before its texts grow into titles and
    authors.  Larger tables stay as they are scanned.
    """
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *rows.columns)


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bibliographic record per page: (page_id, key, full_title, year, doi, host, secure).

    The title is the whole title element, the year comes from the number in the address.
    """
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "cast(page_id as string) AS key",
        r"trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[ \\t\\r\\n]+', ' ')) AS full_title",
        "2015 + cast(regexp_extract(url, '/([0-9]+)', 1) as int) % 6 AS year",
        "concat('10.', 1000 + page_id % 50, '/Doc.', page_id) AS doi",
        "regexp_extract(url, '^https?://([^/]*)', 1) AS host",
        "url LIKE 'https://%' AS secure",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry records: the pages served over https."""
    return page_records(spark, sf_dir).where("secure").selectExpr(
        "doi", "full_title AS title", "year", "split(host, '[.]') AS authors", "host AS venue"
    )


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication metadata: all pages but those of mobile hosts.

    Titles lost words or are missing, years are missing, zero or badly written.
    """
    return page_records(spark, sf_dir).where("host NOT LIKE 'm.%'").selectExpr(
        "key",
        r"""CASE WHEN page_id % 31 = 0 THEN ''
                 WHEN page_id % 3 = 0 THEN regexp_replace(full_title, ' [^ ]+$', '')
                 ELSE full_title END AS title""",
        """CASE WHEN page_id % 17 = 0 THEN NULL
                WHEN page_id % 19 = 0 THEN '0'
                WHEN page_id % 23 = 0 THEN concat(' ', year, ' ')
                WHEN page_id % 29 = 0 THEN concat(year, '.0')
                ELSE cast(year as string) END AS year""",
        "host AS venue",
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows (key, title, doi) of all pages; the DOI comes in many spellings."""
    return page_records(spark, sf_dir).selectExpr(
        "key",
        "CASE WHEN page_id % 37 = 0 THEN '' ELSE full_title END AS title",
        """CASE page_id % 8 WHEN 0 THEN concat('https://doi.org/', doi)
                            WHEN 1 THEN concat('http://doi.org/', doi)
                            WHEN 2 THEN concat('doi.org/', doi)
                            WHEN 3 THEN concat('DOI: ', doi)
                            WHEN 4 THEN concat('doi:', doi)
                            WHEN 5 THEN concat(' ', doi, ' ')
                            WHEN 6 THEN CASE WHEN page_id % 3 = 0 THEN 'None' ELSE doi END
                            ELSE CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN '' ELSE doi END
           END AS doi""",
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached answers per (title, year): publications without a query string in the address."""
    pages = table(spark, sf_dir, "pages").selectExpr("cast(page_id as string) AS key", "url")
    kept = pages.where("url NOT LIKE '%?%'").join(publications(spark, sf_dir), "key")
    return kept.groupBy("title", "year").agg(
        F.expr("min(CASE WHEN url LIKE 'https://%' THEN concat('10.1000/', key) END) AS doi"),
        F.expr("cast(max(length(title)) as double) / 2 AS score"),
    )


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full records of all documents; the title is the whole text on one line.

    Every two words of the text make an author, of whom every second has an ORCID.  Nothing is
    written: a query computes the columns it reads where the documents are scanned.
    """
    return paper_rows(documents(spark, sf_dir))


# The words as one value: a filter that is moved below them must not split the text for each author.
_BOUND = "element_at(transform(array(words), w -> "


def paper_rows(rows: DataFrame, *kept: str) -> DataFrame:
    """Records of document rows (doc_id, source, text), with the columns ``kept`` as they are."""
    base = rows.selectExpr(
        *kept,
        "doc_id",
        "cast(doc_id as string) AS key",
        "source",
        r"trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ')) AS title",
    )
    worded = base.withColumn("words", F.expr("split(title, ' ')"))
    pair = "concat(w[2 * i], ', ', coalesce(get(w, 2 * i + 1), 'X.'))"
    bound = _BOUND
    last = "cast((size(w) + 1) div 2 as int) - 1"
    return worded.selectExpr(
        *kept,
        "doc_id",
        "key",
        "source",
        "title",
        """CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 11 = 0 THEN concat('x', 1990 + doc_id % 35)
                ELSE concat(1990 + doc_id % 35, '-', lpad(cast(doc_id % 12 + 1 as string), 2, '0')) END AS pub_date""",
        f"""CASE source WHEN 'src3' THEN concat(source, ' [issn:{TARGET_ISSN}]')
                        WHEN 'src7' THEN concat(source, ' [issn:{PRINT_ISSN}]')
                        WHEN 'src11' THEN concat('{JOURNAL_NAME.capitalize()} ', source)
                        ELSE source END AS venue""",
        "concat('  omid:br/06', doc_id, ' doi:10.1/', doc_id) AS id",
        f"""{bound}array_join(transform(sequence(0, {last}), i -> concat({pair}, ' [omid:ra/', i,
              CASE WHEN i % 2 = 0 THEN concat(' orcid:0000-000', i % 10, '-', lpad(cast(doc_id % 10000 as string), 4, '0'),
                   '-', lpad(cast(i % 1000 as string), 3, '0'), CASE WHEN i % 3 = 0 THEN 'X' ELSE cast(i % 10 as string) END)
                   ELSE '' END, ']')), '; ')), 1) AS author""",
        f"""{bound}array_join(transform(sequence(0, {last}), i ->
              CASE WHEN i % 7 = 3 THEN concat('University of ', w[2 * i])
                   WHEN i % 11 = 5 THEN concat({pair}, ', 0000-0001-2345-6789')
                   WHEN i % 5 = 4 THEN concat(w[2 * i], ' ', coalesce(get(w, 2 * i + 1), 'X.'), ',')
                   ELSE {pair} END), ';')), 1) AS author_plain""",
    )


def author_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with authors made of every two words of the text, some without a name."""
    base = documents(spark, sf_dir).selectExpr(
        "cast(doc_id as string) AS key",
        r"split(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ')), ' ') AS words",
    )
    bound = _BOUND
    last = "cast((size(w) + 1) div 2 as int) - 1"
    return base.selectExpr(
        "key",
        f"""{bound}transform(sequence(0, {last}), i -> named_struct('name',
              CASE WHEN i % 10 = 7 THEN '' ELSE concat(w[2 * i], ' ', coalesce(get(w, 2 * i + 1), 'X.')) END,
              'org', ''))), 1) AS authors""",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a title of its own: (doc_id, key, title, year)."""
    return (
        table(spark, sf_dir, "documents")
        .selectExpr("doc_id", "posexplode(split(text, '\\n')) AS (line_no, title)")
        .where("title <> ''")
        .selectExpr(
            "doc_id",
            "concat(doc_id, '-', line_no) AS key",
            "title",
            "cast(2015 + doc_id % 6 as int) AS year",
        )
    )


def line_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry over the lines of the labelled documents."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return lines(spark, sf_dir).join(labelled, "doc_id", "left_semi").selectExpr(
        "concat('10.1000/', key) AS doi",
        "title",
        "year",
        "cast(array() as array<string>) AS authors",
        "'' AS venue",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored matches out of the labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").selectExpr(
        "cast(doc_id as string) AS key",
        "n_chars / 100.0D AS score",
        "quality = 1 AS is_correct",
        "toxic = 0 AS on_registry",
    )


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large set of scored matches out of the order lines."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_extendedprice AS score", "l_returnflag = 'N' AS is_correct"
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as string) AS citing", "cast(l_suppkey as string) AS cited"
    )


def cited_pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications of the extracted journal: the small parts."""
    return table(spark, sf_dir, "part").where("p_size <= 10").selectExpr(
        "cast(p_partkey as string) AS id", "p_name AS title"
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers ever given, several per DOI: (doi, exists, error_type, ts, event_id)."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('10.1000/', user_id) AS doi",
        "event_type = 'view' AS exists",
        """CASE event_type WHEN 'signup' THEN 'HTTP_404' WHEN 'click' THEN 'Timeout'
                           WHEN 'error' THEN 'ConnectionError' WHEN 'purchase' THEN 'HTTP_429' END AS error_type""",
        "ts",
        "event_id",
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted (key, doi) pairs to enrich: one per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) AS key",
        """CASE WHEN o_orderkey % 7 = 0 THEN concat('https://doi.org/10.1000/', o_custkey, ' ')
                WHEN o_orderkey % 11 = 0 THEN 'None'
                ELSE concat('10.1000/', o_custkey) END AS doi""",
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata per DOI of the labelled documents, whole texts as titles."""
    labelled = table(spark, sf_dir, "labels").selectExpr("cast(doc_id as string) AS key")
    return papers(spark, sf_dir).join(labelled, "key", "left_semi").selectExpr(
        "concat('10.1000/', key) AS doi",
        "title",
        "author_plain AS author",
        "pub_date AS year",
        "source AS source_title",
    )


#: Header of each source's file; one source lacks a column.
DUMP_HEADER = """CASE WHEN source = 'src5' THEN '"id,title,author,venue"' ELSE '"id,title,author,pub_date,"venue"";;' END"""
_DUMPS: dict[tuple[str, str], DataFrame] = {}
_DUMP_LINE = """concat('"', id, ',', '""', title, '"",""', author, '"",', pub_date, ',""', venue, '""',
                  CASE WHEN doc_id % 5 = 0 THEN ',' ELSE '' END, '"',
                  CASE WHEN doc_id % 3 = 0 THEN ';;' ELSE '' END)"""


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rendered in the wrapped dialect, one file per source, header at line 0.

    Titles keep their quotes and brackets, so some lines are irregular.  The lines are written once
    per session where they are rendered, as their readers filter them by what they hold.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DUMPS:
        _DUMPS[key] = materialize(_dump_lines(spark, sf_dir), "dump_lines", keep=True)
    return _DUMPS[key]


def _dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).selectExpr("source", "doc_id + 1 AS line_no", f"{_DUMP_LINE} AS value")
    # Out of the table itself: the sources need no text.
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    headers = sources.selectExpr("source", "0L AS line_no", f"{DUMP_HEADER} AS value")
    return headers.unionByName(rows)


def dump_files(rows: DataFrame, piece_lines: int = 100_000) -> DataFrame:
    """Documents as the lines of files, (source, piece, value), each file in one task and in order.

    Every piece of some lines of a source starts with its header.  Rows are dealt and sorted as raw
    texts and rendered after that, so the long lines are not shuffled.
    """
    piece = F.lpad(F.floor((F.col("doc_id") + 1) / piece_lines).cast("string"), 8, "0")
    body = rows.where("doc_id + 1 > 0").withColumn("piece", piece).withColumn("line_no", F.col("doc_id") + 1)
    headers = body.where("source IS NOT NULL").select("source", "piece", F.lit(0).cast("long").alias("line_no")).distinct()
    dealt = body.unionByName(headers, allowMissingColumns=True).repartition("source", "piece")
    ordered = dealt.sortWithinPartitions("source", "piece", "line_no")
    lines = paper_rows(ordered, "piece", "line_no")
    value = f"CASE WHEN line_no = 0 THEN {DUMP_HEADER} ELSE {_DUMP_LINE} END AS value"
    return lines.selectExpr("source", "piece", value)
