"""The query catalogue against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "normalize_doi", "parse_author_string", "parse_author_orcid", "keywords_distinct", "normalize_author_name",
    "best_candidate", "title_similarity", "tune_cutoff", "evaluate_holdout", "bulk_validate", "prefix_sums",
    "enrich_entries", "author_index", "citation_lists", "extract_community", "seeded_split", "read_wrapped_dump",
    "read_labelled", "upsert_lookup",
)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["cutoff", "accuracy"]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())
