"""Views that shuffle and write no grown texts, dump files that keep only the journal's lines, joins by key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citeweave.functions.names import normalize_author_name
from citeweave.operators import candidates, lookup
from citeweave.operators.authors import author_papers
from citeweave.plans import views
from citeweave.streaming import extraction


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, f"src{i % 4}", f"one two  three\n{i} four five") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs.repartition(2 * spark.sparkContext.defaultParallelism).write.option("parquet.block.size", 1).parquet(f"{path}/documents.parquet")
    return str(path)


def test_views_over_documents_write_and_shuffle_nothing(spark, folder, monkeypatch):
    monkeypatch.setattr(spark.sparkContext.__class__, "defaultParallelism", property(lambda self: 1))
    monkeypatch.setattr(views, "materialize", lambda df, *a, **k: pytest.fail("written"))
    for view in (views.papers, views.author_lists):
        df = view(spark, folder)
        assert df.count() == 40 and "Exchange" not in plan(df)
        assert all(f"{folder}/documents.parquet" in f for f in df.inputFiles())


def test_few_pieces_are_spread_before_texts_grow(spark, folder, monkeypatch):
    monkeypatch.setattr(spark.sparkContext.__class__, "defaultParallelism", property(lambda self: 99))
    df = views.papers(spark, folder)
    assert df.rdd.getNumPartitions() == 99 and df.count() == 40
    assert "author" not in plan(df.select("title")).split("Exchange")[1]


def test_dump_files_are_whole_and_in_order(spark, folder, tmp_path):
    dealt = views.dump_files(views.documents(spark, folder), piece_lines=10)
    dealt.write.partitionBy("source", "piece").text(str(tmp_path / "dump"), compression="gzip")
    read = spark.read.text(str(tmp_path / "dump")).select(F.input_file_name().alias("file"), "source", "value").collect()
    expected = {(r.source, r.line_no): r.value for r in views.dump_lines(spark, folder).collect()}
    files = {}
    for r in read:
        files.setdefault((r.file, r.source), []).append(r.value)
    assert sorted(v for (s, n), v in expected.items() if n) == sorted(v for lines in files.values() for v in lines[1:])
    place = {v: n for (s, n), v in expected.items() if n}
    for (_, source), lines in files.items():
        assert lines[0] == expected[source, 0]
        assert [place[v] for v in lines[1:]] == sorted(place[v] for v in lines[1:])


def test_only_lines_that_matter_are_kept(spark):
    lines = ['"id,title,author,pub_date,""venue"""', '"p1,T,,2001,Nature"', '"p2,T,,2001,SCIENTOMETRICS x"', '"p3,T,,2001,[issn:0138-9130]"', None]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    kept = lambda **journal: [r.value for r in extraction.JournalTables(spark, "", journal).needed(df).collect()]
    assert kept() == [lines[0], lines[2], lines[3]]
    assert kept(name="nature", issns=()) == lines[:2]
    assert kept(name="é") == lines
    # Doubled quotes of the dialect are single ones in the venue.
    quoted = spark.createDataFrame([('"p1,T,,2001,the ""x"" journal"',)], "value string")
    assert extraction.JournalTables(spark, "", {"name": 'the "x" j'}).needed(quoted).count() == 1


def test_small_sides_of_growing_joins_do_not_pass_through_the_driver(spark):
    gold = spark.createDataFrame([("a", "T", "10.1/x"), ("b", "", None)], "key string, title string, doi string")
    pubs = spark.createDataFrame([("a", "U", "2001")], "key string, title string, year string")
    registry = spark.createDataFrame([("10.1/x", "U", 2001, [], "")], "doi string, title string, year int, authors array<string>, venue string")
    joined = lookup.attach_metadata(gold, pubs)
    assert {r.key: r.title for r in joined.collect()} == {"a": "U", "b": ""}
    best = spark.createDataFrame([("U", 2001, "10.1/x", 1.0)], "title string, lookup_year int, doi string, score double")
    found = candidates.attach_candidate(best.select("title", "lookup_year"), best, registry)
    assert [r.cr_year for r in found.collect()] == [2001]
    for df in (joined, found):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)


def test_plain_names_skip_rules_and_keep_their_keys(spark):
    names = {
        "Ann Lee": "ann_lee", " ann LEE ": "ann_lee", "a. lee": "a_lee", "7 x": "7_x", "ann  lee": "ann_lee", "ann lee\n": "ann_lee",
        "ann b lee": "ann_lee", "lee": "unknown_lee", "a_ lee": "a_lee", "x" * 60 + " " + "y" * 60: "x" * 60 + "_" + "y" * 39,
        "x" * 99 + " y": "x" * 99,
    }
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", normalize_author_name(F.col("name")).alias("k"))
    assert {r.name: r.k for r in df.collect()} == names
    assert normalize_author_name(F.col("name"))._jc.toString().startswith("CASE WHEN")


def test_names_are_normalised_once(spark):
    people = [("p", [{"name": "Ann Lee"}, {"name": ""}, {"name": None}, {"name": "_"}]), ("q", []), ("r", None), ("s", [None])]
    pairs = author_papers(spark.createDataFrame(people, "key string, authors array<struct<name: string>>"))
    assert sorted(tuple(r) for r in pairs.collect()) == [("ann_lee", "p"), ("unknown", "p")]
    text = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert sum("(?U)[^" in line for line in text.splitlines()) == 1 and "size(filter" not in text
