"""Hot keys, exact sizes, readers and total orders."""

import pytest
from pyspark.sql import functions as F

from citeweave.operators import authors, enrich, evaluate, extract, lookup, sampling
from citeweave.plans import jobs
from citeweave.session import clear_intermediates, materialize
from citeweave.sources import dump, lookup_store, readers


def test_hot_author_is_dealt_over_tasks(spark):
    """A third of all pairs on one author: no task holds it after the grouping."""
    papers = spark.range(30_000).selectExpr(
        "cast(id as string) AS key",
        "array(named_struct('name', if(id % 3 = 0, 'Hot Author', concat('Author N', id % 997)), 'org', '')) AS authors",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = authors.author_index(papers, part_size=100)
        sizes = (
            index.where("author = 'hot_author'").withColumn("task", F.spark_partition_id())
            .groupBy("task").agg(F.sum(F.size("papers")).alias("n")).collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in sizes) == 10_000
    assert len(sizes) >= 3 and max(r.n for r in sizes) < 6_000


def test_gold_headers_by_position(spark, tmp_path):
    (tmp_path / "g.csv").write_text('_code;title;DOI;Cinese_title;\n1;"two\nlines";10.1/a;x;\n')
    rows = readers.read_gold(spark, str(tmp_path))
    assert rows.columns == ["_code", "title", "DOI", "Cinese_title"]
    assert [tuple(r) for r in rows.collect()] == [("1", "two\nlines", "10.1/a", "x")]


def test_labelled_line_breaks(spark, tmp_path):
    (tmp_path / "l.csv").write_text('key,title,doi,id_on_crossref\nk1,"a\nb",10.1/a,True\nk2,c,10.1/b,False\n')
    rows = readers.read_labelled(spark, str(tmp_path)).orderBy("key").collect()
    assert [(r.key, r.title, r.on_registry) for r in rows] == [("k1", "a\nb", True), ("k2", "c", False)]


@pytest.mark.parametrize("n", [0, 2, 5, 9])
def test_split_is_exact_with_repeated_keys(spark, n):
    df = spark.createDataFrame([("k", 1)] * 5 + [("a", 2)], "key string, x int")
    split = sampling.seeded_split(df, n=n)
    assert split.where("split = 'train'").count() == min(n, 6) and split.count() == 6
    pilot = sampling.pilot_then_rest(df, n=n)
    assert pilot.where("batch = 'pilot'").count() == min(n, 6)


def test_repeated_header_and_order_across_files(spark, tmp_path):
    head = '"id,title,author,pub_date,venue"'
    row = '"{},T{},""A [orcid:0000-0001-2345-6789]"",2010,scientometrics"'
    (tmp_path / "a.csv").write_text("\n".join([head, row.format("x", "old"), head, row.format("y", "1")]))
    (tmp_path / "b.csv").write_text("\n".join([head, row.format("x", "new")]))
    rows = dump.read_wrapped_dump(spark, str(tmp_path))
    assert sorted(r.id for r in rows.collect()) == ["id", "x", "x", "y"]
    kept = extract.publications(rows, F.struct("source", "line_no"))
    assert {(r.id, r.title) for r in kept.collect()} == {("x", "Tnew"), ("y", "T1")}


def test_short_ids_are_rehashed_until_none_clashes(spark):
    ids = spark.range(150).selectExpr("cast(id as string) AS id")
    found = extract.short_ids(ids, length=2).collect()
    assert len({r.short_id for r in found}) == 150 and {len(r.short_id) for r in found} == {2}


def test_exact_median(spark):
    rows = [(True, None, float(x)) for x in (5, 1, 9, 3)] + [(False, True, 2.0)] + [(None, False, float(x)) for x in range(101)]
    df = spark.createDataFrame(rows, "on_registry boolean, is_correct boolean, score double")
    got = {(r.on_registry, r.is_correct): r.median_score for r in evaluate.score_profile(df, buckets=7).collect()}
    assert got == {(True, None): 3.0, (False, True): 2.0, (None, False): 50.0}


def test_duplicate_dois_do_not_multiply_rows(spark):
    meta = spark.createDataFrame([("d", "A", "x", "2001", "s"), ("d", "B", "y", "2002", "s")], "doi string, title string, author string, year string, source_title string")
    results = spark.createDataFrame([("k", "d", "found")], "key string, doi string, status string")
    assert [r.title for r in enrich.convert_records(results, meta).collect()] == ["B"]
    ties = spark.createDataFrame([("d", 1, "a"), ("d", 1, "b")], "doi string, ts int, v string")
    assert [r.v for r in lookup.last_wins(ties, ["doi"], F.col("ts")).collect()] == ["b"]


def test_kept_answers_of_searches(spark, tmp_path):
    schema = "title string, year string, doi string, score double"
    first = spark.createDataFrame([("t", "2001", "d1", 1.0), ("u", None, None, 0.0)], schema)
    second = spark.createDataFrame([("t", "2001", "d2", 2.0)], schema)
    path = str(tmp_path / "answers")
    lookup_store.upsert_lookup(spark, path, first, lookup_store.ANSWER_SCHEMA)
    kept = lookup_store.upsert_lookup(spark, path, second, lookup_store.ANSWER_SCHEMA)
    assert {(r.title, r.doi) for r in kept.collect()} == {("t", "d2"), ("u", None)}


def test_rerun_searches_nothing(spark, monkeypatch):
    """With the answers of a first run at hand, a second run has nothing left to search."""
    pubs = spark.createDataFrame([("k1", "red green blue", "2001"), ("k2", "", None), ("k3", "red", None)], "key string, title string, year string")
    registry = spark.createDataFrame(
        [("10.1/a", "red green blue", 2001, ["A"], "v")], "doi string, title string, year int, authors array<string>, venue string"
    )
    first = jobs.search(pubs, registry, "title")
    answers = jobs.answers_of(first, "title")
    asked = []
    real = jobs.best_candidate
    monkeypatch.setattr(jobs, "best_candidate", lambda wanted, *a, **k: asked.append(wanted.count()) or real(wanted, *a, **k))
    again = jobs.search(pubs, registry, "title", answers=answers)
    pick = ("key", "registry_doi", "score", "cr_title")
    assert sorted(map(str, again.select(*pick).collect())) == sorted(map(str, first.select(*pick).collect()))
    assert asked == [0]


def test_intermediate_tables_are_deleted(spark):
    clear_intermediates(spark)
    kept = materialize(spark.range(3), "kept", keep=True)
    gone = materialize(spark.range(4), "gone")
    assert gone.count() == 4
    assert clear_intermediates(spark) == 1 and clear_intermediates(spark) == 0
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        spark.read.parquet(gone.inputFiles()[0]).count()
