"""Repeated keys in joins, splits that read their input once, candidate search past one batch."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from citeweave.operators import candidates, lookup, sampling
from citeweave.sources import lookup_store

from .test_matching import brute_force


def test_repeated_publications_do_not_multiply_rows(spark):
    gold = spark.createDataFrame([("a", "csv a"), ("b", "csv b"), (None, "csv c")], "key string, title string")
    pubs = spark.createDataFrame(
        [("a", "first", "2001", 1), ("a", "last", "1999", 2), ("b", None, "2000", 1), ("b", None, "2000", 1), (None, "x", "1", 1)],
        "key string, title string, year string, ord int",
    )
    rows = lookup.attach_metadata(gold, pubs, F.col("ord")).orderBy(F.col("key").asc_nulls_last()).collect()
    assert [(r.key, r.title, r.year, r.meta_title) for r in rows] == [
        ("a", "last", "1999", "last"), ("b", "csv b", "2000", None), (None, "csv c", "2020", None),
    ]
    assert {r.title for r in lookup.attach_metadata(gold, pubs).collect()} == {"last", "csv b", "csv c"}


def test_repeated_answers_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([("a", "2001"), ("a", None), ("b", "2001")], "title string, year string")
    answers = spark.createDataFrame(
        [("a", "2001", "10.1/x", 3.0), ("a", "2001", "10.1/y", 2.0), ("a", None, "10.1/z", 1.0), ("a", None, "10.1/z", 1.0)],
        "title string, year string, doi string, score double",
    )
    got = {(r.title, r.year): (r.registry_doi, r.score) for r in lookup.lookup_join(rows, answers).collect()}
    assert got == {("a", "2001"): ("10.1/y", 2.0), ("a", None): ("10.1/z", 1.0), ("b", "2001"): (None, 0.0)}


def test_splits_read_their_input_once(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("string").alias("key")).write.parquet(f"{tmp_path}/in")
    split = sampling.seeded_split(spark.read.parquet(f"{tmp_path}/in"), n=7)
    assert split.where("split = 'train'").count() == 7 and split.count() == 50
    assert not any(str(tmp_path) in name for name in split.inputFiles())


def test_candidates_over_many_batches(spark):
    """Searches stay with their candidates where both sides of a union are dealt by the search."""
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)]
    title = lambda: " ".join(rng.sample(words, rng.randint(1, 12)))
    registry = [(f"10.1/{i:04d}", title(), 2000 + i % 2) for i in range(300)]
    searches = sorted({(title(), 2000 + i % 2) for i in range(300)})
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for key, value in zip(before, ("-1", "7"), strict=True):
            spark.conf.set(key, value)
        found = candidates.best_candidate(
            spark.createDataFrame(searches, "title string, lookup_year int"),
            spark.createDataFrame(registry, "doi string, title string, year int"),
            hot_rows=20,
        ).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    got = {(r.title, r.lookup_year): (r.doi, round(r.score, 6)) for r in found}
    assert got == {k: (doi, round(score, 6)) for k, (doi, score) in brute_force(searches, registry).items()}


def test_upserts_write_their_batch_only(spark, tmp_path):
    path = str(tmp_path / "lookup")
    frame = lambda ids, day, found: spark.createDataFrame(
        [(f"10.1/{i}", found, None, f"2024-01-{day:02d}") for i in ids], "doi string, exists boolean, error_type string, ts string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    lookup_store.upsert_lookup(spark, path, frame(range(500), 1, False), max_deltas=3)
    merged = lookup_store.upsert_lookup(spark, path, frame([3, 3, 700], 2, True), max_deltas=3)
    assert spark.read.parquet(f"{path}/delta=2").count() == 2
    assert merged.count() == 501 and merged.where("exists").count() == 2
    # An older answer that comes later doesn't count.
    assert lookup_store.upsert_lookup(spark, path, frame([3], 1, False), max_deltas=3).where("exists").count() == 2
    # What a crash left behind is not read and is written anew.
    frame(range(900), 9, True).write.parquet(f"{path}/delta=4")
    (tmp_path / "lookup" / "delta=4" / "_SUCCESS").unlink()
    assert lookup_store.load_lookup(spark, path).count() == 501
    merged = lookup_store.upsert_lookup(spark, path, frame([800], 3, True), max_deltas=3)
    assert merged.count() == 502 and lookup_store._committed(spark, path, "version") == [4]
    assert lookup_store._counting(spark, path) == (4, [])
    merged = lookup_store.upsert_lookup(spark, path, frame([801], 3, True), max_deltas=3)
    assert merged.count() == 503 and lookup_store._counting(spark, path) == (4, [5])


def test_last_given_answer_to_a_search_wins(spark, tmp_path):
    path, schema = str(tmp_path / "answers"), lookup_store.ANSWER_SCHEMA
    for doi in ("10.1/z", "10.1/a", None):
        row = spark.createDataFrame([("t", None, doi, 1.0)], "title string, year string, doi string, score double")
        lookup_store.upsert_lookup(spark, path, row, schema, max_deltas=1)
        assert [r.doi for r in lookup_store.load_lookup(spark, path, schema).collect()] == [doi]
