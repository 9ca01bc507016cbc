"""Candidate search in cells: no candidate pairs are written, any number of pieces and shards gives the same answers."""

from __future__ import annotations

import random

import pytest

from citeweave.operators import candidates
from citeweave.sources import writers

from .test_matching import brute_force, skewed_titles

SEARCHES, REGISTRY = "title string, lookup_year int", "doi string, title string, year int"


def test_nothing_written_grows_with_candidate_pairs(spark, monkeypatch):
    # All searches share hot words with all entries, so pairs are many times the rows.
    hot = [f"h{i}" for i in range(12)]
    registry = [(f"10.1/{i:03d}", " ".join([*hot[: 6 + i % 6], f"r{i}"]), 2000) for i in range(60)]
    searches = [(" ".join([*hot[i % 5 :], f"s{i}"]), 2000) for i in range(60)]
    written = {}

    def kept(df, name, **options):
        written[name] = written.get(name, 0) + (out := df.localCheckpoint()).count()
        return out

    monkeypatch.setattr(candidates, "materialize", kept)
    found = candidates.best_candidate(spark.createDataFrame(searches, SEARCHES), spark.createDataFrame(registry, REGISTRY), hot_rows=2)
    expected = brute_force(searches, registry)
    assert {(r.title, r.lookup_year): (r.doi, round(r.score, 6)) for r in found.collect()} == {k: (d, round(s, 6)) for k, (d, s) in expected.items()}
    assert written and max(written.values()) <= len(registry) + len(searches)


@pytest.mark.parametrize("cell_words", [60, 300])
def test_pieces_and_shards_give_the_same_answers(spark, cell_words):
    rng = random.Random(cell_words)
    # Years far apart share tasks.
    years = [1, 2000, 2001, 2002, 2066, 9999]
    registry = [(f"10.1/{i:04d}", t, rng.choice(years)) for i, t in enumerate(skewed_titles(rng, 120))]
    searches = sorted({(t, rng.choice(years)) for t in skewed_titles(rng, 120)} | {("...", 2000)})
    found = candidates.best_candidate(
        spark.createDataFrame(searches, SEARCHES), spark.createDataFrame(registry, REGISTRY), hot_rows=10, cell_words=cell_words
    )
    got = {(r.title, r.lookup_year): (r.doi, round(r.score, 6)) for r in found.collect()}
    assert got == {k: (d, round(s, 6)) for k, (d, s) in brute_force(searches, registry).items()}


def test_missing_years_dois_and_titles(spark):
    registry = [(None, "a b", 2000), ("10.1/y", "a b c", 2000), ("10.1/x", "c", None), ("10.1/w", None, 2000), ("10.1/v", "é ß", 2000)]
    searches = [("a b", 2000), ("a b", None), ("c", 2000), (None, 2000), ("É", 1999), ("c", 2001)]
    run = lambda rows, known: {
        (r.title, r.lookup_year): (r.doi, r.score > 0)
        for r in candidates.best_candidate(spark.createDataFrame(rows, SEARCHES), spark.createDataFrame(known, REGISTRY)).collect()
    }
    assert run(searches, registry) == {
        ("a b", 2000): (None, True), ("a b", None): (None, False), ("c", 2000): ("10.1/y", True), (None, 2000): (None, False),
        ("É", 1999): ("10.1/v", True), ("c", 2001): (None, False),
    }
    assert run(searches[:1], []) == {("a b", 2000): (None, False)}
    assert run([], registry) == {}


def test_titles_are_shuffled_once_for_their_answers(spark):
    registry = spark.createDataFrame([("10.1/x", "U", 2001, [], "")], "doi string, title string, year int, authors array<string>, venue string")
    best = spark.createDataFrame([("U", 2001, "10.1/x", 1.0), ("V", 2001, None, 0.0)], "title string, lookup_year int, doi string, score double")
    rows = spark.createDataFrame([("U", 2001), ("U", 2001), ("V", 2001), (None, 2001)], SEARCHES)
    found = candidates.attach_candidate(rows, best, registry)
    got = sorted((r.title or "", r.registry_doi, r.score, r.cr_title) for r in found.collect())
    assert got == [("", None, 0.0, None), ("U", "10.1/x", 1.0, "U"), ("U", "10.1/x", 1.0, "U"), ("V", None, 0.0, None)]
    assert "hashpartitioning(title" not in found._jdf.queryExecution().executedPlan().toString()


def test_converted_papers_are_written_compressed(spark, tmp_path):
    rows = [(f"k{i}", " ".join(f"word{j}" for j in range(300))) for i in range(50)]
    writers.write_converted(spark.createDataFrame(rows, "key string, title string").coalesce(1), str(tmp_path))
    assert sorted((r.key, r.title) for r in spark.read.json(f"{tmp_path}/converted").collect()) == sorted(rows)
    assert sum(f.stat().st_size for f in (tmp_path / "converted").iterdir()) < sum(len(t) for _, t in rows) / 4
