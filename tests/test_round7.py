"""Searches leave nothing on disk but their answers; pieces of the registry take turns."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from citeweave.operators import candidates
from citeweave.session import discard, materialize, shared_folder

SEARCHES, REGISTRY = "title string, lookup_year int", "doi string, title string, year int"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffle_files(spark)
    kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevens")
    deadline = time.time() + 20
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 7
    discard(kept)
    discard(spark.range(3))
    assert not [p for p in Path(shared_folder(spark).removeprefix("file:")).iterdir() if p.name.startswith("sevens-")]


@pytest.mark.parametrize("cell_words", [20, 1_000_000])
def test_searches_keep_only_answers_and_deal_each_search_once_at_a_time(spark, monkeypatch, cell_words):
    registry = [(f"10.1/{i:02d}", f"a b w{i} v{i % 5}", 2000 + i % 2) for i in range(40)]
    searches = [(f"a w{i} v{i % 3}", 2000) for i in range(40)]
    sizes, dealt = [], candidates._dealt

    def counted(terms, entries, wanted, grid):
        rows = dealt(terms, entries, wanted, grid)
        sizes.append(rows.where("search IS NOT NULL").count())
        return rows

    monkeypatch.setattr(candidates, "_dealt", counted)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    answers = candidates.best_candidate(
        spark.createDataFrame(searches, SEARCHES), spark.createDataFrame(registry, REGISTRY), cell_words=cell_words, by_words=True
    )
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["best"]
    assert set(sizes) == {40} and (len(sizes) > 1) == (cell_words == 20)
    details = spark.createDataFrame([(*r, [], "") for r in registry], f"{REGISTRY}, authors array<string>, venue string")
    found = candidates.attach_candidate(spark.createDataFrame([*searches, (None, 2000), ("?", None)], SEARCHES), answers, details)
    got = {r.title: (r.registry_doi, r.cr_title) for r in found.collect()}
    assert got.pop(None) == (None, None) and got.pop("?") == (None, None)
    assert got == {f"a w{i} v{i % 3}": (f"10.1/{i:02d}", f"a b w{i} v{i % 5}") for i in range(40)}
