"""The candidate search cuts each title into words once and reads few postings; titles are compared in step; arrivals leave only what is read again."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.functions import similarity
from citeweave.functions.text import strip_space
from citeweave.operators import candidates
from citeweave.session import shared_folder
from citeweave.sources import writers

from . import test_round4

SEARCHES, REGISTRY = "title string, lookup_year int", "doi string, title string, year int"


def test_titles_are_cut_into_words_once(spark, monkeypatch):
    plans, write = [], candidates.materialize

    def planned(df, name, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name, **options)

    monkeypatch.setattr(candidates, "materialize", planned)
    searches = spark.createDataFrame([("a b", 2000), ("B, a!", 2000), ("?", 2000), (None, 2000), ("c", None), ("a", 2000)], SEARCHES)
    registry = spark.createDataFrame([("10.1/z", "b a", 2001), ("10.1/y", "a b c", 2000), ("10.1/x", "...", 2000)], REGISTRY)
    found = candidates.best_candidate(searches, registry)
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    assert sum(plan.count("regexp_extract_all") for plan in plans) == 2
    got = {(r.title, r.lookup_year): r.doi for r in found.collect()}
    assert got == {
        ("a b", 2000): "10.1/y", ("B, a!", 2000): "10.1/y", ("?", 2000): None, (None, 2000): None, ("c", None): None, ("a", 2000): "10.1/y",
    }


@pytest.mark.parametrize("bits", [0, 5, 30])
@pytest.mark.parametrize("scale", [1, 200_000_000])
def test_index_finds_the_first_best_entry_in_any_steps(bits, scale):
    rng = random.Random(bits)
    weights = np.array([(30 - i) * scale for i in range(30)])
    entries = [sorted(rng.sample(range(30), rng.randint(1, 12))) for _ in range(80)]
    entries[0] = list(range(30))  # each word is in some entry
    index = candidates._Index(weights, np.concatenate(entries).astype(np.int32), np.array([len(e) for e in entries]), 30 - bits)
    for _ in range(150):
        search = np.array(sorted(rng.sample(range(30), rng.randint(1, 15))))
        scores = [int(weights[np.intersect1d(search, e)].sum()) for e in entries]
        best = (max(scores), scores.index(max(scores)))
        for lead, first, few in ((1, 1, 1), (4, 512, 48), (2, 40, 3)):
            assert index.best(search, 0, lead, first, few) == best
            assert index.best(search, best[0], lead, first, few) == best
            assert index.best(search, best[0] + 1, lead, first, few) is None


def test_a_copied_search_reads_the_rarest_word_only():
    # Words 1 to 3 are in all entries, word 0 in two of them.
    held = np.array([[0, 1, 2, 3], [0, 1, 2, 3]] + [[1, 1, 2, 3]] * 500).astype(np.int32)
    index = candidates._Index(np.array([9, 3, 2, 1]), held.ravel(), np.full(502, 4), 4)
    read = []
    index.rows = type("Rows", (), {"__getitem__": lambda _, part, rows=index.rows: read.append(part.stop - part.start) or rows[part]})()
    assert index.best(np.arange(4), 15) == (15, 0)
    assert read == [2]


def test_parts_of_a_publication_are_written_compressed(spark, tmp_path):
    rows = [(f"k{i % 5}", " ".join(f"word{j}" for j in range(300)), i) for i in range(50)]
    writers.write_extracted(spark.createDataFrame(rows, "id string, title string, part int").coalesce(1), str(tmp_path))
    written = spark.read.schema("id string, title string, part int").json(f"{tmp_path}/publications")
    assert sorted(map(tuple, written.collect())) == sorted(rows)
    assert sum(f.stat().st_size for f in (tmp_path / "publications").iterdir()) < sum(len(t) for _, t, _ in rows) / 4


def test_arrivals_leave_no_lines(spark, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    for name in ("a.csv", "b.csv", "1.csv", "2.csv"):
        test_round4.put(tmp_path, name)
    state = test_round4.arrive(spark, tmp_path)
    assert not [p.name for p in set(folder.iterdir()) - before if p.name.startswith("arrived-")]
    assert state.extracted(2).count() == 5
    assert all(".zstd." in f.name for f in (tmp_path / "tables").rglob("*.parquet"))


def test_titles_compared_in_step_as_one_by_one(monkeypatch):
    rng = random.Random(8)
    alphabets = ["ab", "abcdefgh ", "aé漢字😀x", "".join(map(chr, range(0x4E00, 0x5200)))]

    def text():
        return "".join(rng.choices(rng.choice(alphabets), k=rng.choice([0, 1, 2, 61, 62, 63, 124, 125, 300, 2100])))

    pairs = [(a := text(), text() if rng.random() < 0.6 else a[: len(a) // 2] + text()) for _ in range(300)]
    expected = [similarity.lcs_length(a, b) for a, b in pairs]
    monkeypatch.setattr(similarity, "TOGETHER", 0)
    for entries in (1 << 10, 1 << 21):
        monkeypatch.setattr(similarity, "TABLE", entries)
        assert similarity.lcs_lengths(pairs).tolist() == expected
    assert similarity.lcs_lengths([]).tolist() == []


def test_similarities_of_batches_stay_with_their_rows(spark):
    rows = [(f"title {i} {'x' * (i % 7)}", f"Title {i * 7 % 50} y" if i % 5 else None, i % 3 > 0) for i in range(400)]
    rows += [(" Same ", "same\u00a0", True), ("\u3000 ", "a", True), ("q", "q", True), ("q", "q", None), ("a", "B", True)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        df = spark.createDataFrame(rows, "a string, b string, ok boolean").repartition(2)
        got = df.select("a", "b", "ok", similarity.title_similarity(F.col("a"), F.col("b"), F.col("ok")).alias("s")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows)
    for r in got:
        a, b = (r.a or "").strip().lower(), (r.b or "").strip().lower()
        assert r.s == (2.0 * similarity.lcs_length(a, b) / (len(a) + len(b)) if r.ok and a and b else 0.0)


def test_white_space_is_what_the_pattern_says(spark):
    codes = spark.range(0x10FFFF).where("id NOT BETWEEN 55296 AND 57343 AND id > 0").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")
    )
    texts = codes.select(F.concat("c", "c", F.lit("a \n b"), "c", F.lit("\n"), "c").alias("t"))
    plain = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert texts.where(strip_space(F.col("t")) != plain).count() == 0
    assert texts.where(strip_space(F.col("t")) != F.col("t")).count() >= 25
    plan = spark.range(1).select(strip_space(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
