"""Operators on documents against plain versions, with odd and empty inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, jaccard, lines, quality

from . import brute
from .conftest import by_id, made_docs

ITEMS = [
    (7, "bead dead fade cafe deaf head heed feed deed abed bade babe"), (8, "Short Item"), (9, None), (10, ""), (11, "..."),
    (12, "short item"), (13, "bade babe ebb add bag gab cab dab fab had bah dah aha"),
]


def test_quality_measurements(frame, docs):
    found = quality.ledger(frame, "doc_id", "failures").withColumn("base", quality.fails(F.lit(0).cast("long"), "base"))
    assert found.columns[:2] == ["doc_id", "failures"]
    entries = quality.ledger(frame)
    got = by_id(
        entries.withColumn("base", quality.fails(F.col("failures"), "base")),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base",
    )
    assert got == brute.quality(docs)


def test_quality_policies_and_ablations(spark, frame, empty):
    entries = quality.ledger(frame)
    kept = quality.kept_documents(frame, "v1")
    assert kept.columns == frame.columns
    rejected = entries.where(quality.fails(F.col("failures"), "v1")).count()
    assert kept.count() == frame.count() - rejected
    rows = {(r.policy, r.rule): r for r in quality.ablations(entries).collect()}
    assert rows["v1", "few_words"].rejected == rejected
    few = entries.where("failures = 1").count()
    assert rows["v1", "few_words"].only_this == few
    assert rows["v1", "few_words"].rejected_without == rejected - few
    assert quality.ledger(empty).count() == 0
    assert {r.rejected for r in quality.ablations(quality.ledger(empty)).collect()} == {0}


def test_quality_plan_is_native(frame):
    plan = quality.ledger(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("RepartitionByExpression")[0][:0]


def _deduplicated(df):
    found = lines.deduplicated(df).select("doc_id", f"`{lines.FOUND}`.*")
    return found.withColumn("sha", F.sha2(F.col("kept_text").cast("binary"), 256))


def test_line_dedup(frame, docs, empty):
    assert by_id(_deduplicated(frame), "n_lines", "n_dropped", "sha") == brute.line_dedup(docs)
    assert _deduplicated(empty).count() == 0
    clean = lines.clean_documents(frame)
    assert clean.columns == frame.columns
    assert 1001 in {r.doc_id for r in clean.collect()}


def test_line_index_is_reversible(spark, frame):
    """Insert three batches, take one out again, in any order: the state is that of the rest."""
    keyed = lines.keyed_lines(frame)
    part = F.pmod(F.col("doc_id"), F.lit(3))
    a, b, c = (keyed.where(part == k) for k in range(3))
    index = lines.LineIndex.empty(spark, 40).insert(a).insert(b).insert(c).insert(b)
    index = index.delete(b.select("doc_id"))
    plain = lines.LineIndex.empty(spark, 40).insert(c).insert(a)

    def state(x, name):
        return sorted(map(tuple, getattr(x, name).collect()))

    for name in ("postings", "counts"):
        assert state(index, name) == state(plain, name)
    held = {r.shard: lines.CuckooFilter(r.n_buckets, bytes(r.slots)) for r in index.filters.collect()}
    for r in plain.counts.toPandas().groupby("shard"):
        assert held[r[0]].may_hold(r[1]["lo"].to_numpy(), r[1]["hi"].to_numpy()).all()
    assert sum(int((f.table > 0).sum()) for f in held.values()) == plain.counts.count()


def test_line_index_saved(spark, frame, tmp_path):
    index = lines.LineIndex.empty(spark, 10).insert(lines.keyed_lines(frame))
    index.save(str(tmp_path))
    again = lines.LineIndex.load(spark, str(tmp_path))
    assert again.n_shards == index.n_shards and again.counts.count() == index.counts.count()


def test_cuckoo_filter_grows_when_full():
    import numpy as np

    lo, hi = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, (2, 4000))
    small = lines.CuckooFilter(64)
    assert not small.insert(lo, hi)
    made = lines._filled(lo, hi)
    assert made.may_hold(lo, hi).all()
    other = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, (2, 4000))
    assert made.may_hold(*other).mean() < 0.01


def test_jaccard(frame, docs, empty):
    found = jaccard.jaccard_components(frame)
    assert by_id(found, "n_shingles", "component_id") == brute.jaccard(docs)
    assert jaccard.jaccard_components(empty).count() == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_jaccard_blocks_and_tiny_sets(spark, monkeypatch, seed):
    """Short texts, where segments run short, and runs that are compared block by block."""
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = [(i, " ".join((t or "").split()[:30])) for i, t in made_docs(90, seed)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(jaccard.jaccard_components(df), "n_shingles", "component_id") == brute.jaccard(rows)


def test_jaccard_of_unlike_texts(spark):
    """Buckets in which no two texts share anything."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(9))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(jaccard.jaccard_components(df), "component_id") == {i: (i,) for i in range(5)}


def test_jaccard_clean_documents(frame, docs):
    want = {i for i, (_, c) in brute.jaccard(docs).items() if i == c}
    clean = jaccard.clean_documents(frame)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == want


def test_index_entries_meet_for_every_linked_pair():
    """The pigeonhole itself: linked sets share an entry, whatever the sizes."""
    import numpy as np

    rng = np.random.default_rng(5)
    windows, bits = jaccard.Windows(75), np.zeros(1 << jaccard._FREQUENT_BITS, bool)
    for _ in range(600):
        size = int(rng.integers(1, 60))
        base = rng.integers(0, 1 << 63, size, np.uint64)
        off = int(rng.integers(0, size // 4 + 1))
        extra = rng.integers(0, 1 << 63, int(rng.integers(0, size // 6 + 1)), np.uint64)
        a, b = np.unique(base), np.unique(np.concatenate([base[off:], extra]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common):
            entries = [set(jaccard.index_entries(x, windows, bits).tolist()) for x in (a, b)]
            assert entries[0] & entries[1]


def _items(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("shard", [200_000, 5])
def test_contamination(spark, shard):
    docs = [
        (1, "BEAD, dead fade-cafe deaf head; heed feed deed abed bade babe and more"), (2, "a short item and a short item"),
        (3, None), (4, ""), (5, "dead fade cafe deaf head heed feed deed abed"), (6, "clean text of some words"),
        (7, "x bade babe ebb add bag gab cab dab fab had bah dah aha y bead dead fade cafe deaf head heed feed deed abed"),
        (8, "shortitem short-item"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.digest(decontaminate.contamination(df, _items(spark), shard_windows=shard))
    want = brute.contamination(docs, ITEMS)
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    clean = decontaminate.clean_documents(df, _items(spark), shard_windows=shard)
    assert {r.doc_id for r in clean.collect()} == {i for i, w in want.items() if not w[4]}


def test_contamination_of_odd_documents(spark, frame, docs, empty):
    items = [(1, docs[0][1]), (2, docs[3][1]), (3, "one")]
    found = decontaminate.digest(decontaminate.contamination(frame, _items(spark, items)))
    want = brute.contamination(docs, items)
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    assert decontaminate.contamination(empty, _items(spark)).count() == 0
    none = decontaminate.digest(decontaminate.contamination(frame, _items(spark).where("false")))
    assert none.where("contaminated").count() == 0 and none.count() == len(docs)


def test_jaccard_of_one_id_with_different_texts(spark):
    """Links are verified on the text that made them, and a row goes by its own text."""
    words = [f"w{k}" for k in range(40)]
    text, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(f"v{k}" for k in range(30))
    df = spark.createDataFrame([(5, other), (5, text), (7, near), (3, other), (9, None)], "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert found == {(5, 26, 3), (5, 36, 5), (7, 37, 5), (3, 26, 3), (9, 0, 9)}
    kept = {(r.doc_id, r.text) for r in jaccard.clean_documents(df).collect()}
    assert kept == {(5, text), (3, other), (9, None)}
