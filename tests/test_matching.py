"""Candidate search, cutoffs and evaluation."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from citeweave.operators import bulk, candidates, evaluate, validate
from citeweave.plans import jobs

SCORED = [(10.0, False, True), (20.0, True, True), (30.0, False, True), (40.0, True, False), (50.0, True, True)]


def brute_force(searches, registry):
    """Best record by summed weight of shared words, over all pairs."""
    words = lambda t: set(re.findall(r"\w+", t.lower()))
    df = Counter(w for _, t, _ in registry for w in words(t))
    n = len(registry)
    weight = {w: round(math.log(1 + (n - c + 0.5) / (c + 0.5)) * 1e6) for w, c in df.items()}
    out = {}
    for title, year in searches:
        best = None
        for doi, other, y in registry:
            if year <= y <= year + 1:
                score = sum(weight[w] for w in words(title) & words(other))
                if score and (best is None or (-score, doi) < best):
                    best = (-score, doi)
        out[title, year] = (best[1], -best[0] / 1e6) if best else (None, 0.0)
    return out


def skewed_titles(rng, n):
    """A third of all titles are copies, and two words are in nearly all of them."""
    rare = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        if rng.random() < 1 / 3:
            out.append("the of common copy")
        else:
            hot = [w for w in ("the", "of", "and", "in") if rng.random() < 0.8]
            out.append(" ".join(hot + rng.sample(rare, rng.randint(0, 4))) or "empty")
    return out


@pytest.mark.parametrize("hot_rows, lead_words", [(0, 1), (2, 1), (10, 2), (60, 4), (10_000, 4)])
def test_best_candidate_is_exact(spark, hot_rows, lead_words):
    rng = random.Random(hot_rows)
    registry = [(f"10.1/{i:04d}", t, 2000 + rng.randint(0, 3)) for i, t in enumerate(skewed_titles(rng, 250))]
    searches = sorted({(t, 2000 + rng.randint(0, 3)) for t in skewed_titles(rng, 200)} | {("nothing shared", 2000), ("the of", 2001)})
    found = candidates.best_candidate(
        spark.createDataFrame(searches, "title string, lookup_year int"),
        spark.createDataFrame(registry, "doi string, title string, year int"),
        hot_rows=hot_rows,
        lead_words=lead_words,
    )
    got = {(r.title, r.lookup_year): (r.doi, r.score) for r in found.collect()}
    expected = brute_force(searches, registry)
    assert got.keys() == expected.keys()
    for key, (doi, score) in expected.items():
        assert got[key][0] == doi, key
        assert got[key][1] == pytest.approx(score)


def test_bulk_validation_equals_brute_force(spark):
    rng = random.Random(7)
    registry = [(f"10.1/{i:03d}", t, 2000 + i % 3, [], "v") for i, t in enumerate(skewed_titles(rng, 60))]
    pubs = [(f"k{i}", t if i % 9 else "", str(2000 + i % 3)) for i, t in enumerate(skewed_titles(rng, 60))]
    out = jobs.bulk_validate(
        spark.createDataFrame(pubs, "key string, title string, year string"),
        spark.createDataFrame(registry, "doi string, title string, year int, authors array<string>, venue string"),
        F.lit(2.0),
        hot_rows=5,
    )
    best = brute_force({(t, int(y)) for _, t, y in pubs if t}, [r[:3] for r in registry])
    by_doi = {r[0]: r for r in registry}
    got = {r.key: r for r in out.collect()}
    assert len(got) == len(pubs)
    for key, title, year in pubs:
        code = "no_title"
        if title:
            doi, score = best[title, int(year)]
            code = "low_score"
            if score >= 2.0:
                other = by_doi[doi]
                lcs = _lcs(title, other[1])
                good = 2 * lcs / (len(title) + len(other[1])) > 0.5 and other[2] == int(year)
                code = None if good else "invalid"
        assert got[key].code == code
        assert got[key].status == ("rejected" if code else "validated")


def _lcs(a, b):
    table = defaultdict(int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i, j] = table[i - 1, j - 1] + 1 if x == y else max(table[i - 1, j], table[i, j - 1])
    return table[len(a) - 1, len(b) - 1]


def scored(spark):
    return spark.createDataFrame(SCORED, "score double, is_correct boolean, on_registry boolean")


@pytest.mark.parametrize("buckets", [2, 3, 200])
def test_cutoff_sweep(spark, buckets):
    sweep = evaluate.cutoff_sweep(scored(spark), buckets)
    rows = {r.cutoff: (r.tp, r.fp, r.tn, r.fn, round(r.accuracy, 6)) for r in sweep.collect()}
    assert rows == {
        10.0: (3, 2, 0, 0, 0.6), 20.0: (3, 1, 1, 0, 0.8), 30.0: (2, 1, 1, 1, 0.6),
        40.0: (2, 0, 2, 1, 0.8), 50.0: (1, 0, 2, 2, 0.6),
    }
    assert evaluate.best_cutoff(sweep).first().cutoff == 20.0
    assert evaluate.best_cutoff(sweep, manual=35).first().cutoff == 35.0
    for cutoff in rows:
        at = evaluate.confusion_at(scored(spark), F.lit(cutoff)).first()
        assert (at.tp, at.fp, at.tn, at.fn) == rows[cutoff][:4]


def test_sweep_over_skewed_scores(spark):
    rng = random.Random(3)
    rows = [(float(rng.choice([5, 5, 5, rng.randint(0, 400)])), rng.random() < 0.5) for _ in range(1500)]
    df = spark.createDataFrame(rows, "score double, is_correct boolean")
    for r in evaluate.cutoff_sweep(df, 16).collect():
        assert r.tp == sum(s >= r.cutoff and c for s, c in rows)
        assert r.fp == sum(s >= r.cutoff and not c for s, c in rows)
        assert r.fn == sum(s < r.cutoff and c for s, c in rows)


def test_no_cutoff_is_right(spark):
    df = spark.createDataFrame([(1.0, False)], "score double, is_correct boolean")
    assert evaluate.best_cutoff(evaluate.cutoff_sweep(df)).first().cutoff == 0.0


def test_wrong_matches(spark):
    assert [r.score for r in evaluate.wrong_matches(scored(spark), F.lit(20.0)).collect()] == [30.0]


def test_holdout_matrices(spark):
    rows = [
        ("d1", 50.0, True, True), ("d2", 50.0, True, False), ("d3", 50.0, False, True), ("d4", 35.0, False, False),
        ("d5", 20.0, True, True), ("d6", 20.0, True, False), ("d7", 20.0, False, True), (None, 0.0, None, None),
    ]
    df = spark.createDataFrame(rows, "registry_doi string, score double, is_correct boolean, is_valid_match boolean")
    r = evaluate.evaluate_holdout(df, F.lit(35.0)).first()
    assert (r.total, r.with_result, r.tp, r.fp, r.tn, r.fn) == (8, 7, 2, 2, 1, 2)
    assert (r.tp_valid, r.fp_valid, r.tn_valid, r.fn_valid) == (1, 1, 4, 1)
    empty = evaluate.evaluate_holdout(df.where("registry_doi IS NULL"), F.lit(35.0)).first()
    assert empty.accuracy is None and empty.f1_valid is None
    direct = evaluate.evaluate_direct(df.withColumn("is_correct", F.expr("is_correct AND is_valid_match")), F.lit(35.0)).first()
    assert (direct.tp, direct.fp, direct.tn, direct.fn) == (1, 3, 2, 1)


def test_match_details(spark):
    rows = [("kitten", "2008", "sitting", 2008, "d"), ("ab", "2008", "ac", 2008, "d"), ("abc", "2008", "abc", 2009, "d"), ("abc", "2008", None, None, None)]
    df = spark.createDataFrame(rows, "meta_title string, meta_year string, cr_title string, cr_year int, registry_doi string")
    out = validate.expand_details(validate.add_match_details(df)).collect()
    assert [r.is_valid_match for r in out] == [True, False, False, False]
    assert [r.author_valid for r in out] == [True, True, True, False]


def test_bulk_outcomes(spark):
    rows = [
        ("a", "", None, 0.0, False, None), ("b", "T", "10.1/B", 34.9, False, None), ("c", "T", "DOI:10.1/C", 35.0, True, None),
        ("d", "T", "10.1/D", 60.0, False, None), ("e", "T", None, 0.0, False, "Timeout"),
    ]
    df = spark.createDataFrame(rows, "key string, title string, registry_doi string, score double, is_valid_match boolean, error string")
    out = {r.key: r for r in bulk.bulk_outcomes(df, F.lit(35.0)).collect()}
    assert [out[k].status for k in "abcde"] == ["rejected", "rejected", "validated", "rejected", "error"]
    assert out["a"].reason == "No title found" and out["b"].reason == "Score 34.9 below cutoff 35.0"
    assert out["c"].doi == "10.1/c" and out["e"].error == "Timeout"
    counts = bulk.outcome_counts(bulk.bulk_outcomes(df, F.lit(35.0))).first()
    assert counts.total == counts.validated + counts.rejected + counts.error == 5
