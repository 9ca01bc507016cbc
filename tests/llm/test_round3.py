"""Periodic runs, vector codes and weighted fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, lines, periodic_runs, queries, vector_codes, weighted_prints
from citeweave.llm import jaccard as ngram_join
from citeweave.session import materialize

from . import brute
from .conftest import made_docs


def plain_runs(words, repeats=4, least=6):
    found = {}
    for p in range(1, len(words) // repeats + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, repeats * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in found.items())


def collapsed(words, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_with_covers_of_all_sizes():
    rng = random.Random(7)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n = rng.choice([0, 1, 3, 5, 6, 10, 30, 100, 300])
            words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(list(texts[-1]) if texts and rng.random() < 0.3 else words)
        want = [plain_runs(w) for w in texts]
        for modulus, cover in ((31, periodic_runs.COVER), (7, (1, 2, 4)), (3, (0, 1)), (1, (0,))):
            found = periodic_runs.runs_of([np.array(w, np.int64) for w in texts], modulus=modulus, cover=cover)
            assert [[tuple(r) for r in x.tolist()] for x in found] == want
    with pytest.raises(ValueError):
        periodic_runs.runs_of([np.zeros(9, np.int64)], modulus=5, cover=(0,))


def test_runs_of_a_very_long_text():
    words = np.arange(400_000)
    words[1000:301_000] = words[1000 + np.arange(300_000) % 70_001]
    words[350_000:350_006] = 5
    (runs,) = periodic_runs.runs_of([words])
    assert runs.tolist() == [[1000, 300_000, 70_001], [350_000, 6, 1]]


def test_periodic_runs_of_documents(frame, empty, docs):
    extra = [(2001, "a b " * 40), (2002, "x " * 6 + "y z " * 4 + "Y z"), (2003, ("p q r\n" * 5 + "s ") * 5), (2001, None)]
    spark = frame.sparkSession
    df = frame.unionByName(spark.createDataFrame([(i, t, 0, "x", 1) for i, t in extra], frame.schema))
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.periodic_runs(df).collect())
    want = Counter()
    for doc_id, text in [*docs, *extra]:
        words = brute.WORD.findall(text or "")
        runs = plain_runs(words)
        want[doc_id, len(words), tuple(runs), collapsed(words, runs)] += 1
    assert got == want
    assert periodic_runs.periodic_runs(empty).count() == 0


def test_op11_query(spark, tmp_path):
    rows = made_docs(200, 5) + [(i, "word " * (i % 7) + f"{i} other") for i in range(3000, 3200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for doc_id, text in rows:
        words = brute.WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        assert got[doc_id] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        ), doc_id
    assert planted > 20


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and None not in v and all(map(math.isfinite, v))]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, found, strict=True) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = Counter()
    for (i, _, label), a in zip(kept, assigned(), strict=True):
        out[i, label, "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)] += 1
    return out, books


@pytest.mark.parametrize("spread", [1.0, 1e5])
def test_vector_codes(spark, spread):
    """A third of all vectors is one and the same, with tied entries, small owners and values of both signs."""
    rng = random.Random(11)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * spread for _ in range(8)], rng.choice([None, 1, 2])) for i in range(240)]
    rows += [(1000 + i, list(rows[5][1]), 3) for i in range(120)] + [(i + 2000, list(rows[i][1]), None) for i in range(30)]
    rows += [(5000, None, 1), (5001, [0.5, None] + [0.1] * 6, 1), (5002, [float("nan")] * 8, 2), (5003, [float("inf")] + [0.0] * 7, 2)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame(
        [(i, v, label, 0, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, row int, code string"
    ).repartition(3)
    made = vector_codes.code(df, entries=20, owned=50)
    want, books = plain_codes(rows, entries=20)
    assert made.codebooks.tolist() == books
    assert Counter(tuple(r) for r in made.codes.select("vec_id", "label", "code", "error").collect()) == want
    sums = Counter()
    for (_, label, _, error), n in want.items():
        sums[label] += error * n
    assert {(r.label, r.label_error) for r in vector_codes.label_errors(made.codes).collect()} == set(sums.items())


def test_vector_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none = vector_codes.code(spark.createDataFrame([(1, None, 1)], schema))
    assert none.codes.count() == 0 and none.codebooks.shape[1] == 0
    assert vector_codes.label_errors(none.codes).count() == 0
    # Other lengths go, lengths that 4 doesn't divide are filled up, beyond the bound values are held.
    rows = [(2, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (3, [1.0], 1), (None, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (4, [3e38, -3e38, 0.0, 0.0, 0.0], None)]
    made = vector_codes.code(spark.createDataFrame(rows, schema), entries=2, rounds=1)
    assert {(r.vec_id, r.label) for r in made.codes.collect()} == {(2, 1), (None, 1), (4, None)}
    assert made.codebooks.shape == (4, 2, 2) and abs(made.codebooks).max() <= vector_codes.bound(5)
    blank = vector_codes.code(spark.createDataFrame([(1, [], 1)], schema))
    assert [tuple(r) for r in blank.codes.collect()] == [(1, 1, "00000000", 0)]


def test_only_parts_that_change_migrate(spark, monkeypatch):
    """The tables of arrivals hold members with a new entry and nothing else."""
    written = {}

    def kept(df, name):
        written[name] = materialize(df, name)
        return written[name]

    monkeypatch.setattr(vector_codes, "materialize", kept)
    vector_codes.code(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), entries=16)
    sizes = []
    for number in range(vector_codes.ROUNDS):
        arrivals = written[f"arrivals-{number}"]
        assert arrivals.where("not moved").count() == 0
        sizes.append(arrivals.count())
    assert sizes[0] == written["members-0"].count() == 2000 and max(sizes[1:]) < 1000


def jaccard(a, b):
    a, b = (Counter(brute.WORD.findall(brute.lower(x))) for x in (a, b))
    both = set(a) | set(b)
    more = sum(max(a[k], b[k]) for k in both)
    return sum(min(a[k], b[k]) for k in both) / more if more else 1.0


def test_collisions_estimate_generalised_jaccard():
    """Over many samples the share of equal ones is the similarity, weights included."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    pairs = []
    for _ in range(12):
        a = [rng.choice(words) for _ in range(rng.choice([20, 80, 300]))]
        b = a[: rng.randrange(len(a))] + [rng.choice(words) for _ in range(rng.choice([0, 10, 200]))]
        pairs.append((" ".join(a), " ".join(b)))
    pairs += [("a " * 9 + "b", "a " * 3 + "b"), ("x y", "X\ty"), ("one", "two"), ("", " ")]
    draws = weighted_prints.Draws(4096)
    one, other = (weighted_prints.prints([p[k].encode() for p in pairs], draws) for k in (0, 1))
    for (a, b), share in zip(pairs, (one == other).mean(axis=1), strict=True):
        s = jaccard(a, b)
        assert abs(share - s) <= 4.5 * math.sqrt(max(s * (1 - s), 1e-4) / 4096), (a, b, s, share)


def test_prints_do_not_depend_on_neighbours():
    """A text has one fingerprint whatever slice it stands in, with more terms than a block holds too."""
    draws = weighted_prints.Draws(8)
    long = " ".join(f"t{i}" for i in range(70_000)).encode()
    texts = [b"a b a", b"", long, None, b"b a a", b"c"]
    together = weighted_prints.prints(texts, draws)
    for text, found in zip(texts, together, strict=True):
        assert (weighted_prints.prints([text], draws)[0] == found).all()
    assert (together[0] == together[4]).all() and not together[1].any() and not together[3].any()


def test_edited_texts_over_ranges(spark, empty, tmp_path):
    rows = made_docs(150, 9) + [(None, "no id"), (3, "three again"), (7, None), (7, None), (7, "x")]
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, range int, hash string").repartition(5)
    hashes = {t: h for t, h in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((i is not None, i or 0, hashes[t or ""], t or "") for i, t in rows))
    texts = [t for *_, t in order]
    want = Counter()
    for (known, doc_id, _, text), following in zip(order, texts[1:] + texts[:1], strict=True):
        q = len(text) // 4
        want[doc_id if known else None, text, text[: len(text) - q] + following[:q], following] += 1
    prints = {}
    for r in weighted_prints.fingerprints(df.select("doc_id", "text"), 16).join(df.select("doc_id", "text"), "doc_id").collect():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    for range_bytes in (1 << 26, 3000):
        found = weighted_prints.with_edited(df, samples=16, range_bytes=range_bytes).collect()
        assert Counter((r.doc_id, r.text, r.edited) for r in found) == Counter({k[:3]: 0 for k in want}) + sum(
            (Counter({k[:3]: n}) for k, n in want.items()), Counter()
        )
        assert all(r.fingerprint in prints[r.doc_id] for r in found if r.doc_id is not None)
        by_text = {r.text: r.fingerprint for r in found}
        assert Counter((r.doc_id, r.text, r.edited, r.next_fingerprint) for r in found) == sum(
            (Counter({(*k[:3], by_text[k[3]]): n}) for k, n in want.items()), Counter()
        )
    assert weighted_prints.with_edited(empty).count() == 0
    one = weighted_prints.with_edited(spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")).first()
    assert one.edited == "abcd efab" and one.next_fingerprint == one.fingerprint


def test_op13_query(spark):
    rows = {r.doc_id: r for r in queries.op13_weighted_prints(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    off = []
    for d, e in zip(docs, docs[1:] + docs[:1], strict=True):
        text, following, r = d.text or "", e.text or "", rows[d.doc_id]
        edited = weighted_prints.tail_replaced(text, following)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
    assert np.abs(off).mean() < 0.04 and abs(np.mean(off)) < 0.01 and np.abs(off).max() < 0.25


@pytest.mark.parametrize("shard", [200_000, 3])
def test_contamination_per_row_whatever_the_shards(spark, shard):
    """Rows that share an id, or have none, are answered each."""
    items = [(1, "a b c d e f g h i j k"), (2, "short item"), (3, "b c d e f g h i j k l m n")]
    docs = [(5, "x a b c d e f g h i j y"), (5, "short item here"), (5, "short item here"), (None, "clean"), (None, "b c d e f g h i j k l")]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(2),
        spark.createDataFrame(items, "item_id long, text string"),
        shard_windows=shard,
    )
    rows = Counter(tuple(r)[:3] for r in decontaminate.digest(found).select("doc_id", "n_words", "n_hit").collect())
    assert rows == Counter({(5, 12, 10): 1, (5, 3, 2): 2, (None, 1, 0): 1, (None, 11, 11): 1})


def test_stages_keep_columns_of_any_name(spark):
    """Names with dots, blanks and quotes, and names the stages use themselves."""
    rows = [(1, "the same long line\nown line one", 1, "x", 2, 3), (2, "the same long line\nother", 4, "y", 5, 6), (3, None, 7, None, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, `dropped lines` string, `q``r` int, n_dropped int")
    kept = lines.clean_documents(df)
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {rows[0], (2, "other", *rows[1][2:]), (3, "", *rows[2][2:])}
    apart = ngram_join.clean_documents(df.unionByName(spark.createDataFrame([(9, *rows[0][1:])], df.schema)))
    assert apart.columns == df.columns
    assert {tuple(r) for r in apart.collect()} == set(rows)
