"""Scalar expressions against worked examples."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.functions import dates, errors, identifiers, matching, names, similarity, titles


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, normal, strict",
    [
        ("https://doi.org/10.1162/qss_a_00292", "10.1162/qss_a_00292", "10.1162/qss_a_00292"),
        ("10.1162/qss_a_00292", "10.1162/qss_a_00292", "10.1162/qss_a_00292"),
        ("", None, None),
        (None, None, None),
        ("None", None, None),
        ("DOI: 10.1/ABC", "10.1/abc", "10.1/abc"),
        ("doi:10.1/ABC", "doi:10.1/abc", "10.1/abc"),
        ("doi.org/doi.org/10.1/X", "doi.org/10.1/x", "doi.org/10.1/x"),
        (" 10.1/A ", " 10.1/a ", "10.1/a"),
    ],
)
def test_normalize_doi(spark, text, normal, strict):
    assert one(spark, identifiers.normalize_doi(F.col("d")), d=text) == normal
    assert one(spark, identifiers.normalize_doi(F.col("d"), strict_docs=True), d=text) == strict


def test_clean_doi(spark):
    bare = "10.1162/qss_a_00292"
    for text, expected in (("https://doi.org/" + bare, bare), (bare, bare), ("", "")):
        assert one(spark, identifiers.clean_doi(F.col("d")), d=text) == expected


@pytest.mark.parametrize(
    "title, other, ratio",
    [
        ("kitten", "sitting", 8 / 13),
        ("abc", "abc", 1.0),
        ("abcd", "wxyz", 0.0),
        ("ab", "ac", 0.5),
        ("", "abc", 0.0),
        (None, "abc", 0.0),
        (" ABC ", "abc", 1.0),
    ],
)
def test_title_similarity(spark, title, other, ratio):
    value = one(spark, similarity.title_similarity(F.col("a"), F.col("b")), a=title, b=other)
    assert value == pytest.approx(ratio)
    assert one(spark, similarity.title_valid(F.lit(ratio)), a="") == (ratio > 0.5)


def test_similarity_equals_native_form(spark):
    words = ["graph", "graphs of citations", "citation graph", "été", "e", "Ab C", "the study of x"]
    pairs = [(a, b) for a in words for b in words]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a",
        "b",
        similarity.title_similarity(F.col("a"), F.col("b")).alias("s"),
        similarity.title_similarity_native(F.col("a"), F.col("b")).alias("n"),
    )
    values = {(r.a, r.b): (r.s, r.n) for r in df.collect()}
    for (a, b), (s, n) in values.items():
        assert s == pytest.approx(n)
        assert 0 <= s <= 1 and s == pytest.approx(values[(b, a)][0])
        assert (s == 1.0) == (a.lower() == b.lower())


@settings(max_examples=200, deadline=None)
@given(st.text("abcé ", max_size=40), st.text("abcé ", max_size=40))
def test_lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert similarity.lcs_length(a, b) == row[-1]


@pytest.mark.parametrize(
    "year, other, valid, difference",
    [
        ("2008", "2008", True, 0),
        ("2008", "2009", False, 1),
        ("2008.0", "2008", False, None),
        (" 2008 ", "2008", True, 0),
        (None, "2008", False, None),
        ("0", "2008", False, None),
        ("2008", None, False, None),
    ],
)
def test_year_check(spark, year, other, valid, difference):
    pair = F.col("a"), F.col("b")
    assert one(spark, dates.year_valid(*pair), a=year, b=other) == valid
    assert one(spark, dates.year_difference(*pair), a=year, b=other) == difference


@pytest.mark.parametrize(
    "text, looked_up, parsed, prefix",
    [
        ("2018-02", 2020, 2018, 2018),
        ("x2018", 2020, None, None),
        ("", 2020, None, None),
        ("1", 2020, None, 1),
        ("2011", 2011, 2011, 2011),
        ("20", 20, None, 20),
        ("n.d.", 2020, None, None),
        (None, 2020, None, None),
    ],
)
def test_years(spark, text, looked_up, parsed, prefix):
    assert one(spark, dates.lookup_year(F.col("y")), y=text) == looked_up
    assert one(spark, dates.parse_year(F.col("y")), y=text) == parsed
    assert one(spark, dates.year_prefix(F.col("y")), y=text) == prefix


@pytest.mark.parametrize(
    "field, expected",
    [
        ("Shi Wei,; Ma Xiang-Rong,; 1Department of X; Smith, Alice", ["Shi Wei", "Ma Xiang-Rong", "Alice Smith"]),
        ("Smith, Susan", []),
        ("Rossi, Mario, 0000-0001-2345-6789", []),
        ("Li; Xu B", ["Xu B"]),
        ("A" * 51, []),
        ("Doe,  Jane   Q", ["Jane Q Doe"]),
        (", Solo", ["Solo"]),
        (None, []),
    ],
)
def test_parse_author_string(spark, field, expected):
    assert one(spark, names.parse_author_string(F.col("f"))["name"], f=field) == expected


def test_whole_word_affiliations(spark):
    parsed = names.parse_author_string(F.col("f"), whole_word=True)["name"]
    assert one(spark, parsed, f="Smith, Susan; UK Office") == ["Susan Smith"]


def test_parse_author_orcid(spark):
    field = "Rossi, M [omid:ra/1 orcid:0000-0001-2345-678X]; Bi, L [omid:ra/2]"
    (author,) = one(spark, names.parse_author_orcid(F.col("f")), f=field)
    assert author.asDict() == {"name": "Rossi, M", "orcid": "0000-0001-2345-678X", "org": ""}


@pytest.mark.parametrize(
    "name, key",
    [
        ("J. Doe", "j_doe"),
        ("J.K. Rowling", "j_rowling"),
        ("Plato", "unknown_plato"),
        ("!!!", "unknown_unknown"),
        ("", "unknown_unknown"),
        ("Haifeng Qian", "haifeng_qian"),
        ("José  María Müller", "josé_müller"),
        ("Xiang - Rong Ma", "xiang-rong_ma"),
        ("O'Neil B", "oneil_b"),
        ("_ _", ""),
        ("a" * 120, ("unknown_" + "a" * 120)[:100]),
    ],
)
def test_normalize_author_name(spark, name, key):
    assert one(spark, names.normalize_author_name(F.col("n")), n=name) == key


def test_keywords(spark):
    title = "A Study of Citation Networks and citation graphs"
    assert one(spark, titles.keywords_distinct(F.col("t")), t=title) == ["citation", "networks", "graphs"]
    assert one(spark, titles.keywords_all(F.col("t")), t=title) == ["study", "citation", "networks", "citation", "graphs"]
    assert one(spark, titles.keywords_distinct(F.col("t")), t="énergie noire") == ["noire"]


def test_retryable(spark):
    for text, plain, http in (
        ("Timeout", True, True), ("ConnectionError", True, True), ("HTTP_429", False, True),
        ("HTTP_503", False, True), ("HTTP_404", False, False), (None, False, False),
    ):
        assert one(spark, errors.is_retryable(F.col("e")), e=text) == plain
        assert one(spark, errors.is_retryable(F.col("e"), retry_http=True), e=text) == http


def test_three_ways_of_being_correct(spark):
    pair = F.col("g"), F.col("r")
    assert one(spark, matching.is_correct_for_tuning(*pair), g="", r="None") is False
    assert one(spark, matching.is_correct_for_holdout(*pair), g="", r="None") is True
    assert one(spark, matching.is_correct_for_holdout(*pair), g=None, r=None) is False
    assert one(spark, matching.is_correct_direct(*pair, F.lit(False)), g="10.1/A", r="10.1/a") is False


def test_lookup_key_and_tokens(spark):
    assert one(spark, identifiers.lookup_key(F.col("t"), F.col("y")), t="T", y=None) == "T_None"
    assert one(spark, identifiers.first_token(F.col("t")), t="  omid:br/1 doi:2") == "omid:br/1"
    assert one(spark, identifiers.first_token(F.col("t")), t="") == ""
