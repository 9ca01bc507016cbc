"""Queries on matching titles to the registry, cutoffs and evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from citeweave.functions.dates import lookup_year
from citeweave.functions.fixed_values import ERROR_EMPTY_ANSWER, ERROR_NO_TITLE
from citeweave.functions.identifiers import normalize_doi
from citeweave.functions.similarity import title_similarity as similarity
from citeweave.functions.similarity import title_valid as above_threshold
from citeweave.operators import candidates, evaluate, validate
from citeweave.plans import jobs, views
from citeweave.plans.registered import SQL, query, six
from citeweave.plans.view_sql import (
    BEST,
    LCS,
    LINES,
    PAGES,
    RATES,
    SCORED,
    SCORED_LINES,
    SWEEP,
    attached,
    doi_sql,
    with_,
    words,
    year_sql,
)
from citeweave.session import by_key, shared_folder
from citeweave.sources.writers import write_wrong_matches

_WANTED = f"""
wanted AS (SELECT title, {year_sql('year')} AS lookup_year FROM publications WHERE title <> '')"""
_WANTED_LINES = "\nwanted AS (SELECT title, year AS lookup_year FROM lines)"


def _sources(spark, d):
    """Labelled rows with their registry flag, publications, registry."""
    registry = views.registry(spark, d)
    gold = views.gold(spark, d)
    held = registry.select(F.col("doi").alias("_doi"))
    flagged = gold.join(
        by_key(held), normalize_doi(F.col("doi")) == F.lower("_doi"), "left"
    ).select(*gold.columns, F.col("_doi").isNotNull().alias("on_registry"))
    return flagged, views.publications(spark, d), registry


@query(
    with_(PAGES, _WANTED, BEST)
    + """SELECT DISTINCT w.title, w.lookup_year, doi, coalesce(score, 0) AS score
    FROM wanted w LEFT JOIN best b ON w.title = b.title AND w.lookup_year = b.lookup_year"""
)
def best_candidate(spark, d):
    asked = views.publications(spark, d).where("title <> ''").select(
        "title", lookup_year(F.col("year")).alias("lookup_year")
    )
    return candidates.best_candidate(asked, views.registry(spark, d))


@query(
    with_(LINES, _WANTED_LINES, BEST)
    + """SELECT DISTINCT w.title, w.lookup_year, doi, coalesce(score, 0) AS score
    FROM wanted w LEFT JOIN best b ON w.title = b.title AND w.lookup_year = b.lookup_year"""
)
def best_candidate_lines(spark, d):
    """Every line of every document searched for among the lines of the labelled ones."""
    asked = views.lines(spark, d).select("title", F.col("year").alias("lookup_year"))
    return candidates.best_candidate(asked, views.line_registry(spark, d))


@query(
    with_(PAGES, _WANTED)
    + f"""SELECT w.lookup_year, r.year, count(*) AS pairs FROM (SELECT DISTINCT title, lookup_year FROM wanted) w
    JOIN registry r ON r.year BETWEEN w.lookup_year AND w.lookup_year + 1 AND r.title = w.title GROUP BY ALL"""
)
def year_range_join(spark, d):
    """The range condition as an equi-join on exploded years, next to an equal title."""
    asked = views.publications(spark, d).where("title <> ''").select(
        "title", lookup_year(F.col("year")).alias("lookup_year")
    ).distinct()
    years = asked.withColumn("year", candidates.searched_years())
    return (
        years.join(views.registry(spark, d).select("title", "year"), ["title", "year"])
        .groupBy("lookup_year", "year")
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


@query(
    with_(PAGES)
    + f"""SELECT r.title, arg_max(r.doi, (len({words('r.title')}), r.doi)) AS doi FROM registry r GROUP BY r.title"""
)
def top1_per_record(spark, d):
    n_words = F.size(F.regexp_extract_all(F.lower("title"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    ranked = views.registry(spark, d).select("title", "doi", n_words.alias("n"))
    return candidates.rerank_by(ranked, F.col("n"), F.col("doi"), keys=["title"]).select("title", "doi")


_PAIRS = """
compared AS (
  SELECT p.key, lower(trim(p.title)) AS a, lower(trim(r.full_title)) AS b
  FROM publications p JOIN page_records r ON r.page_id = (p.key::BIGINT + 3) // 3 * 3)"""


def _pairs(spark, d):
    """Each publication with the record of a neighbouring page."""
    other = views.page_records(spark, d).select(
        F.col("page_id").alias("_id"), F.col("full_title").alias("cr_title")
    )
    near = (F.floor((F.col("key").cast("bigint") + 3) / 3) * 3).cast("bigint")
    return views.publications(spark, d).withColumn("_id", near).join(other, "_id")


@query(
    with_(PAGES, _PAIRS, LCS, recursive=True)
    + """SELECT key, round(coalesce(ratio, 0), 6) AS similarity, coalesce(ratio, 0) > 0.5 AS title_valid
    FROM compared c LEFT JOIN ratios s ON c.a = s.a AND c.b = s.b"""
)
def title_similarity(spark, d):
    ratio = similarity(F.col("title"), F.col("cr_title"))
    return _pairs(spark, d).withColumn("s", ratio).select(
        "key", six("s").alias("similarity"), above_threshold(F.col("s")).alias("title_valid")
    )


@query(
    with_(PAGES, attached("title"), recursive=True)
    + """SELECT key, round(title_similarity, 6) AS title_similarity, title_valid, year_valid, author_valid, is_valid_match
    FROM matched WHERE coalesce(search_title, '') <> ''"""
)
def is_valid_match(spark, d):
    matched = jobs.training_matches(*_sources(spark, d))
    return validate.expand_details(matched).select(
        "key", six("title_similarity").alias("title_similarity"), "title_valid", "year_valid", "author_valid", "is_valid_match"
    )


@query(
    with_(PAGES, attached("title"), recursive=True)
    + """SELECT key, CASE WHEN registry_doi IS NOT NULL THEN year_difference END AS year_difference,
      round(title_similarity, 6) AS title_similarity FROM matched WHERE coalesce(search_title, '') <> ''"""
)
def details_expand(spark, d):
    matched = jobs.training_matches(*_sources(spark, d))
    return matched.select(
        "key", F.col("details.year_difference").alias("year_difference"),
        six("details.title_similarity").alias("title_similarity"),
    )


_TRAINED = """
scored AS (
  SELECT key, score, coalesce(gold_norm = registry_norm, false) AS is_correct FROM matched WHERE coalesce(search_title, '') <> '')"""


@query(
    with_(PAGES, attached("title"), _TRAINED, SWEEP, recursive=True)
    + "SELECT cutoff, round(accuracy, 6) AS accuracy FROM best_cut"
)
def tune_cutoff(spark, d):
    best = jobs.tune_cutoff(*_sources(spark, d)).best
    return best.select("cutoff", six("accuracy").alias("accuracy"))


_HELD = f"""
held AS (
  SELECT *, registry_doi IS NOT NULL AS found, score >= 20 AS taken,
    registry_doi IS NOT NULL AND gold_norm IS NOT DISTINCT FROM registry_norm AS is_correct FROM matched)"""


@query(
    with_(
        PAGES, attached("csv_title"), _HELD,
        """
counts AS (
  SELECT count(*) AS total, count(*) FILTER (found) AS with_result,
    count(*) FILTER (found AND taken AND is_correct) AS tp, count(*) FILTER (found AND taken AND NOT is_correct) AS fp,
    count(*) FILTER (found AND NOT taken AND NOT is_correct) AS tn, count(*) FILTER (found AND NOT taken AND is_correct) AS fn,
    count(*) FILTER (found AND taken AND is_valid_match AND is_correct) AS tp_valid,
    count(*) FILTER (found AND taken AND is_valid_match AND NOT is_correct) AS fp_valid,
    count(*) FILTER (found AND ((taken AND NOT is_valid_match) OR (NOT taken AND NOT (is_valid_match AND is_correct)))) AS tn_valid,
    count(*) FILTER (found AND NOT taken AND is_valid_match AND is_correct) AS fn_valid
  FROM held)""",
        f"\nstandard AS (SELECT {RATES} FROM counts)",
        f"""
validated AS (SELECT {RATES} FROM (SELECT tp_valid AS tp, fp_valid AS fp, tn_valid AS tn, fn_valid AS fn FROM counts))""",
        recursive=True,
    )
    + """SELECT c.*, round(s.accuracy, 6) AS accuracy, round(s.precision, 6) AS precision, round(s.recall, 6) AS recall,
      round(s.f1, 6) AS f1, round(v.accuracy, 6) AS accuracy_valid, round(v.precision, 6) AS precision_valid,
      round(v.recall, 6) AS recall_valid, round(v.f1, 6) AS f1_valid FROM counts c, standard s, validated v"""
)
def evaluate_holdout(spark, d):
    out = jobs.evaluate_on_holdout(*_sources(spark, d), F.lit(20.0))
    return out.select(*[six(n).alias(n) if t == "double" else F.col(n) for n, t in out.dtypes])


@query(
    with_(
        PAGES, attached("csv_title"), _HELD,
        """
counts AS (
  SELECT count(*) AS total, count(*) FILTER (found) AS with_result,
    count(*) FILTER (found AND taken AND r) AS tp, count(*) FILTER (found AND taken AND NOT r) AS fp,
    count(*) FILTER (found AND NOT taken AND NOT r) AS tn, count(*) FILTER (found AND NOT taken AND r) AS fn
  FROM (SELECT *, is_correct AND is_valid_match AS r FROM held))""",
        f"\nmeasures AS (SELECT {RATES} FROM counts)",
        recursive=True,
    )
    + """SELECT c.*, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1 FROM counts c, measures"""
)
def evaluate_direct(spark, d):
    out = jobs.evaluate_by_search(*_sources(spark, d), F.lit(20.0))
    return out.select(*[six(n).alias(n) if t == "double" else F.col(n) for n, t in out.dtypes])


@query(
    with_(PAGES, attached("csv_title"), _HELD, recursive=True)
    + f"""SELECT key, score, is_correct, is_correct AND is_valid_match AS is_correct_with_validation, found AND taken AS exceeds_cutoff,
      CASE WHEN taken THEN registry_doi END AS accepted_doi, CASE WHEN taken AND is_valid_match THEN registry_doi END AS accepted_valid,
      CASE WHEN coalesce(csv_title, '') = '' THEN '{ERROR_NO_TITLE}' WHEN registry_doi IS NULL THEN '{ERROR_EMPTY_ANSWER}' END AS error
    FROM held"""
)
def missing_title(spark, d):
    """Hold-out rows with their outcome; rows without a title are kept as error rows."""
    return jobs.holdout_matches(*_sources(spark, d), F.lit(20.0)).select(
        "key", "score", "is_correct", "is_correct_with_validation", "exceeds_cutoff", "accepted_doi",
        F.col("accepted_doi_with_validation").alias("accepted_valid"), "error",
    )


_BULK = (
    f"""
asked AS (
  SELECT key, title, year, title AS meta_title, year AS meta_year, title AS search_title, {year_sql('year')} AS lookup_year FROM publications),
wanted AS (SELECT title, lookup_year FROM asked WHERE title <> ''),"""
    + BEST
    + """,
found AS (
  SELECT a.*, best.doi AS registry_doi, coalesce(best.score, 0) AS score, r.title AS cr_title, r.year AS cr_year
  FROM asked a LEFT JOIN best ON a.search_title = best.title AND a.lookup_year = best.lookup_year
  LEFT JOIN registry r ON r.doi = best.doi),
compared AS (SELECT lower(trim(title)) AS a, lower(trim(cr_title)) AS b FROM found WHERE registry_doi IS NOT NULL),"""
    + LCS
    + f""",
outcomes AS (
  SELECT key, CASE WHEN title = '' THEN 'no_title' WHEN score < 20 THEN 'low_score'
    WHEN NOT (coalesce(s.ratio, 0) > 0.5 AND coalesce(try_cast(CASE WHEN regexp_matches(f.year, '^ *[0-9]+ *$') THEN trim(f.year) END AS INTEGER) = cr_year, false))
      THEN 'invalid' END AS code,
    CASE WHEN title <> '' THEN {doi_sql('registry_doi')} END AS doi, CASE WHEN title <> '' THEN score END AS score
  FROM found f LEFT JOIN ratios s ON lower(trim(f.title)) = s.a AND lower(trim(f.cr_title)) = s.b)"""
)


@query(
    with_(PAGES, _BULK, recursive=True)
    + "SELECT key, CASE WHEN code IS NULL THEN 'validated' ELSE 'rejected' END AS status, code, doi, score FROM outcomes"
)
def bulk_validate(spark, d):
    out = jobs.bulk_validate(views.publications(spark, d), views.registry(spark, d), F.lit(20.0))
    return out.select("key", "status", "code", "doi", "score")


@query(
    with_(PAGES, _BULK, recursive=True)
    + f"""SELECT o.key, CASE WHEN p.title = '' THEN 'no_title' WHEN a.title IS NULL THEN code
        WHEN a.score < 20 THEN 'low_score' ELSE 'invalid' END AS code,
      CASE WHEN a.title IS NULL OR p.title = '' THEN o.doi ELSE {doi_sql('a.doi')} END AS doi,
      CASE WHEN a.title IS NULL OR p.title = '' THEN o.score ELSE coalesce(a.score, 0) END AS score
    FROM outcomes o JOIN publications p ON o.key = p.key
    LEFT JOIN answers a ON p.title = a.title AND p.year IS NOT DISTINCT FROM a.year"""
)
def bulk_validate_cached(spark, d):
    """Bulk validation where part of the searches have been answered before.

    The kept answers name other DOIs than a search would find, which shows that they count.
    """
    out = jobs.bulk_validate(
        views.publications(spark, d), views.registry(spark, d), F.lit(20.0), answers=views.answers(spark, d)
    )
    return out.select("key", "code", "doi", "score")


@query(
    with_(PAGES, _BULK, recursive=True)
    + """SELECT count(*) AS total, count(*) FILTER (code IS NULL) AS validated, count(*) FILTER (code IS NOT NULL) AS rejected,
      0 AS error FROM outcomes"""
)
def outcome_counts(spark, d):
    from citeweave.operators.bulk import outcome_counts as counts

    return counts(jobs.bulk_validate(views.publications(spark, d), views.registry(spark, d), F.lit(20.0)))


@query(
    with_(PAGES, _BULK, recursive=True)
    + """SELECT 'validated' AS branch, key, doi FROM outcomes WHERE code IS NULL
    UNION ALL SELECT 'rejected', key, doi FROM outcomes WHERE code IS NOT NULL"""
)
def route_by_status(spark, d):
    from citeweave.operators.bulk import route_by_status as route
    from citeweave.session import materialize

    out = jobs.bulk_validate(views.publications(spark, d), views.registry(spark, d), F.lit(20.0))
    branches = route(materialize(out, "outcomes"))
    return (
        branches["validated"].select(F.lit("validated").alias("branch"), "key", "doi")
        .unionByName(branches["rejected"].select(F.lit("rejected").alias("branch"), "key", "doi"))
    )


@query()
def bulk_validate_lines(spark, d):
    """Every line of every document validated against the labelled ones.

    Comparing lines of any length is too slow in SQL; see the brute-force test.
    """
    pubs = views.lines(spark, d).withColumn("year", F.col("year").cast("string"))
    out = jobs.bulk_validate(pubs, views.line_registry(spark, d), F.lit(20.0))
    return out.select("key", "status", "code", "doi", "score")


@query(
    with_(SCORED)
    + f"""SELECT tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM (SELECT *, {RATES} FROM (SELECT count(*) FILTER (score >= 20 AND is_correct) AS tp, count(*) FILTER (score >= 20 AND NOT is_correct) AS fp,
      count(*) FILTER (score < 20 AND NOT is_correct) AS tn, count(*) FILTER (score < 20 AND is_correct) AS fn FROM scored))"""
)
def confusion_at(spark, d):
    return _rounded(evaluate.confusion_at(views.scored(spark, d), F.lit(20.0)))


def _rounded(df):
    return df.select(*[six(n).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


@query(
    with_(SCORED_LINES)
    + f"""SELECT l_returnflag, tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
      round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM (SELECT *, {RATES} FROM (SELECT l_returnflag, count(*) FILTER (l_tax > 0.04 AND l_quantity > 25) AS tp,
      count(*) FILTER (l_tax <= 0.04 AND l_quantity > 25) AS fp, count(*) FILTER (l_tax <= 0.04 AND l_quantity <= 25) AS tn,
      count(*) FILTER (l_tax > 0.04 AND l_quantity <= 25) AS fn FROM lineitem GROUP BY l_returnflag))"""
)
def rates(spark, d):
    big, taxed = F.col("l_quantity") > 25, F.col("l_tax") > 0.04
    counts = views.table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(big & taxed).alias("tp"), F.count_if(big & ~taxed).alias("fp"),
        F.count_if(~big & ~taxed).alias("tn"), F.count_if(~big & taxed).alias("fn"),
    )
    return _rounded(counts.select("*", *evaluate.rates(*[F.col(n) for n in ("tp", "fp", "tn", "fn")])))


_SWEPT = """SELECT cutoff, tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM sweep"""


@query(with_(SCORED, SWEEP) + _SWEPT)
def cutoff_sweep(spark, d):
    return _rounded(evaluate.cutoff_sweep(views.scored(spark, d)))


@query(with_(SCORED_LINES, SWEEP) + _SWEPT)
def prefix_sums(spark, d):
    return _rounded(evaluate.cutoff_sweep(views.scored_lines(spark, d)))


@query(with_(SCORED, SWEEP) + "SELECT cutoff, round(accuracy, 6) AS accuracy FROM best_cut")
def best_cutoff(spark, d):
    return _rounded(evaluate.best_cutoff(evaluate.cutoff_sweep(views.scored(spark, d))))


@query(with_(SCORED_LINES, SWEEP) + "SELECT cutoff, round(accuracy, 6) AS accuracy FROM best_cut")
def best_cutoff_lines(spark, d):
    return _rounded(evaluate.best_cutoff(evaluate.cutoff_sweep(views.scored_lines(spark, d))))


@query(with_(SCORED) + "SELECT DISTINCT score FROM scored")
def distinct_scores(spark, d):
    return evaluate.distinct_scores(views.scored(spark, d))


@query(
    with_(SCORED)
    + """SELECT on_registry, is_correct, count(*) AS n, min(score) AS min_score, max(score) AS max_score,
      round(avg(score), 6) AS avg_score, quantile_disc(score, 0.5) AS median_score FROM scored GROUP BY ALL"""
)
def score_profile(spark, d):
    return evaluate.score_profile(views.scored(spark, d)).withColumn("avg_score", six("avg_score"))


@query(
    with_(SCORED, SWEEP)
    + """SELECT key, score FROM scored WHERE score >= (SELECT cutoff FROM best_cut) AND NOT is_correct AND on_registry"""
)
def wrong_matches(spark, d):
    scored = views.scored(spark, d)
    cutoff = evaluate.best_cutoff(evaluate.cutoff_sweep(scored)).select("cutoff").scalar()
    return evaluate.wrong_matches(scored, cutoff).select("key", "score")


@query(
    with_(PAGES, attached("title"), _TRAINED, SWEEP, recursive=True)
    + f"""SELECT m.key, m.registry_doi, m.score, m.cr_title, m.cr_year, m.cr_authors, m.is_valid_match, round(m.title_similarity, 6) AS title_similarity
    FROM matched m WHERE coalesce(search_title, '') <> '' AND m.score >= (SELECT cutoff FROM best_cut)
      AND NOT coalesce(gold_norm = registry_norm, false) AND gold_norm IN (SELECT lower(doi) FROM registry)"""
)
def error_analysis(spark, d):
    return _wrong_rows(_wrong(spark, d), "registry_doi")


@query(SQL["error_analysis"].replace("m.registry_doi, m.score", "m.registry_doi AS crossref_doi, m.score"))
def write_error_analysis(spark, d):
    """The written file of wrong matches, read back."""
    path = f"{shared_folder(spark)}/wrong-{uuid.uuid4().hex}"
    write_wrong_matches(_wrong(spark, d), path)
    read = spark.read.csv(f"{path}/wrong_matches", header=True, quote='"', escape='"', multiLine=True)
    typed = {"score": "double", "title_similarity": "double", "cr_year": "int", "is_valid_match": "boolean"}
    rows = read.withColumns({c: F.col(c).cast(t) for c, t in typed.items()})
    return _wrong_rows(rows.withColumn("cr_authors", F.array("cr_authors")), "crossref_doi")


def _wrong(spark, d):
    return jobs.error_analysis(jobs.tune_cutoff(*_sources(spark, d)))


def _wrong_rows(wrong, doi):
    if "details" in wrong.columns:
        wrong = validate.expand_details(wrong)
    return wrong.select(
        "key", doi, "score", "cr_title", "cr_year", F.concat_ws(", ", "cr_authors").alias("cr_authors"),
        "is_valid_match", six("title_similarity").alias("title_similarity"),
    )


@query(
    with_(PAGES, attached("csv_title"), _HELD, recursive=True)
    + """SELECT key, registry_doi, score, is_correct, coalesce(cr_title, '') AS cr_title, round(title_similarity, 6) AS title_similarity,
      title_valid, year_valid, author_valid FROM held"""
)
def write_validation_results(spark, d):
    """Hold-out rows and metrics written, the rows read back."""
    from citeweave.plans.table_queries import scratch
    from citeweave.session import materialize
    from citeweave.sources.writers import write_validation_results as write

    path, cutoff = scratch(spark, "validation"), F.lit(20.0)
    matched = materialize(jobs.holdout_matches(*_sources(spark, d), cutoff), "holdout")
    write(matched, evaluate.evaluate_holdout(matched, cutoff), path)
    rows = spark.read.csv(f"{path}/validation_results", header=True, quote='"', escape='"')
    flags = ("is_correct", "title_valid", "year_valid", "author_valid")
    return rows.select(
        "key", "registry_doi", F.col("score").cast("double").alias("score"), F.coalesce("cr_title", F.lit("")).alias("cr_title"),
        six(F.col("title_similarity").cast("double")).alias("title_similarity"), *[F.col(f).cast("boolean").alias(f) for f in flags],
    )
