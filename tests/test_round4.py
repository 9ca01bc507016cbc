"""Dump folders that grow, short ids that stay, lookups that break off."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from citeweave.operators import extract
from citeweave.plans import jobs
from citeweave.sources import dump, readers, writers
from citeweave.streaming import extraction

HEADER = '"id,title,author,pub_date,""venue"""'
JOURNAL = "Scientometrics [issn:0138-9130]"
PERSON = "Doe, A [orcid:0000-0001-2345-6789]"
FILES = {
    "a.csv": [HEADER, f'"p1,Old title,""{PERSON}"",2001,{JOURNAL}"', f'"p2,Second,""{PERSON}"",2002,{JOURNAL}"'],
    "b.csv": [HEADER, f'"p1,New title,""{PERSON}"",2003,{JOURNAL}"', f'"p3,Third,""{PERSON}"",2004,{JOURNAL}"', '"p9,Other,,2004,Nature"'],
}
EDGES = {"1.csv": [("p1", "p3"), ("p3", "x"), ("y", "p2"), ("y", "p2")], "2.csv": [("p3", "p1"), ("p2", "p2"), ("x", "y"), ("z", "p3")]}


def put(folder, name):
    for kind in ("dump", "edges"):
        (folder / kind).mkdir(exist_ok=True)
    if name in FILES:
        (folder / "dump" / name).write_text("\n".join(FILES[name]) + "\n")
    else:
        (folder / "edges" / name).write_text("citing,cited\n" + "".join(f"{a},{b}\n" for a, b in EDGES[name]))


def rows(df):
    names = ("id", "title", "year", "part", "parts", "outgoing_citations", "incoming_citations")
    return sorted(json.dumps([r[n] for n in names]) for r in df.select(*names).collect())


def arrive(spark, folder, **options):
    paths = [str(folder / p) for p in ("dump", "edges", "tables", "out")]
    return extraction.extract_arrivals(spark, *paths, part_size=2, **options)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    for name in (*FILES, *EDGES):
        put(folder, name)
    found = dump.read_wrapped_dump(spark, str(folder / "dump"))
    edges = readers.read_citation_edges(spark, str(folder / "edges"))
    out = rows(jobs.extract_community(found, edges, F.struct("source", "line_no"), part_size=2))
    assert len({json.loads(r)[0] for r in out}) == 3 and any("New title" in r for r in out)
    return out


@pytest.mark.parametrize("lots", [["a.csv 1.csv", "b.csv 2.csv"], ["b.csv", "2.csv", "a.csv", "1.csv"], ["1.csv 2.csv", "a.csv", "b.csv"]])
def test_arrivals_in_lots_equal_one_batch(spark, tmp_path, whole, lots):
    # An older file that arrives late does not replace a newer row: places count, not arrivals.
    for lot in lots:
        for name in lot.split():
            put(tmp_path, name)
        state = arrive(spark, tmp_path)
    assert rows(state.extracted(2)) == whole
    written = spark.read.schema(
        "id string, title string, year int, part bigint, parts bigint, outgoing_citations array<string>, incoming_citations array<string>"
    ).json(str(tmp_path / "out/publications"))
    assert rows(written) == whole
    before = sorted(p.name for p in (tmp_path / "tables/publications").iterdir())
    assert rows(arrive(spark, tmp_path).extracted(2)) == whole
    assert sorted(p.name for p in (tmp_path / "tables/publications").iterdir()) == before


@pytest.mark.parametrize("table", ["touching_lines", "short_ids", "edges", "touching_edges"])
def test_arrivals_after_a_lost_driver(spark, tmp_path, whole, monkeypatch, table):
    """A batch that stops before any of its tables is made good by the next run."""
    write = extraction.JournalTables.write

    def stop(self, df, name, batch):
        if name == table:
            raise RuntimeError("lost")
        return write(self, df, name, batch)

    for name in ("a.csv", "1.csv"):
        put(tmp_path, name)
    with monkeypatch.context() as patch:
        patch.setattr(extraction.JournalTables, "write", stop)
        with pytest.raises(Exception, match="lost"):
            arrive(spark, tmp_path)
    for name in ("b.csv", "2.csv"):
        put(tmp_path, name)
    assert rows(arrive(spark, tmp_path).extracted(2)) == whole


def test_arrivals_of_nothing(spark, tmp_path):
    for kind in ("dump", "edges"):
        (tmp_path / kind).mkdir()
    assert arrive(spark, tmp_path).extracted().count() == 0


def test_short_ids_stay_and_never_clash(spark):
    # With two hexadecimal digits 200 ids must clash often.
    old, new = [f"b{i:03d}" for i in range(100)], [f"a{i:03d}" for i in range(100)]
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    first = extract.short_ids(frame(old), length=2)
    given = {r.id: r.short_id for r in first.collect()}
    later = {r.id: r.short_id for r in extract.short_ids(frame(old + new), length=2, taken=first).collect()}
    assert given.items() <= later.items()
    assert len(later) == len(set(later.values())) == 200


def test_enrichment_with_lookups_that_break_off(spark, tmp_path):
    entries = spark.createDataFrame([("a", "10.1/a"), ("b", "10.1/b"), ("c", "10.1/c"), ("d", "10.1/d")], "key string, doi string")
    lookups = spark.createDataFrame([], "doi string, exists boolean, error_type string, ts timestamp_ntz")
    shape = "doi string, title string, author string, year string, source_title string, error_type string, failure string"
    metadata = spark.createDataFrame(
        [("10.1/a", "T", "", "2001", "V", None, None), ("10.1/b", "T", "", "2001", "V", None, "ReadTimeout: slow"),
         ("10.1/c", "T", "", "2001", "V", None, "KeyError: x")], shape,
    )
    now = F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))
    run = jobs.enrich(entries, lookups, metadata, now)
    got = {r.key: (r.status, r.error_type, r.retryable) for r in run.results.collect()}
    assert got == {
        "a": ("found", None, False), "b": ("error", "ReadTimeout: slow", True),
        "c": ("error", "KeyError: x", False), "d": ("not found", None, False),
    }
    # A failure is no answer: nothing is kept of it.
    assert {r.doi for r in run.fresh.collect()} == {"10.1/a", "10.1/d"} and "failure" not in run.fresh.columns
    writers.write_run_outputs(run.results, run.converted, run.summary, str(tmp_path), now)
    report = spark.read.json(f"{tmp_path}/summary").first()
    assert (report.total_results, report.converted_papers, report.summary.failure) == (4, 1, 3)
    assert spark.read.json(f"{tmp_path}/not_found").count() == 3 and spark.read.json(f"{tmp_path}/retry").count() == 1


def test_wrong_matches_file_has_all_columns(spark, tmp_path):
    wrong = spark.createDataFrame([("k", "T", "10.1/a", "10.1/b", 3.0, True)], "key string, title string, doi string, registry_doi string, score double, on_registry boolean")
    writers.write_wrong_matches(wrong, str(tmp_path))
    read = spark.read.csv(f"{tmp_path}/wrong_matches", header=True)
    assert tuple(read.columns) == writers.WRONG_MATCH_COLUMNS
    assert read.first()[:6] == ("k", "T", "10.1/a", "10.1/b", "3.0", "true")
