"""Lookups, authors, extraction, samples, sources and sinks."""

import io
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from citeweave.operators import authors, enrich, extract, lists, lookup, sampling
from citeweave.plans import jobs
from citeweave.sources import archives, dump, lookup_store, readers, registry, writers
from citeweave.streaming import incremental

PAPERS = [
    ("rJZe1IHB", [("Haifeng Qian", ""), ("Renu Joseph", ""), ("Ning Zeng", "")]),
    ("LNZGIKx7", [("Haifeng Qian", ""), ("John Doe", ""), ("", "")]),
]
EDGES = [("omid:br/061", "omid:br/9"), ("omid:br/7", "omid:br/061"), ("omid:br/061", "omid:br/061"), ("omid:br/1", "omid:br/2")]


def papers(spark):
    return spark.createDataFrame(PAPERS, "key string, authors array<struct<name string, org string>>")


def test_author_index(spark):
    index = {r.author: r.papers for r in authors.author_index(papers(spark)).collect()}
    assert index == {
        "haifeng_qian": ["LNZGIKx7", "rJZe1IHB"], "renu_joseph": ["rJZe1IHB"],
        "ning_zeng": ["rJZe1IHB"], "john_doe": ["LNZGIKx7"],
    }
    stats = authors.author_stats(papers(spark)).first()
    assert (stats.authors, stats.pairs, stats.mean_papers) == (4, 5, 1.25)


def test_lists_of_a_hot_key_come_in_parts(spark):
    pairs = [("hot", f"v{i}") for i in range(1000)] + [("cold", "v1"), ("cold", "v1")]
    df = spark.createDataFrame(pairs, "k string, v string")
    rows = lists.parted_lists(df, "k", "v", "vs", part_size=100).collect()
    hot = [r for r in rows if r.k == "hot"]
    assert len(hot) == 10 and all(r.parts == 10 and len(r.vs) < 200 for r in hot)
    assert sorted(v for r in hot for v in r.vs) == sorted(v for k, v in pairs if k == "hot")
    assert [(r.part, r.vs) for r in rows if r.k == "cold"] == [(0, ["v1", "v1"])]


def test_citations(spark):
    pubs = spark.createDataFrame([("omid:br/061",), ("omid:br/5",)], "id string")
    touching = extract.edges_touching(spark.createDataFrame(EDGES, "citing string, cited string"), pubs)
    merged = {r.id: r for r in extract.merge_citations(pubs, extract.citation_lists(touching)).collect()}
    assert merged["omid:br/061"].outgoing_citations == ["omid:br/061", "omid:br/9"]
    assert merged["omid:br/061"].incoming_citations == ["omid:br/061", "omid:br/7"]
    assert merged["omid:br/5"].outgoing_citations == []
    counts = extract.pubs_with_citations(pubs, touching).first()
    assert (counts.with_citations, counts.publications) == (1, 2)


@pytest.mark.parametrize("length, n", [(8, 300), (2, 900), (1, 100)])
def test_short_ids_are_unique_and_complete(spark, length, n):
    ids = spark.range(n).selectExpr("cast(id as string) AS id")
    rows = extract.short_ids(ids, length).collect()
    assert {r.id for r in rows} == {str(i) for i in range(n)} and len(rows) == n
    assert len({r.short_id for r in rows}) == n
    assert {r.id: r.short_id for r in extract.short_ids(ids, length).collect()} == {r.id: r.short_id for r in rows}


HEADER = '"id,title,author,pub_date,"venue"";;'
ROW = (
    '"omid:br/061 doi:10.1/a,""A, title"",""Rossi, M [omid:ra/1 orcid:0000-0001-2345-6789]; Bi, L [omid:ra/2]"",'
    '2010-05,""Scientometrics [issn:0138-9130]""";;'
)


def test_wrapped_dump(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, ROW, '"short,row"', ROW.replace("A, title", "B")]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(['"id,title"', ROW]) + "\n")
    rows = dump.read_wrapped_dump(spark, str(tmp_path))
    assert rows.count() == 2
    (pub,) = extract.publications(rows, F.col("line_no")).collect()
    assert (pub.id, pub.title, pub.year) == ("omid:br/061", "B", 2010)
    assert [a.name for a in pub.authors] == ["Rossi, M"] and pub.venue == "Scientometrics [issn:0138-9130]"


def test_regular_and_irregular_splits_agree(spark):
    rng = random.Random(1)
    bits = ['a', 'b c', ',', '"x, y"', '[p, q]', '"in [k, l] q"', ' ', ',,', 'é']
    lines = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in lines], "t string").select(
        "t", F.col("t").rlike(dump._REGULAR).alias("regular"),
        dump._split_regular(F.col("t")).alias("r"), dump._split_irregular(F.col("t")).alias("i"),
    )
    rows = df.where("regular").collect()
    assert len(rows) > 200
    for row in rows:
        assert row.r == row.i, row.t


@pytest.mark.parametrize(
    "line, fields",
    [
        ('"a,[x [y, z], w],b"', ["a", "[x [y, z], w]", "b"]),
        ('"a,""q [r, s"",t,u"', ["a", 'q [r, s",t,u']),
        ('"a,b,"', ["a", "b"]),
        ("a,,b", ["a", "", "b"]),
    ],
)
def test_unusual_lines(spark, line, fields):
    assert spark.createDataFrame([(line,)], "v string").select(dump.split_wrapped(F.col("v"))).first()[0] == fields


def test_archives(spark, tmp_path):
    def zipped(members):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for name, content in members.items():
                z.writestr(name, content)
        return data.getvalue()

    inner = zipped({"x.csv": "citing,cited\na,b\n", "skip.txt": "no"})
    (tmp_path / "outer.zip").write_bytes(zipped({"inner.zip": inner, "y.csv": "h\r\n1\r\n", "bad.csv": b"\xff\xfe"}))
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as tar:
        info = tarfile.TarInfo("d/z.csv")
        info.size = 4
        tar.addfile(info, io.BytesIO(b"q\nr\n"))
    (tmp_path / "broken.zip").write_bytes(b"nothing")
    rows = archives.read_archive_members(spark, str(tmp_path)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.line_no):
        got.setdefault(r.member, []).append(r.value)
    assert got == {"inner.zip/x.csv": ["citing,cited", "a,b"], "y.csv": ["h", "1"], "d/z.csv": ["q", "r"]}


def test_read_gold(spark, tmp_path):
    path = tmp_path / "gold.csv"
    path.write_bytes(" Key ;title;DOI; Cinese_title;\nk1; A title ;10.1/a;x;\nk2;B;;caf\xe9;\n".encode("iso-8859-1"))
    rows = readers.read_gold(spark, str(path), encoding="ISO-8859-1").collect()
    assert [r.asDict() for r in rows] == [
        {"Key": "k1", "title": "A title", "DOI": "10.1/a", "Cinese_title": "x"},
        {"Key": "k2", "title": "B", "DOI": "", "Cinese_title": "café"},
    ]
    path.write_text("Key;title\nk;t\n")
    with pytest.raises(ValueError):
        readers.read_gold(spark, str(path))


@pytest.mark.parametrize("sep", [",", ";"])
def test_read_labelled(spark, tmp_path, sep):
    path = tmp_path / "labelled.csv"
    lines = [
        ["title", "key", "TITLE", "Doi", "id_on_crossref"],
        ["old", "k1", f'"T{sep} 1"', "10.1/a", "TRUE"], ["o", "k2", "T2", "d", "Errore API"],
        ["o", "k3", "T3", "d"], ["o", "k4", "", "", ""], ["o", "k5", "T5", "d", "true", "extra"],
    ]
    path.write_text("\n".join(sep.join(l) for l in lines) + "\n")
    rows = {r.key: (r.title, r.doi, r.on_registry) for r in readers.read_labelled(spark, str(path)).collect()}
    assert rows == {"k1": (f"T{sep} 1", "10.1/a", True), "k2": ("T2", "d", False), "k4": ("", "", False), "k5": ("T5", "d", True)}
    path.write_text("key,title\nk,t\n")
    with pytest.raises(ValueError):
        readers.read_labelled(spark, str(path))


def test_read_keyed_json_and_key_doi(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": {"title": "T", "year": 2008, "authors": [{"name": "N", "org": ""}]},\n "b": {"title": "U", "year": "x"}}')
    rows = {r.key: (r.title, r.year) for r in readers.read_keyed_json(spark, str(tmp_path / "p.json")).collect()}
    assert rows == {"a": ("T", "2008"), "b": ("U", "x")}
    (tmp_path / "k.csv").write_text('key,doi\na,https://doi.org/10.1/A\nb,None\nc,"10.1/x,y"\nd\n')
    got = {r.key: r.doi for r in readers.read_key_doi(spark, str(tmp_path / "k.csv")).collect()}
    assert got == {"a": "10.1/a", "c": "10.1/x,y"}


def test_registry_items(spark):
    items = [
        '{"DOI": "d1", "title": [], "author": [{"family": "Lee"}, {"given": "Ann", "family": "Lee"}, {}], "container-title": [], "publisher": "P"}',
        '{"DOI": "d2", "score": 3.5, "title": ["T"], "published": {"date-parts": [[2008, 1]]}, "container-title": ["V"]}',
    ]
    rows = {r.doi: r for r in registry.parse_registry_items(spark.createDataFrame([(i,) for i in items], "value string")).collect()}
    assert (rows["d1"].title, rows["d1"].year, rows["d1"].authors, rows["d1"].venue, rows["d1"].score) == ("", None, ["Lee", "Ann Lee"], "P", 0.0)
    assert (rows["d2"].title, rows["d2"].year, rows["d2"].authors, rows["d2"].venue, rows["d2"].score) == ("T", 2008, [], "V", 3.5)


def test_prepare_and_write_gold(spark, tmp_path):
    rows = [("k1", "A", "10.1/a"), ("k2", "B", "10.1/zzz"), ("k3", "C", ""), ("k4", "D", "None"), ("k5", "E", "10.1/bad")]
    gold = jobs.prepare_gold(
        spark.createDataFrame(rows, "key string, title string, doi string"),
        spark.createDataFrame([("10.1/A",)], "doi string"), spark.createDataFrame([("10.1/BAD",)], "doi string"), n=3,
    )
    flags = {r.key: (r.on_registry, r.lookup_error) for r in gold.collect()}
    assert flags == {"k1": (True, False), "k2": (False, False), "k3": (False, False), "k4": (False, False), "k5": (False, True)}
    writers.write_split(gold, str(tmp_path))
    read = {f: spark.read.csv(f"{tmp_path}/{f}", header=True).collect() for f in ("training_set", "validation_set", "failed_requests")}
    assert (len(read["training_set"]), len(read["validation_set"])) == (3, 2)
    assert [r.ID_on_Crossref for r in read["failed_requests"]] == ["Errore API"]


@pytest.mark.parametrize("rows, train", [(310, 300), (12, 12)])
def test_split_sizes(spark, rows, train):
    df = spark.range(rows).selectExpr("cast(id as string) AS key")
    split = sampling.seeded_split(df)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts.get("train") == train and counts.get("validation", 0) == rows - train
    assert split.select("key").distinct().count() == rows
    again = sampling.seeded_split(df.repartition(7))
    assert split.exceptAll(again.select(*split.columns)).isEmpty()
    pilot = sampling.pilot_then_rest(df).where("batch = 'pilot'").count()
    assert pilot == min(100, rows)


def test_lookup_versions(spark, tmp_path):
    path = str(tmp_path / "lookup")
    assert lookup_store.load_lookup(spark, path).isEmpty()
    schema = "doi string, exists boolean, error_type string, ts timestamp_ntz"
    frame = lambda rows: spark.createDataFrame(rows, "doi string, exists boolean, error_type string, t string").selectExpr(
        "doi", "exists", "error_type", "cast(t as timestamp_ntz) AS ts")
    lookup_store.upsert_lookup(spark, path, frame([("a", False, "Timeout", "2024-01-01"), ("b", True, None, "2024-01-01")]))
    merged = lookup_store.upsert_lookup(spark, path, frame([("a", True, None, "2024-01-02"), ("b", False, "x", "2023-01-01")]))
    assert {r.doi: r.exists for r in merged.collect()} == {"a": True, "b": True}
    assert lookup_store._versions(spark, path) == [1, 2]


METADATA = [("10.1/a", "Citation graphs today", "Smith, Alice", "2018-02", "V"), ("10.1/b", "T", "", "", "")]


def metadata(spark):
    return spark.createDataFrame(METADATA, "doi string, title string, author string, year string, source_title string")


def test_enrich_and_rerun(spark):
    entries = spark.createDataFrame([("k1", "10.1/a"), ("k2", "10.1/x"), ("k3", "10.1/t"), ("k4", "10.1/a")], "key string, doi string")
    known = spark.createDataFrame([("10.1/x", False, "HTTP_404"), ("10.1/t", False, "Timeout")], "doi string, exists boolean, error_type string")
    known = known.withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    first = jobs.enrich(entries, known, metadata(spark), F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00")))
    assert {r.doi for r in first.fresh.collect()} == {"10.1/a", "10.1/t"}
    assert {r.key: r.status for r in first.results.collect()} == {"k1": "found", "k2": "not found", "k3": "not found", "k4": "found"}
    converted = {r.key: r for r in first.converted.collect()}
    assert set(converted) == {"k1", "k4"}
    assert (converted["k1"].keywords, converted["k1"].authors[0].name, converted["k1"].year) == (["citation", "graphs", "today"], "Alice Smith", 2018)
    summary = first.summary.first()
    assert (summary.total, summary.success, summary.success_percentage) == (4, 2, 50.0)
    again = jobs.enrich(entries, lookup.merge_lookups(known, first.fresh), metadata(spark), F.localtimestamp())
    assert again.fresh.isEmpty()


def test_replay_keeps_what_still_fails(spark):
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    old = spark.createDataFrame([("a", False, "Timeout"), ("b", False, "Timeout")], "doi string, exists boolean, error_type string").withColumn("ts", at)
    answers = spark.createDataFrame([("a", None), ("b", "ReadTimeout")], "doi string, error_type string")
    merged, left = lookup.replay_retries(old.select("doi"), answers, old, F.localtimestamp())
    assert {r.doi: r.exists for r in merged.collect()} == {"a": True, "b": False}
    assert [r.doi for r in left.collect()] == ["b"]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"key": "k1", "title": "alpha beta gamma", "year": 2008}\n{"key": "k2", "title": "zzz", "year": 2008}\n')
    reg = spark.createDataFrame([("10.1/A", "alpha beta gamma", 2008, [], "v"), ("10.1/B", "other", 2001, [], "v")],
                                "doi string, title string, year int, authors array<string>, venue string")
    stream = incremental.publication_stream(spark, str(tmp_path / "in"))
    kept = str(tmp_path / "answers")
    writer = incremental.validate_stream(stream, reg, F.lit(0.5), str(tmp_path / "out"), str(tmp_path / "cp"), kept)
    writer.trigger(availableNow=True).start().awaitTermination(120)
    rows = spark.read.csv(f"{tmp_path}/out/batch=0/validated", header=True).collect()
    assert [(r.key, r.doi) for r in rows] == [("k1", "10.1/a")]
    assert spark.read.csv(f"{tmp_path}/out/batch=0/rejected", header=True).count() == 1
    answers = lookup_store.load_lookup(spark, kept, lookup_store.ANSWER_SCHEMA).collect()
    assert {(r.title, r.year, r.doi) for r in answers} == {("alpha beta gamma", "2008", "10.1/A"), ("zzz", "2008", None)}

    (tmp_path / "pairs").mkdir()
    (tmp_path / "pairs" / "1.csv").write_text("k1,10.1/a\nk2,10.1/none\n")
    pairs = spark.readStream.schema("key string, doi string").csv(str(tmp_path / "pairs"))
    incremental.enrich_stream(pairs, metadata(spark), str(tmp_path / "lk"), str(tmp_path / "eo"), str(tmp_path / "ec")).trigger(
        availableNow=True).start().awaitTermination(120)
    assert {r.doi: r.exists for r in lookup_store.load_lookup(spark, str(tmp_path / "lk")).collect()} == {"10.1/a": True, "10.1/none": False}
    assert spark.read.json(f"{tmp_path}/eo/batch=0/found").count() == 1
