"""The pipeline against plain versions of its stages, and its registration."""

from __future__ import annotations

import sys

import regex

import __spark_entry__ as entry
import corpus_pipeline
from citeweave.llm import queries

from . import brute

FOLDER = "/root/testdata/sf0.001"


def _kept(docs):
    """Every rule of the policy, one document after the other."""
    for doc_id, text in docs:
        n, chars, symbols, dup_lines, repeated, base = brute.quality([(doc_id, text)])[doc_id]
        letters, upper = len(regex.findall(r"\p{L}", text)), len(regex.findall(r"\p{Lu}", text))
        lines = sum(1 for x in text.split("\n") if brute.WORD.search(x))
        bad = (
            base or 10 * symbols > 3 * n or 10 * upper > 6 * letters or 10 * text.count("!") > 4 * n
            or chars < 2 * n or chars > 14 * n or 10 * dup_lines > 6 * lines
        )
        if not bad:
            yield doc_id, text


def _without_lines(docs):
    holders: dict[str, int] = {}
    for doc_id, text in sorted(docs):
        for line in text.split("\n"):
            holders.setdefault(brute.lower(line.strip(brute.BLANKS)), doc_id)
    for doc_id, text in docs:
        keys = [brute.lower(x.strip(brute.BLANKS)) for x in text.split("\n")]
        kept = [x for x, key in zip(text.split("\n"), keys) if len(key) < 10 or holders[key] == doc_id]
        if len(kept) == len(keys) or brute.WORD.search("\n".join(kept)):
            yield doc_id, "\n".join(kept)


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    packed = corpus_pipeline.run(spark, FOLDER).toPandas()
    want = list(_kept(want))
    want = list(_without_lines(want))
    want = [(i, t) for i, t in want if brute.jaccard(want)[i][1] == i] if len(want) < 60 else _heads(want)
    hits = brute.contamination(want, items)
    want = {i: t for i, t in want if not hits[i][4]}
    assert set(packed["doc_id"]) == set(want)
    lengths = packed.groupby("doc_id")["length"].sum()
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.tokenizer_path())
    made.encode_special_tokens = True
    for doc_id, text in want.items():
        assert lengths[doc_id] == len(made.encode(text, add_special_tokens=False).ids) + 1
    assert (packed.groupby("sequence_id")["length"].sum() <= 2048).all()


def _heads(docs):
    heads = brute.jaccard(docs)
    return [(i, t) for i, t in docs if heads[i][1] == i]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(30), FOLDER)
        assert out.schema.simpleString() == docs.schema.simpleString()
    empty = docs.where("false")
    assert corpus_pipeline.STAGES[-1][1](spark, empty, FOLDER).count() == 0


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert set(queries.SQL) <= names


def test_nothing_else_imports_the_subpackage():
    import subprocess

    script = "import sys; sys.modules['citeweave.llm'] = None\n" + (
        "import citeweave.plans.jobs, citeweave.plans.views, citeweave.streaming.incremental, citeweave.plans.table_queries, "
        "citeweave.plans.field_queries, citeweave.plans.link_queries, citeweave.sources.archives"
    )
    assert subprocess.run([sys.executable, "-c", script], capture_output=True).returncode == 0
