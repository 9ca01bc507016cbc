"""Whole jobs where inputs differ from the given tables: wrapped notices, added tokens, re-wrapped quotes."""

from __future__ import annotations

import textwrap
import zlib

import numpy as np
import pytest

import corpus_pipeline
from citeweave.llm import chat, licences, queries
from citeweave.llm.tokens import Encoder

#: Headers in their usual wording, by family.
HEADERS = {
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
}


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(licences.sample_paragraphs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))


def _header(family, width, sign):
    return "\n".join(sign + x for x in textwrap.wrap(HEADERS[family], width, break_on_hyphens=False))


def test_wrapped_headers_of_each_family(spark, model):
    """Every header counts once, whatever the width and the comment signs, between lines of code."""
    rows, want = [], {}
    for width, sign in ((72, ""), (72, " * "), (60, "# "), (36, "// ")):
        for family in HEADERS:
            rows.append((len(rows), f"import os\n{_header(family, width, sign)}\ncode = 1"))
            want[len(want)] = (1, family)
    rows.append((len(rows), f"{_header('mit', 40, '')}\nother words\n{_header('gpl', 40, '')}\n{_header('mit', 50, '')}"))
    want[len(want)] = (3, "gpl,mit")
    # A notice whose words are in two documents is in neither.
    half = _header("bsd", 72, "").split("\n")
    for part in (half[0][:40], half[1]):
        rows.append((len(rows), part))
        want[len(want)] = (0, "")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_confirmed, r.families) for r in licences.scan(df, model).collect()}
    assert got == want


def test_wrapped_headers_are_no_training_text(spark):
    df = spark.createDataFrame([(1, f"plain words\n{_header('gpl', 72, '# ')}\nmore words")], "doc_id long, text string")
    assert licences.sample_paragraphs(df) == ["plain words", "# option) any later version.", "more words"]


@pytest.fixture(scope="module")
def plain():
    """The tokenizer as loaded."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def test_special_ids_equal_the_plain_library(plain):
    rng = np.random.default_rng(6)
    letters = [*" \n\t.,'a bé<|>\x1f", "<|endoftext|>", "<|endoftext", " word", "Word."]
    texts = ["a <|endoftext|> b", *("".join(rng.choice(letters, rng.integers(0, 12))) for _ in range(2000))]
    encoder = Encoder(queries.tokenizer_path(), limit=500, special_ids=True)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got[0] == [64, 220, 50256, 275] and got == [plain(t) for t in texts]


def test_queries_keep_the_tokenizer_as_loaded(spark, docs, plain, tmp_path):
    rows = [*docs, (2001, "a <|endoftext|> b"), (2002, "<|endoftext|><|endoftext|>"), (2003, "after it")]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    wanted = {i: plain(t) for i, t in rows}
    table = queries.table(spark, folder, "documents")
    for packed in (queries.op6_best_fit_packing(spark, folder), corpus_pipeline.STAGES[-1][1](spark, table, folder)):
        found = packed.toPandas()
        for doc_id, ids in wanted.items():
            whole = np.array([*ids, 0], "<u4")
            own = found[found["doc_id"] == doc_id]
            assert own["length"].sum() == len(whole)
            for start, length, crc in zip(own["start"], own["length"], own["ids_crc32"], strict=True):
                assert zlib.crc32(whole[start : start + length].tobytes()) == crc
    at = 0
    written = {r.doc_id: r for r in queries.op8_token_output(spark, folder).collect()}
    for doc_id, ids in sorted(wanted.items()):
        whole = np.array([*ids, 2], "<u4")
        row = written[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(whole), zlib.crc32(whole.tobytes()))
        at += len(whole)


LONG = (
    "The archive of the northern station holds forty years of readings, and most of them were never typed in. "
    "We should ask whether the paper sheets can be scanned before the building closes next spring."
)
OTHER = "Nobody has looked at the second cellar since the flood of last autumn, so bring rubber boots and two lamps."


def _quoted(text, width, sign="> "):
    return "\n".join(sign + x for x in textwrap.wrap(text, width))


def test_quotes_that_are_no_whole_lines(spark):
    wrapped = "\n".join(textwrap.wrap(LONG, 40))
    rows = [
        (1, 0, LONG), (1, 1, OTHER), (1, 2, _quoted(LONG, 72) + "\nI will ask."), (1, 3, "> whether the paper sheets can be scanned\nYes."),
        (1, 4, _quoted(LONG.upper(), 30, ">> ") + "\n" + _quoted(OTHER, 50) + "\nBoth."),
        (1, 5, "> " + LONG + " " + OTHER[:30] + "\nMost of it."), (1, 6, "> I will\n> ask.\nThanks."),
        (1, 7, "> some sheets of a paper that nobody in this thread wrote, can be scanned before the\nUnknown"),
        (2, 0, wrapped), (2, 1, OTHER), (2, 2, "> " + LONG + "\nOne line."), (2, 3, _quoted(LONG, 60, "> > ") + "\nDeeper"),
        (3, 0, OTHER), (3, 1, _quoted(LONG, 72) + "\nOf another conversation"), (3, 2, LONG),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread) for r in chat.reply_ordered(df.repartition(3)).collect()}
    assert got == {
        (1, 0): (None, 0), (1, 1): (None, 1), (1, 2): (0, 0), (1, 3): (0, 0), (1, 4): (1, 1), (1, 5): (0, 0), (1, 6): (2, 0),
        (1, 7): (None, 7), (2, 0): (None, 0), (2, 1): (None, 1), (2, 2): (0, 0), (2, 3): (0, 0), (3, 0): (None, 0),
        (3, 1): (None, 1), (3, 2): (None, 2),
    }


def test_pieces_of_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, ""), (1, 2, ">\n> ")], "conv_id int, turn int, text string")
    assert chat.pieces(df, False).count() == 0 and chat.pieces(df, True).count() == 0
    assert chat.pieces(df.where("false"), True).count() == 0


def test_mail_view_of_all_conversations(spark):
    """The given messages hold no quotes: here each quotes the one before, wrapped at 60 columns."""
    rows = {(r.conv_id, r.turn): r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()}
    want = {k: k[1] - 1 for k in rows if len(rows.get((k[0], k[1] - 1), "").split()) > 8}
    mails = [(c, t, "user", (_quoted(rows[c, t - 1], 60) + "\n" if (c, t) in want else "") + x) for (c, t), x in rows.items()]
    df = spark.createDataFrame(mails, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.reply_to for r in chat.reply_ordered(df).collect() if r.reply_to is not None}
    assert len(want) > 20 and got == want
