"""The encoder of a worker lasts over tasks and gives the ids of the library."""

from __future__ import annotations

import numpy as np
import pytest

from citeweave.llm import token_files, tokens
from citeweave.llm.queries import tokenizer_path

ODD = [
    "", " ", "a", " é", "Größe große, größe. ﬁ ª º", " plain Plain, plain. plain", "x\ny\n\nz ", "  two  blanks", "don't I'll we'RE", "a1 1a 12, 1.",
    "日本 語, العربية नमस्ते", " <|endoftext|> x", "tab\tx  y", "\x1f q", " ,", " .a", "é ñ,", " 𝒳 𝒴,", " Ġ Ċ", "\n plain", " plain\nplain",
]


@pytest.mark.parametrize("special_ids", [False, True])
def test_ids_are_those_of_the_library(special_ids):
    encoder = tokens.shared_encoder(tokenizer_path(), special_ids)
    assert tokens.shared_encoder(tokenizer_path(), special_ids) is encoder
    for _ in range(2):
        assert encoder.encode(ODD) == encoder.whole(ODD)


def test_tasks_of_a_worker_share_their_encoder(spark):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    manifest = token_files.write_token_files(docs, tokenizer_path(), end_id=2, special_ids=True)
    library = Tokenizer.from_file(tokenizer_path())
    for row in token_files.read_token_files(manifest).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == [*library.encode(ODD[row.doc_id], add_special_tokens=False).ids, 2]
