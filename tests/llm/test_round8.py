"""New words reach the tokenizers library many at a time, whose ids they keep."""

from __future__ import annotations

import sys

import numpy as np
import pytest

from citeweave.llm.queries import tokenizer_path
from citeweave.llm.tokens import Encoder

ENDS = ["", ",", ".", "$$$", "...", "'s", "'", "²", "7", "-x", "!?", "́", "’s", "_", "­", "\x1f", "\t", "<|endoftext|>"]
LETTERS = [*"abcdefghijklmnopqrstuvwxyzABCéßñøДж中語한ﬁªǅ𝒳"]


def made(rng, n, ends=ENDS, letters=LETTERS):
    """Texts of words most of which come once, with all kinds of ends and blanks."""
    odds = [0.6, *[0.4 / (len(ends) - 1)] * (len(ends) - 1)]

    def word():
        return "".join(rng.choice(letters, rng.integers(1, 9))) + rng.choice(ends, p=odds)

    def blank():
        return rng.choice([" ", "\n", "  ", " \n"], p=[0.9, 0.09, 0.005, 0.005])

    return ["".join(word() + blank() for _ in range(rng.integers(0, 30))).strip(" ") for _ in range(n)]


@pytest.mark.parametrize("special_ids", [False, True])
@pytest.mark.parametrize("limit", [50, 100_000])
def test_new_words_have_the_ids_of_the_library(limit, special_ids):
    rng = np.random.default_rng(11)
    encoder = Encoder(tokenizer_path(), limit=limit, special_ids=special_ids)
    for _ in range(4):
        texts = made(rng, 400)
        assert encoder.encode(texts) == encoder.whole(texts)
        assert encoder.encode(texts[::-1]) == encoder.whole(texts[::-1])
    assert encoder.encode([]) == []


def test_long_words():
    encoder = Encoder(tokenizer_path())
    texts = ["語" * 3000 + " " + "word" * 3000 + ", x", "é" * 70_000]
    assert encoder.encode(texts) == encoder.whole(texts)


def test_letters_without_a_token(tmp_path):
    """A vocabulary without some bytes: tokens don't tell where a word ends."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    small = Tokenizer(models.BPE({"a": 0, "b": 1, "Ġ": 2, "ab": 3, "Ċ": 4}, [("a", "b")]))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(path := f"{tmp_path}/small.json")
    encoder = Encoder(path)
    texts = ["ab abc cab", "c", " c ab\nabab é", "ccc ab", ""]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert np.frombuffer(encoder.encode(["ab abc"])[0], encoder.dtype).tolist() == [3, 2, 3]


def test_the_library_is_not_called_word_by_word():
    rng = np.random.default_rng(12)
    texts = [" ".join("".join(x) for x in rng.choice([*"abcdefghijklmnopqrstuvwxyz"], (400, 9))) for _ in range(10)]
    encoder, calls = Encoder(tokenizer_path()), []

    def count(frame, event, called):
        if event == "c_call" and type(getattr(called, "__self__", None)).__module__.startswith("tokenizers"):
            calls.append(called.__name__)

    sys.setprofile(count)
    try:
        found = encoder.encode(texts)
    finally:
        sys.setprofile(None)
    assert 0 < len(calls) < 100 and found == encoder.whole(texts)
