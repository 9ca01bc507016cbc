from __future__ import annotations

import random

import pytest

#: Cases every operator on documents must stand: nulls, empty and long texts, ties, odd blanks.
ODD = [
    (1001, None), (1002, ""), (1003, "\n\n"), (1004, " \t "), (1005, "one"), (1006, "ONE"), (1007, "a b c d"),
    (1008, "Same line here\nsame LINE here \n"), (1009, "same line here"), (1010, "x  y\x0bz\r\n\tq"), (1011, "é È ñ 中文 ﬁ"),
    (1012, "w " * 5000), (1013, "\x1f a\x1fb <|endoftext|> $$ || <b>"), (1014, "a b c d"),
]


def made_docs(n: int = 120, seed: int = 3) -> list[tuple[int, str | None]]:
    """Documents with exact and near copies, shared lines and passages, and the odd cases."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(300)]

    def text(size):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(size))

    docs: list[tuple[int, str | None]] = []
    shared = [text(12) for _ in range(4)]
    for doc_id in range(n):
        if docs and rng.random() < 0.5:
            base = rng.choice(docs)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                base[rng.randrange(len(base))] = rng.choice(words)
            made = " ".join(base)
        else:
            made = text(rng.choice([3, 6, 20, 60, 150, 400]))
        if rng.random() < 0.3:
            made += "\n" + rng.choice(shared)
        docs.append((doc_id, made))
    return docs + ODD


@pytest.fixture(scope="session")
def docs():
    return made_docs()


@pytest.fixture(scope="session")
def frame(spark, docs):
    """The documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, i % 3, "x", None) for i, t in docs]
    schema = "doc_id long, text string, failures int, node string, n_lines long"
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture(scope="session")
def empty(frame):
    return frame.where("false")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
