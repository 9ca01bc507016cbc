"""Normalised indel similarity of two titles: ``2 * LCS / (len a + len b)``.

Spark's ``levenshtein`` charges one for a substitution and so orders pairs differently.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed_values import TITLE_THRESHOLD
from .text import is_blank, strip_space

# Workers get this module with the function, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine-word-parallel row per character of ``b``."""
    if len(a) < len(b):
        a, b = b, a
    full = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    # A zero bit marks a position of ``a`` at which the LCS grows.
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


#: Places of a text in one number, which leaves room for a carry.
PLACES = 62
#: Numbers that a text compared in step with others may take; a pair goes with those of the next size.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 8, 10, 13, 16, 20, 26, 32])
#: Pairs for each number of the width from which steps together are faster than one by one.
TOGETHER = 12
#: Entries of the tables of the pairs compared at once.
TABLE = 1 << 21
#: Characters of the texts that wait for others of like length.
WAITING = 1 << 24


def lcs_lengths(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """``lcs_length`` of many pairs, those of like length in step with each other, very long ones one by one."""
    out = np.zeros(len(pairs), np.int64)
    ordered = [(a, b) if len(a) >= len(b) else (b, a) for a, b in pairs]
    sizes = np.searchsorted(WIDTHS, np.array([-(-len(a) // PLACES) for a, _ in ordered], np.int64))
    steps = np.array([len(b) for _, b in ordered], np.int64)
    for size in np.unique(sizes).tolist():
        here = np.flatnonzero((sizes == size) & (steps > 0))
        if size == len(WIDTHS) or len(here) < TOGETHER * WIDTHS[size]:
            out[here] = [lcs_length(*ordered[i]) for i in here.tolist()]
        else:
            here = here[np.argsort(-steps[here], kind="stable")]
            out[here] = _in_step([ordered[i] for i in here.tolist()], int(WIDTHS[size]), steps[here])
    return out


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _in_step(pairs: list[tuple[str, str]], width: int, steps: np.ndarray) -> np.ndarray:
    """LCS of pairs whose first text takes ``width`` numbers at most; the second ones are of falling length ``steps``."""
    first, second = _codes([a for a, _ in pairs]), _codes([b for _, b in pairs])
    letter = np.zeros(int(max(first.max(), second.max())) + 1, np.int64)
    letter[second] = 1
    known = letter[first] > 0
    n, k = len(pairs), int(letter.sum())
    if n > 1 and n * k * width > TABLE:
        half = n // 2
        return np.concatenate([_in_step(pairs[:half], width, steps[:half]), _in_step(pairs[half:], width, steps[half:])])
    letter = letter.cumsum() - 1
    # Where each letter stands in the first text of a pair, a bit for each place.
    sizes = np.array([len(a) for a, _ in pairs], np.int64)
    place = np.arange(len(first)) - np.repeat(sizes.cumsum() - sizes, sizes)
    where = np.zeros(width * n * k, np.int64)
    at = ((place // PLACES) * n + np.repeat(np.arange(n), sizes)) * k + letter[first]
    np.add.at(where, at[known], np.left_shift(1, place % PLACES)[known])
    where = where.reshape(width, n * k)
    # The entry of each step of each pair, steps after steps.
    alive = np.searchsorted(-steps, -np.arange(1, steps[0] + 1), "right")
    pair = np.repeat(np.arange(n), steps)
    step = np.arange(len(second)) - np.repeat(steps.cumsum() - steps, steps)
    entries = np.empty(len(second), np.int64)
    entries[(alive.cumsum() - alive)[step] + pair] = pair * k + letter[second]
    # A zero bit marks a place of the first text at which the LCS grows.
    full = (1 << PLACES) - 1
    row = np.full((width, n), full)
    rooms, carry, done = np.empty((2, n), np.int64), np.empty(n, np.int64), 0
    for m in alive.tolist():
        entry = entries[done : done + m]
        done += m
        hit, new, over = rooms[0, :m], rooms[1, :m], carry[:m]
        over.fill(0)
        for w in range(width):
            old = row[w, :m]
            where[w].take(entry, out=hit, mode="clip")
            np.bitwise_and(hit, old, out=hit)
            np.add(old, hit, out=new)
            np.add(new, over, out=new)
            np.right_shift(new, PLACES, out=over)
            np.bitwise_xor(old, hit, out=old)
            np.bitwise_or(old, new, out=old)
            np.bitwise_and(old, full, out=old)
    return PLACES * width - np.bitwise_count(row).sum(axis=0, dtype=np.int64)


@F.pandas_udf(T.DoubleType())
def _indel_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def ratios() -> Iterator[pd.Series]:
        lengths = np.array([len(x) + len(y) for x, y in pairs], np.int64)
        found = np.split(2.0 * lcs_lengths(pairs) / np.maximum(lengths, 1), np.cumsum([c.sum() for c in compared])[:-1])
        for values, here in zip(found, compared, strict=True):
            out = pd.Series(np.nan, index=range(len(here)), dtype="Float64")
            out[here] = values
            yield out.mask(~here)

    pairs, compared, waiting = [], [], 0
    for a, b in batches:
        here = (a.notna() & b.notna()).to_numpy()
        pairs += zip(a[here], b[here], strict=True)
        compared.append(here)
        waiting += int(a[here].str.len().sum() + b[here].str.len().sum()) + len(here)
        if waiting >= WAITING:
            yield from ratios()
            pairs, compared, waiting = [], [], 0
    if compared:
        yield from ratios()


def _comparable(title: Column) -> Column:
    return F.lower(strip_space(title))


def title_similarity(title: Column, other: Column, only_if: Column | None = None) -> Column:
    """Similarity in [0, 1] of two titles, ignoring case and outer white space.

    Equal titles and missing titles are settled natively; only the rest goes to Python.
    Rows outside ``only_if`` are not compared at all and come out as 0.
    """
    a, b = _comparable(title), _comparable(other)
    missing = is_blank(strip_space(title)) | is_blank(strip_space(other))
    if only_if is not None:
        missing = missing | ~F.coalesce(only_if, F.lit(False))
    compare = ~missing & (title != other) & (a != b)
    ratio = _indel_ratio(F.when(compare, a), F.when(compare, b))
    return F.coalesce(ratio, F.when(missing, 0.0).otherwise(1.0))


def title_similarity_native(title: Column, other: Column) -> Column:
    """The same value out of nested folds: slow, kept as a cross-check for tests."""
    a, b = _comparable(title), _comparable(other)
    left, right = F.split(a, ""), F.split(b, "")
    zeros = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def next_row(row: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.length(b)),
            F.array(F.lit(0)),
            lambda acc, j: F.array_append(
                acc,
                F.when(ch == F.get(right, j - 1), F.get(row, j - 1) + 1).otherwise(
                    F.greatest(F.get(row, j), F.element_at(acc, -1))
                ),
            ),
        )

    last = F.aggregate(left, zeros, next_row)
    ratio = 2.0 * F.element_at(last, -1) / (F.length(a) + F.length(b))
    return F.when(is_blank(a) | is_blank(b), 0.0).otherwise(ratio)


def title_valid(similarity: Column, threshold: float = TITLE_THRESHOLD) -> Column:
    return similarity > threshold
