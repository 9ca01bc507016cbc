"""Periodic runs of the words of texts: stretches that repeat a short period four times or more.

A run is a stretch of consecutive words with smallest period q and a length of at least
`max(LEAST, REPEATS * q)` that no neighbouring word extends keeping the period.  Runs are found
on harmonic grids: a run of period p holds, in one go, at least `(REPEATS - 1) * p` places whose
word equals the one p further on, so one place of every grid of that step lies in it.  For each
period the grid's places are extended to both sides by longest common extensions, which cost
n/p queries each, n log n in all.

An extension is answered by a difference cover.  Only the suffixes at places whose remainder by
the modulus lies in the cover are sorted, by doubling over blocks of `modulus` words; a sparse
table over the blocks that neighbours share answers minima.  Two places are first compared word
by word until both are sampled, which takes fewer words than the modulus; most places of a grid
differ before that, and a slice of texts without longer repeats sorts nothing.

Texts are searched in tasks, a slice of a few megabytes at once; a text is never cut and never
compared with another, so nothing is shuffled.

Defined results: a null text, an empty one or one without words has no run, no words and the
empty collapsed text; words are compared as they are, bytes for bytes; repeated rows are
answered each; rows without doc_id like others; of a stretch that has several periods the
smallest counts; an empty table gives an empty one.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.words import binary, scatter, slices

#: Times a period must fit into a run, and words a run must have.
REPEATS, LEAST = 4, 6
#: A modulus and a set of remainders whose differences are all remainders (fixed values).
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Grid places looked at together.
_CHUNK = 1 << 21
_RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string"


class Extensions:
    """Longest common extensions in a sequence of ids, by a difference cover of its suffixes.

    Two places that are compared must lie in one text, and a separator that occurs nowhere else
    must stand before and behind every text, so that no extension leaves it.
    """

    def __init__(self, ids: np.ndarray, text_of: np.ndarray, modulus: int = MODULUS, cover: tuple[int, ...] = COVER) -> None:
        self.ids, self.text_of, self.modulus = ids, text_of, modulus
        self.cover = np.array(sorted(cover))
        held = np.zeros(modulus, bool)
        held[self.cover] = True
        steps = np.arange(modulus)
        # Words to go until two places with these remainders are both sampled.
        both = held[(steps[:, None, None] + steps) % modulus] & held[(steps[None, :, None] + steps) % modulus]
        if not both.any(axis=2).all():
            raise ValueError(f"{cover} is no difference cover of {modulus}")
        self.until = both.argmax(axis=2)
        self._rank: np.ndarray | None = None

    def longest(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words from each x and y on."""
        out = np.zeros(len(x), np.int64)
        at = np.flatnonzero(self.ids[x] == self.ids[y])
        until = self.until[x[at] % self.modulus, y[at] % self.modulus]
        for k in range(self.modulus):
            there = until == k
            if there.any():
                met = at[there]
                out[met] = k + self._sampled(x[met] + k, y[met] + k)
                at, until = at[~there], until[~there]
            same = self.ids[x[at] + k] == self.ids[y[at] + k]
            out[at[~same]] = k
            at, until = at[same], until[same]
            if not len(at):
                break
        return out

    def _sampled(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words from sampled places on: whole blocks by the sparse table, then fewer words than a block."""
        if self._rank is None:
            self._sort()
        a, b = self._rank[self._index(x)], self._rank[self._index(y)]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        blocks = np.minimum(self._least[level, low], self._least[level, high - (1 << level)])
        out = blocks.astype(np.int64) * self.modulus
        at = np.arange(len(x))
        while len(at):
            same = self.ids[x[at] + out[at]] == self.ids[y[at] + out[at]]
            at = at[same]
            out[at] += 1
        return out

    def _index(self, places: np.ndarray) -> np.ndarray:
        return self._class[places % self.modulus] * self._width + places // self.modulus

    def _sort(self) -> None:
        """Ranks of the sampled suffixes in the order of their blocks, and the minima of shared blocks."""
        modulus, n = self.modulus, len(self.ids)
        self._width = width = n // modulus + 1
        self._class = np.full(modulus, -1)
        self._class[self.cover] = np.arange(len(self.cover))
        places = (self.cover[:, None] + modulus * np.arange(width)).ravel()
        inside = places < n
        padded = np.concatenate([self.ids, np.full(2 * modulus, -1)])
        rank = np.zeros(len(places), np.int64)
        rank[inside] = self._names(places[inside], padded)
        levels = [rank]
        column = np.tile(np.arange(width), len(self.cover))
        span, total = 1, int(inside.sum())
        # Ranks count from 1; 0 stands for what lies beyond the end.
        while int(rank.max()) < total:
            follow = np.zeros_like(rank)
            further = np.flatnonzero(column + span < width)
            follow[further] = rank[further + span]
            key = rank * (int(rank.max()) + 1) + follow
            rank = np.zeros_like(rank)
            rank[inside] = np.unique(key[inside], return_inverse=True)[1] + 1
            levels.append(rank)
            span *= 2
        self._rank = rank - 1
        order = np.empty(total, np.int64)
        order[rank[inside] - 1] = np.flatnonzero(inside)
        a, b = order[:-1], order[1:]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            fits = (column[a] + shared < width) & (column[b] + shared < width)
            far = np.where(fits, shared, 0)
            same = fits & (levels[k][a + far] == levels[k][b + far]) & (levels[k][a + far] > 0)
            shared[same] += 1 << k
        tables = [shared.astype(np.int32)]
        while 1 << len(tables) <= len(shared):
            last, half = tables[-1], 1 << (len(tables) - 1)
            tables.append(np.concatenate([np.minimum(last[:-half], last[half:]), last[-half:]]))
        self._least = np.stack(tables)

    def _names(self, places: np.ndarray, padded: np.ndarray) -> np.ndarray:
        """Numbers from 1 on for the blocks at these places: equal blocks of one text have equal ones."""
        texts = self.text_of[places].astype(np.uint64)
        for seed in range(1, 9):
            factors = scatter(np.arange(1, self.modulus + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)
            name = scatter(texts + np.uint64(seed))
            for k in range(self.modulus):
                name = name + scatter(padded[places + k].astype(np.uint64) + np.uint64(seed)) * factors[k]
            _, first, number = np.unique(name, return_index=True, return_inverse=True)
            # Names are hashes: every block is compared with the first of its name.
            same = texts == texts[first[number]]
            for k in range(self.modulus):
                same &= padded[places + k] == padded[places[first[number]] + k]
            if same.all():
                return number.astype(np.int64) + 1
        raise RuntimeError("blocks of words can't be told apart by hashes")


def _grids(sizes: np.ndarray, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in it, period) of all grid places of texts of these sizes, a bounded number at a time."""
    most = sizes // repeats
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (repeats - 1) * period
    counts = (sizes[text] - 1 - period) // step + 1
    ends = np.cumsum(counts)
    start = 0
    while start < len(text):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + _CHUNK, "right")))
        part = counts[start:stop]
        number = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        yield np.repeat(text[start:stop], part), number * np.repeat(step[start:stop], part), np.repeat(period[start:stop], part)
        start = stop


def runs_of(
    words: list[np.ndarray],
    repeats: int = REPEATS,
    least: int = LEAST,
    modulus: int = MODULUS,
    cover: tuple[int, ...] = COVER,
) -> list[np.ndarray]:
    """Runs of each text, given as word ids from 0 on: rows (start, length, period) by start, then period."""
    sizes = np.array([len(w) for w in words], np.int64)
    # separator, text, separator, text, ..., separator
    pieces = [np.array([-2], np.int64)]
    for number, w in enumerate(words):
        pieces += [w, np.array([-3 - number], np.int64)]
    ids = np.concatenate(pieces).astype(np.int64)
    text_of = np.repeat(np.arange(len(words) + 1), np.append(sizes, 0) + 1)
    first = np.cumsum(sizes + 1) - sizes
    ahead = Extensions(ids, text_of, modulus, cover)
    back = Extensions(ids[::-1].copy(), text_of[::-1].copy(), modulus, cover)
    found = [np.empty((4, 0), np.int64)]
    for text, place, period in _grids(sizes, repeats):
        x = first[text] + place
        keep = ids[x] == ids[x + period]
        x, text, period = x[keep], text[keep], period[keep]
        right = ahead.longest(x, x + period)
        last = len(ids) - 1
        left = back.longest(last - (x - 1), last - (x + period - 1))
        length = right + left + period
        keep = length >= np.maximum(least, repeats * period)
        found.append(np.stack([text, x - left - first[text], length, period])[:, keep])
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))
    rows = np.stack([text, start, length, period])[:, order]
    # Multiples of a period span the same stretch; the smallest comes first.
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    rows = rows[:, new]
    rows = rows[:, np.lexsort((rows[3], rows[1], rows[0]))]
    cuts = np.searchsorted(rows[0], np.arange(1, len(words)))
    return [part.T for part in np.split(rows[1:], cuts, axis=1)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: of every run the first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every text; `collapsed` keeps the first period of each run."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [(t or b"").split() for t in binary(batch.column("text"))]
            known: dict[bytes, int] = {}
            words = [np.array([known.setdefault(w, len(known)) for w in t], np.int64) for t in texts]
            runs = runs_of(words, repeats, least)
            collapsed = [
                b" ".join(compress(t, kept_words(len(t), r).tolist()) if len(r) else t) for t, r in zip(texts, runs, strict=True)
            ]
            flat = np.concatenate(runs)
            ends = np.cumsum([0, *(len(r) for r in runs)]).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), entries),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(search, SCHEMA)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, then the smallest start, then the smallest period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(
        best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"))
    )
