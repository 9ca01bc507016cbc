"""Fingerprints of texts by consistent weighted sampling of their words.

A text's terms are its words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, each with its number of
occurrences as weight.  For every sample and term a hash of both draws r and c from a
gamma distribution of shape 2 and b evenly from 0 to 1.  A term of weight S takes the
sample's quantised level t = floor(ln S / r + b), y = exp(r (t - b)), and the sample picks
the term with the smallest c / (y exp(r)).  Two texts pick the same (term, t) with the probability of their generalised
Jaccard similarity: the sum of the smaller weights over that of the larger ones.  So the share of
equal samples estimates it, with a standard error of sqrt(s (1 - s) / samples).

A fingerprint is a text of four hexadecimal digits per sample.  Different picks share their
digits once in 65,536.  It depends on the text and the parameters alone, so fingerprints of
different tables can be compared, and equal texts have equal ones.

Nothing is shuffled for fingerprints.  `with_edited` deals documents over ranges of (doc_id, hash
of text), each with the first row of the following range behind it, so a task reads its range in
order and holds a slice of it.  The texts are shuffled once; the driver holds one key per range.

Defined results: null counts as the empty text; texts without words share the fingerprint of
zeros, which is like itself and unlike (with a chance of 2^-16 a sample) all others; repeated rows
each have a fingerprint.  In the order of `with_edited` rows without doc_id come first, rows with
the same doc_id stand by the hash of their text, then the text; the row after the last is the
first, which is the row itself in a table of one.  Rows that share both id and text stay in one range.  An empty table gives an empty one.  Other columns are left out.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.words import binary, scatter, slices, word_hashes

SAMPLES = 96
#: Cells, terms by samples, whose draws are made together.
_CELLS = 1 << 17
#: Bytes of text a range aims at.
RANGE_BYTES = 1 << 26
#: Terms whose distances are held at once.
_BLOCK = 1 << 16
#: Bytes of text fingerprinted together.
_SLICE = 1 << 22
_DEALT = "doc_id long, text string, hash long, range int, halo boolean"
_COMPARED = "doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, next_fingerprint string"


def _uniform(mixed: np.ndarray, shift: int) -> np.ndarray:
    """21 bits of 64 as numbers above 0 and below 1."""
    bits = ((mixed >> np.uint64(shift)) & np.uint64(0x1FFFFF)).view(np.int64).astype(np.int32).astype(np.float32)
    bits += np.float32(0.5)
    bits *= np.float32(2**-21)
    return bits


class Draws:
    """r, ln c and b of terms (64-bit hashes) for each sample."""

    def __init__(self, samples: int = SAMPLES) -> None:
        self.samples = samples
        self.seeds = scatter(np.arange(1, 2 * samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, samples)

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draws of all samples (columns) for all terms (rows)."""
        return self._drawn(terms[:, None], *self.seeds)

    def cells(self, terms: np.ndarray, samples: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draws of one sample for each term."""
        return self._drawn(terms, self.seeds[0][samples], self.seeds[1][samples])

    @staticmethod
    def _drawn(terms: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one, two = scatter(terms ^ first), scatter(terms ^ second)
        r = -np.log(_uniform(one, 0) * _uniform(one, 21))
        c = -np.log(_uniform(two, 0) * _uniform(two, 21))
        return r, np.log(c), _uniform(one ^ (two << np.uint64(1)), 43)


def counted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text and their weights, texts one after the other; terms per text."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    weights = np.diff(np.append(starts, len(hashes)))
    return hashes[starts], weights, np.bincount(text[starts], minlength=len(counts))


def prints(texts: list[bytes | None], draws: Draws) -> np.ndarray:
    """16 bits per sample of each text."""
    samples = draws.samples
    terms, weights, sizes = counted(*word_hashes(texts))
    out = np.zeros((len(texts), samples), np.uint16)
    if not len(terms):
        return out
    # Draws are made once per distinct term and weight of the slice.
    order = np.lexsort((weights, terms))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(terms[order]) != 0) | (np.diff(weights[order]) != 0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    terms, weights = terms[order[new]], weights[order[new]]
    stops = np.cumsum(sizes)
    starts = stops - sizes
    least = np.full((len(texts), samples), np.inf, np.float32)
    picked = np.zeros((len(texts), samples), np.int64)
    block = _BLOCK
    for low in range(0, len(terms), block):
        table = _distances(terms[low : low + block], weights[low : low + block], draws)
        for text, (start, stop) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
            own = number[start:stop]
            if len(terms) > block:
                # A text's terms come in order, so those of a block stand together.
                own = own[np.searchsorted(own, low) : np.searchsorted(own, low + block)]
            if not len(own):
                continue
            rows = table.take(own - low, axis=0, mode="clip")
            at = rows.argmin(axis=0)
            found = rows[at, np.arange(samples)]
            if low == 0:
                least[text], picked[text] = found, own[at]
            else:
                better = found < least[text]
                least[text, better], picked[text, better] = found[better], own[at[better]]
    held = sizes > 0
    term, weight = terms[picked[held]], weights[picked[held]]
    level = np.zeros(term.shape, np.uint64)
    several = weight > 1
    if several.any():
        r, _, b = draws.cells(term[several], np.broadcast_to(np.arange(samples), term.shape)[several])
        level[several] = np.floor(np.log(weight[several].astype(np.float32)) / r + b).astype(np.uint64)
    out[held] = (scatter(term + scatter(level + np.uint64(1))) >> np.uint64(48)).astype(np.uint16)
    return out


def _distances(terms: np.ndarray, weights: np.ndarray, draws: Draws) -> np.ndarray:
    """ln(c / (y exp(r))) by weighted term and sample."""
    out = np.empty((len(terms), draws.samples), np.float32)
    step = max(1, _CELLS // draws.samples)
    for start in range(0, len(terms), step):
        part = slice(start, start + step)
        r, c, b = draws.of(terms[part])
        weight = np.log(weights[part].astype(np.float32))[:, None]
        out[part] = c - r * (np.floor(weight / r + b) - b + 1)
    return out


def _hex(found: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in found]


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of every text."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(samples)
        for batch in slices(batches, "text", _SLICE):
            found = _hex(prints(binary(batch.column("text")), draws))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found)], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(search, "doc_id long, fingerprint string")


def likeness(one: str | Column, other: str | Column, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree: estimates the generalised Jaccard similarity."""
    one, other = (F.col(x) if isinstance(x, str) else x for x in (one, other))
    places = F.sequence(F.lit(0), F.lit(samples - 1))
    same = F.filter(places, lambda i: F.substr(one, 4 * i + 1, F.lit(4)) == F.substr(other, 4 * i + 1, F.lit(4)))
    return F.size(same) / samples


def tail_replaced(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the one that follows."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _in_ranges(docs: DataFrame, range_bytes: int) -> DataFrame:
    """Rows in order of doc_id and hash of text, per partition; behind each range the row that follows it.

    Columns doc_id, text, hash, range, halo; `halo` marks the rows that belong to the next range.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_ranges = max(1, math.ceil(size / range_bytes))
    keys = rows.select("doc_id", "hash").repartitionByRange(n_ranges, F.col("doc_id").asc_nulls_first(), "hash")
    first = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct("doc_id", "hash")).alias("key"))

    def ordered(doc_id: int | None, code: int) -> tuple[bool, int, int]:
        return doc_id is not None, doc_id or 0, code

    # One key per range.
    bounds = sorted(ordered(*r["key"]) for r in first.collect())
    at_bound = {b: (i - 1) % len(bounds) for i, b in enumerate(bounds)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [ordered(*k) for k in zip(batch.column("doc_id").to_pylist(), batch.column("hash").to_pylist(), strict=True)]
            halos = [i for i, k in enumerate(own) if k in at_bound]
            ranges = [bisect_right(bounds, k) - 1 for k in own] + [at_bound[own[i]] for i in halos]
            both = pa.Table.from_batches([batch]).take(pa.array([*range(len(own)), *halos], pa.int64()))
            both = both.append_column("range", pa.array(ranges, pa.int32()))
            yield from both.append_column("halo", pa.array([False] * len(own) + [True] * len(halos))).to_batches()

    dealt = rows.mapInArrow(deal, _DEALT).repartition(n_ranges, "range")
    return dealt.sortWithinPartitions("range", "halo", F.col("doc_id").asc_nulls_first(), "hash", "text")


def with_edited(
    docs: DataFrame,
    edit: Callable[[str, str], str] = tail_replaced,
    samples: int = SAMPLES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Every text with what `edit` makes of it and the next one, and the fingerprints of all three.

    Columns doc_id, text, edited, fingerprint, edited_fingerprint, next_fingerprint.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(samples)
        waiting: list[tuple[int | None, str, bool]] = []
        for batch in slices(batches, "text", _SLICE):
            rows = waiting + list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "halo")), strict=True))
            waiting = rows[-1:]
            # A row of a range is followed by another of it, or by the first of the next range.
            own = [i for i, row in enumerate(rows[:-1]) if not row[2]]
            texts = [row[1] for row in rows]
            edited = [edit(texts[i], texts[i + 1]) for i in own]
            found = _hex(prints([t.encode() for t in texts + edited], draws))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][0] for i in own], pa.int64()),
                    pa.array([texts[i] for i in own], pa.string()),
                    pa.array(edited, pa.string()),
                    pa.array([found[i] for i in own], pa.string()),
                    pa.array(found[len(rows) :], pa.string()),
                    pa.array([found[i + 1] for i in own], pa.string()),
                ],
                names=[x.split()[0] for x in _COMPARED.split(", ")],
            )

    return _in_ranges(docs, range_bytes).drop("hash", "range").mapInArrow(search, _COMPARED)
