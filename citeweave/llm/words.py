"""Words and shared helpers of the operators, for use inside Arrow tasks.

Texts are handled as UTF-8 bytes: lower-casing touches A-Z only, and the classes of the word
patterns below 0x80 are byte classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing; all others become blanks.
_ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def as_alnum(text: bytes | None) -> bytes:
    """Lower-cased, with a blank for everything but digits, letters a-z and characters beyond ASCII."""
    return text.translate(_ALNUM) if text else b""


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters a-z and characters beyond ASCII."""
    return as_alnum(text).split()


_DRAWN = np.random.default_rng(20240101)
#: Random odd factors: per byte value, per place in a word, per place in a shingle.
_BYTES, _PLACES, _SHINGLE = (_DRAWN.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 1 << 12, 64))
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\x20\x09-\x0D]+` of all texts, A-Z lower-cased; words per text.

    All texts are cut at once: a word's hash is the sum, over its bytes, of a factor for the
    byte times a factor for its place.
    """
    whole = np.frombuffer(b"\n".join([b"", *(t or b"" for t in texts), b""]).lower(), np.uint8)
    blank = _BLANK[whole]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    sizes = stops - starts
    ends = np.cumsum(np.array([0, *(len(t or b"") + 1 for t in texts)]))
    counts = np.diff(np.searchsorted(starts, ends + 1))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    first = np.cumsum(sizes) - sizes
    letters = whole[~blank]
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    longest = int(sizes.max())
    factors = _PLACES if longest <= len(_PLACES) else np.concatenate([_PLACES, scatter(np.arange(longest, dtype=np.uint64)) | np.uint64(1)])
    return np.add.reduceat(_BYTES[letters] * factors[place], first), counts


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of `width` words of each text.

    A text of fewer words has the whole sequence as its only one, a text without words none.
    """
    words, counts = word_hashes(texts)
    n = max(0, len(words) - width + 1)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += words[k : k + n] * _SHINGLE[k]
    total = scatter(total)
    out, at = [], 0
    for count in counts.tolist():
        if count >= width:
            out.append(np.unique(total[at : at + count - width + 1]))
        elif count:
            short = (words[at : at + count] * _SHINGLE[:count]).sum(dtype=np.uint64) + np.uint64(count)
            out.append(scatter(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out


def scatter(x: np.ndarray) -> np.ndarray:
    """Mix the bits of an array of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def binary(column: pa.Array) -> list[bytes | None]:
    """A text column as bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def quoted(column: str) -> str:
    """A column's name for `select`, whatever signs it holds."""
    return "`" + column.replace("`", "``") + "`"


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in pieces of about `limit` bytes of one column, a row at least."""
    for batch in batches:
        sizes = np.array([len(x) if x is not None else 0 for x in binary(batch.column(column))], np.int64)
        groups = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(groups, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)
