"""Best-fit packing of documents into sequences by the sum of squares.

Documents become token ids with an end id; longer ones than a sequence are cut, so that all
pieces but the first are full.  Full pieces are sequences of their own.  The others are dealt
to groups of bounded size, which pack independently: pieces come by falling length, and each
goes into that open sequence which makes the sum, over all gaps, of the squared number of open
sequences with that gap smallest; a new one is opened only where nothing fits.  A group
leaves a few sequences unfilled, so the loss shrinks with the size of a group, not with the
number of documents.

Defined results: a null or empty text is the end id alone; rows without doc_id are packed like
others; equal lengths are ordered by doc_id and piece; repeated rows are packed each; an empty
table gives no pieces.  Other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.tokens import Encoder
from citeweave.llm.words import slices
from citeweave.session import materialize

CAPACITY = 2048
#: Pieces per group that the number of groups aims at.
GROUP = 1 << 16
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False, special_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of all texts; `ids` are 32-bit little-endian."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, special_ids=special_ids)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for row, packed in enumerate(encoder.encode(texts)):
                ids = np.frombuffer(packed, encoder.dtype).astype("<u4").tobytes() + end
                n = len(ids) // 4
                first = n % capacity or capacity
                starts = [0, *range(first, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    part = ids[4 * a : 4 * b]
                    rows.append((row, piece, a, b - a, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*rows, strict=True))
            arrays = [
                batch.column("doc_id").take(pa.array(columns[0], pa.int64())).cast(pa.int64()),
                pa.array(columns[1], pa.int32()),
                *(pa.array(c, pa.int64()) for c in columns[2:5]),
                *([pa.array(columns[5], pa.binary())] if with_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

    schema = _PIECES + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces that come in this order; sequences count from 0."""
    open_at = np.zeros(capacity + 1, np.int64)  # open sequences per level they are filled to
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        levels = open_at[1 : capacity - length + 1]
        level = 0
        if levels.any():
            # Change of the sum of squares when a sequence moves up by `length`; a full one is closed.
            change = 2 * (open_at[length + 1 :] - levels) + 2
            change[-1] -= 1
            change[levels == 0] = np.iinfo(np.int64).max
            level = len(change) - int(np.argmin(change[::-1]))
        if level:
            open_at[level] -= 1
            place = waiting[level].pop()
        else:
            place, opened = opened, opened + 1
        sequence[i], offset[i] = place, level
        filled = level + length
        if filled < capacity:
            open_at[filled] += 1
            waiting[filled].append(place)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (with a column `length`) with `sequence_id` and `offset`."""
    numbered = materialize(pieces.withColumn("piece number", F.monotonically_increasing_id()), "packing-pieces")
    full = numbered.where(F.col("length") == capacity).select(
        *pieces.columns, (-F.col("piece number") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = numbered.where(F.col("length") < capacity)
    n_groups = max(1, math.ceil(short.count() / GROUP))

    def placed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "piece number"], ascending=[False, True, True, True])
        sequence, offset = sum_of_squares(group["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame(
            {"piece number": group["piece number"].to_numpy(), "sequence_id": (int(key[0]) << 32) + sequence, "offset": offset}
        )

    narrow = short.select("doc_id", "piece", "length", "piece number", F.pmod("piece number", F.lit(n_groups)).alias("group"))
    places = narrow.groupBy("group").applyInPandas(placed, "`piece number` long, sequence_id long, offset long")
    return full.unionByName(short.join(places, "piece number").select(*pieces.columns, "sequence_id", "offset"))
