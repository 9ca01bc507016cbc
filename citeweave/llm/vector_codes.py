"""Codes for vectors: each is cut into parts, and each part is named by an entry of a codebook.

Codebooks are fitted by Lloyd's rounds whose members stay where they are.  Parts live in files
by (position, entry, salt), their owner.  In a round, the task of an owner compares its members
with the codebook and writes them back without a shuffle; only members whose entry changes
are shuffled, to the partition of their new owner.  Then every owner sums the members it holds, and
one row of sums per entry and task is all that is combined.  An entry that holds a third of all
parts is as many owners as the salts say: a salt holds `OWNED` parts at most, whatever entry
they share.  A lost executor costs the files of one round at most, as every round is written.

The codebook is the only thing that passes through the driver: `entries` vectors of integers.

Defined results: rows whose vector is null, or holds null or non-finite components, are left
out, and so are vectors of another length than that of the smallest vec_id that is kept (ties:
the longest).  A length that `parts` doesn't divide is filled up with zeros.  Components become
integers `floor(scale * x)`, held within the bound at which the error of a vector fits a long: for
64 components 2^27, which is a component of 131,072 at the scale of 1024.  Sums of errors beyond
a long are held at its largest value.  Rows are ordered by vec_id (null last), then vector;
repeated rows are coded each and may be entries each.  With fewer rows than entries the codebook
has that many; an empty table gives an empty one.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts a salt of an owner holds at most, about.
OWNED = 1 << 18
#: Cells of a table of distances computed at once.
_CELLS = 1 << 20
_MEMBER = "row long, position int, part array<long>, entry int, moved boolean, error long"


@dataclass(frozen=True)
class Coded:
    """Codes of all kept rows, (vec_id, label, code, error), and the codebooks they refer to."""

    codes: DataFrame
    #: Integers by part, entry and place in the part.
    codebooks: np.ndarray

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def bound(length: int) -> int:
    """Largest integer of a component for which the error of a vector fits a long."""
    return math.isqrt((1 << 60) // max(1, length))


def nearest(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, the lowest on ties, and the squared distance."""
    entry, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    largest = max((int(np.abs(x).max(initial=0)) for x in (parts, codebook)), default=0)
    # Products of doubles are exact as long as no sum exceeds their 53 bits.
    exact = 4 * largest * largest * max(1, parts.shape[1]) < 1 << 53
    book = codebook.astype(np.float64) if exact else codebook
    squares = (book * book).sum(axis=1)
    step = max(1, _CELLS // (len(codebook) * (1 if exact else max(1, parts.shape[1]))))
    for start in range(0, len(parts), step):
        some = parts[start : start + step]
        if exact:
            some = some.astype(np.float64)
            distance = squares - 2 * (some @ book.T)
            own = (some * some).sum(axis=1)
        else:
            distance = ((some[:, None, :] - book) ** 2).sum(axis=2)
            own = 0
        at = distance.argmin(axis=1)
        entry[start : start + step] = at
        error[start : start + step] = distance[np.arange(len(some)), at] + own
    return entry, error


def _integers(vector: str, length: int, scale: int) -> Column:
    """Components as whole numbers `floor(scale * x)` within the bound."""
    most = float(bound(length))
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))))


def _kept(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and finite."""
    # A component that is not a number counts as larger than any.
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "embedding", "label").where(F.col("embedding").isNotNull() & finite)


def _assigned(members: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Members with the entry that is nearest now, whether it is another one, and the squared distance."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column("position").to_numpy(zero_copy_only=False)
            parts = batch.column("part").flatten().to_numpy(zero_copy_only=False).reshape(len(position), codebooks.shape[2])
            entry, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
            for p in np.unique(position):
                own = position == p
                entry[own], error[own] = nearest(parts[own], codebooks[p])
            before = batch.column("entry").to_numpy(zero_copy_only=False)
            columns = [pa.array(entry), pa.array(entry != before), pa.array(error)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "position", "part")), *columns],
                names=["row", "position", "part", "entry", "moved", "error"],
            )

    return members.select("row", "position", "part", "entry").mapInArrow(search, _MEMBER)


def _updated(members: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks with every used entry at the floor of the mean of its members."""
    width = codebooks.shape[2]
    sums = [F.sum(F.get("part", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    found = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *sums)
    new = codebooks.copy()
    # One row per entry at most.
    for r in found.collect():
        new[r["position"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return new


def code(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    owned: int = OWNED,
) -> Coded:
    """Codes of `vectors` (vec_id, embedding, label) after fitting the codebooks to them."""
    spark = vectors.sparkSession
    rows = _kept(vectors)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.size("embedding").desc()).select(F.size("embedding")).first()
    length = first[0] if first else 0
    width = -(-length // parts)
    cut = F.concat(_integers("embedding", length, scale), F.array_repeat(F.lit(0).cast("long"), parts * width - length))
    numbered = materialize(
        rows.where(F.size("embedding") == length).select(
            "vec_id", "label", cut.alias("vector"), F.monotonically_increasing_id().alias("row")
        ),
        "vectors",
    )
    seeds = numbered.orderBy(F.col("vec_id").asc_nulls_last(), "vector", "row").select("vector").limit(entries).collect()
    if not seeds:
        return Coded(spark.createDataFrame([], "vec_id long, label int, code string, error long"), np.empty((parts, 0, width), np.int64))
    books = np.array([r["vector"] for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)

    total = numbered.count()
    salts = max(1, math.ceil(total / owned))
    owner = [F.col("position"), F.col("entry"), F.pmod(F.xxhash64("row"), F.lit(salts))]
    partitions = max(parts * salts, spark.sparkContext.defaultParallelism)
    pieces = F.array([F.struct(F.lit(p).alias("position"), F.slice("vector", p * width + 1, width).alias("part")) for p in range(parts)])
    members = numbered.select("row", F.explode(pieces).alias("x")).select("row", "x.*", F.lit(-1).alias("entry"))
    for number in range(rounds):
        found = materialize(_assigned(members, books), f"members-{number}")
        arrivals = materialize(found.where("moved").repartition(partitions, *owner), f"arrivals-{number}")
        # The others stay in the files their task has written.
        members = found.where("not moved").unionByName(arrivals)
        books = _updated(members, books)
    last = materialize(_assigned(members, books), "members-last")
    digits = max(2, len(f"{entries - 1:x}"))
    by_row = last.groupBy("row").agg(
        *[F.max(F.when(F.col("position") == p, F.col("entry"))).alias(f"e{p}") for p in range(parts)], F.sum("error").alias("error")
    )
    named = F.concat(*[F.lpad(F.lower(F.hex(f"e{p}")), digits, "0") for p in range(parts)])
    return Coded(numbered.join(by_row, "row").select("vec_id", "label", named.alias("code"), "error"), books)


def label_errors(codes: DataFrame) -> DataFrame:
    """`codes` with the error summed over rows of the same label, those without label together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    labels = codes.groupBy(F.col("label").alias("of label")).agg(total.cast("long").alias("label_error"))
    return codes.join(labels, F.col("label").eqNullSafe(F.col("of label")), "left").drop("of label")
