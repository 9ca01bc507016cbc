"""Incremental line deduplication: sharded cuckoo filters in front of exact reference counts.

The state is a folder of three tables, replaced version by version:

* `postings` (shard, hi, lo, doc_id): which document holds which line, the exact table that
  makes deletions reversible;
* `counts` (shard, hi, lo, n_docs, first_doc): references per line, derived from it;
* `filters` (shard, n_buckets, slots): one cuckoo filter per shard over the lines of `counts`.

A batch asks the filters first: a line they don't know is new and needs no look at `counts`;
only lines they may know are joined with `counts`.  Lines whose last document goes leave the
filter again.  Shards are cut from the line's hash, so that a hot line is one key of one
shard; everything is reduced to one row per line, with partial sums before the shuffle,
before any shard meets a task.  The number of shards follows the number of lines.

Lines are known by 128-bit hashes of their keys (stripped, A-Z lower-cased).

Defined results: a null or empty text is one empty line; lines with keys under 10 code points
are never dropped; a line repeated within one document only stays; repeated rows of one
document count as one reference and keep the same lines; an empty table gives an empty state.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.words import quoted
from citeweave.session import materialize

MIN_KEY = 10
#: Lines per shard that the number of shards aims at: some megabytes in a task.
SHARD_LINES = 250_000
SLOTS = 4
_BLANKS = " \t\n\x0b\x0c\r"
_KEYED = "doc_id long, line_no int, hi long, lo long"
_FILTERS = "shard int, n_buckets long, slots binary"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        lines = pc.split_pattern(texts, "\n")
        flat, rows = lines.flatten(), pc.list_parent_indices(lines).to_numpy()
        counts = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
        numbers = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = pc.ascii_lower(pc.utf8_trim(flat, characters=_BLANKS))
        long_enough = pc.greater_equal(pc.utf8_length(keys), MIN_KEY).to_numpy(zero_copy_only=False)
        chosen = np.flatnonzero(long_enough)
        digests = b"".join(map(xxhash.xxh3_128_digest, keys.take(pa.array(chosen)).to_pylist()))
        parts = np.frombuffer(digests, ">i8").reshape(-1, 2).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows[chosen])).cast(pa.int64()),
                pa.array(numbers[chosen].astype(np.int32)),
                pa.array(parts[:, 0]),
                pa.array(parts[:, 1]),
            ],
            names=["doc_id", "line_no", "hi", "lo"],
        )


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, hi, lo) of every line whose key is long enough; rows without id give none."""
    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_keyed, _KEYED)


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit marks, four slots a bucket, two buckets a line."""

    def __init__(self, n_buckets: int, slots: bytes | None = None) -> None:
        self.n_buckets = n_buckets
        stored = np.frombuffer(slots, np.uint16) if slots is not None else np.zeros(n_buckets * SLOTS, np.uint16)
        self.table = stored.reshape(n_buckets, SLOTS).copy()

    @classmethod
    def for_lines(cls, n: int) -> CuckooFilter:
        """A filter that is at most 70 % full with n lines; the bucket count is a power of two."""
        return cls(1 << max(0, math.ceil(math.log2(max(1, n) / SLOTS / 0.7))))

    def _places(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = lo.astype(np.int64).view(np.uint64), hi.astype(np.int64).view(np.uint64)
        marks = (low & np.uint64(0xFFFF)).astype(np.uint16)
        marks[marks == 0] = 1
        first = ((low >> np.uint64(16)) ^ (high << np.uint64(7))) & np.uint64(self.n_buckets - 1)
        first = first.astype(np.int64)
        return marks, first, self._other(first, marks)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            step = np.asarray(mark, np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        return bucket ^ (step & np.uint64(self.n_buckets - 1)).astype(np.int64)

    def may_hold(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        marks, a, b = self._places(lo, hi)
        return (self.table[a] == marks[:, None]).any(1) | (self.table[b] == marks[:, None]).any(1)

    def insert(self, lo: np.ndarray, hi: np.ndarray) -> bool:
        """Add distinct lines; False when a line found no place, so that a larger filter is due."""
        marks, a, b = self._places(lo, hi)
        rows = self.table.tolist()
        for mark, one, two in zip(marks.tolist(), a.tolist(), b.tolist(), strict=True):
            for at in (one, two):
                if 0 in rows[at]:
                    rows[at][rows[at].index(0)] = mark
                    break
            else:
                at = two
                for kick in range(500):
                    slot = kick % SLOTS
                    mark, rows[at][slot] = rows[at][slot], mark
                    at = int(self._other(np.int64(at), np.uint16(mark)))
                    if 0 in rows[at]:
                        rows[at][rows[at].index(0)] = mark
                        break
                else:
                    return False
        self.table = np.array(rows, np.uint16).reshape(self.n_buckets, SLOTS)
        return True

    def delete(self, lo: np.ndarray, hi: np.ndarray) -> None:
        """Remove lines that were inserted."""
        marks, a, b = self._places(lo, hi)
        for mark, one, two in zip(marks, a, b, strict=True):
            at = one if mark in self.table[one] else two
            self.table[at, np.flatnonzero(self.table[at] == mark)[0]] = 0


def _filled(lo: np.ndarray, hi: np.ndarray) -> CuckooFilter:
    size = len(lo)
    while not (made := CuckooFilter.for_lines(size)).insert(lo, hi):
        size *= 2
    return made


def _shard_rows(shard: int, made: CuckooFilter) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard], "n_buckets": [made.n_buckets], "slots": [made.table.tobytes()]})


def _build(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
    return _shard_rows(int(key[0]), _filled(lines["lo"].to_numpy(), lines["hi"].to_numpy()))


def _stored(filters: pd.DataFrame) -> CuckooFilter | None:
    return CuckooFilter(int(filters["n_buckets"].iloc[0]), filters["slots"].iloc[0]) if len(filters) else None


def _ask(key: tuple, lines: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    known = _stored(filters)
    lines["maybe"] = known.may_hold(lines["lo"].to_numpy(), lines["hi"].to_numpy()) if known else False
    return lines


def _put_in(key: tuple, lines: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter with new lines in it; without slots if it has become too full."""
    known, lo, hi = _stored(filters), lines["lo"].to_numpy(), lines["hi"].to_numpy()
    if known is None:
        known = _filled(lo, hi)
    elif not known.insert(lo, hi):
        return pd.DataFrame({"shard": [int(key[0])], "n_buckets": [0], "slots": [None]})
    return _shard_rows(int(key[0]), known)


def _take_out(key: tuple, lines: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    known = _stored(filters)
    if known is None:
        return pd.DataFrame({"shard": [], "n_buckets": [], "slots": []})
    known.delete(lines["lo"].to_numpy(), lines["hi"].to_numpy())
    return _shard_rows(int(key[0]), known)


_LINE = ["shard", "hi", "lo"]
_POSTINGS = "shard int, hi long, lo long, doc_id long"
_COUNTS = "shard int, hi long, lo long, n_docs long, first_doc long"


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*_LINE).agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


class LineIndex:
    """One version of the state; `insert` and `delete` hand back the next one."""

    def __init__(self, n_shards: int, postings: DataFrame, counts: DataFrame, filters: DataFrame) -> None:
        self.n_shards, self.postings, self.counts, self.filters = n_shards, postings, counts, filters

    @classmethod
    def empty(cls, spark: SparkSession, n_lines: int = 0) -> LineIndex:
        """No lines yet; cut into shards for about `n_lines` to come."""
        n_shards = max(1, math.ceil(n_lines / SHARD_LINES))
        return cls(n_shards, *(spark.createDataFrame([], schema) for schema in (_POSTINGS, _COUNTS, _FILTERS)))

    def insert(self, keyed: DataFrame) -> LineIndex:
        """Add the lines of documents, of which none is in the state with other lines."""
        shard = F.pmod(F.col("hi"), F.lit(self.n_shards)).cast("int").alias("shard")
        batch = materialize(keyed.select(shard, "hi", "lo", "doc_id").distinct(), "line-batch")
        lines = batch.groupBy(*_LINE).agg(F.lit(1).alias("one")).select(*_LINE)
        asked = materialize(
            lines.groupBy("shard")
            .cogroup(self.filters.groupBy("shard"))
            .applyInPandas(_ask, "shard int, hi long, lo long, maybe boolean"),
            "line-asked",
        )
        maybe = asked.where("maybe").select(*_LINE)
        # A document that is in the state already adds nothing for the lines it holds.
        again = self.postings.join(maybe, _LINE, "left_semi")
        added = batch.join(again, [*_LINE, "doc_id"], "left_anti")
        counted = materialize(_counted(added).join(maybe.withColumn("maybe", F.lit(True)), _LINE, "left"), "line-counted")
        merged = (
            self.counts.unionByName(counted.where("maybe").select(self.counts.columns))
            .groupBy(*_LINE)
            .agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
        )
        counts = merged.unionByName(counted.where("maybe IS NULL").select(self.counts.columns))
        unseen = counted.select(*_LINE, "maybe").join(
            self.counts.withColumn("maybe", F.lit(True)), [*_LINE, "maybe"], "left_anti"
        )
        counts = materialize(counts, "line-counts")
        filters = materialize(self._cogrouped(unseen.select(*_LINE), _put_in), "line-filters")
        full = filters.where("slots IS NULL").select("shard")
        rebuilt = counts.join(full, "shard", "left_semi").select(*_LINE).groupBy("shard").applyInPandas(_build, _FILTERS)
        return LineIndex(
            self.n_shards,
            materialize(self.postings.unionByName(added.select(self.postings.columns)), "line-postings"),
            counts,
            materialize(filters.where("slots IS NOT NULL").unionByName(rebuilt), "line-filters"),
        )

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take documents out again: as if they had never been inserted."""
        gone = self.postings.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
        touched = materialize(gone.select(*_LINE).distinct(), "line-touched")
        postings = materialize(
            self.postings.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_anti").select(self.postings.columns),
            "line-postings",
        )
        left = materialize(_counted(postings.join(touched, _LINE, "left_semi")), "line-left")
        dead = touched.join(left, _LINE, "left_anti")
        counts = self.counts.join(touched, _LINE, "left_anti").unionByName(left.select(self.counts.columns))
        return LineIndex(
            self.n_shards,
            postings,
            materialize(counts.select(self.counts.columns), "line-counts"),
            materialize(self._cogrouped(dead, _take_out), "line-filters"),
        )

    def _cogrouped(self, lines: DataFrame, change: Callable) -> DataFrame:
        """The filters, changed by the lines of their shards."""
        touched = lines.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(_or_same(change), _FILTERS)
        return touched

    def dropped(self, keyed: DataFrame) -> DataFrame:
        """(doc_id, line_no) of lines of which a smaller doc_id holds the first occurrence."""
        repeated = self.counts.where("n_docs > 1").select("hi", "lo", "first_doc")
        return keyed.join(repeated, ["hi", "lo"]).where("doc_id <> first_doc").select("doc_id", "line_no")

    def save(self, folder: str) -> None:
        for name in ("postings", "counts", "filters"):
            getattr(self, name).withColumn("n_shards", F.lit(self.n_shards)).write.parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> LineIndex:
        tables = [spark.read.parquet(f"{folder}/{name}") for name in ("postings", "counts", "filters")]
        first = tables[2].select("n_shards").first()
        return cls(first[0] if first else 1, *(t.drop("n_shards") for t in tables))


def _or_same(change: Callable) -> Callable:
    """Shards without changed lines keep the filter they have."""

    def changed(key: tuple, lines: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        return change(key, lines, filters) if len(lines) else filters

    return changed


#: Column in which `without_lines` adds what it found to documents of any columns.
FOUND = "line deduplication"


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` with a struct (n_lines, n_dropped, kept_text): the text without the dropped lines.

    The list of dropped lines of a document is never longer than the document itself.
    """
    gone = "dropped lines"
    while gone in docs.columns:
        gone += " "
    lists = dropped.groupBy("doc_id").agg(F.collect_set("line_no").alias(gone))
    text = F.coalesce(F.col("text"), F.lit(""))

    def kept(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    found = F.struct(
        (F.length(F.regexp_replace(text, r"[^\n]+", "")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col(gone).isNull(), text)
        .otherwise(F.get(F.transform(F.array(F.split(text, "\n")), kept), F.lit(0)))
        .alias("kept_text"),
    )
    return docs.join(lists, "doc_id", "left").select(*[docs[quoted(c)] for c in docs.columns], found.alias(FOUND))


def deduplicated(docs: DataFrame, n_batches: int = 2) -> DataFrame:
    """`docs` with the struct of `without_lines`, after inserting all documents batch by batch."""
    keyed = materialize(keyed_lines(docs), "line-keys")
    index = LineIndex.empty(docs.sparkSession, keyed.count())
    for batch in range(n_batches):
        index = index.insert(keyed.where(F.pmod(F.xxhash64("doc_id"), F.lit(n_batches)) == batch))
    return without_lines(docs, index.dropped(keyed))


def clean_documents(docs: DataFrame) -> DataFrame:
    """`docs`, same columns, without repeated lines; texts of which nothing is left go.

    A column `n_chars` is counted again.
    """
    kept = f"`{FOUND}`.kept_text"
    done = deduplicated(docs).where(f"`{FOUND}`.n_dropped = 0 OR {kept} RLIKE r'[^ \\t-\\r]'")
    changed = {"text": F.col(kept), "n_chars": F.length(F.col(kept)).cast("long")}
    return done.select(*[changed[c].alias(c) if c in changed else F.col(quoted(c)) for c in docs.columns])
