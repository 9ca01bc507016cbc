"""Benchmark decontamination: multi-pattern search of word windows after Wu and Manber.

Texts and benchmark items become sequences of word numbers (0 for a word no item has).  All
windows of one length are searched together: a table says, for each pair of neighbouring
words, how far the scan may jump ahead; pairs that end a window select the few windows with
that ending, and these are compared word by word.  Most of a clean text is never looked at.

Documents are not moved: the tables of the windows go to the tasks.  Windows beyond
`shard_windows` are searched shard by shard, so that what is sent stays bounded; the finds
of one document are then put together.

Defined results: null and empty texts have no words and no finds; items without words have no
windows; repeated items are each counted; repeated documents are each searched; items of equal
text are all named; empty tables give no finds.  Other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.words import alnum_words, binary
from citeweave.session import materialize

WINDOW = 10
#: Windows sent to the tasks at once: some tens of megabytes.
SHARD_WINDOWS = 200_000
_ITEM = "item string, words array<string>"
_FOUND = "n_words long, hits array<struct<start: int, stop: int>>, items array<string>"


@dataclass
class Windows:
    """Search tables of all windows of one length."""

    length: int
    jump: dict[tuple[int, ...], int] = field(default_factory=dict)
    ending: dict[tuple[int, ...], list[tuple[int, ...]]] = field(default_factory=lambda: defaultdict(list))

    @property
    def block(self) -> int:
        return min(2, self.length)

    @property
    def farthest(self) -> int:
        return self.length - self.block + 1

    def add(self, window: tuple[int, ...]) -> None:
        for stop in range(self.block, self.length + 1):
            pair, left = window[stop - self.block : stop], self.length - stop
            self.jump[pair] = min(left, self.jump.get(pair, self.farthest))
        self.ending[window[-self.block :]].append(window)

    def find(self, words: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(start, window) of every occurrence."""
        jump, farthest, block, length = self.jump, self.farthest, self.block, self.length
        at, end = length, len(words)
        while at <= end:
            pair = tuple(words[at - block : at])
            step = jump.get(pair, farthest)
            if step == 0:
                start = at - length
                here = tuple(words[start:at])
                for window in self.ending[pair]:
                    if window == here:
                        yield start, window
                step = 1
            at += step


class Patterns:
    """Windows of benchmark items, ready for search."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = defaultdict(set)
        self.tables: dict[int, Windows] = {}
        for item, words in items:
            numbers = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            length = min(window, len(numbers))
            for start in range(len(numbers) - length + 1 if length else 0):
                self._add(item, numbers[start : start + length])

    def _add(self, item: str, window: tuple[int, ...]) -> None:
        if window not in self.items:
            self.tables.setdefault(len(window), Windows(len(window))).add(window)
        self.items[window].add(item)

    def search(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit spans in ascending order without overlap, items found."""
        words = alnum_words(text)
        known = self.numbers.get
        numbers = [known(w, 0) for w in words]
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for table in self.tables.values():
            for start, window in table.find(numbers):
                spans.append((start, start + table.length))
                items |= self.items[window]
        return len(words), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words) per stretch of an item: whole items, as long as they are not huge.

    Items of more than `SHARD_WINDOWS` words are cut into stretches that overlap by a window.
    """

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column("item_id").to_pylist(), binary(batch.column("text"))
            rows = [
                (name, [w.decode("utf-8", "surrogateescape") for w in words[i : i + SHARD_WINDOWS + window - 1]])
                for name, text in zip(names, texts, strict=True)
                if (words := alnum_words(text))
                for i in range(0, max(1, len(words) - window + 1), SHARD_WINDOWS)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                names=["item", "words"],
            )

    named = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), "text")
    return named.mapInArrow(stretches, _ITEM)


def _searched(docs: DataFrame, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """Finds per row of `docs`, which has a text and further columns to keep."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    kept = [c for c in docs.columns if c != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(sent.value, window)
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        for batch in batches:
            found = [patterns.search(text) for text in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in spans] for _, spans, _ in found], pa.list_(span)),
                    pa.array([sorted(names) for _, _, names in found], pa.list_(pa.string())),
                ],
                names=[*kept, "n_words", "hits", "items"],
            )

    return docs.mapInArrow(search, ", ".join(f"`{c}` long" for c in kept) + ", " + _FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(doc_id, n_words, hits, items) per row of `docs`: hit word spans and the items with occurring windows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = _shards(item_windows(benchmark, window), shard_windows)
    items, more = next(shards), next(shards, None)
    if more is None:
        return _searched(texts, items, window)
    # Rows are numbered once: a doc_id may repeat or be missing.
    numbered = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    first = _searched(numbered, items, window)
    for items in chain([more], shards):
        first = first.unionByName(_searched(numbered, items, window))
    # A document has one row per shard of windows, with finds bounded by its own words.
    spans = F.sort_array(F.flatten(F.collect_list("hits")))
    union = F.aggregate(
        spans,
        F.array().cast("array<struct<start: int, stop: int>>"),
        lambda done, s: F.when(
            F.get(done, F.size(done) - 1)["stop"] >= s["start"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["start"].alias("start"),
                        F.greatest(F.get(done, F.size(done) - 1)["stop"], s["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    found = first.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        union.alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return found.drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """`docs`, same columns, without those in which a window occurs; one filter per shard of windows."""
    for items in _shards(item_windows(benchmark, window), shard_windows):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(items), window), docs.schema)
    return docs


def _clean(sent: Broadcast, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(sent.value, window)
        for batch in batches:
            yield batch.filter(pa.array([not patterns.search(t)[1] for t in binary(batch.column("text"))], pa.bool_()))

    return clean


def _shards(items: DataFrame, limit: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in lists of about `limit` windows, fetched list by list; one list at least."""
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in items.toLocalIterator():
        if held and size + len(row["words"]) > limit:
            yield held
            held, size = [], 0
        held.append((row["item"], [w.encode("utf-8", "surrogateescape") for w in row["words"]]))
        size += len(row["words"])
    yield held


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    hit = F.aggregate("hits", F.lit(0), lambda n, s: n + s["stop"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
