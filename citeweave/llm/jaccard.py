"""Exact Jaccard join of word shingle sets by partitioning the universe of shingles.

Two sets link when `100 * intersection >= percent * union`, that is when at most
`H = (100 - percent) * (|R| + |S|) / (100 + percent)` shingles are in one of them only.

*Segments.*  Sizes fall into bands; a band's window holds all pairs whose smaller set lies in
the band.  In a window, shingles are hashed into a fixed number of segments.  At most H segments of a
linked pair differ, so of any H + 1 filled segments of one set one is equal in the other.
Each set indexes that many, cheapest first: many rare shingles before few, and shingles known
to be frequent last.  The order depends on a segment's content only, so both sides of a pair
agree on it and the pair meets in an equal segment.

*One-deletion neighbourhoods.*  A set whose shingles fill fewer than H + 1 segments indexes all
of them.  For pairs of two such sets, all segments with every neighbourhood of one shingle
less are indexed as well: a segment of two or more shingles then bears two differences.  Sets
that this doesn't cover either index H + 1 single shingles.  So no pair is missed.

*Candidates.*  Equal sets are one node from the start.  Index entries travel packed, per slice of
documents and bucket; what comes back is the runs of nodes with an equal entry.  Nodes are
first compared with the heaviest node they share a run with; only nodes of a run that this
leaves in different components are compared with each other, by sketches that prove most pairs
apart.  Components are all that is asked for, so no link between different texts is lost.

*Verification* compares the whole shingle sets.  Shingles and sets are known by 64-bit hashes.

Defined results: null and empty texts have no shingles and link with nothing; fewer words than
a shingle make one; equal texts link; rows without doc_id are left out; repeated rows, and rows
of one doc_id with different texts, are
answered each; an empty table gives an empty answer.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.graph import components
from citeweave.llm.words import binary, quoted, scatter, shingle_sets, slices
from citeweave.session import materialize

WORDS = 5
PERCENT = 75
#: Index entries per bucket that the number of buckets aims at: about 100 MB in a task.
BUCKET_ENTRIES = 3_000_000
#: Frequent shingles that go to the end of the order: a bound on what is sent, not on results.
FREQUENT = 1 << 16
_FREQUENT_BITS = 22
#: Bits of the sketches of the largest sets.
SKETCH_BITS = 8192
#: Nodes of a run that are compared with each other in one task.
BLOCK = 4096
#: Rows of small runs that a task of the second look aims at.
GROUP_ROWS = 50_000
_U = np.uint64
_Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def set_key(shingles: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set."""
    return int.from_bytes(xxhash.xxh3_64_digest(shingles.tobytes()), "big", signed=True)


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles per value of their low bits, four bits or more per shingle up to a limit.

    Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    n_bits = 512
    while n_bits < min(4 * len(shingles), SKETCH_BITS):
        n_bits *= 2
    odd = np.bincount((shingles & _U(n_bits - 1)).astype(np.int64), minlength=n_bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


class Windows:
    """Bands of sizes, a factor of 1.5 each, and what a set of a given size does in them."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.bands = [1]
        self._places: dict[int, np.ndarray] = {}

    def differences(self, both: int) -> int:
        return (100 - self.percent) * both // (100 + self.percent)

    def of(self, size: int) -> list[tuple[int, int]]:
        """(window, differences that a partner may make) of all windows of a size."""
        while self.bands[-1] <= size:
            self.bands.append(max(self.bands[-1] + 1, self.bands[-1] * 3 // 2))
        found = []
        for k, low in enumerate(self.bands[:-1]):
            after = self.bands[k + 1]
            top = (after - 1) * 100 // self.percent
            if low <= size <= top:
                partner = min(size * 100 // self.percent, top) if size < after else after - 1
                found.append((k, self.differences(size + partner)))
        return found

    def places(self, window: int) -> np.ndarray:
        """A random number for each of the window's segments."""
        if window not in self._places:
            n = max(1, self.bands[window] * 9 // 10)
            self._places[window] = scatter(np.arange(n, dtype=_U) + _U((window + 1) << 34))
        return self._places[window]


def index_entries(shingles: np.ndarray, windows: Windows, frequent: np.ndarray) -> np.ndarray:
    """64-bit index entries of one set in all its windows."""
    out = []
    often = frequent[(shingles & _U(len(frequent) - 1)).astype(np.int64)]
    spread = shingles >> _U(32)
    for window, differences in windows.of(len(shingles)):
        places = windows.places(window)
        segment = (spread * _U(len(places)) >> _U(32)).astype(np.uint16 if len(places) < 1 << 16 else np.int64)
        order = np.argsort(segment, kind="stable")
        segment, content = segment[order], shingles[order]
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        whole = np.add.reduceat(content, first)
        place = places[segment[first]]
        entry = whole ^ place
        needed = differences + 1
        size = np.concatenate([first[1:], [len(order)]]) - first
        if len(entry) > needed:
            rare = size - np.add.reduceat(often[order], first, dtype=np.int64)
            cost = 8 - 3 * np.minimum(rare, 2) - np.minimum(size, 2)
            key = (cost.astype(_U) << _U(60)) | (entry >> _U(4))
            entry = entry[np.argpartition(key, needed - 1)[:needed]]
        out.append(entry)
        if len(first) < needed:
            several = np.repeat(size > 1, size)
            less = np.repeat(whole, size)[several] - content[several]
            both = np.concatenate([whole ^ place, less ^ np.repeat(place, size)[several]])
            out.append(scatter(both + _U(1)))
            if len(first) + int((size > 1).sum()) < needed:
                out.append(scatter(shingles[:needed] ^ places[:1]))
    return np.concatenate(out) if out else np.empty(0, _U)


_SETS = "doc_id long, print long, n_shingles long, node long, sketch binary, frequent binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; the first of each slice also carries the slice's frequent shingles."""
    for batch in slices(batches, "text"):
        sets = shingle_sets(binary(batch.column("text")), WORDS)
        frequent: list[bytes | None] = [None] * len(sets)
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        chosen = counts >= max(4, len(sets) // 250)
        frequent[0] = np.stack([values[chosen], counts[chosen].astype(_U)]).tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("print"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) for s in sets], pa.int64()),
                pa.array([sketch(s) for s in sets], pa.binary()),
                pa.array(frequent, pa.binary()),
            ],
            names=["doc_id", "print", "n_shingles", "node", "sketch", "frequent"],
        )


def _unpack_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("frequent").to_pylist():
            values, counts = np.frombuffer(packed, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], names=["shingle", "n"])


def frequent_bits(sets: DataFrame) -> np.ndarray:
    """Marks of frequent shingles by their low bits; some others are marked too, which costs little."""
    packed = sets.where("frequent IS NOT NULL").select("frequent")
    top = (
        packed.mapInArrow(_unpack_frequent, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT)
    )
    values = top.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(_U)
    bits = np.zeros(1 << _FREQUENT_BITS, bool)
    bits[(values & _U(len(bits) - 1)).astype(np.int64)] = True
    return bits


def _packed_index(docs: DataFrame, bits: np.ndarray, n_buckets: int, percent: int) -> DataFrame:
    """(bucket, entries): per slice of documents and bucket, which nodes have which entries."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(percent)
        frequent = np.unpackbits(sent.value).astype(bool)
        for batch in slices(batches, "text"):
            nodes: dict[int, np.ndarray] = {}
            for shingles in shingle_sets(binary(batch.column("text")), WORDS):
                if len(shingles) and (node := set_key(shingles)) not in nodes:
                    nodes[node] = index_entries(shingles, windows, frequent)
            if not nodes:
                continue
            entries = np.concatenate(list(nodes.values()))
            owner = np.repeat(np.arange(len(nodes)), [len(e) for e in nodes.values()])
            bucket = ((entries >> _U(40)) % _U(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            entries, owner, bucket = entries[order], owner[order], bucket[order]
            names = np.fromiter(nodes, np.int64, len(nodes))
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = [
                _packed(entries[a:b], names, owner[a:b])
                for a, b in zip(starts, [*starts[1:], len(bucket)], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts].astype(np.int32)), pa.array(rows, pa.binary())], names=["bucket", "entries"]
            )

    return docs.select("text").mapInArrow(pack, "bucket int, entries binary")


def _packed(entries: np.ndarray, names: np.ndarray, owner: np.ndarray) -> bytes:
    """Number of nodes, their names, their counts, and the low six bytes of each entry."""
    present, counts = np.unique(owner, return_counts=True)
    low = entries.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return b"".join(
        [np.uint64(len(present)).tobytes(), names[present].tobytes(), counts.astype("<u4").tobytes(), low.tobytes()]
    )


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(entries, nodes) of one packed row."""
    n = int(np.frombuffer(packed, _U, 1)[0])
    names, counts = np.frombuffer(packed, np.int64, n, 8), np.frombuffer(packed, "<u4", n, 8 + 8 * n)
    low = np.frombuffer(packed, np.uint8, offset=8 + 12 * n).reshape(-1, 6)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :6] = low
    return wide.view("<u8").ravel(), np.repeat(names, counts)


def _runs(group: pd.DataFrame) -> pd.DataFrame:
    """Distinct sorted lists of nodes that share an entry of the bucket."""
    entries, nodes = (np.concatenate(x) for x in zip(*map(_unpacked, group["entries"]), strict=True))
    order = np.lexsort((nodes, entries))
    entries, nodes = entries[order], nodes[order]
    same = np.diff(entries, prepend=~entries[:1]) == 0
    again = same & (np.diff(nodes, prepend=~nodes[:1]) == 0)
    entries, nodes = entries[~again], nodes[~again]
    starts = np.flatnonzero(np.diff(entries, prepend=~entries[:1]))
    lengths = np.diff(starts, append=len(entries))
    two = starts[lengths == 2]
    pairs = np.unique(np.stack([nodes[two], nodes[two + 1]], 1), axis=0)
    longer = {nodes[a : a + n].tobytes() for a, n in zip(starts[lengths > 2], lengths[lengths > 2], strict=True)}
    found = [*pairs, *(np.frombuffer(x, np.int64) for x in sorted(longer))]
    return pd.DataFrame({"nodes": pd.Series(found, dtype=object)})


def _folded(sketches: list[bytes], n_bytes: int) -> np.ndarray:
    """Sketches brought to one length, a row of 64-bit words each."""
    rows = [np.bitwise_xor.reduce(np.frombuffer(s, _U).reshape(-1, n_bytes // 8), axis=0) for s in sketches]
    return np.array(rows)


def _may_link(percent: int) -> _Task:
    """Pairs whose sizes and sketches don't rule a link out."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            found = [
                int(np.bitwise_count(np.bitwise_xor(*(_folded([s], min(len(x), len(y)))[0] for s in (x, y)))).sum())
                for x, y in zip(a, b, strict=True)
            ]
            good = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            good &= np.array(found, np.int64) <= (100 - percent) * (n_a + n_b) // (100 + percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return check


def _compare(percent: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """Distinct pairs (a < b) of nodes of a run, in different components, that may link."""

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        group = group.sort_values("run")
        names, first, local = np.unique(group["node"].to_numpy(np.int64), return_index=True, return_inverse=True)
        root = group["root"].to_numpy(np.int64)[first]
        n = group["n_shingles"].to_numpy(np.int64)[first]
        sketches = [group["sketch"].iloc[k] for k in first.tolist()]
        length = np.array([len(x) for x in sketches])
        block = group["block"].to_numpy(np.int64)
        run = group["run"].to_numpy(np.int64)
        cuts = np.flatnonzero(np.diff(run, prepend=~run[:1], append=~run[-1:]))

        def pairs() -> Iterator[np.ndarray]:
            """Codes of the pairs of each run that are to be compared, a stretch of nodes at a time."""
            for start, stop in zip(cuts, cuts[1:], strict=False):
                own, at = local[start:stop], block[start:stop]
                step = max(1, (1 << 20) // len(own))
                for k in range(0, len(own), step):
                    one, other = own[k : k + step, None], own[None, :]
                    open_pair = (one < other) & (root[one] != root[other])
                    if i != j:
                        open_pair &= at[k : k + step, None] != at[None, :]
                    yield (one * len(names) + other)[open_pair]

        def possible(codes: np.ndarray) -> np.ndarray:
            a, b = np.divmod(codes, len(names))
            near = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
            codes, a, b = codes[near], a[near], b[near]
            shorter = np.minimum(length[a], length[b])
            kept = [codes[:0]]
            for size in np.unique(shorter):
                places = np.flatnonzero(length >= size)
                rows = np.zeros((len(names), size // 8), _U)
                rows[places] = _folded([sketches[k] for k in places.tolist()], int(size))
                for part in np.array_split(np.flatnonzero(shorter == size), 1 + len(codes) // 50_000):
                    apart = np.bitwise_count(rows[a[part]] ^ rows[b[part]]).sum(1, dtype=np.int64)
                    kept.append(codes[part[apart <= (100 - percent) * (n[a[part]] + n[b[part]]) // (100 + percent)]])
            return np.concatenate(kept)

        found, held, size = [], [], 0
        for codes in pairs():
            held.append(codes)
            size += len(codes)
            if size > 1 << 21:
                found.append(possible(np.unique(np.concatenate(held))))
                held, size = [], 0
        found.append(possible(np.unique(np.concatenate([*held, np.empty(0, np.int64)]).astype(np.int64))))
        a, b = np.divmod(np.unique(np.concatenate(found)), len(names))
        return pd.DataFrame({"a": names[a], "b": names[b]})

    return compare


def _linked(percent: int) -> _Task:
    """Pairs of which the whole shingle sets link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_b"):
            a = batch.column("a").to_pylist()
            # Rows come by `a`: its set is made once per slice.
            rows = {name: row for row, name in enumerate(a)}
            texts = batch.column("text_a").take(pa.array(list(rows.values()), pa.int64()))
            left = dict(zip(rows, shingle_sets(binary(texts), WORDS), strict=True))
            good = []
            for name, other in zip(a, shingle_sets(binary(batch.column("text_b")), WORDS), strict=True):
                common = len(np.intersect1d(left[name], other, assume_unique=True))
                good.append(100 * common >= percent * (len(left[name]) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return check


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their whole texts."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked(percent), "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of `docs` with a doc_id."""
    return _placed(docs, percent).select("doc_id", "n_shingles", "component_id")


def _placed(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, print, n_shingles, component_id); rows that share a doc_id are told apart by the hash of the text."""
    plain = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("print"))
    sets = materialize(plain.mapInArrow(_sets, _SETS), "shingle-sets")
    classes = sets.where("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "print")).alias("first")
    ).select("node", "n_shingles", "sketch", F.col("first.doc_id").alias("first_doc"), F.col("first.print").alias("first_print"))
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    n_buckets = max(1, round(0.6 * total / BUCKET_ENTRIES))
    packed = _packed_index(plain, frequent_bits(sets), n_buckets, percent)
    runs = materialize(packed.groupBy("bucket").applyInPandas(_runs, "nodes array<long>").distinct(), "jaccard-runs")
    members = materialize(
        runs.select(F.xxhash64("nodes").alias("run"), F.size("nodes").alias("size"), F.explode("nodes").alias("node")), "jaccard-members"
    )
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    nodes = materialize(classes.join(weights, "node"), "jaccard-nodes")
    texts = materialize(
        plain.join(
            nodes.select("node", F.col("first_doc").alias("doc_id"), F.col("first_print").alias("print")), ["doc_id", "print"]
        ).dropDuplicates(["node"]),
        "jaccard-texts",
    )
    first = materialize(_leaders(members, nodes), "jaccard-first")
    links = materialize(_verified(_sketched(first, nodes, percent), texts, percent), "jaccard-links")
    linked = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = _open_pairs(members, nodes, linked, percent).join(first, ["a", "b"], "left_anti")
    links = links.unionByName(materialize(_verified(more, texts, percent), "jaccard-links"))
    linked = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = linked.join(nodes.select("node", "first_doc"), "node")
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component"))
    known = rooted.join(smallest, "root").select("node", "component")
    named = classes.select("node", "first_doc").join(known, "node", "left")
    named = named.select("node", F.coalesce("component", "first_doc").alias("component"))
    return sets.join(named, "node", "left").select(
        "doc_id",
        "print",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def _leaders(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """First look: pairs (a < b) of each node and the heaviest node it shares a run with.

    A node weighs what its runs hold together, so the text that many others were copied from
    tends to lead them.
    """
    weighed = members.join(nodes.select("node", "weight"), "node")
    order = F.struct("weight", "node")
    heaviest = weighed.groupBy("run").agg(F.max(order).alias("leader"))
    led = members.join(heaviest, "run").where("node <> leader.node")
    best = led.groupBy("node").agg(F.max("leader").alias("leader"))
    return best.select(
        F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")
    ).distinct()


def _sketched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches leave."""
    sides = [
        nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab"
    ]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_may_link(percent), "a long, b long")


def clean_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs`, same columns, with the rows of the smallest doc_id of each component only.

    A row goes by its own text: of rows that share a doc_id only those of other components go.
    """
    found = _placed(docs, percent).where("component_id <> doc_id")
    gone = found.select(F.col("doc_id").alias("gone_doc"), F.col("print").alias("gone_print")).distinct()
    same = (docs["doc_id"] == gone["gone_doc"]) & (F.xxhash64(docs["text"]) == gone["gone_print"])
    return docs.join(gone, same, "left_anti").select([quoted(c) for c in docs.columns])


def _open_pairs(members: DataFrame, nodes: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Second look: pairs (a < b) that share a run but no component and that sketches leave.

    The nodes of a run that holds several components are compared in one task, or block by
    block in several; only pairs that may link come out.
    """
    placed = members.join(linked, "node", "left").select("run", "size", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("run").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    still = placed.join(mixed.select("run"), "run", "left_semi").join(nodes.select("node", "n_shingles", "sketch"), "node")
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
    dealt = still.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    # Small runs share a task by the thousand; pairs they have in common come out once.
    n_groups = max(1, members.count() // GROUP_ROWS)
    place = F.when(n_blocks > 1, F.col("run")).otherwise(F.pmod("run", F.lit(n_groups)))
    pairs = dealt.groupBy(place.alias("place"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return pairs.applyInPandas(_compare(percent), "a long, b long").distinct()
