"""Best registry record for a title, published in the searched year or the one after.

The score of a record is the summed weight of the different words it shares with the
searched title; a word weighs ``ln(1 + (N - df + 0.5) / (df + 0.5))``, held in whole
millionths so that sums do not depend on the order of addition.

The search is exact and writes no candidate pairs.  Copies collapse first: searches with the
same words and year are one search, registry entries with the same words and year one entry with
the smallest DOI.  Entries come in pieces, one after the other, so that the searches are shuffled
once at a time however many pieces there are.  The entries of a piece and all searches are dealt
over cells of a searched year and a shard of the searches.  A task reads the entries of its cell
into an index of bounded size and answers the searches as they stream by.  A search keeps the words its cell has,
rarest first; words in more than ``hot_rows`` records are *hot* and come last.  What an entry can
score is bounded by its first shared word and the weights from there on, so it is looked for in
steps of more and more postings, ``lead_words`` words at least in the first.  The entries that lead after a step
are scored in full and set the score to beat; postings are read only as far as the weights still reach
it.  Of the entries found, those that the other words may lift to the score are kept: the most
common hot words have a bit for each entry, so that a table lookup adds eight of them, and few
entries are left to be scored in full.  A search that has the words of some entry, all of them and no others, has
the highest score there is, so only its rarest word is read.  The best of the pieces is the answer; what was
written on the way there is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions.text import WORD
from citeweave.functions.titles import title_terms
from citeweave.session import by_key, discard, materialize

from .lookup import one_per

HOT_ROWS = 200
#: Rarest words of a search that are asked for first, at least.
LEAD_WORDS = 4
MICRO = 1_000_000
#: Words of the entries in one cell; what a task holds in memory grows with them.
CELL_WORDS = 10_000_000
#: Remainders of years that cells are told apart by.
_YEARS = 16


def term_weight(df: Column, total: Column) -> Column:
    """Weight of a word in whole millionths."""
    odds = (total - df + 0.5) / (df + 0.5)
    return F.round(F.log(1.0 + odds) * MICRO).cast("bigint")


def _signature(words: Column, year: str) -> Column:
    """128-bit stand-in for a set of words and a year, to keep shuffle rows narrow."""
    return F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col(year).cast("string"), F.lit("")), words)))


def _words(title: Column) -> Column:
    """Different words of a title, sorted, in one text: words hold no blanks."""
    return F.concat_ws(" ", title_terms(title))


def _worded(title: Column) -> Column:
    """Whether a title has a word; a filter on its words would cut every title twice."""
    return F.lower(title).rlike(WORD)


def _key(title: Column) -> Column:
    """128-bit stand-in for a title, by which it gets its answer."""
    return F.unhex(F.md5(title))


def collapse_registry(registry: DataFrame) -> DataFrame:
    """One entry per set of words and year: (words, year, doi, copies)."""
    return (
        registry.where(_worded(F.col("title"))).select("doi", F.col("year").cast("bigint").alias("year"), _words(F.col("title")).alias("words"))
        .groupBy("words", "year")
        .agg(F.min("doi").alias("doi"), F.count(F.lit(1)).alias("copies"))
    )


def searching_years(year: str) -> Column:
    """The years whose searches ask for an entry of a year."""
    return F.explode(F.array(F.col(year), F.col(year) - 1))


def searched_years() -> Column:
    """The searched year and the next one, so that the range becomes an equi-join."""
    return F.explode(F.array(F.col("lookup_year"), F.col("lookup_year") + 1))


@dataclass
class Grid:
    """Cells (lookup_year, shard) of each piece: entries are dealt over pieces, searches over shards."""

    years: int
    pieces: int
    shards: int

    def __len__(self) -> int:
        return self.years * self.shards

    def piece(self) -> Column:
        return F.pmod(F.xxhash64("words"), F.lit(self.pieces)).alias("piece")

    def shard(self) -> Column:
        return F.pmod(F.xxhash64("search"), F.lit(self.shards)).alias("shard")

    def every_shard(self) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.shards - 1).cast("long"))).alias("shard")

    def task(self) -> Column:
        """Task of a cell; cells may share one, and only do with years far apart."""
        year = F.pmod(F.col("lookup_year"), F.lit(self.years).cast("long"))
        return (year * self.shards + F.col("shard")).cast("int")


def _grid(entries: DataFrame, cell_words: int) -> Grid:
    """As many pieces as bound the words of a cell, as many shards as keep all cores busy."""
    held = entries.select(F.size(F.split("words", " ")).alias("n"), searching_years("year").alias("lookup_year"))
    years = held.groupBy("lookup_year").agg(F.sum("n").alias("n"))
    found = years.agg(F.max("n").alias("most"), F.min("lookup_year").alias("first"), F.max("lookup_year").alias("last")).first()
    span = min(_YEARS, found.last - found.first + 1) if found.most else 1
    pieces = -(-(found.most or 1) // cell_words)
    return Grid(span, pieces, max(1, round(entries.sparkSession.sparkContext.defaultParallelism / span)))


def _vocabulary(entries: DataFrame, total: Column, grid: Grid, hot_rows: int) -> DataFrame:
    """(term, weight, hot, year, piece): words with their weight in the registry, for each place that has them."""
    counts = (
        entries.select("year", grid.piece(), "copies", F.explode(F.split("words", " ")).alias("term"))
        .groupBy("term", "year", "piece")
        .agg(F.sum("copies").alias("n"))
    )
    df = F.sum("n").over(Window.partitionBy("term"))
    return counts.withColumn("df", df).select(
        "term", term_weight(F.col("df"), total).alias("weight"), (F.col("df") > hot_rows).alias("hot"), "year", "piece"
    )


# Kinds of rows of a cell, in the order in which they come.
_TERM, _ENTRY, _SEARCH = 0, 1, 2


#: Hot words of a cell that have a bit for each entry; fewer where entries are short.
_BITS = 1024
#: Postings read before a score to beat is looked for, and by how much more the next steps read.
_FIRST, _MORE = 512, 16
#: Entries scored in full for a score to beat: in the first step, in later ones.
_TOP = (8, 32)
#: As many candidates are scored in full at once.
_FEW = 48
#: Rows of texts that are numbered at once, as the words are hashed anew each time.
_NUMBERED = 20_000
#: Which of eight words each byte has.
_BYTES = (np.arange(256) >> np.arange(8)[:, None] & 1).astype(np.float64)


class _Vocabulary:
    """Words of a cell with their weights, rarest word first."""

    def __init__(self, terms: pa.Array, weights: np.ndarray, hot: np.ndarray):
        # A word comes once for each of the two years.
        named = terms.dictionary_encode()
        first = np.unique(named.indices.to_numpy(), return_index=True)[1]
        self.terms, self.weights = named.dictionary, weights[first]
        self.rare = int(len(first) - hot[first].sum())

    def numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known words of texts by number, those of a text rising, where each text starts, and sizes of the texts."""
        split = pc.split_pattern(words, " ")
        found = pc.index_in(split.values, value_set=self.terms)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.diff(split.offsets.to_numpy())
        text = np.repeat(np.arange(len(words)), sizes)[known]
        keys = text << 32 | found.drop_null().to_numpy()
        keys.sort()
        starts = np.append(0, np.bincount(text, minlength=len(words)).cumsum())
        return (keys & 0xFFFFFFFF).astype(np.int32), starts, sizes


class _Index:
    """Entries of a cell under their words; entries are in the order of their DOIs.

    ``held`` are the words of each entry in turn, ``sizes`` how many each has.  Words from ``rare`` on
    are hot: the most common of them also have a bit for each entry, eight words to a byte.
    """

    def __init__(self, weights: np.ndarray, held: np.ndarray, sizes: np.ndarray, rare: int):
        self.weights, self.held, n = weights, held, len(sizes)
        self.starts = np.append(0, sizes.cumsum())
        # In place, as this is where a task holds most.
        keys = held.astype(np.int64)
        keys <<= 32
        keys |= np.repeat(np.arange(n, dtype=np.int32), sizes)
        keys.sort()
        self.rows = keys.astype(np.int32)  # the lower half
        del keys
        self.at = np.append(0, np.bincount(held, minlength=len(weights)).cumsum())
        # The bits take no more room than the words.
        self.bitted = len(weights) - min(_BITS, len(weights) - rare, 32 * len(held) // max(n, 1))
        self.bits = np.zeros((-(-(len(weights) - self.bitted) // 8), n), np.uint8)
        for word in range(self.bitted, len(weights)):
            group, bit = divmod(word - self.bitted, 8)
            self.bits[group, self.rows[self.at[word] : self.at[word + 1]]] |= np.uint8(1 << bit)
        # Scores so far; four bytes hold the sums of all but very long searches.
        self.narrow, self.wide, self.own = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(len(weights), np.int64)

    def scores(self, entries: np.ndarray) -> np.ndarray:
        """Full scores of entries against the words in ``own``."""
        starts = self.starts[entries]
        sizes = self.starts[entries + 1] - starts
        ends = sizes.cumsum()
        flat = np.arange(ends[-1]) + (starts - ends + sizes).repeat(sizes)
        return np.add.reduceat(self.own.take(self.held.take(flat)), ends - sizes)

    def best(
        self, ids: np.ndarray, floor: int = 0, lead_words: int = LEAD_WORDS, first: int = _FIRST, few: int = _FEW
    ) -> tuple[int, int] | None:
        """Highest score of an entry for the words of a search, ``floor`` at least, and the first entry that has it.

        An entry scores at most what the words from its first shared one on weigh (``reach``).
        """
        weights = self.weights[ids]
        reach = np.append(weights[::-1].cumsum()[::-1], 0)
        if reach[0] < floor:
            return None
        falling = -reach[:-1]
        sums = self.narrow if reach[0] < 2**31 else self.wide
        starts = self.at[ids]
        sizes = self.at[ids + 1] - starts
        places = list(zip(starts.tolist(), (starts + sizes).tolist(), strict=True))
        read, short = sizes.cumsum(), weights.astype(sums.dtype)
        self.own[ids] = weights
        asked, limit, top, rows = 0, first, _TOP[0], np.empty(0, np.intp)
        stop = int(falling.searchsorted(-floor, "right"))
        # Few postings at first: the better the score to beat, the fewer of the others are needed.
        while asked < stop:
            most = min(limit, (int(read[asked - 1]) if asked else 0) + 2 * len(sums))
            to = min(stop, max(asked + 1 if asked else lead_words, int(read.searchsorted(most, "right"))))
            found = np.concatenate([self.rows[a:b] for a, b in places[asked:to]], dtype=np.intp)
            np.add.at(sums, found, short[asked:to].repeat(sizes[asked:to]))
            rows = np.concatenate([rows, found]) if asked else found
            if len(rows) > 2 * len(sums):
                rows = np.unique(rows)
            asked, limit, under = to, max(limit, int(read[to - 1])) * _MORE, sums.take(rows)
            if asked == stop and floor and len(rows) > _FIRST:
                break
            tried = rows[under.argpartition(len(rows) - top)[-top:]] if len(rows) > top else rows
            floor, top = max(floor, int(self.scores(tried).max())), _TOP[1]
            stop = int(falling.searchsorted(-floor, "right"))
        left = int(reach[asked])
        kept = (under >= floor - left).nonzero()[0]
        kept, under = rows.take(kept), under.take(kept)
        common = max(asked, int(ids.searchsorted(self.bitted)))
        if len(kept) > few and common < len(ids):
            for group, table in zip(*self._tables(ids[common:], weights[common:], sums.dtype), strict=True):
                under = under + table.take(self.bits[group].take(kept))
                left -= int(table[-1])
                still = (under >= floor - left).nonzero()[0]
                kept, under = kept.take(still), under.take(still)
                if len(kept) <= few:
                    break
        answer = None
        if len(kept):
            scores = self.scores(kept)
            score = int(scores.max())
            if score >= floor:
                answer = score, int(kept[scores == score].min())
        if 8 * len(rows) > len(sums):
            sums.fill(0)
        else:
            sums[rows] = 0
        self.own[ids] = 0
        return answer

    def _tables(self, ids: np.ndarray, weights: np.ndarray, kind: np.dtype) -> tuple[list[int], np.ndarray]:
        """The bytes of the bits that have some of the words, and what each value of such a byte weighs."""
        groups, bit = np.divmod(ids - self.bitted, 8)
        new = np.append(True, groups[1:] != groups[:-1])
        own = np.zeros((int(new.sum()), 8))
        own[new.cumsum() - 1, bit] = weights
        return groups[new].tolist(), (own @ _BYTES).astype(kind)


class _Cell:
    """What a task holds of the cell it is at."""

    def __init__(self, lead_words: int):
        self.lead_words, self.terms, self.held, self.dois = lead_words, [], [], []
        self.waiting: list[pa.RecordBatch] = []
        self.vocabulary = self.index = None
        self.kind, self.rows = _TERM, 0

    def take(self, kind: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if kind != self.kind or self.rows >= _NUMBERED:
            yield from self.settle()
        self.kind = kind
        self.rows += part.num_rows
        self.waiting.append(part)

    def settle(self) -> Iterator[pa.RecordBatch]:
        """Work on the rows that wait, all of one kind."""
        waiting, self.waiting, self.rows = self.waiting, [], 0
        if not waiting:
            return
        if self.kind == _TERM:
            self.terms += waiting
            return
        if self.terms:
            weights, hot = (_column(self.terms, c).to_numpy(zero_copy_only=False) for c in ("weight", "hot"))
            self.vocabulary, self.terms = _Vocabulary(_column(self.terms, "name"), weights, hot), []
        if self.vocabulary is None:
            return
        ids, starts, sizes = self.vocabulary.numbers(_column(waiting, "words"))
        if self.kind == _ENTRY:
            self.held.append((ids, np.diff(starts)))
            self.dois.append(_column(waiting, "name"))
            return
        if self.held:
            held, counts = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.held = []
            self.index = _Index(self.vocabulary.weights, held, counts, self.vocabulary.rare)
            self.dois = pa.concat_arrays(self.dois)
        if self.index is None:
            return
        copied = _column(waiting, "copied").to_numpy(zero_copy_only=False)
        # No score is above that of an entry with all words; where some word has none here, no entry has all.
        some = np.flatnonzero((np.diff(starts) > 0) & (~copied | (np.diff(starts) == sizes))).tolist()
        best = []
        for i in some:
            words = ids[starts[i] : starts[i + 1]]
            floor = int(self.index.weights[words].sum()) if copied[i] else 0
            best.append(self.index.best(words, floor, self.lead_words))
        some = [i for i, found in zip(some, best, strict=True) if found]
        best = [found for found in best if found]
        columns = [
            _column(waiting, "search").take(pa.array(some, pa.int64())),
            pa.array([score for score, _ in best], pa.int64()),
            self.dois.take(pa.array([entry for _, entry in best], pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["search", "score", "doi"])


def _column(parts: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.concat_arrays([part.column(name) for part in parts])


def _best_of_cells(rows: DataFrame, lead_words: int) -> DataFrame:
    """(search, score, doi): best entry of its cell for each search; rows come by cell, kind and order."""
    at = ("lookup_year", "shard")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell = None, _Cell(lead_words)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (*at, "kind")], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))).tolist()
            for start, stop in zip(starts, [*starts[1:], len(keys)], strict=True):
                *place, kind = keys[start].tolist()
                if place != here:
                    yield from cell.settle()
                    here, cell = place, _Cell(lead_words)
                yield from cell.take(kind, batch.slice(start, stop - start))
        yield from cell.settle()

    return rows.mapInArrow(searched, "search binary, score long, doi string")


def best_candidate(
    searches: DataFrame,
    registry: DataFrame,
    hot_rows: int = HOT_ROWS,
    lead_words: int = LEAD_WORDS,
    cell_words: int = CELL_WORDS,
    by_words: bool = False,
) -> DataFrame:
    """Top registry record of each different (title, lookup_year).

    ``searches`` has (title, lookup_year), ``registry`` (doi, title, year).  Gives (title,
    lookup_year, doi, score); without a hit the DOI is null and the score 0.  With ``by_words``
    it gives (key, lookup_year, doi, score) of the searches with a hit, which ``attach_candidate`` takes too.
    """
    entries = materialize(collapse_registry(registry), "entries")
    year, words = F.col("lookup_year"), F.col("words")
    asked = searches.where(_worded(F.col("title")) & year.isNotNull()).select(
        _key(F.col("title")).alias("key"), year, _words(F.col("title")).alias("words")
    )
    # Titles are cut into words once: each search keeps the titles that ask for it, by their keys.
    different = materialize(
        asked.groupBy(_signature(words, "lookup_year").alias("search"))
        .agg(
            F.first(year.cast("bigint")).alias("lookup_year"),
            F.first(words).alias("words"),
            F.collect_set(F.struct("key", "lookup_year")).alias("spelled"),
        )
        .join(by_key(_copies(entries)), "search", "left")
        .withColumn("copied", F.col("copied").isNotNull()),
        "searches",
    )
    grid = _grid(entries, cell_words)
    total = registry.agg(F.count(F.lit(1)).alias("n")).scalar()
    terms = materialize(_vocabulary(entries, total, grid, hot_rows), "terms")
    best = None
    for piece in range(grid.pieces):
        here = (grid.piece() == piece, F.col("piece") == piece)
        found = _best_of_cells(_dealt(terms.where(here[1]), entries.where(here[0]), different, grid), lead_words)
        before, best = best, materialize(_best(found if best is None else found.unionByName(best)), "best")
        if before is not None:
            discard(before)
    spelled = different.select("search", "spelled").join(by_key(best), "search")
    answers = materialize(
        spelled.select(F.explode("spelled").alias("asked"), "doi", (F.col("score") / MICRO).alias("score")).select(
            "asked.key", "asked.lookup_year", "doi", "score"
        ),
        "best",
    )
    for done in (different, entries, terms, best):
        discard(done)
    if by_words:
        return answers
    titles = searches.groupBy(_key(F.col("title")).alias("key"), "lookup_year").agg(F.first("title").alias("title"))
    return titles.join(by_key(answers), ["key", "lookup_year"], "left").select(
        "title", "lookup_year", "doi", F.coalesce("score", F.lit(0.0)).alias("score")
    )


def _copies(entries: DataFrame) -> DataFrame:
    """(search, copied): the searches that have the words of an entry of their years, all of them and no others."""
    years = entries.where("year IS NOT NULL").select("words", searching_years("year").alias("lookup_year"))
    return years.select(_signature(F.col("words"), "lookup_year").alias("search")).distinct().withColumn("copied", F.lit(True))


def _dealt(terms: DataFrame, entries: DataFrame, searches: DataFrame, grid: Grid) -> DataFrame:
    """Rows of all cells of a piece, each cell in one task: its words rarest first, entries by DOI, then searches."""
    years = searching_years("year").alias("lookup_year")
    kind = lambda n: F.lit(n).cast("long").alias("kind")
    words = terms.where("year IS NOT NULL").select(kind(_TERM), F.col("term").alias("name"), "weight", "hot", "year", years)
    held = entries.where("year IS NOT NULL").select(kind(_ENTRY), F.col("doi").alias("name"), "words", "year", years)
    offered = words.drop("year").unionByName(held.drop("year"), allowMissingColumns=True).select("*", grid.every_shard())
    wanted = searches.select(kind(_SEARCH), "search", "words", "copied", "lookup_year", grid.shard())
    rows = offered.unionByName(wanted, allowMissingColumns=True)
    dealt = rows.repartitionById(len(grid), grid.task())
    return dealt.sortWithinPartitions("lookup_year", "shard", "kind", F.desc("weight"), "name")


def _best(scored: DataFrame) -> DataFrame:
    """(search, score, doi) of the highest score, smallest DOI on ties; combines before the shuffle."""
    top = F.min(F.struct((-F.col("score")).alias("neg"), "doi")).alias("top")
    return scored.groupBy("search").agg(top).select("search", (-F.col("top.neg")).alias("score"), F.col("top.doi").alias("doi"))


def registry_details(registry: DataFrame) -> DataFrame:
    """(registry_doi, cr_title, cr_year, cr_authors, cr_venue), one row per doi."""
    return one_per(registry.select("doi", "title", "year", "authors", "venue"), "doi").select(
        F.col("doi").alias("registry_doi"),
        F.col("title").alias("cr_title"),
        F.col("year").alias("cr_year"),
        F.col("authors").alias("cr_authors"),
        F.col("venue").alias("cr_venue"),
    )


def attach_candidate(searched: DataFrame, answers: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the answer (doi, score) and the registry metadata to each searched record.

    ``searched`` has (title, lookup_year); of registry records with one doi one counts.
    """
    # Answers go by a hash of 128 bits, as their titles would be shuffled once for each join.
    on, found = ["_key", "lookup_year"], (F.col("doi").alias("registry_doi"), "score")
    asked = searched.withColumn("_key", _key(F.col("title")))
    given = F.col("key") if "key" in answers.columns else _key(F.col("title"))
    short = answers.select(given.alias("_key"), "lookup_year", *found)
    answered = short.join(by_key(registry_details(registry)), "registry_doi", "left")
    return asked.join(by_key(answered), on, "left").drop("_key").withColumn("score", F.coalesce("score", F.lit(0.0)))


def rerank_by(scored: DataFrame, *order: Column, keys: list[str]) -> DataFrame:
    """Keep the best row per key by the given descending criteria (combines map-side)."""
    row = F.struct(*[c for c in scored.columns if c not in keys])
    ranked = scored.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("row"))
    return ranked.select(*keys, "row.*")
