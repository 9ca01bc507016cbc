"""Quotation linking: find what a message quotes, and order conversations by reply.

Lines that begin with `>` are quotes, nested as deep as there are signs.  Normalised quoted
lines are hashed and joined, within their conversation, with the first message that holds the
line as its own text.  Quoted lines that are no whole line of an earlier message, because a
mail client wrapped them anew or because they quote part of a line, are found by passage:
consecutive lines of one level are joined, and so are those of originals; every run of
`PIECE` words is hashed and joined with the first message that holds it.  Such a line comes
from the message that most of the pieces which touch it come from, a third of them at least.

A message replies to the earlier message that most of its least nested
quoted lines come from, the latest of those on a tie.  Threads follow from these links: a
message's thread is the turn that its chain of replies starts with.  Ordered by (conv_id,
thread, turn), every message comes after the one it replies to, and threads stay together.

Own lines and pieces shrink to one row per distinct one of a conversation before they meet
quotes, so a conversation or a line with a third of all rows forms no pairs; nothing is gathered per
conversation.

Defined results: null and empty texts have no lines; quotes that no earlier message holds are
removed and counted, but link nothing; passages of fewer words than a piece link
by whole lines and passages alone; rows without conv_id or turn are threads of their own;
rows that repeat a turn share its links; an empty table gives no rows.  Other columns are
left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.words import scatter, slices, word_hashes
from citeweave.session import materialize

#: Signs of a quote at the start of a line.
QUOTE = r"^[ \t]*(?:>[ \t]*)+"
_SIGNS = re.compile(QUOTE)
_KEY = ["conv_id", "turn"]
#: Words of the pieces that find quotes which are no whole lines.
PIECE = 4
_PIECE = np.random.default_rng(11).integers(1, 1 << 63, PIECE, np.uint64) * np.uint64(2) + np.uint64(1)


def message_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, place, level, key) of every line that isn't blank; level 0 is the message's own.

    `key` is the hash of the line without signs, in lower case, with single blanks.
    """
    lines = messages.select(*_KEY, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    signs = F.regexp_extract("line", QUOTE, 0)
    marked = lines.select(*_KEY, "place", signs.alias("signs"), F.expr("substr(line, length(signs) + 1)").alias("rest"))
    normal = F.lower(F.trim(F.regexp_replace("rest", r"[ \t\r]+", " ")))
    levelled = marked.select(
        *_KEY, "place", (F.length("signs") - F.length(F.replace("signs", F.lit(">"), F.lit("")))).alias("level"), normal.alias("line")
    )
    return levelled.where("line <> ''").select(*_KEY, "place", "level", F.md5(F.col("line").cast("binary")).alias("key"))


def pieces(messages: DataFrame, quoted: bool) -> DataFrame:
    """(conv_id, turn, level, key, first, last): hashed runs of `PIECE` words of passages, and the lines they touch.

    Of quotes if `quoted`, else of the messages' own text, each piece of a message once.
    """
    types = {f.name: f.dataType for f in messages.schema.fields}
    schema = f"conv_id {types['conv_id'].simpleString()}, turn {types['turn'].simpleString()}, level int, key long, first int, last int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines, rows, places, levels, runs = [], [], [], [], []
            run = 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                run += 1
                before = None
                for place, line in enumerate((text or "").split("\n")):
                    found = _SIGNS.match(line)
                    depth = found[0].count(">") if found else 0
                    run += depth != before
                    before = depth
                    if (depth > 0) == quoted:
                        lines.append(line[found.end() if found else 0 :].lower().encode("utf-8", "surrogatepass"))
                        rows.append(row)
                        places.append(place)
                        levels.append(depth)
                        runs.append(run)
            words, counts = word_hashes(lines)
            n = max(0, len(words) - PIECE + 1)
            keys = np.zeros(n, np.uint64)
            for k in range(PIECE):
                keys += words[k : k + n] * _PIECE[k]
            counts = np.asarray(counts)
            line_of = np.repeat(np.arange(len(lines)), counts)
            first, last = line_of[:n], line_of[len(line_of) - n :]
            runs_of = np.array(runs, np.int64)
            starts = np.cumsum(counts) - counts
            whole = runs_of[first] == runs_of[last] if n else np.empty(0, bool)
            keys, first, last = keys[whole], first[whole], last[whole]
            # Passages and own lines of fewer words are one piece.
            heads = np.flatnonzero(np.diff(runs_of, prepend=-1))
            tails = np.append(heads[1:], len(runs_of))[: len(heads)] - 1
            short = [(heads, tails)] if quoted else [(heads, tails), (np.arange(len(lines)),) * 2]
            for head, tail in short:
                sizes = starts[tail] + counts[tail] - starts[head]
                for n in range(1, PIECE):
                    chosen = sizes == n
                    at = starts[head[chosen]]
                    some = np.full(len(at), n, np.uint64)
                    for k in range(n):
                        some += words[at + k] * _PIECE[k]
                    keys = np.append(keys, some)
                    first, last = np.append(first, head[chosen]), np.append(last, tail[chosen])
            keys = scatter(keys).view(np.int64)
            rows_of, places_of = np.array(rows, np.int64), np.array(places, np.int32)
            if not quoted and len(keys):
                order = np.lexsort((keys, rows_of[first]))
                same = (np.diff(keys[order], prepend=0) == 0) & (np.diff(rows_of[first][order], prepend=-1) == 0)
                chosen = order[~same]
                keys, first, last = keys[chosen], first[chosen], last[chosen]
            at = pa.array(rows_of[first], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(at),
                    batch.column("turn").take(at),
                    pa.array(np.array(levels, np.int32)[first], pa.int32()),
                    pa.array(keys, pa.int64()),
                    pa.array(places_of[first], pa.int32()),
                    pa.array(places_of[last], pa.int32()),
                ],
                names=["conv_id", "turn", "level", "key", "first", "last"],
            )

    return messages.select(*_KEY, "text").mapInArrow(cut, schema)


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, original, n_lines): how many lines each message quotes from which."""
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    lines = message_lines(known)
    own = lines.where("level = 0").groupBy("conv_id", "key").agg(F.min("turn").alias("original"))
    quoted = lines.where("level > 0").groupBy(*_KEY, "level", "place", "key").agg(F.count(F.lit(1)).alias("n"))
    held = materialize(quoted.join(own, ["conv_id", "key"], "left"), "chat-quotes")
    by_line = held.where("original < turn").groupBy(*_KEY, "level", "original").agg(F.sum("n").alias("n_lines"))
    open_lines = held.where("original IS NULL OR original >= turn").groupBy(*_KEY, "level", "place").agg(F.sum("n").alias("n_lines"))
    if open_lines.isEmpty():
        return by_line
    first = pieces(known, False).groupBy("conv_id", "key").agg(F.min("turn").alias("original"))
    found = pieces(known.where(F.col("text").rlike(r"(?:^|\n)[ \t]*>")), True).join(first, ["conv_id", "key"], "left")
    source = F.when(F.col("original") < F.col("turn"), F.col("original")).alias("original")
    touched = found.select(*_KEY, "level", source, F.explode(F.sequence("first", "last")).alias("place"))
    counted = touched.groupBy(*_KEY, "level", "place", "original").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.when(F.col("original").isNotNull(), F.struct("n", "original")))
    # A chance run of words in a line of many is no source.
    origin = counted.groupBy(*_KEY, "level", "place").agg(best.alias("best"), F.sum("n").alias("total")).where("3 * best.n >= total")
    more = (
        origin.join(open_lines, [*_KEY, "level", "place"])
        .groupBy(*_KEY, "level", F.col("best.original").alias("original"))
        .agg(F.sum("n_lines").alias("n_lines"))
    )
    return by_line.unionByName(more).groupBy(*_KEY, "level", "original").agg(F.sum("n_lines").alias("n_lines"))


def replies(links: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages with a link."""
    best = F.max(F.struct((-F.col("level")).alias("near"), "n_lines", "original"))
    return links.groupBy(*_KEY).agg(best.alias("best")).select(*_KEY, F.col("best.original").alias("reply_to"))


def threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread): the first turn of every chain of replies.

    Chains halve in every round, as each message takes over the link of the one it points to.
    """
    chains = materialize(answers.withColumn("thread", F.col("reply_to")), "chat-chains")
    while True:
        ahead = chains.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        joined = chains.join(ahead, ["conv_id", "thread"], "left")
        following = materialize(
            joined.select(*_KEY, "reply_to", F.coalesce("further", "thread").alias("thread"), F.col("further").isNotNull().alias("moved")),
            "chat-chains",
        )
        chains = following.drop("moved")
        if following.where("moved").isEmpty():
            return chains


def reply_ordered(messages: DataFrame) -> DataFrame:
    """(conv_id, thread, turn, role, text, reply_to, n_quoted): messages without quotes, with their place.

    `text` has the own lines only; `n_quoted` counts the lines taken out.
    """
    placed = threads(replies(quotation_links(messages)))
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    own = F.filter(lines, lambda line: ~line.rlike(QUOTE))
    cleaned = messages.select(
        *_KEY, "role", F.array_join(own, "\n").alias("text"), (F.size(lines) - F.size(own)).cast("long").alias("n_quoted")
    )
    return cleaned.join(placed, _KEY, "left").select(
        "conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", "role", "text", "reply_to", "n_quoted"
    )
