"""Quality rules: a bitmask ledger that policies and ablations read without measuring again.

`ledger` evaluates every rule once per document and stores the measurements and one bit per
failed rule.  A policy is a versioned set of rules; applying it is one bitwise AND.  Ablations
(what would each rule alone, or all but it, reject) aggregate the bits, never the texts.

Everything here is built-in column functions.  A document is one row from start to end, so
neither hot sources nor copies meet in a task, and nothing is shuffled before ablations.

Defined results: a null text counts as empty; an empty text has no words and fails
`few_words`; repeated rows are measured each on its own; an empty table gives an empty ledger;
columns not named in `keep` are left out, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Rules in bit order, each on a struct of measurements.  A bit is never given to another
#: rule: new rules go to the end.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    ("shouting", lambda m: 10 * m["n_upper"] > 6 * m["n_letters"]),
    ("exclamations", lambda m: 10 * m["n_exclamations"] > 4 * m["n_words"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 14 * m["n_words"]),
    ("repeated_lines", lambda m: 10 * m["n_dup_lines"] > 6 * m["n_lines"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE_RULES = ("few_words", "repeated_words")

#: Rules of each policy version; a version never changes once results exist.
POLICIES = {
    "base": BASE_RULES,
    "v1": tuple(name for name, _ in RULES),
    "v2": tuple(name for name, _ in RULES if name != "repeated_lines"),
}

MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_exclamations",
)


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(BIT[name] for name in set(rules))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _left(text: Column, pattern: str) -> Column:
    """Characters that remain when all matches of `pattern` are removed."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at ascending starts."""
    added = F.transform(
        starts, lambda s, k: F.least(F.lit(3), s - F.coalesce(F.get(starts, k - 1), F.lit(-3)))
    )
    return F.aggregate(added, F.lit(0), lambda total, n: total + n)


def _repeated_starts(windows: Column) -> Column:
    """Ascending starts of the windows whose hash occurs at least twice."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        twice = F.filter(
            s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    return bound(pairs, starts)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    The 64-bit window hashes are sorted as plain longs first; only texts in which two of them
    are equal go on to sort (hash, position) pairs.
    """

    def count(windows: Column) -> Column:
        any_twice = bound(
            F.sort_array(windows),
            lambda s: F.size(F.filter(s, lambda h, j: h == F.get(s, j + 1))) > 0,
        )
        return F.when(any_twice, bound(_repeated_starts(windows), _covered)).otherwise(F.lit(0))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bound(windows, count)).cast("long")


def measurements(text: Column) -> Column:
    """All measurements of a text as one struct."""

    def of_text(t: Column) -> Column:
        words = F.filter(F.split(t, r"[ \t-\r]+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.regexp_replace(x, r"^[ \t-\r]+", "")) > 0)
        by_words = bound(
            words,
            lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeat")),
        )
        by_lines = bound(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        )
        return bound(
            F.struct(by_words.alias("w"), by_lines.alias("x")),
            lambda s: F.struct(
                s["w"]["n"].alias("n_words"),
                _left(t, r"[ \t-\r]+").alias("word_chars"),
                _left(t, r"[^#*$%&|<>]+").alias("n_symbols"),
                s["x"]["dup"].alias("n_dup_lines"),
                s["w"]["repeat"].alias("n_repeat_words"),
                s["x"]["n"].alias("n_lines"),
                _left(t, r"\P{L}+").alias("n_letters"),
                _left(t, r"\P{Lu}+").alias("n_upper"),
                _left(t, "[^!]+").alias("n_exclamations"),
            ),
        )

    return bound(F.coalesce(text, F.lit("")), of_text)


def failure_bits(measured: Column) -> Column:
    """One bit per failed rule, from a struct of measurements."""

    def bits(m: Column) -> Column:
        total = F.lit(0).cast("long")
        for name, rule in RULES:
            total = total.bitwiseOR(F.when(rule(m), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
        return total

    return bound(measured, bits)


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """(keep..., the measurements, failures), one row per document; keeps doc_id by default."""
    named = [F.col(f"`{c}`") for c in keep or ("doc_id",)]

    def entry(m: Column) -> Column:
        return F.struct(*[m[c].alias(c) for c in MEASUREMENTS], failure_bits(m).alias("failures"))

    # A generator keeps the struct from being computed again for each of its fields.
    entries = docs.select(*named, F.explode(F.array(bound(measurements(F.col("text")), entry))).alias("ledger entry"))
    return entries.select(*named, "`ledger entry`.*")


def fails(failures: Column, version: str) -> Column:
    """Does a row of the ledger break a rule of the policy?"""
    return failures.bitwiseAND(F.lit(mask_of(POLICIES[version])).cast("long")) != 0


def kept_documents(docs: DataFrame, version: str = "v1") -> DataFrame:
    """The rows of `docs`, with their own columns, that the policy keeps."""
    bits = bound(measurements(F.col("text")), failure_bits)
    return docs.where(~fails(bits, version))


def ablations(entries: DataFrame, versions: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """(policy, rule, rejected, rejected_without, only_this) over a ledger.

    `rejected`: documents the policy rejects; `rejected_without`: if it lacked the rule;
    `only_this`: documents that fail this rule alone.  The ledger shrinks to one row per
    pattern of bits before anything is shuffled or multiplied.
    """
    patterns = entries.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    rules = entries.sparkSession.createDataFrame(
        [Row(policy=v, rule=r, mask=mask_of(POLICIES[v]), bit=BIT[r]) for v in versions for r in POLICIES[v]]
    )
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    counted = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    # At most 2 ** rules patterns meet a fixed list of rules.
    return (
        rules.join(F.broadcast(patterns), F.lit(True), "left")
        .groupBy("policy", "rule")
        .agg(
            counted(hit != 0)("rejected"),
            counted(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) != 0)("rejected_without"),
            counted(hit == F.col("bit"))("only_this"),
        )
    )
