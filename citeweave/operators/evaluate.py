"""Score cutoffs and evaluation of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SWEEP_BUCKETS = 200


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def rates(tp: Column, fp: Column, tn: Column, fn: Column, suffix: str = "", absent: bool = False) -> list[Column]:
    """Accuracy, precision, recall and F1, 0 on a zero denominator.

    With ``absent`` they are null when nothing was classified.
    """
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    measures = {
        "accuracy": _ratio(tp + tn, tp + fp + tn + fn),
        "precision": precision,
        "recall": recall,
        "f1": F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0),
    }
    if absent:
        some = tp + fp + tn + fn > 0
        measures = {n: F.when(some, m) for n, m in measures.items()}
    return [m.alias(n + suffix) for n, m in measures.items()]


def _conditions(taken: Column, right: Column) -> dict[str, Column]:
    """The four cells of a confusion matrix."""
    return {
        "tp": taken & right,
        "fp": taken & ~right,
        "tn": ~taken & ~right,
        "fn": ~taken & right,
    }


def confusion_at(scored: DataFrame, cutoff: Column) -> DataFrame:
    """Confusion counts and rates at one cutoff, in one pass."""
    cells = _conditions(F.col("score") >= cutoff, _flag(F.col("is_correct")))
    counts = scored.agg(*[F.count_if(c).alias(n) for n, c in cells.items()])
    return counts.select("*", *rates(*[F.col(n) for n in cells]))


def distinct_scores(scored: DataFrame) -> DataFrame:
    return scored.select("score").distinct()


def _in_ranges(per_score: DataFrame, buckets: int) -> DataFrame:
    """Add ``bucket``: value ranges that hold about the same number of rows of ``per_score``.

    The bounds need not be exact; they only have to be the same for all rows.
    """
    steps = [i / buckets for i in range(1, buckets)]
    bounds = per_score.agg(F.percentile_approx("score", steps, 10_000).alias("b")).scalar()
    placed = per_score.withColumn("bounds", bounds).withColumn("bucket", F.lit(0))
    # Number of bounds up to the score, by bisection: a few comparisons per distinct score.
    for step in (1 << i for i in reversed(range(buckets.bit_length()))):
        reached = F.get("bounds", F.col("bucket") + (step - 1)) <= F.col("score")
        placed = placed.withColumn("bucket", F.col("bucket") + F.when(reached, step).otherwise(0))
    return placed.drop("bounds")


def cutoff_sweep(scored: DataFrame, buckets: int = SWEEP_BUCKETS) -> DataFrame:
    """Confusion counts and rates with every distinct score as cutoff.

    Prefix sums on two levels: scores are cut into value ranges holding about the same
    number of distinct scores, range totals (at most ``buckets`` + 1 rows) give the
    offsets, and only within a range are the scores ordered.
    """
    right = _flag(F.col("is_correct"))
    per_score = scored.groupBy("score").agg(
        F.count_if(right).alias("right"), F.count_if(~right).alias("wrong")
    )
    placed = _in_ranges(per_score, buckets)
    # One row per bucket, so the ungrouped window below is of fixed size.
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = placed.groupBy("bucket").agg(
        F.sum("right").alias("n_right"), F.sum("wrong").alias("n_wrong")
    )
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("n_right").over(above), F.lit(0)).alias("right_above"),
        F.coalesce(F.sum("n_wrong").over(above), F.lit(0)).alias("wrong_above"),
        F.sum("n_right").over(everything).alias("all_right"),
        F.sum("n_wrong").over(everything).alias("all_wrong"),
    )
    down = (
        Window.partitionBy("bucket")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counts = placed.join(F.broadcast(offsets), "bucket").select(
        F.col("score").alias("cutoff"),
        (F.col("right_above") + F.sum("right").over(down)).alias("tp"),
        (F.col("wrong_above") + F.sum("wrong").over(down)).alias("fp"),
        "all_right",
        "all_wrong",
    )
    cells = counts.select(
        "cutoff",
        "tp",
        "fp",
        (F.col("all_wrong") - F.col("fp")).alias("tn"),
        (F.col("all_right") - F.col("tp")).alias("fn"),
    )
    return cells.select("*", *rates(*[F.col(n) for n in ("tp", "fp", "tn", "fn")]))


def best_cutoff(sweep: DataFrame, manual: float | None = None) -> DataFrame:
    """Cutoff of the highest accuracy, the lowest one on ties; (cutoff, accuracy).

    The cutoff is 0 when no cutoff classifies anything right.  ``manual`` overrides it.
    """
    hits = F.col("tp") + F.col("tn")
    best = sweep.agg(
        F.min(F.struct((-hits).alias("neg"), "cutoff", "accuracy")).alias("best")
    ).select(
        F.when(F.col("best.neg") < 0, F.col("best.cutoff")).otherwise(0.0).alias("cutoff"),
        F.col("best.accuracy").alias("accuracy"),
    )
    return best if manual is None else best.withColumn("cutoff", F.lit(float(manual)))


def score_profile(scored: DataFrame, buckets: int = SWEEP_BUCKETS) -> DataFrame:
    """Scores by presence on the registry and correctness, with the exact lower median.

    The median comes from counts per score: totals of value ranges say in which range it
    lies, and only the scores of that range are ordered.
    """
    group = ["on_registry", "is_correct"]
    profile = scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.avg("score").alias("avg_score"),
    )
    per_score = scored.where("score IS NOT NULL").groupBy(*group, "score").agg(F.count(F.lit(1)).alias("k"))
    # Nulls take part as a group of their own, so groups are told apart by their text.
    label = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in group])
    placed = _in_ranges(per_score.withColumn("g", label), buckets)
    ranges = Window.partitionBy("g").orderBy("bucket")
    totals = placed.groupBy("g", "bucket").agg(F.sum("k").alias("in_range")).select(
        "g",
        "bucket",
        F.coalesce(F.sum("in_range").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        "in_range",
        F.ceil(F.sum("in_range").over(Window.partitionBy("g")) / 2).alias("half"),
    )
    middle = totals.where("below < half AND below + in_range >= half").select("g", "bucket", "below", "half")
    up = Window.partitionBy("g", "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = placed.join(F.broadcast(middle), ["g", "bucket"]).withColumn("upto", F.col("below") + F.sum("k").over(up))
    medians = reached.where("upto >= half").groupBy("g").agg(F.min("score").alias("median_score"))
    return profile.withColumn("g", label).join(F.broadcast(medians), "g", "left").drop("g")


def evaluate_holdout(matched: DataFrame, cutoff: Column) -> DataFrame:
    """Standard and validated confusion matrix over the rows with a registry DOI.

    Above the cutoff an invalid match counts as a true negative of the validated matrix,
    even if its DOI is right; below it only a valid and right one is a false negative.
    """
    found = F.col("registry_doi").isNotNull()
    taken = F.col("score") >= cutoff
    right, valid = _flag(F.col("is_correct")), _flag(F.col("is_valid_match"))
    cells = {n: F.count_if(found & c) for n, c in _conditions(taken, right).items()}
    checked = {
        "tp": taken & valid & right,
        "fp": taken & valid & ~right,
        "tn": (taken & ~valid) | (~taken & ~(valid & right)),
        "fn": ~taken & valid & right,
    }
    counts = matched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("with_result"),
        *[c.alias(n) for n, c in cells.items()],
        *[F.count_if(found & c).alias(n + "_valid") for n, c in checked.items()],
    )
    names = ("tp", "fp", "tn", "fn")
    return counts.select(
        "*",
        *rates(*[F.col(n) for n in names], absent=True),
        *rates(*[F.col(n + "_valid") for n in names], suffix="_valid", absent=True),
    )


def evaluate_direct(matched: DataFrame, cutoff: Column) -> DataFrame:
    """One confusion matrix in which a match is right only when it is valid too."""
    found = F.col("registry_doi").isNotNull()
    cells = _conditions(F.col("score") >= cutoff, _flag(F.col("is_correct")))
    counts = matched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("with_result"),
        *[F.count_if(found & c).alias(n) for n, c in cells.items()],
    )
    return counts.select("*", *rates(*[F.col(n) for n in cells], absent=True))


def wrong_matches(matched: DataFrame, cutoff: Column) -> DataFrame:
    """Accepted but wrong matches of records that are on the registry."""
    return matched.where(
        (F.col("score") >= cutoff) & ~_flag(F.col("is_correct")) & _flag(F.col("on_registry"))
    )
