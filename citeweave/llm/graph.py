"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.session import materialize


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them and itself.

    Only a minimum per node is aggregated, with partial minima before the shuffle; the
    neighbours of a node are never gathered.
    """
    if larger_only:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = pairs
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = both.join(least, "u")
    if larger_only:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # (u, m) itself is one of the pairs: its link stays as it is.
        out = linked.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of `pairs` (u, v): root is the smallest node it reaches.

    Alternates large and small stars until nothing changes; every round is written, so a lost
    executor costs one round at most.  Loops and repeated pairs are allowed.
    """
    edges = materialize(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        edges = materialize(_star(materialize(_star(edges, True), "edges"), False), "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
