"""Exact-size seeded splits and first-n batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions.fixed_values import PILOT_SIZE, SPLIT_SEED, TRAIN_SIZE
from citeweave.session import materialize


def _first_n(df: DataFrame, rank: Column, n: int, name: str) -> DataFrame:
    """Add a flag for exactly n rows: those with the smallest (rank, hash of the row).

    A top-n gives the last of them; every other row is decided by one comparison.  Only rows
    tied with the last one, equal in every column, are numbered.  The input is computed once.
    """
    ranked = materialize(
        df.withColumn("_rank", F.struct(rank.alias("r"), F.xxhash64(*df.columns).alias("h"))), "ranked"
    )
    top = ranked.select("_rank").orderBy("_rank").limit(n)
    last = top.agg(F.max("_rank").alias("last"))
    tied_in = top.join(last, F.col("_rank") == F.col("last")).agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = ranked.withColumn("_last", last.scalar())
    before = F.coalesce(F.col("_rank") < F.col("_last"), F.lit(False))
    tied = F.coalesce(F.col("_rank") == F.col("_last"), F.lit(False))
    numbered = placed.where(tied).withColumn(
        name, F.row_number().over(Window.partitionBy("_rank").orderBy("_rank")) <= tied_in
    )
    return placed.where(~tied).withColumn(name, before).unionByName(numbered).drop("_rank", "_last")


def seeded_split(
    df: DataFrame, key: str = "key", n: int = TRAIN_SIZE, seed: int = SPLIT_SEED
) -> DataFrame:
    """Add ``split``: train for exactly n rows in a seeded order of the keys, else validation."""
    rank = F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))).alias("h"), F.col(key))
    return (
        _first_n(df, rank, n, "_train")
        .withColumn("split", F.when(F.col("_train"), "train").otherwise("validation"))
        .drop("_train")
    )


def limit_keys(df: DataFrame, key: str = "key", n: int | None = None) -> DataFrame:
    """First n rows by key, all of them when n is not given."""
    return df if n is None else df.orderBy(key).limit(n)


def pilot_then_rest(df: DataFrame, key: str = "key", n: int = PILOT_SIZE) -> DataFrame:
    """Add ``batch``: pilot for exactly the first n rows by key, else rest."""
    return (
        _first_n(df, F.col(key), n, "_pilot")
        .withColumn("batch", F.when(F.col("_pilot"), "pilot").otherwise("rest"))
        .drop("_pilot")
    )
