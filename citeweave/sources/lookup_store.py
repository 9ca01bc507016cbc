"""Lookup tables kept between runs.

A table is a folder of numbered commits: `version=n` holds the whole table, `delta=n` the answers
one run has added.  The newest version and the deltas after it count; they are put together when
read.  A run writes its own answers only; after `MAX_DELTAS` of them it writes a version, so the
whole table is rewritten once in that many runs.  A folder without Spark's mark of success, left
by a crash, is not read, and the next run writes it anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.lookup import last_wins

ANSWER_SCHEMA = "title string, year string, doi string, score double, error string"
LOOKUP_SCHEMA = "doi string, exists boolean, error_type string, ts timestamp_ntz"
MAX_DELTAS = 16


def _committed(spark: SparkSession, path: str, kind: str) -> list[int]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done or [])


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers whose write was committed, whole tables and deltas."""
    return sorted({*_committed(spark, path, "version"), *_committed(spark, path, "delta")})


def _counting(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number of the newest whole table, 0 without one, and of the deltas after it."""
    base = max(_committed(spark, path, "version"), default=0)
    return base, [n for n in _committed(spark, path, "delta") if n > base]


def _newest(rows: DataFrame) -> DataFrame:
    """One row per key: the latest answer per DOI, or the last given one per (title, year)."""
    if "ts" in rows.columns:
        return last_wins(rows.drop("_number"), ["doi"], F.col("ts"))
    return last_wins(rows, ["title", "year"], F.col("_number")).drop("_number")


def load_lookup(spark: SparkSession, path: str, schema: str = LOOKUP_SCHEMA) -> DataFrame:
    """The table as of the last commit, or an empty one; a damaged one is an error, not empty."""
    base, deltas = _counting(spark, path)
    parts = [f"version={base}"] * bool(base) + [f"delta={n}" for n in deltas]
    if not parts:
        return spark.createDataFrame([], schema)
    frames = [spark.read.schema(schema).parquet(f"{path}/{part}") for part in parts]
    if not deltas:
        return frames[0]
    rows = frames[0].withColumn("_number", F.lit(0))
    for number, frame in enumerate(frames[1:], 1):
        rows = rows.unionByName(frame.withColumn("_number", F.lit(number)))
    return _newest(rows)


def upsert_lookup(
    spark: SparkSession, path: str, fresh: DataFrame, schema: str = LOOKUP_SCHEMA, max_deltas: int = MAX_DELTAS
) -> DataFrame:
    """Add answers to the table.

    The latest answer per DOI wins; answers to searches have no time of their own, so there
    the fresh one per (title, year) does.
    """
    number = max(_versions(spark, path), default=0) + 1
    empty = spark.createDataFrame([], schema)
    added = empty.unionByName(fresh, allowMissingColumns=True).select(empty.columns)
    _newest(added.withColumn("_number", F.lit(0))).write.mode("overwrite").parquet(f"{path}/delta={number}")
    if len(_counting(spark, path)[1]) > max_deltas:
        compact_lookup(spark, path, schema)
    return load_lookup(spark, path, schema)


def compact_lookup(spark: SparkSession, path: str, schema: str = LOOKUP_SCHEMA) -> None:
    """Write the whole table as a version under the number of the last delta, which it replaces."""
    base, deltas = _counting(spark, path)
    if deltas:
        load_lookup(spark, path, schema).write.mode("overwrite").parquet(f"{path}/version={deltas[-1]}")
