"""Session set-up and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Shuffle files of an action go when it ends, not when the driver happens to collect its garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submitter configures it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("citeweave")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, else a local one in local mode."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="citeweave-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


# Intermediate tables written so far, per application.
_WRITTEN: dict[str, list[str]] = {}


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in here, which nothing else reads, are deleted with the end of each."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_CONF) if before is None else spark.conf.set(CLEANUP_CONF, before)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a frame that several later steps read, and hand back the written table.

    The table survives lost executors, cuts the lineage and gives the optimizer real sizes.
    ``clear_intermediates`` deletes it, unless ``keep`` says that it outlives its job.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_go(spark):
        df.write.parquet(path, compression="zstd")
    if not keep:
        _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: both sides are dealt by key.

    Without the hint each such table below the broadcast threshold passes through the driver.
    """
    return df.hint("merge")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more; others stay."""
    spark = df.sparkSession
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    folders = {file.rsplit("/", 2)[-2] for file in df.inputFiles()}
    for path in [p for p in written if p.rsplit("/", 1)[-1] in folders]:
        _delete(spark, path)
        written.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_intermediates(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application; how many there were.

    For the owner of a job to call once its results are written: frames that still read the
    tables can't be used afterwards.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)
