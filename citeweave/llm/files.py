"""Files that tasks write and read themselves, in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from citeweave.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """Address of a folder for one job's files, below the folder all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system of an address, as executors reach it, and the path in it."""
    return fs.FileSystem.from_uri(folder)


def new_name(partition: int, ending: str) -> str:
    """A name no other attempt at the same task uses; readers only follow the manifest."""
    return f"part-{partition:06d}-{uuid.uuid4().hex}{ending}"
