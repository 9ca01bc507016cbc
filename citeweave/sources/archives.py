"""Lines of CSV members inside archives, one archive per task.

Archives cannot be split, so a dump that ships as one huge archive is extracted first and
read by the splittable text readers; this reader is for folders of many archives.
"""

from __future__ import annotations

import io
import logging
import sys
import tarfile
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Workers get this module with the function, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_LINES = 20_000
SCHEMA = "archive string, member string, line_no bigint, value string"


def read_archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, line_no, value) of all .csv members of tar.gz, zip and nested zip files.

    A member that cannot be read is logged and skipped.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_batches, SCHEMA)


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            for member, stream in _csv_members(path, io.BytesIO(content)):
                lines = enumerate(io.TextIOWrapper(stream, encoding="utf-8", newline="\n"))
                try:
                    while chunk := list(islice(lines, BATCH_LINES)):
                        numbers, texts = zip(*chunk)
                        yield pd.DataFrame(
                            {
                                "archive": path,
                                "member": member,
                                "line_no": numbers,
                                "value": [t.rstrip("\r\n") for t in texts],
                            }
                        )
                except (OSError, UnicodeDecodeError, zipfile.BadZipFile) as error:
                    logging.warning("member %s of %s skipped: %s", member, path, error)


def _csv_members(path: str, data: io.BytesIO) -> Iterator[tuple[str, io.BufferedIOBase]]:
    try:
        if path.endswith((".tar.gz", ".tgz")):
            with tarfile.open(fileobj=data, mode="r:gz") as tar:
                for info in tar:
                    if info.isfile() and info.name.endswith(".csv"):
                        yield info.name, tar.extractfile(info)
        elif path.endswith(".zip"):
            with zipfile.ZipFile(data) as outer:
                for name in outer.namelist():
                    if name.endswith(".csv"):
                        yield name, outer.open(name)
                    elif name.endswith(".zip"):
                        for inner, stream in _csv_members(name, io.BytesIO(outer.read(name))):
                            yield f"{name}/{inner}", stream
    except (OSError, tarfile.TarError, zipfile.BadZipFile) as error:
        logging.warning("archive %s skipped: %s", path, error)
