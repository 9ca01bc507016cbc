"""Token ids in Arrow files of equal-length sequences with masks.

A task writes one file for its range of documents: record batches of fixed-size lists, `tokens`
and `mask`, so that any sequence is a slice of mapped memory without a copy.  The ids of the
documents follow one another; only a file's last sequence is padded, where the mask is false.
A second file holds where each document starts.  Readers go by the manifest, which names only
files of finished tasks.

Defined results: a null or empty text is the end id alone; documents come in ascending doc_id
order, without doc_id first; repeated rows are written each; an empty table gives an empty
manifest.  Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.files import new_folder, new_name, opened
from citeweave.llm.tokens import shared_encoder
from citeweave.llm.words import slices
from citeweave.session import materialize

LENGTH = 2048
#: Sequences per record batch: a megabyte of 16-bit ids.
BATCH = 256
_MANIFEST = "folder string, name string, index_name string, first_doc long, n_docs long, n_tokens long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class Writer:
    """Writes one file of sequences and its index."""

    def __init__(self, folder: str, partition: int, dtype: np.dtype, length: int) -> None:
        self.folder, self.dtype, self.length = folder, dtype, length
        self.name, self.index_name = new_name(partition, ".arrow"), new_name(partition, ".index.arrow")
        self.system, self.path = opened(folder)
        self.system.create_dir(self.path, recursive=True)
        ids = pa.from_numpy_dtype(dtype.newbyteorder("="))
        self.schema = pa.schema([("tokens", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.system.open_output_stream(f"{self.path}/{self.name}")
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[bytes] = []
        self.size = 0
        self.n_tokens = 0
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.index.append((doc_id, self.n_tokens, n))
        self.n_tokens += n
        self.held.append(ids)
        self.size += n
        if self.size >= BATCH * self.length:
            self._write(self.size // self.length * self.length)

    def _write(self, n: int) -> None:
        """Write the first n held ids; n may reach into padding."""
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        values = np.zeros(n, self.dtype)
        values[: len(ids)] = ids[:n]
        mask = np.arange(n) < len(ids)
        for start in range(0, n, BATCH * self.length):
            stop = min(n, start + BATCH * self.length)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(values[start:stop]), type=self.schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask[start:stop]), type=self.schema.field(1).type),
            ]
            self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held = [ids[n:].tobytes()] if n < len(ids) else []
        self.size = max(0, len(ids) - n)

    def close(self) -> dict:
        if self.size:
            self._write(-(-self.size // self.length) * self.length)
        self.file.close()
        self.sink.close()
        columns = [pa.array(c, pa.int64()) for c in zip(*self.index, strict=True)]
        with self.system.open_output_stream(f"{self.path}/{self.index_name}") as sink, pa.ipc.new_file(sink, _INDEX) as index:
            index.write_batch(pa.RecordBatch.from_arrays(columns, schema=_INDEX))
        return {
            "folder": self.folder,
            "name": self.name,
            "index_name": self.index_name,
            "first_doc": self.index[0][0],
            "n_docs": len(self.index),
            "n_tokens": self.n_tokens,
        }


class TokenFile:
    """One file, mapped where the file system allows; sequences and masks are views."""

    def __init__(self, folder: str, name: str) -> None:
        system, path = opened(folder)
        local = system.type_name == "local"
        source = pa.memory_map(f"{path}/{name}") if local else system.open_input_file(f"{path}/{name}")
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("tokens").type.list_size
        # All batches but the last few are equal; the starts are few numbers either way.
        counts = [self.reader.get_batch(i).num_rows for i in range(self.reader.num_record_batches)]
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.starts[-1])

    def _row(self, column: str, i: int) -> pa.Array:
        batch = int(np.searchsorted(self.starts, i, side="right")) - 1
        at = i - int(self.starts[batch])
        lists = self.reader.get_batch(batch).column(column)
        return lists.slice(at, 1).flatten()

    def sequence(self, i: int) -> np.ndarray:
        return self._row("tokens", i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        return self._row("mask", i)

    def batches(self) -> Iterator[np.ndarray]:
        """The ids of each record batch, as views, without padding."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            real = batch.column("mask").flatten().true_count
            yield batch.column("tokens").flatten().to_numpy(zero_copy_only=True)[:real]


def read_index(folder: str, name: str) -> pa.Table:
    system, path = opened(folder)
    with system.open_input_file(f"{path}/{name}") as source:
        return pa.ipc.open_file(source).read_all()


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, folder: str | None = None, special_ids: bool = False
) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; the manifest, with `base` per file.

    `base` counts the ids of all files before.
    """
    place = folder or new_folder(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, special_ids)
        end = np.array([end_id], encoder.dtype).tobytes()
        writer = None
        for batch in slices(batches, "text", 1 << 23):
            if writer is None:
                writer = Writer(place, TaskContext.get().partitionId(), encoder.dtype, length)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                writer.add(doc_id, ids + end)
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.close()], schema=_manifest_schema())

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    manifest = materialize(ordered.mapInArrow(write, _MANIFEST), "token-manifest")
    # One row per file: a running sum over these is small.
    before = Window.orderBy("first_doc").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _manifest_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _MANIFEST.split(", "))])


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of all documents, a file per task.

    `ids` and the checksum are over little-endian unsigned 32-bit ids.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row)

    def _documents(row: dict) -> Iterator[pa.RecordBatch]:
        index = read_index(row["folder"], row["index_name"])
        parts = TokenFile(row["folder"], row["name"]).batches()
        counts, out, held = index["n_tokens"].to_pylist(), [], np.empty(0, np.uint32)
        at = 0
        for n in counts:
            while len(held) - at < n:
                held, at = np.concatenate([held[at:], next(parts).astype("<u4")]), 0
            ids = held[at : at + n].tobytes()
            at += n
            out.append((zlib.crc32(ids), ids if with_ids else None))
        crcs, ids = zip(*out, strict=True)
        columns = [
            index["doc_id"].combine_chunks(),
            pa.array(np.asarray(index["start"]) + row["base"]),
            index["n_tokens"].combine_chunks(),
            pa.array(crcs, pa.int64()),
            *([pa.array(ids, pa.binary())] if with_ids else []),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    files = manifest.select("folder", "name", "index_name", "base")
    return files.repartition(max(1, manifest.count())).mapInArrow(read, schema)
