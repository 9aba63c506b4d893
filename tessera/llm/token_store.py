"""Token ids in Arrow files of fixed-size lists.

A store is a folder of Arrow IPC files. Each holds the ids of a run of documents, in order, as
equal-length sequences: column `ids` (fixed-size list of uint16), column `mask` (fixed-size list of
bool, false only behind the end of the last sequence). A batch holds `BATCH` sequences, so sequence
k is row k % BATCH of batch k // BATCH, found through the file's footer and read in place from a
memory map. Beside each file lies an index in the same format: doc_id, place and number of ids.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan
from tessera.llm.bytelevel import encoder
from tessera.llm.common import checkpointed, shared_dir

#: Ids in a sequence, and sequences in a batch.
LENGTH, BATCH = 1024, 256
#: Bytes of text for each file that a store of them is planned with.
FILE_BYTES = 32 << 20


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Appends ids and writes full batches as they come; at most one batch and one block are held."""

    def __init__(self, sink, length: int = LENGTH, batch: int = BATCH):
        self.length, self.batch, self.rest, self.total = length, batch, np.zeros(0, np.uint16), 0
        self.schema = pa.schema([("ids", pa.list_(pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        ids = np.concatenate((self.rest, ids))
        step = self.length * self.batch
        for at in range(0, len(ids) - step + 1, step):
            self._write(ids[at : at + step], step)
        self.rest = ids[len(ids) - len(ids) % step :]

    def _write(self, ids: np.ndarray, real: int) -> None:
        column = pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < real), self.length)
        self.file.write_batch(pa.record_batch([column, mask], schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            size = -(-len(self.rest) // self.length) * self.length
            self._write(np.concatenate((self.rest, np.zeros(size - len(self.rest), np.uint16))), len(self.rest))
        self.file.close()


class Reader:
    """Random access to the sequences of a file; arrays are views of the mapped file where it is local."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        self.source = pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self._held = (-1, None, None)

    def _batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        if self._held[0] != k:
            got = self.file.get_batch(k)
            self._held = (k, got.column(0).flatten().to_numpy(zero_copy_only=True), got.column(1))
        return self._held[1:]

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence k."""
        ids, mask = self._batch(k // self.batch)
        at = k % self.batch
        return ids[at * self.length : (at + 1) * self.length], mask[at].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids start to start + count of the file, through the batches that hold them."""
        step, out = self.length * self.batch, []
        while count > 0:
            k, at = divmod(start, step)
            got = self._batch(k)[0][at : at + count]
            out.append(got)
            start, count = start + len(got), count - len(got)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint16)


def write_store(docs: DataFrame, path: str, folder: str, end_id: int = 2, files: int | None = None) -> DataFrame:
    """Write the ids of all documents, in ascending doc_id order, to `folder`; returns the manifest.

    The manifest has a row per file: (part, file, first and documents and tokens). Files are named by
    part and attempt, closed before their row is returned, and never written over, so a part that runs
    again after an executor is lost leaves at worst a file that no manifest names.
    """
    narrow = docs.select(F.col("doc_id"), F.col("text"))
    if files is None:
        size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(1, -(-size // FILE_BYTES))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def stage(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = _file_system(folder)
        name = f"{root}/ids-{part:06d}-{uuid.uuid4().hex}.arrow"
        writer = index = None
        first, documents = None, 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for k, parts in textscan.blocks(texts):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    sink, index_sink = system.open_output_stream(name), system.open_output_stream(name + ".index")
                    writer = Writer(sink)
                    index_schema = pa.schema([("doc_id", batch.column("doc_id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                    index = pa.ipc.new_file(index_sink, index_schema)
                ids, at = encoder(path).encode(parts)
                n = np.diff(at) + 1
                whole = np.full(len(ids) + len(parts), end_id, np.uint16)
                keep = np.ones(len(whole), bool)
                keep[np.cumsum(n) - 1] = False
                whole[keep] = ids
                start = writer.total + np.cumsum(n) - n
                own = batch.column("doc_id").slice(k, len(parts))
                index.write_batch(pa.record_batch([own, pa.array(start), pa.array(n)], schema=index_schema))
                writer.add(whole)
                first = own[0].as_py() if not documents else first
                documents += len(parts)
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            shown = name if "://" not in folder else f"{folder}/{name.rsplit('/', 1)[1]}"
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [shown], "first": pa.array([first], batch.column("doc_id").type), "documents": [documents], "tokens": [writer.total]})

    ordered = narrow.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return checkpointed(ordered.mapInArrow(stage, f"part long, file string, first {kind}, documents long, tokens long"))


def read_store(manifest: DataFrame) -> DataFrame:
    """Read a store back: (doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    start counts the ids of all documents before; ids_crc32 is of the ids as little-endian unsigned
    32-bit integers. The manifest has a row per file, a fixed number of bytes of text each.
    """
    from pyspark.sql import Window as W

    kind = manifest.schema["first"].dataType.simpleString()
    before = F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    files = manifest.select("part", "file", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    n = manifest.count()

    def stage(batches):
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                system, path = _file_system(name)
                reader = Reader(name)
                with system.open_input_file(path + ".index") as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        own = index.get_batch(k)
                        starts, counts = own.column(1).to_numpy(), own.column(2).to_numpy()
                        crc = [zlib.crc32(reader.ids(a, c).astype("<u4").data) for a, c in zip(starts.tolist(), counts.tolist())]
                        yield pa.RecordBatch.from_arrays([own.column(0), pa.array(starts + base), own.column(2), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(max(1, n), "part").mapInArrow(stage, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def stored_tokens(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Write a store (by default in the shared folder) and read it back.

    A null or empty text is its end id alone. Repeated rows and equal ids follow each other; null ids come
    first; an empty table gives no files and no rows; further columns are not read.
    """
    folder = folder or f"{shared_dir(docs.sparkSession).rstrip('/')}/token-store-{uuid.uuid4().hex}"
    return read_store(write_store(docs, path, folder, end_id))
