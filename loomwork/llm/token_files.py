"""Token ids of a corpus in Arrow files of equal-length sequences.

The ids of all documents, each closed by an end id, run on in ascending doc_id order. Every task writes one range of
doc_ids: ``ids-*.arrow``, whose record batches hold ``ids`` (fixed-size lists; 16 bits where the vocabulary allows) and
``mask`` (fixed-size lists of booleans, false where the last sequence is padded), and ``docs-*.arrow`` with doc_id,
start and n_tokens of the range's documents. Both are Arrow stream messages closed by the file footer, uncompressed, so
sequence i is read in place: batch i // ROWS, row i % ROWS, no copy. Files are written to a name of their attempt's own,
which only the manifest of the finished job names: repeated tasks do no harm. The manifest, a row per range, is one file:
Spark runs a process for every file that a task begins in a local folder, which shares the executor's memory for a moment
and seems to take as much again.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import arrow_store, materialise, partitions, scratch
from loomwork.llm.tokens import default_vocabulary, encoder

LENGTH = 2048
#: Sequences in a record batch.
ROWS = 256
END_ID = 2
#: Ids that a task reads back, at least; files with fewer share a task.
READ_IDS = 1 << 20
DOCS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def ids_schema(kind: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a run of ids into sequences and writes full batches as they come."""

    def __init__(self, sink, kind: pa.DataType, length: int) -> None:
        self.schema = ids_schema(kind, length)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.kind, self.length = kind, length
        self.left: list[np.ndarray] = []
        self.waiting = self.total = self.sequences = 0

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length)]
        lists.append(pa.FixedSizeListArray.from_arrays(mask, self.length))
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.sequences += len(ids) // self.length

    def add(self, ids: np.ndarray) -> None:
        self.left.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        size = self.length * ROWS
        if self.waiting >= size:
            run = np.concatenate(self.left)
            full = len(run) // size * size
            for at in range(0, full, size):
                self._write(run[at : at + size], size)
            self.left, self.waiting = [run[full:]], len(run) - full

    def close(self) -> None:
        if self.waiting:
            run = np.concatenate(self.left)
            padded = np.zeros(-(-len(run) // self.length) * self.length, run.dtype)
            padded[: len(run)] = run
            self._write(padded, len(run))
        self.writer.close()


@dataclass
class TokenFiles:
    """What a job wrote: the folder, and one manifest row per range (part, ids_file, docs_file, n_docs, n_tokens)."""

    folder: str
    manifest: DataFrame
    length: int

    def files(self) -> DataFrame:
        """The manifest with ``before``, the ids in the files of smaller doc_ids; one row per file."""
        rows = self.manifest.orderBy("part").collect()
        before, out = 0, []
        for r in rows:
            out.append((r["part"], r["ids_file"], r["docs_file"], before))
            before += r["n_tokens"]
        spark = self.manifest.sparkSession
        return spark.createDataFrame(out, "part int, ids_file string, docs_file string, before long")

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32), read back from the files alone."""
        count, ids = self.manifest.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
        n = max(1, min(partitions(self.manifest.sparkSession) * 4, count, -(-ids // READ_IDS)))
        # dealt in turn, from one partition with a row per file: tasks get as many files each; the order keeps the two apart
        files = self.files().coalesce(1).sortWithinPartitions("part").repartition(n)
        return files.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> TokenFiles:
    """Encodes every whole text of ``docs`` (doc_id, text) and writes the files to the shared folder.

    Null and empty texts are their end id alone. Null doc_ids come first; rows that repeat a doc_id follow one another
    in the order of their texts. An empty table gives files without documents.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    folder = scratch(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        code = encoder(vocabulary)
        kind = pa.uint16() if max(code.size, end_id + 1) <= 1 << 16 else pa.uint32()
        dtype = kind.to_pandas_dtype()
        store, root = arrow_store(folder)
        store.create_dir(root, recursive=True)
        tag = f"{part:06d}-{uuid.uuid4().hex}.arrow"
        n_docs = 0
        with (
            store.open_output_stream(f"{root}/ids-{tag}") as sink,
            store.open_output_stream(f"{root}/docs-{tag}") as doc_sink,
            pa.ipc.new_file(doc_sink, DOCS_SCHEMA) as doc_writer,
        ):
            writer = SequenceWriter(sink, kind, length)
            for batch in batches:
                at = 0
                for n, ids, offsets in code.encode(batch.column(1)):
                    closed = np.insert(ids.astype(dtype), offsets[1:], end_id)
                    counts = np.diff(offsets) + 1
                    starts = writer.total + np.cumsum(counts) - counts
                    writer.add(closed)
                    own = batch.column(0).slice(at, n)
                    doc_writer.write_batch(
                        pa.RecordBatch.from_arrays([own, pa.array(starts), pa.array(counts)], schema=DOCS_SCHEMA)
                    )
                    at += n
                    n_docs += n
            writer.close()
        row = [part], [f"{folder}/ids-{tag}"], [f"{folder}/docs-{tag}"], [n_docs], [writer.total], [writer.sequences]
        names = ["part", "ids_file", "docs_file", "n_docs", "n_tokens", "n_sequences"]
        arrays = [pa.array(row[0], pa.int32()), *map(pa.array, row[1:])]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select("doc_id", "text").repartitionByRange(partitions(spark), F.col("doc_id"), F.xxhash64("text"))
    rows = rows.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    schema = "part int, ids_file string, docs_file string, n_docs long, n_tokens long, n_sequences long"
    manifest = spark.createDataFrame(rows.mapInArrow(run, schema).collect(), schema)  # one row per range
    return TokenFiles(folder, materialise(manifest.coalesce(1), "token-manifest"), length)


def _open(uri: str):
    store, path = arrow_store(uri)
    if isinstance(store, pa.fs.LocalFileSystem):
        return pa.memory_map(path)
    return store.open_input_file(path)


def sequence(ids_file: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence i of a file and its mask; the ids are a view of the file's bytes."""
    with pa.ipc.open_file(_open(ids_file)) as reader:
        batch, row = reader.get_batch(i // ROWS), i % ROWS
    ids, mask = batch.column("ids")[row].values, batch.column("mask")[row].values
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def _runs(reader: pa.ipc.RecordBatchFileReader) -> Iterator[np.ndarray]:
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids = batch.column("ids").flatten().to_numpy()
        if i + 1 == reader.num_record_batches:
            ids = ids[: int(np.count_nonzero(batch.column("mask").flatten().to_numpy(zero_copy_only=False)))]
        yield ids


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids_file, docs_file, before in zip(*(batch.column(c).to_pylist() for c in ("ids_file", "docs_file", "before"))):
            with pa.ipc.open_file(_open(ids_file)) as ids_reader, pa.ipc.open_file(_open(docs_file)) as docs_reader:
                runs, have, at = _runs(ids_reader), np.empty(0, np.uint16), 0
                for i in range(docs_reader.num_record_batches):
                    docs = docs_reader.get_batch(i)
                    sums = []
                    for n in docs.column("n_tokens").to_pylist():
                        crc = 0
                        while n:
                            if at == len(have):
                                have, at = next(runs), 0
                            some = have[at : at + n]
                            crc = zlib.crc32(some.astype("<u4").tobytes(), crc)
                            at += len(some)
                            n -= len(some)
                        sums.append(crc)
                    start = pa.array(docs.column("start").to_numpy() + before)
                    columns = [docs.column("doc_id"), start, docs.column("n_tokens"), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
