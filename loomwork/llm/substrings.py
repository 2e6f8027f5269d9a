"""Substring dedup with a log-structured index of window fingerprints.

A window is WINDOW consecutive words. Batches of documents come one after another; a window of a batch is a copy if an
earlier batch holds its words, or a document of the same batch with a smaller doc_id. ``Index.add`` takes the next batch,
``Index.save`` and ``Index.open`` keep an index between runs; ``dedup`` sends one table through an index in batches.

1. Texts are cut into words once and kept in chunks (``Store``): Arrow files in the shared folder, which later passes
   read in place, so no text is ever shuffled.
2. Each chunk sends its distinct window hashes, sorted, delta-coded and compressed, with the smallest doc_id of the
   chunk that has them, to buckets by hash. However many documents of a chunk share a passage, it sends it once.
3. A bucket merges the batch's hashes with the index's runs of the bucket: sorted, immutable segments that hold each
   hash's first document. Chunks get back the hashes that an earlier document has, and which one. The batch's own
   first hashes become a new run; when FANOUT runs of a level exist, they are merged into one of the next level.
4. Each chunk joins its copies to spans that have one source document, removes the words they cover, and asks the
   source's chunk to compare: a digest of the span's words against one of the source's words. Equal requests are asked
   once, and a chunk that is asked much is asked by several tasks, each with a share of the requests. A span that
   differs is asked window by window; a window that differs (a hash collision) is resolved exactly by its words.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm.common import arrow_store, delete, drop, materialise, partitions, scratch

WINDOW = 13
#: Words in a chunk, about; a longer document is a chunk of its own.
CHUNK_WORDS = 1 << 20
#: Hash bits beyond those that number all windows: one window in 2**SPARE_BITS meets another's hash by chance.
SPARE_BITS = 28
#: Runs of a level that are merged into one of the next.
FANOUT = 2
#: Batches of a whole table: enough for runs to be merged once before the last batch comes.
BATCHES = FANOUT + 1
#: Windows of a bucket, about, over the whole index.
BUCKET_WINDOWS = 1 << 21
#: Requests that are worth reading a chunk once more in another task, at least.
REQUESTS = 512
#: First windows of requests whose places in a chunk a task remembers.
FOUND = 1 << 14
#: Stands for a null doc_id in comparisons: after all others, like the largest one. Chunks know which ids are null.
NO_ID = (1 << 63) - 1
#: Bits of the filter that limits the exact pass to the hashes in question.
FILTER_BITS = 1 << 20

_CHUNK_SCHEMA = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int32())),
        ("words", pa.large_list(pa.large_binary())),
        ("known", pa.int64()),
    ]
)


# --- numbers, sorted or small, as compressed bytes


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers >= 0 as byte planes, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    top = int(values.max()) if len(values) else 0
    size = max(1, -(-top.bit_length() // 8))
    planes = values.view(np.uint8).reshape(-1, 8)[:, :size].T
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:], max_output_size=max(1, n * size)), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = planes.reshape(size, n).T
    return out.view(np.uint64).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, np.uint64)
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unsqueeze(data, n), dtype=np.uint64)


def squeeze_ids(values: np.ndarray) -> bytes:
    """Signed numbers, near each other at best."""
    least = int(values.min()) if len(values) else 0
    return least.to_bytes(8, "little", signed=True) + squeeze(values.astype(np.int64).view(np.uint64) - np.uint64(least & (1 << 64) - 1))


def unsqueeze_ids(data: bytes, n: int) -> np.ndarray:
    least = int.from_bytes(data[:8], "little", signed=True)
    return (unsqueeze(data[8:], n) + np.uint64(least & (1 << 64) - 1)).view(np.int64)


# --- chunks


class Chunk:
    """Documents as numbers of distinct words: doc_ids ascending, where each ends, word numbers, the words, and how many
    documents, the first ones, have an id."""

    def __init__(self, doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray, words: list[bytes], known: int) -> None:
        self.doc_ids, self.ends, self.ids, self.words, self.known = doc_ids, ends, ids, words, known
        self.starts = np.r_[0, ends[:-1]].astype(np.int64)

    def hashes(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each window in order: hash, document (place in the chunk), first word."""
        if len(self.ids) < WINDOW:
            none = np.empty(0, np.int64)
            return none.astype(np.uint64), none, none
        own = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
        w = own[self.ids]
        n = len(w) - WINDOW + 1
        prime = np.uint64(0x9E3779B97F4A7C15)
        h = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            h *= prime
            h += w[i : i + n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h >>= np.uint64(64 - bits)
        doc = np.repeat(np.arange(len(self.ends)), self.ends - self.starts)[:n]
        first = np.flatnonzero(np.arange(n) + WINDOW <= self.ends[doc])
        return h[first], doc[first], first

    def distinct(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, ascending, and the smallest document of each; each window's place among them."""
        h, doc, first = self.hashes(bits)
        order = np.argsort(h)
        sorted_h = h[order]
        new = np.r_[True, sorted_h[1:] != sorted_h[:-1]] if len(h) else np.zeros(0, bool)
        place = np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(h) else doc
        return sorted_h[new], least, place, h, doc, first

    def text(self, a: int, b: int) -> bytes:
        words = self.words
        return b" ".join([words[i] for i in self.ids[a:b].tolist()])


def _list(words: pa.Array) -> list[bytes]:
    """Like to_pylist of a binary array, several times faster."""
    return words.to_numpy(zero_copy_only=False).tolist()


def _make_chunk(doc_ids: list[np.ndarray], null: list[np.ndarray], texts: list[pa.Array]) -> Chunk:
    ids, missing = np.concatenate(doc_ids), np.concatenate(null)
    order = np.lexsort((missing, ids))
    words = pc.ascii_split_whitespace(pa.concat_arrays(texts).cast(pa.large_binary()).cast(pa.large_string()).take(pa.array(order)))
    # a text of spaces at its ends has empty words there
    flat, offsets = words.flatten(), words.offsets.to_numpy()
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0)
    if pc.sum(pc.invert(full)).as_py():
        kept = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
        flat, offsets = flat.filter(full), kept[offsets]
    coded = flat.dictionary_encode()
    distinct = _list(coded.dictionary.cast(pa.large_binary()))
    return Chunk(ids[order], offsets[1:].astype(np.int64), coded.indices.to_numpy().astype(np.int32), distinct, int(len(ids) - missing.sum()))


def load(file: str, row: int) -> Chunk:
    store, path = arrow_store(file)
    with store.open_input_file(path) as source, pa.ipc.open_file(source) as reader:
        batch = reader.get_batch(row)
    doc_ids, ends, ids = (batch.column(i)[0].values.to_numpy() for i in range(3))
    return Chunk(doc_ids, ends, ids, _list(batch.column(3)[0].values), batch.column(4)[0].as_py())


def store_chunks(docs: DataFrame, bounds: list[int], folder: str, first: int = 0) -> DataFrame:
    """Cuts the texts of ``docs`` into words, kept in files under ``folder``: (chunk, batch, file, row, n_docs, n_windows),
    one row per chunk. A document's batch is ``first`` and the number of bounds below its doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_store(folder)
        store.create_dir(root, recursive=True)
        part, made = TaskContext.get().partitionId(), 0
        name = f"{part:06d}-{uuid.uuid4().hex}.arrow"
        waiting: dict[int, tuple[list, list, list, list]] = {}
        rows: list[tuple] = []
        with (
            store.open_output_stream(f"{root}/{name}") as sink,
            pa.ipc.new_file(sink, _CHUNK_SCHEMA, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer,
        ):

            def flush(batch_no: int) -> None:
                nonlocal made
                own_ids, own_null, own_texts, _ = waiting.pop(batch_no)
                c = _make_chunk(own_ids, own_null, own_texts)
                values = [pa.array([c.doc_ids]), pa.array([c.ends]), pa.array([c.ids]), pa.array([c.words], _CHUNK_SCHEMA.field(3).type), pa.array([c.known])]
                writer.write_batch(pa.RecordBatch.from_arrays(values, schema=_CHUNK_SCHEMA))
                windows = int(np.maximum(c.ends - c.starts - WINDOW + 1, 0).sum())
                rows.append(((first << 46) | (part << 23) | made, first + batch_no, f"{folder}/{name}", made, len(c.doc_ids), windows))
                made += 1

            for batch in batches:
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(NO_ID).to_numpy()
                texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
                size = pc.binary_length(texts).to_numpy().astype(np.int64)
                number = np.searchsorted(bounds, ids, side="left") if bounds else np.zeros(len(ids), np.int64)
                # about six bytes a word: slices that do not overshoot a chunk by much
                cut = np.flatnonzero(np.diff(np.cumsum(size) // (CHUNK_WORDS * 3))) + 1
                for a, b in zip(np.r_[0, cut].tolist(), np.r_[cut, len(ids)].tolist()):
                    for batch_no in np.unique(number[a:b]).tolist():
                        at = a + np.flatnonzero(number[a:b] == batch_no)
                        own = waiting.setdefault(batch_no, ([], [], [], [0]))
                        own[0].append(ids[at])
                        own[1].append(null[at])
                        own[2].append(texts.take(pa.array(at)))
                        own[3][0] += int(size[at].sum())
                        if own[3][0] >= CHUNK_WORDS * 6:
                            flush(batch_no)
            for batch_no in sorted(waiting):
                flush(batch_no)
        kinds = pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "batch", "file", "row", "n_docs", "n_windows"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "chunk long, batch int, file string, row int, n_docs long, n_windows long")


# --- the index

_HASHES = "bucket int, kind int, chunk long, n long, hashes binary, docs binary, chunks binary, file string"
_RUN_NAMES = [x.split()[0] for x in _HASHES.split(", ")]


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


_RUN_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string()]
#: What a run's file holds of each of its buckets.
_SEGMENT = pa.schema([("hashes", pa.binary()), ("docs", pa.binary()), ("chunks", pa.binary())])


def _send(bits: int, bucket_bits: int):
    """A chunk's distinct hashes by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, file, row in zip(*(batch.column(c).to_pylist() for c in ("chunk", "file", "row"))):
                chunk = load(file, row)
                hashes, doc, *_ = chunk.distinct(bits)
                docs = chunk.doc_ids[doc]
                cuts = np.searchsorted(hashes, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << np.uint64(bits - bucket_bits))
                out = []
                for bucket, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    if b > a:
                        low = hashes[a:b] - np.uint64(bucket << (bits - bucket_bits))
                        out.append((bucket, 1, number, b - a, squeeze_sorted(low), squeeze_ids(docs[a:b]), None, None))
                yield _rows(out, _RUN_NAMES, _RUN_KINDS)

    return run


def _segment(row: dict) -> dict:
    """A run's row with its segment, which lies in a file at the place that ``chunk`` tells."""
    store, path = arrow_store(row["file"])
    with store.open_input_file(path) as source, pa.ipc.open_file(source) as reader:
        batch = reader.get_batch(row["chunk"])
    return row | {name: batch.column(name)[0].as_py() for name in _SEGMENT.names}


def _merge(folder: str | None, answer: bool):
    """Buckets' rows, segments of runs (kind 0) and chunks' hashes (kind 1), to answers (kind 2); with a folder, also to
    the segments of a new run there: of the batch's new hashes or, without answers, of all."""

    def merged(rows: list[dict]) -> tuple[list[tuple], tuple | None]:
        old = [_segment(r) for r in rows if r["kind"] == 0]
        new = [r for r in rows if r["kind"] == 1]
        parts = [*old, *new]
        h = np.concatenate([unsqueeze_sorted(r["hashes"], r["n"]) for r in parts])
        docs = np.concatenate([unsqueeze_ids(r["docs"], r["n"]) for r in parts])
        chunks = np.concatenate([unsqueeze_ids(r["chunks"], r["n"]) if r["kind"] == 0 else np.full(r["n"], r["chunk"]) for r in parts])
        recent = np.repeat([0] * len(old) + [1] * len(new), [r["n"] for r in parts])
        order = np.argsort(h, kind="stable")  # every part is a sorted run: equal to merging them
        sorted_h = h[order]
        new_hash = np.r_[True, sorted_h[1:] != sorted_h[:-1]]
        # among equal hashes, what is in the index comes before the batch, then by doc_id
        tied = np.flatnonzero(~new_hash | np.r_[~new_hash[1:], False])
        some = order[tied]
        order[tied] = some[np.lexsort((chunks[some], docs[some], recent[some], h[some]))]
        head = order[new_hash]
        first = np.empty(len(h), np.int64)
        first[order] = head[np.cumsum(new_hash) - 1]
        out, at = [], sum(r["n"] for r in old)
        bucket = parts[0]["bucket"]
        if answer:
            for r in new:
                mine = slice(at, at + r["n"])
                source = first[mine]
                hit = np.flatnonzero((recent[source] == 0) | (docs[source] < docs[mine]))
                if len(hit):
                    s = source[hit]
                    out.append((bucket, 2, r["chunk"], len(hit), squeeze_sorted(hit), squeeze_ids(docs[s]), squeeze_ids(chunks[s]), None))
                at += r["n"]
        keep = head if not answer else head[recent[head] == 1]
        segment = (squeeze_sorted(h[keep]), squeeze_ids(docs[keep]), squeeze_ids(chunks[keep])) if folder and len(keep) else None
        return out, (bucket, len(keep), segment) if segment else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[list[dict]]:
            waiting: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if waiting and row["bucket"] != waiting[0]["bucket"]:
                        yield waiting
                        waiting = []
                    waiting.append(row)
            if waiting:
                yield waiting

        if not folder:
            for rows in groups():
                yield _rows(merged(rows)[0], _RUN_NAMES, _RUN_KINDS)
            return
        store, root = arrow_store(folder)
        store.create_dir(root, recursive=True)
        name, made = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.arrow", 0
        with store.open_output_stream(f"{root}/{name}") as sink, pa.ipc.new_file(sink, _SEGMENT) as writer:
            for rows in groups():
                out, kept = merged(rows)
                if kept:
                    bucket, n, segment = kept
                    writer.write_batch(pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in segment], schema=_SEGMENT))
                    out.append((bucket, 0, made, n, None, None, None, f"{folder}/{name}"))
                    made += 1
                yield _rows(out, _RUN_NAMES, _RUN_KINDS)

    return run


class Index:
    """Window hashes of earlier batches in runs by level: immutable files of segments, one per bucket, sorted by hash; and
    the chunks of these batches. All of it lies under ``folder``.

    Only rows that tell where segments lie are shuffled; whoever merges a bucket reads its segments in place.
    """

    def __init__(self, spark: SparkSession, folder: str, bits: int, bucket_bits: int, batches: int = 0, levels: list[list[str]] | None = None, chunks: list[str] | None = None) -> None:
        self.spark, self.folder, self.bits, self.bucket_bits = spark, folder, bits, bucket_bits
        self.batches, self.levels, self.chunks = batches, levels or [], chunks or []

    @classmethod
    def create(cls, spark: SparkSession, windows: int | None = None, folder: str | None = None, bits: int | None = None) -> Index:
        """An empty index for about so many windows in all; more of them make buckets and spans that are asked anew more,
        never another result. ``folder`` must be shared, and must outlive the application if the index is to."""
        if bits is None:
            bits = 64 if windows is None else min(64, SPARE_BITS + max(1, int(windows).bit_length()))
        buckets = max(16, 4 * partitions(spark), (windows or 0) // BUCKET_WINDOWS)
        return cls(spark, folder or scratch(spark, "substring-index"), bits, min(bits - 1, math.ceil(math.log2(buckets))))

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Index:
        """The index as it was saved last."""
        last = spark.read.parquet(f"{folder}/states").orderBy(F.desc("batches")).first()
        state = json.loads(last["state"])
        return cls(spark, folder, state["bits"], state["bucket_bits"], last["batches"], state["levels"], state["chunks"])

    def save(self) -> None:
        state = json.dumps({"bits": self.bits, "bucket_bits": self.bucket_bits, "levels": self.levels, "chunks": self.chunks})
        rows = self.spark.createDataFrame([(self.batches, state)], "batches int, state string")
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/states")

    def _write(self, rows: DataFrame, name: str) -> str:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return path

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def places(self) -> DataFrame:
        """Where the chunks of all batches are."""
        return self._read(self.chunks, _PLACES)

    def cut(self, docs: DataFrame, bounds: list[int]) -> DataFrame:
        """Texts as chunks of the next batches, which are numbered by how many bounds are below a doc_id."""
        rows = store_chunks(docs, bounds, f"{self.folder}/chunks-{uuid.uuid4().hex}", self.batches)
        self.chunks.append(self._write(rows, "places"))
        return self._read(self.chunks[-1:], _PLACES)

    def meet(self, chunks: DataFrame, keep: bool = True) -> DataFrame:
        """Answers for the chunks of the next batch (kind 2 rows); with ``keep`` the batch joins the index."""
        n = max(1, min(partitions(self.spark) * 4, chunks.count()))
        rows = chunks.repartition(n, "chunk").mapInArrow(_send(self.bits, self.bucket_bits), _HASHES)
        runs = [path for level in self.levels for path in level]
        if runs:
            rows = rows.union(self._read(runs, _HASHES).where("kind = 0"))
        folder = f"{self.folder}/segments-{uuid.uuid4().hex}" if keep else None
        path = self._write(self._by_bucket(rows).mapInArrow(_merge(folder, True), _HASHES), "run")
        if keep:
            self._append(path, 0)
        self.batches += 1
        return self._read([path], _HASHES).where("kind = 2")

    def add(self, docs: DataFrame, text: bool = False) -> DataFrame:
        """The next batch: (doc_id, n_words, n_removed, kept_sha256) of its documents, which join the index."""
        own = self.cut(docs, [])
        return _removed(self, own, self.meet(own), text)

    def _by_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions(self.spark), "bucket").sortWithinPartitions("bucket", "kind")

    def _append(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FANOUT:
            rows = self._read(self.levels[level], _HASHES).where("kind = 0")
            self.levels[level] = []
            merged = self._by_bucket(rows).mapInArrow(_merge(f"{self.folder}/segments-{uuid.uuid4().hex}", False), _HASHES)
            self._append(self._write(merged, f"run-{level + 1}"), level + 1)


_PLACES = "chunk long, batch int, file string, row int, n_docs long, n_windows long"


# --- removal and verification

_OUT = (
    "kind int, chunk long, doc long, doc_id long, n_words long, n_removed long, kept_sha256 string, start long, n long, "
    "source_chunk long, source_doc long, first_hash long, digest binary"
)
_OUT_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_OUT_KINDS = [pa.int32(), *[pa.int64()] * 5, pa.string(), *[pa.int64()] * 5, pa.binary()]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=32).digest()


def _covered(chunk: Chunk, windows: np.ndarray) -> np.ndarray:
    """Which words the windows that begin at these words cover."""
    step = np.zeros(len(chunk.ids) + 1, np.int64)
    np.add.at(step, windows, 1)
    np.add.at(step, windows + WINDOW, -1)
    return np.cumsum(step)[:-1] > 0


def _document(chunk: Chunk, number: int, d: int, gone: np.ndarray, text: bool) -> tuple:
    a, b = int(chunk.starts[d]), int(chunk.ends[d])
    kept = chunk.ids[a:b][~gone[a:b]].tolist()
    data = b" ".join([chunk.words[i] for i in kept])
    doc_id = int(chunk.doc_ids[d])
    said = data.decode() if text else hashlib.sha256(data).hexdigest()
    return (0, number, d, doc_id if d < chunk.known else None, b - a, b - a - len(kept), said, *[None] * 6)


def _remove(bits: int, bucket_bits: int, text: bool):
    """Rows of a chunk, its place (kind 0) and its answers (kind 2), to documents (kind 0) and spans to verify (kind 1)."""

    def finish(place: dict, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        chunk, number = load(place["file"], place["row"]), place["chunk"]
        hashes, least, where, h, doc, first = chunk.distinct(bits)
        source_doc = chunk.doc_ids[least] if len(hashes) else np.empty(0, np.int64)
        source_chunk = np.full(len(hashes), number)
        outside = np.zeros(len(hashes), bool)
        for r in answers:
            begin = int(np.searchsorted(hashes, np.uint64(r["bucket"] << (bits - bucket_bits))))
            hit = begin + unsqueeze_sorted(r["hashes"], r["n"]).astype(np.int64)
            source_doc[hit] = unsqueeze_ids(r["docs"], r["n"])
            source_chunk[hit] = unsqueeze_ids(r["chunks"], r["n"])
            outside[hit] = True
        copy = np.flatnonzero(outside[where] | (source_doc[where] < chunk.doc_ids[doc])) if len(h) else np.empty(0, np.int64)
        gone = _covered(chunk, first[copy])
        out = [_document(chunk, number, d, gone, text) for d in range(len(chunk.doc_ids))]
        yield _rows(out, _OUT_NAMES, _OUT_KINDS)
        s_doc, s_chunk, at, of = source_doc[where[copy]], source_chunk[where[copy]], first[copy], doc[copy]
        new = np.r_[True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1]) | (s_doc[1:] != s_doc[:-1]) | (s_chunk[1:] != s_chunk[:-1])] if len(at) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        lengths = np.diff(np.r_[heads, len(at)])
        out = []
        for i, n in zip(heads.tolist(), lengths.tolist()):
            a = int(at[i])
            digest = _digest(chunk.text(a, a + n + WINDOW - 1))
            out.append((1, number, int(of[i]), None, None, None, None, a, n, int(s_chunk[i]), int(s_doc[i]), int(h[copy[i]].view(np.int64)), digest))
            if len(out) == 10_000:
                yield _rows(out, _OUT_NAMES, _OUT_KINDS)
                out = []
        yield _rows(out, _OUT_NAMES, _OUT_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, answers = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if place is not None:
                        yield from finish(place, answers)
                    place, answers = row, []
                else:
                    answers.append(row)
        if place is not None:
            yield from finish(place, answers)

    return run


def _verify(bits: int):
    """Rows of a chunk, its place (kind 0) and what is asked of it (kind 1), to the requests whose words differ."""
    names = ["source_chunk", "source_doc", "first_hash", "n", "digest"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chunk = None, None
        for batch in batches:
            bad = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    place, chunk = row, None
                    continue
                if chunk is None:
                    chunk, found = load(place["file"], place["row"]), {}
                    h, doc, first = chunk.hashes(bits)
                    order = np.argsort(h)
                    known = h[order]
                key = row["first_hash"], row["source_doc"]
                if key not in found:
                    # where the source's documents hold the window, and where these end; many requests begin with one window
                    if len(found) >= FOUND:
                        found.clear()
                    own = np.int64(key[0]).view(np.uint64)
                    some = order[np.searchsorted(known, own, side="left") : np.searchsorted(known, own, side="right")]
                    some = np.sort(some[chunk.doc_ids[doc[some]] == key[1]])
                    found[key] = list(zip(first[some].tolist(), chunk.ends[doc[some]].tolist()))
                size = row["n"] + WINDOW - 1
                for at, end in found[key]:
                    if at + size <= end and _digest(chunk.text(at, at + size)) == row["digest"]:
                        break
                else:
                    bad.append(tuple(row[c] for c in names))
            yield _rows(bad, names, kinds)

    return run


_SPAN = "chunk long, doc long, start long, n long, source_chunk long, source_doc long, first_hash long, digest binary"
_SPAN_NAMES = [x.split()[0] for x in _SPAN.split(", ")]


def _singles(bits: int, once: bool):
    """Rows of a chunk, its place (kind 0) and spans (kind 1), to the spans' windows as spans of their own; with ``once``
    only one window of those in a chunk that have the same words and ask the same source."""
    kinds = [*[pa.int64()] * 7, pa.binary()]

    def finish(place: dict, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        chunk = load(place["file"], place["row"])
        h, doc, first = chunk.hashes(bits)
        starts, lengths, source_chunk, source_doc = (np.array(x, np.int64) for x in zip(*rows))
        run = np.repeat(np.arange(len(rows)), lengths)
        at = np.searchsorted(first, starts)[run] + np.arange(len(run)) - (np.cumsum(lengths) - lengths)[run]
        source_chunk, source_doc = source_chunk[run], source_doc[run]
        if once:
            order = np.lexsort((at, source_doc, source_chunk, h[at]))
            keys = [x[order] for x in (h[at], source_chunk, source_doc)]
            new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]
            begin = first[at[order]]
            as_first = begin[new][np.cumsum(new) - 1]
            # windows may share a hash and not their words
            for i in range(WINDOW):
                new |= chunk.ids[begin + i] != chunk.ids[as_first + i]
            kept = np.sort(order[new])
            at, source_chunk, source_doc = at[kept], source_chunk[kept], source_doc[kept]
        for a in range(0, len(at), 50_000):
            out = []
            for i, c, d in zip(at[a : a + 50_000].tolist(), source_chunk[a : a + 50_000].tolist(), source_doc[a : a + 50_000].tolist()):
                begin = int(first[i])
                out.append((place["chunk"], int(doc[i]), begin, 1, c, d, int(h[i].view(np.int64)), _digest(chunk.text(begin, begin + WINDOW))))
            yield _rows(out, _SPAN_NAMES, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if rows:
                        yield from finish(place, rows)
                    place, rows = row, []
                else:
                    rows.append((row["start"], row["n"], row["source_chunk"], row["source_doc"]))
        if rows:
            yield from finish(place, rows)

    return run


def _by_chunk(places: DataFrame, rows: DataFrame, chunk: str, n: int) -> DataFrame:
    """Rows of a chunk behind the row that says where it lies."""
    there = places.select(F.col("chunk").alias(chunk), "file", "row", F.lit(0).alias("kind"))
    both = there.unionByName(rows, allowMissingColumns=True)
    return both.repartition(n, chunk).sortWithinPartitions(chunk, "kind")


def _windows(bits: int, wanted: np.ndarray | None, spans: bool):
    """Windows with their words: those of the spans on the row (``spans``), or all whose hash passes the filter."""
    names = ["words", "first_hash", "doc_id", "batch", "chunk", "doc", "start"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chunk = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != last:
                    last, chunk = row["chunk"], load(row["file"], row["row"])
                    h, doc, first = chunk.hashes(bits)
                if spans:
                    at = np.searchsorted(first, row["start"]) + np.arange(row["n"])
                else:
                    at = np.flatnonzero(np.unpackbits(wanted, bitorder="little")[(h % np.uint64(FILTER_BITS)).astype(np.int64)])
                for some in np.array_split(at, max(1, len(at) // 50_000)):
                    out = [
                        (chunk.text(int(first[i]), int(first[i]) + WINDOW), int(h[i].view(np.int64)), int(chunk.doc_ids[doc[i]]), row["batch"], last, int(doc[i]), int(first[i]))
                        for i in some.tolist()
                    ]
                    yield _rows(out, names, kinds)

    return run


_WINDOW_ROWS = "words binary, first_hash long, doc_id long, batch int, chunk long, doc long, start long"


def _redo(text: bool):
    """Chunk places and windows that are copies (kind 1), sorted, to the documents in question (kind 0 rows of _OUT)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, starts, docs = None, [], set()

        def finish() -> pa.RecordBatch:
            out = []
            if docs:
                chunk = load(place["file"], place["row"])
                gone = _covered(chunk, np.array(starts, np.int64))
                out = [_document(chunk, place["chunk"], d, gone, text) for d in sorted(docs)]
            return _rows(out, _OUT_NAMES, _OUT_KINDS)

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if place is not None:
                        yield finish()
                    place, starts, docs = row, [], set()
                else:
                    docs.add(row["doc"])
                    if row["start"] is not None:
                        starts.extend(range(row["start"], row["start"] + row["n"]))
        if place is not None:
            yield finish()

    return run


def _exactly(places: DataFrame, bits: int, spans: DataFrame, bad: DataFrame, text: bool, n: int) -> DataFrame:
    """The documents with spans that differ from their source, anew: what was verified, and the rest by its words."""
    key = ["source_chunk", "source_doc", "first_hash", "n", "digest"]
    marked = spans.join(bad.withColumn("differs", F.lit(True)), key, "left")
    marked = materialise(marked, "substring-marked")
    docs = materialise(marked.where("differs").select("chunk", "doc").distinct(), "substring-redo")
    asked = marked.where("differs").select("chunk", "start", "n").join(places, "chunk")
    asked = asked.repartition(n, "chunk").sortWithinPartitions("chunk").mapInArrow(_windows(bits, None, True), _WINDOW_ROWS)
    asked = materialise(asked, "substring-asked")
    filled = asked.select(F.pmod(F.col("first_hash"), F.lit(FILTER_BITS)).alias("bit")).distinct().collect()  # FILTER_BITS rows at most
    bitmap = np.zeros(FILTER_BITS, np.uint8)
    bitmap[[r["bit"] for r in filled]] = 1
    wanted = np.packbits(bitmap, bitorder="little")
    every = places.repartition(n, "chunk").mapInArrow(_windows(bits, wanted, False), _WINDOW_ROWS)
    least = every.groupBy("words").agg(F.min(F.struct("batch", "doc_id")).alias("least"))
    least = materialise(least.select(F.col("words").alias("w"), "least"), "substring-least")
    copies = asked.join(least, F.col("words") == F.col("w")).where(F.col("least") < F.struct("batch", "doc_id"))
    copies = copies.select("chunk", "doc", "start", F.lit(1).cast("long").alias("n"))
    sure = marked.where("differs is null").join(docs, ["chunk", "doc"]).select("chunk", "doc", "start", "n")
    named = docs.select("chunk", "doc", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("n"))
    rows = copies.union(sure).union(named).withColumn("kind", F.lit(1))
    return _by_chunk(places, rows, "chunk", n).mapInArrow(_redo(text), _OUT)


def _differing(places: DataFrame, spans: DataFrame, bits: int, n: int) -> DataFrame:
    """What spans ask of their sources and the sources deny; equal requests are asked once.

    A chunk is read once, but for one that holds what very many chunks copy: each task answers a task's even part of all
    requests or, where that is less, REQUESTS.
    """
    asked = materialise(spans.select("source_chunk", "source_doc", "first_hash", "n", "digest").distinct(), "substring-requests")
    share_of = max(REQUESTS, -(-asked.count() // n))
    shares = asked.groupBy("source_chunk").agg(F.ceil(F.count("*") / share_of).alias("shares"))
    shares = materialise(shares, "substring-shares")
    share = F.pmod(F.xxhash64("source_doc", "first_hash", "n", "digest"), F.col("shares")).alias("share")
    rows = asked.join(shares, "source_chunk").select(*asked.columns, share, F.lit(1).alias("kind"))
    there = places.join(shares, F.col("chunk") == F.col("source_chunk"))
    there = there.select("source_chunk", "file", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"))
    both = there.unionByName(rows, allowMissingColumns=True).repartition(n, "source_chunk", "share")
    both = both.sortWithinPartitions("source_chunk", "share", "kind")
    bad = materialise(both.mapInArrow(_verify(bits), "source_chunk long, source_doc long, first_hash long, n long, digest binary"), "substring-differing")
    drop(asked, shares)
    return bad


def _removed(index: Index, own: DataFrame, answers: DataFrame, text: bool) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of the documents in the chunks ``own``."""
    spark, bits = index.spark, index.bits
    n = max(1, min(partitions(spark) * 4, own.count()))
    places = index.places().select("chunk", "batch", "file", "row")
    rows = _by_chunk(own, answers, "chunk", n).mapInArrow(_remove(bits, index.bucket_bits, text), _OUT)
    rows = materialise(rows, "substring-removed")
    spans = rows.where("kind = 1").select(*_SPAN_NAMES)
    done = rows.where("kind = 0")
    bad = _differing(places, spans, bits, n)
    if not bad.isEmpty():
        # a span may run on where its source does not: its windows are verified one by one
        key = bad.columns
        apart = spans.join(bad, key, "left_semi").withColumn("kind", F.lit(1))
        whole, apart = spans.join(bad, key, "left_anti"), _by_chunk(own, apart, "chunk", n)
        bad = _differing(places, apart.mapInArrow(_singles(bits, True), _SPAN), bits, n)
        if not bad.isEmpty():
            spans = whole.unionByName(materialise(apart.mapInArrow(_singles(bits, False), _SPAN), "substring-singles"))
    if not bad.isEmpty():
        again = materialise(_exactly(places, bits, spans, bad, text, n), "substring-exact")
        done = done.join(again.select("chunk", "doc"), ["chunk", "doc"], "left_anti").unionByName(again)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def dedup(docs: DataFrame, batches: int = BATCHES, bits: int | None = None, text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs`` (doc_id, text).

    The documents go through an index in ``batches`` of ascending doc_id, so that a copy is what a smaller doc_id holds.
    With ``text``, kept_sha256 holds the kept words themselves. Null and empty texts have no words. A null doc_id counts
    as the largest one. Rows that repeat a doc_id are not copies of each other. ``bits``: of the hashes; fewer mean more
    collisions, never another result. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    shares = [i / batches for i in range(1, batches)]
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or [])) if shares else []
    folder = scratch(spark, "substring-index")
    cut = Index(spark, folder, 64, 0)
    chunks = cut.cut(docs, bounds)
    windows = chunks.agg(F.coalesce(F.sum("n_windows"), F.lit(0))).first()[0]
    index = Index.create(spark, int(windows), folder, bits)
    index.chunks = cut.chunks
    answers = None
    for number in range(len(bounds) + 1):
        own = index.meet(chunks.where(F.col("batch") == number), keep=number < len(bounds))
        answers = own if answers is None else answers.union(own)
    done = _removed(index, chunks, answers, text)
    delete(spark, folder)
    return done


OP4_SQL = r"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS body FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM cut)),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) < doc_id AS copy FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM firsts WHERE copy),
words AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM cut)),
kept AS (
  SELECT x.doc_id, count(*) AS n_words, count(g.i) AS n_removed, string_agg(CASE WHEN g.i IS NULL THEN x.word END, ' ' ORDER BY x.i) AS body
  FROM words x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id)
SELECT c.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k ON c.doc_id = k.doc_id
"""
