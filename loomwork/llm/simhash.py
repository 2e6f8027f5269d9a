"""SimHash near-duplicates, found through deletion-variant signatures of two 32-bit segments.

Fingerprints that differ in two bits at most have a segment that differs in one bit at most. Each distinct
fingerprint is indexed under the 64 variants that leave out one bit of one segment; fingerprints that share a variant
are compared, and those within two bits are linked. Only a spanning forest of the links leaves a task.

Groups that share a variant are compared in memory up to ``MAX_GROUP`` fingerprints. Larger ones take an exact way
without comparisons: their members are indexed under all variants that leave out two of the 64 bits; whoever shares
one is linked, and neighbours within a variant suffice to connect it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import Forest, _edge_batch, connected_components, drop, materialise, reserved

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Distinct fingerprints under one variant that a task compares in memory.
MAX_GROUP = 4096
#: Shingle hashes turned into bits at once.
CHUNK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes: each bit that over half of them have; 0 of none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles of a text with A-Z lower-cased; 0 without words."""
    if not text:
        return 0
    data = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return 0
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(data)]
    digest = xxhash.xxh64_intdigest
    if len(starts) < words:
        return digest(data, 42)
    total = len(starts) - words + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        to = min(at + CHUNK, total)
        hashes = [digest(data[a:b], 42) for a, b in zip(starts[at:to], ends[at + words - 1 : to + words - 1])]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return run


def _one_wildcard(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each fingerprint under its 64 keys: segment, bit left out, and what the rest of the segment holds."""
    fps = batch.column(0).to_numpy().view(np.uint64)
    bit = np.arange(64, dtype=np.uint64)
    low, high = fps & np.uint64(0xFFFFFFFF), fps >> np.uint64(32)
    mask = ~(np.uint64(1) << (bit & np.uint64(31)))
    part = np.where(bit[None, :] < 32, low[:, None], high[:, None])
    keys = (part & mask[None, :]) | (bit[None, :] << np.uint64(32))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, 64).view(np.int64))], names=["key", "fp"]
    )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield _one_wildcard(batch.slice(at, 1024))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: links as (u, v); a fingerprint of a group too large to compare as (u, null)."""
    forest, heavy = Forest(), set()
    key_left, fp_left, in_heavy = np.empty(0, np.int64), np.empty(0, np.int64), None

    def work(keys: np.ndarray, fps: np.ndarray) -> None:
        apart = 1
        alive = np.flatnonzero(keys[1:] == keys[:-1])
        while len(alive):
            near = np.bitwise_count(fps[alive] ^ fps[alive + apart]) <= MAX_BITS
            for a, b in zip(fps[alive[near]].tolist(), fps[alive[near] + apart].tolist()):
                forest.join(a, b)
            apart += 1
            alive = alive[alive + apart < len(keys)]
            alive = alive[keys[alive] == keys[alive + apart]]

    def out() -> pa.RecordBatch:
        u, v = forest.edges()
        many = np.array(sorted(heavy), np.int64)
        us = pa.array(np.concatenate([u, many]), pa.int64())
        vs = pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(len(many), pa.int64())])
        return pa.RecordBatch.from_arrays([us, vs], names=["u", "v"])

    for batch in batches:
        keys = np.concatenate([key_left, batch.column(0).to_numpy()])
        fps = np.concatenate([fp_left, batch.column(1).to_numpy()])
        if not len(keys):
            continue
        if in_heavy is not None:  # the group is already known to be too large
            end = int(np.searchsorted(keys != in_heavy, True)) if keys[-1] != in_heavy else len(keys)
            heavy.update(fps[:end].tolist())
            keys, fps = keys[end:], fps[end:]
            if not len(keys):
                key_left, fp_left = keys, fps
                if len(heavy) > 200_000:
                    yield out()
                    forest, heavy = Forest(), set()
                continue
            in_heavy = None
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        bounds = np.flatnonzero(np.r_[True, keys[1:last] != keys[: last - 1]]) if last else np.empty(0, np.int64)
        sizes = np.diff(np.r_[bounds, last])
        if len(sizes) and sizes.max() > MAX_GROUP:
            big = np.repeat(sizes > MAX_GROUP, sizes)
            heavy.update(fps[:last][big].tolist())
            work(keys[:last][~big], fps[:last][~big])
        elif last:
            work(keys[:last], fps[:last])
        key_left, fp_left = keys[last:], fps[last:]
        if len(key_left) > MAX_GROUP:
            in_heavy = int(key_left[0])
            heavy.update(fp_left.tolist())
            key_left, fp_left = key_left[:0], fp_left[:0]
        if len(forest.parent) + len(heavy) > 500_000:
            yield out()
            forest, heavy = Forest(), set()
    work(key_left, fp_left)
    yield out()


def _two_wildcards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, second = np.triu_indices(64, 1)
    masks = ~((np.uint64(1) << first.astype(np.uint64)) | (np.uint64(1) << second.astype(np.uint64)))
    which = np.arange(len(masks), dtype=np.int32)
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            fps = batch.column(0).slice(at, 64).to_numpy().view(np.uint64)
            keys = (fps[:, None] & masks[None, :]).ravel().view(np.int64)
            arrays = [pa.array(np.tile(which, len(fps))), pa.array(keys), pa.array(np.repeat(fps, len(masks)).view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["pair", "key", "fp"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, last = Forest(), None
    for batch in batches:
        pair, key, fp = (batch.column(i).to_numpy() for i in range(3))
        if last is not None:
            pair, key, fp = np.r_[last[0], pair], np.r_[last[1], key], np.r_[last[2], fp]
        same = np.flatnonzero((pair[1:] == pair[:-1]) & (key[1:] == key[:-1]))
        for a, b in zip(fp[same].tolist(), fp[same + 1].tolist()):
            forest.join(a, b)
        last = pair[-1:], key[-1:], fp[-1:]
        if len(forest.parent) > 500_000:
            yield _edge_batch(*forest.edges())
            forest = Forest()
    yield _edge_batch(*forest.edges())


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints of column ``fp`` within two bits of each other."""
    index = fps.mapInArrow(_variants, "key long, fp long")
    found = index.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_compare, "u long, v long")
    found = materialise(found, "simhash-links")
    heavy = found.where("v is null").select(F.col("u").alias("fp")).distinct()
    more = heavy.mapInArrow(_two_wildcards, "pair int, key long, fp long").repartition("pair", "key")
    more = more.sortWithinPartitions("pair", "key", "fp").mapInArrow(_neighbours, "u long, v long")
    return found.where("v is not null").union(more)


def simhash_components(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long, component_id, group) for every row of ``docs`` (doc_id, text; other columns are not read).

    ``group`` tells components apart: rows that share a doc_id may lie in several.

    Null and empty texts, and texts of spaces only, have fingerprint 0 and are linked like any other. Texts shorter
    than a shingle are one shingle. Repeated rows give repeated rows. A null doc_id is never a component's id unless
    all of the component's ids are null. An empty table gives an empty table.
    """
    prints = docs.select("doc_id", "text").mapInArrow(_fingerprints(words), "doc_id long, fp long")
    prints = materialise(prints, "simhash")
    first = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = materialise(connected_components(links(first.select("fp"))), "simhash-links")
    rooted = first.join(roots, first["fp"] == roots["id"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialise(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    classes = rooted.join(materialise(least, "simhash-least"), F.col("root") == F.col("r"))
    classes = materialise(classes.select(F.col("fp").alias("class_fp"), "component_id", F.col("root").alias("group")), "simhash-classes")
    drop(first, roots, rooted)
    return prints.join(classes, prints["fp"] == classes["class_fp"]).select("doc_id", "fp", "component_id", "group")


def hex_fingerprint(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each near-duplicate group, that with the smallest doc_id; all columns are kept, whatever their names.

    Rows that repeat a doc_id are documents of their own, told apart by their fingerprints: one that is in another group
    than its namesakes stays. Of a group whose smallest doc_id is repeated, one of its rows stays. Rows without a doc_id
    stay. Null and empty texts are a group. Names that begin with ``__lw_`` are refused. An empty table gives an empty table.
    """
    from pyspark.sql import Window
    from pyspark.sql import types as T

    reserved(docs)
    at = docs.columns.index("text")
    prints = _fingerprints(words)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], names=["doc_id", "text"])
            fps = pa.concat_arrays([b.column(1) for b in prints(iter([own]))]) if batch.num_rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], names=[*batch.schema.names, "__lw_fp"])

    classes = simhash_components(docs, words)
    # one fingerprint for each group and its least doc_id: the least that a row of this id has
    chosen = classes.where("doc_id = component_id").groupBy("group").agg(F.min("doc_id").alias("__lw_chosen"), F.min("fp").alias("__lw_least")).drop("group")
    rows = docs.mapInArrow(marked, T.StructType([*docs.schema.fields, T.StructField("__lw_fp", T.LongType())]))
    kept = rows.join(chosen, (rows["doc_id"] == chosen["__lw_chosen"]) & (rows["__lw_fp"] == chosen["__lw_least"])).drop("__lw_chosen", "__lw_least")
    w = Window.partitionBy("doc_id", "__lw_fp").orderBy("text")
    kept = kept.withColumn("__lw_nth", F.row_number().over(w)).where("__lw_nth = 1").drop("__lw_nth", "__lw_fp")
    return kept.union(docs.where("doc_id is null"))
