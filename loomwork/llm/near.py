"""Near-duplicates by SimHash, each confirmed by the Jaccard likeness of the sets of word shingles; an exact way for the rest.

A text's fingerprint is the SimHash of its set of shingles. Texts whose fingerprints are equal or differ in two bits at
most are found through deletion-variant signatures (``simhash.links``) and compared set by set; those that reach 0.8 are
linked. Fingerprints of texts that are alike to 0.8 only may differ in more bits, so prefix filtering finds the rest, and
no link is lost.

Two texts of a and b shingles reach 0.8 only if the first ``a // 5 + 1`` and ``b // 5 + 1`` of their shingles have one
in common, in whatever order all texts share. The order is rarest first, by counts in a table of fixed size, so what
many texts quote comes last and is seldom looked at. Lengths and places rule out most of what shares a shingle; the
rest is compared set by set.

Groups of near copies are large and would be compared in all pairs. So what SimHash links is a component already, and each
shingle's texts are first compared with one of them and with their neighbours by length; only texts of different components
are then compared in full, so that the links, all in all, are exactly those of 0.8 or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm import simhash
from loomwork.llm.common import compact, connected_components, drop, materialise, reserved

SHINGLE_WORDS = 5
#: The likeness asked for is LIKE / OF.
LIKE, OF = 4, 5
#: Counters of shingles that order them; more texts only make the order less sharp.
COUNTERS, CHUNKS = 1 << 18, 16
#: Texts of a task that are remembered, so that copies are indexed once.
REMEMBERED = 1_000_000
#: Pairs of a task that wait for being passed on.
WAITING = 500_000
#: A text's set counts as so many rows of a small table.
SET_ROWS = 50


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, A-Z lower-cased; a text of fewer words is one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.int64)
    data, ends = b" ".join(parts), np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts]).tolist()
    digest = xxhash.xxh64_intdigest
    last = (ends - 1).tolist()[min(words, len(parts)) - 1 :]
    return np.unique(np.array([digest(data[a:b], 42) for a, b in zip(starts, last)], np.uint64).view(np.int64))


def signature(found: np.ndarray) -> int:
    """Equal sets have equal signatures; 0 is the empty set."""
    return int(np.array([xxhash.xxh64_intdigest(found.tobytes(), 42)], np.uint64).view(np.int64)[0]) if len(found) else 0


def _counted(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            found = [shingles(t.as_py(), words) for t in batch.column(0)]
            if found:
                counts += np.bincount(np.concatenate(found) & (COUNTERS - 1), minlength=COUNTERS)
        parts = [c.tobytes() for c in np.split(counts, CHUNKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "counts"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("counts"))
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def counts_of(docs: DataFrame, words: int) -> np.ndarray:
    """How often shingles fall to each counter; the driver gets the counters, whose number is fixed."""
    rows = docs.select("text").mapInArrow(_counted(words), "chunk int, counts binary")
    rows = rows.groupBy("chunk").applyInArrow(_added, "chunk int, counts binary").collect()
    out = np.zeros(COUNTERS, np.int64)
    for r in rows:
        width = COUNTERS // CHUNKS
        out[r["chunk"] * width : (r["chunk"] + 1) * width] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def _postings(words: int, counts):
    """Rows (key, sig, n, pos): the shingles that a text is found by, and their places in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = counts.value, set()
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            size = 0
            for t in batch.column(0):
                found = shingles(t.as_py(), words)
                sig = signature(found)
                if not len(found) or sig in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(sig)
                k = len(found) // OF + 1
                first = found[np.lexsort((found, often[found & (COUNTERS - 1)]))[:k]]
                out.append((first, np.full(k, sig, np.int64), np.full(k, len(found), np.int32), np.arange(k, dtype=np.int32)))
                size += k
                if size > 100_000:
                    yield _rows(out)
                    out, size = [], 0
            if out:
                yield _rows(out)

    return run


def _rows(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["key", "sig", "n", "pos"])


def _possible(n: np.ndarray, pos: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b of one key can belong to texts that are alike: by lengths, and by what is left around the key."""
    na, nb, pa_, pb = (x.astype(np.int64) for x in (n[a], n[b], pos[a], pos[b]))
    most = np.minimum(pa_, pb) + 1 + np.minimum(na - pa_, nb - pb) - 1
    return (OF + LIKE) * most >= LIKE * (na + nb)


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut so that no key spans two pieces."""
    left: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
        keys = now[0]
        if left and left[-1][0][-1] == keys[0] == keys[-1]:
            left.append(now)
            continue
        left.append(now)
        whole = [np.concatenate(c) for c in zip(*left)]
        cut = int(np.searchsorted(whole[0], whole[0][-1]))
        if cut:
            yield [c[:cut] for c in whole]
        left = [[c[cut:] for c in whole]]
    if left:
        yield [np.concatenate(c) for c in zip(*left)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by key: those of keys with several texts, each with two texts to compare it with first."""
    for key, sig, n, pos in _whole_keys(batches):
        order = np.lexsort((sig, n, key))
        key, sig, n, pos = key[order], sig[order], n[order], pos[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])]  # copies from other tasks
        key, sig, n, pos = key[new], sig[new], n[new], pos[new]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[start, len(key)])
        many = np.repeat(sizes > 1, sizes)
        if not many.any():
            continue
        key, sig, n, pos, sizes = key[many], sig[many], n[many], pos[many], sizes[sizes > 1]
        start = np.cumsum(sizes) - sizes
        # a key's own pick, so that a text meets different ones under its keys
        mixed = (sig ^ key) * np.int64(-7046029254386353131)
        group = np.repeat(np.arange(len(sizes)), sizes)
        pick = np.lexsort((mixed, group))[start][group]
        here = np.arange(len(key))
        before = np.maximum(here - 1, start[group])
        arrays = [pa.array(key), pa.array(sig), pa.array(n), pa.array(pos)]
        for other in (pick, before):
            arrays.append(pa.array(sig[other], mask=~((other != here) & _possible(n, pos, here, other))))
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "sig", "n", "pos", "pick", "before"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: pairs of texts of different components that may be alike, and how many keys they share."""
    waiting: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        rows, shared = np.unique(np.concatenate(waiting), axis=0, return_counts=True) if waiting else (np.empty((0, 4), np.int64), np.empty(0, np.int64))
        waiting.clear()
        return pa.RecordBatch.from_arrays([*map(pa.array, rows.T), pa.array(shared)], names=["a", "b", "na", "nb", "shared"])

    for key, sig, n, pos, comp in _whole_keys(batches):
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[start, len(key)])
        mixed = np.repeat(np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start), sizes)
        key, sig, n, pos, comp = key[mixed], sig[mixed], n[mixed], pos[mixed], comp[mixed]
        order = np.lexsort((n, key))
        key, sig, n, pos, comp = key[order], sig[order], n[order], pos[order], comp[order]
        alive, apart = np.arange(len(key)), 1
        while len(alive):
            alive = alive[alive + apart < len(key)]
            other = alive + apart
            # by length: whoever is too long for a text, so is all that follows
            alive = alive[(key[alive] == key[other]) & (OF * n[alive].astype(np.int64) >= LIKE * n[other].astype(np.int64))]
            other = alive + apart
            good = (comp[alive] != comp[other]) & _possible(n, pos, alive, other)
            if good.any():
                u, v = alive[good], other[good]
                u, v = np.where(sig[u] < sig[v], u, v), np.where(sig[u] < sig[v], v, u)
                waiting.append(np.stack([sig[u], sig[v], n[u].astype(np.int64), n[v].astype(np.int64)], axis=1))
            apart += 1
            if sum(map(len, waiting)) > WAITING:
                yield out()
    yield out()


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingles(t.as_py(), words) for t in batch.column(0).slice(at, 256)]
                sigs = pa.array([signature(x) for x in found], pa.int64())
                sets = pa.array(found, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([sigs, sets], names=["sig", "shingles"])

    return run


def _alike(docs: DataFrame, first: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Edges (u, v): the pairs whose sets reach the likeness."""
    pairs = materialise(pairs.distinct(), "near-pairs")
    n = pairs.count()
    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    wanted = first.join(wanted, F.col("sig") == F.col("w")).select("w", F.col("first_id").alias("w_id"))
    wanted = materialise(compact(wanted, 2 * n), "near-wanted")
    ids = wanted.select("w_id").distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(words), "sig long, shingles array<long>").join(wanted.select("w"), F.col("sig") == F.col("w"), "left_semi")
    sets = materialise(compact(sets.dropDuplicates(["sig"]), 2 * n * SET_ROWS), "near-sets")
    left = sets.select(F.col("sig").alias("a_sig"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("sig").alias("b_sig"), F.col("shingles").alias("b_set"))
    both = pairs.join(left, F.col("a") == F.col("a_sig")).join(right, F.col("b") == F.col("b_sig"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    alike = (OF + LIKE) * common >= LIKE * (F.size("a_set") + F.size("b_set"))
    links = materialise(compact(both.where(alike).select(F.col("a").alias("u"), F.col("b").alias("v")), n * SET_ROWS), "near-links")
    drop(pairs, wanted, sets)
    return links


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, fps = [], []
            for t in batch.column(1):
                found = shingles(t.as_py(), words)
                sigs.append(signature(found))
                fps.append(simhash.majority(found))
            fps = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.int64()), batch.column(2), fps], names=["doc_id", "sig", "key", "fp"])

    return run


def simhash_pairs(first: DataFrame) -> DataFrame:
    """(a, b) of ``first`` (sig, fp): pairs to compare that connect all sets whose fingerprints are equal or within ``simhash.MAX_BITS``.

    One set stands for those of its fingerprint. The empty set has none.
    """
    some = first.where("sig <> 0").select("sig", "fp")
    leaders = materialise(some.groupBy("fp").agg(F.min("sig").alias("leader")), "near-fingerprints")
    one, other = (leaders.select(F.col("fp").alias(f"fp_{x}"), F.col("leader").alias(x)) for x in ("a", "b"))
    same = some.join(one, F.col("fp") == F.col("fp_a")).where("sig <> a").select("a", F.col("sig").alias("b"))
    links = simhash.links(leaders.select("fp"))
    across = links.join(one, F.col("u") == F.col("fp_a")).join(other, F.col("v") == F.col("fp_b")).select("a", "b")
    return same.union(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def components(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, component_id, key, group) for every row of ``docs`` (doc_id, text; other columns are not read).

    ``key`` is a hash of the text, which tells rows of one doc_id apart, ``group`` tells components apart. Null and empty texts, and texts of white space,
    are alike. A null doc_id is never a component's id unless all of its ids are null. Repeated rows give repeated
    rows, an empty table an empty one.
    """
    spark = docs.sparkSession
    prints = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).mapInArrow(_prints(words), "doc_id long, sig long, key long, fp long")
    prints = materialise(prints, "near-prints")
    first = materialise(prints.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.min("fp").alias("fp")), "near-distinct")
    counts = spark.sparkContext.broadcast(counts_of(docs, words))
    index = docs.select("text").mapInArrow(_postings(words, counts), "key long, sig long, n int, pos int")
    index = index.repartition("key").sortWithinPartitions("key")
    shared = "key long, sig long, n int, pos int, pick long, before long"
    shared = materialise(index.mapInArrow(_shared, shared), "near-shared")
    # texts that share a good part of their keys; the others wait for the second step, where shared keys are counted
    pairs = shared.where("pick is not null or before is not null").groupBy("sig")
    pairs = pairs.agg(F.count("*").alias("keys"), F.first("n").alias("n"), F.min("pick").alias("pick"), F.mode("before").alias("before"))
    pairs = pairs.where("20 * keys >= n").select("sig", F.explode(F.array("pick", "before")).alias("other")).where("other is not null")
    pairs = pairs.select(F.least("sig", "other").alias("a"), F.greatest("sig", "other").alias("b"))
    links = _alike(docs, first, simhash_pairs(first).union(pairs), words)
    roots = materialise(connected_components(links), "near-components")
    known = shared.select("key", "sig", "n", "pos").join(roots, F.col("sig") == F.col("id"), "left")
    known = known.select("key", "sig", "n", "pos", F.coalesce("root", "sig").alias("comp"))
    known = known.repartition("key").sortWithinPartitions("key")
    found = known.mapInArrow(_across, "a long, b long, na long, nb long, shared long").groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    # what two texts have in common is among the keys of both, or beyond the keys of the one whose keys end first
    most = F.col("shared") + F.greatest(*[F.col(c) - F.floor(F.col(c) / OF) - 1 for c in ("na", "nb")])
    found = found.where((OF + LIKE) * most >= LIKE * (F.col("na") + F.col("nb")))
    more = _alike(docs, first, found.select("a", "b"), words)
    if more.limit(1).count():
        star = roots.select(F.col("id").alias("u"), F.col("root").alias("v")).where("u <> v")
        roots = materialise(connected_components(star.union(more)), "near-components")
    rooted = materialise(
        first.join(roots, F.col("sig") == F.col("id"), "left").select("sig", "first_id", F.coalesce("root", "sig").alias("root")), "near-roots"
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    classes = rooted.join(materialise(least, "near-least"), F.col("root") == F.col("r"))
    classes = materialise(classes.select(F.col("sig").alias("class_sig"), "component_id", F.col("root").alias("group")), "near-classes")
    drop(first, shared, links, more, roots, rooted)
    return prints.join(classes, prints["sig"] == classes["class_sig"]).select("doc_id", "component_id", "key", "group")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each group of alike texts, that with the smallest doc_id; all columns are kept, whatever their names.

    Rows that repeat a doc_id are documents of their own, told apart by their texts: one that is unlike all others
    stays. Of a group whose smallest doc_id is repeated, one of its rows stays. Rows without a doc_id stay. Null and
    empty texts are a group. Names that begin with ``__lw_`` are refused. An empty table gives an empty table.
    """
    reserved(docs)
    # one row for each group: the least doc_id and, where rows share it, the least key; aggregated before the shuffle
    chosen = components(docs, words).where("doc_id = component_id").groupBy("group").agg(F.min("doc_id").alias("__lw_chosen"), F.min("key").alias("__lw_least"))
    chosen = chosen.drop("group")
    kept = docs.withColumn("__lw_key", F.xxhash64("text"))
    kept = kept.join(chosen, (kept["doc_id"] == chosen["__lw_chosen"]) & (kept["__lw_key"] == chosen["__lw_least"])).drop("__lw_chosen", "__lw_least")
    w = Window.partitionBy("doc_id", "__lw_key").orderBy("text")
    kept = kept.withColumn("__lw_nth", F.row_number().over(w)).where("__lw_nth = 1").drop("__lw_nth", "__lw_key")
    return kept.union(docs.where("doc_id is null"))
