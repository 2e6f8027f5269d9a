"""Best-fit packing with large-item matching.

How items are packed depends on their lengths alone, so the plan is made from the histogram of lengths, which has as
many entries as the capacity, however many documents there are. Items above a third of the capacity pair at most twice
per bin: from the longest down, each is matched with the longest other that still fits. Shorter items, from the
longest down, go to the bins with the smallest gap that holds them. Equal bins are planned together, with a count.
Each item then finds its place from its length and its rank among the items of that length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.llm.common import materialise, running_sums
from loomwork.llm.tokens import default_vocabulary, encoder

CAPACITY = 2048
END_ID = 0
#: Bits of a rank in a plan key; the rest holds the length.
RANK_BITS = 48


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal bins: (number of bins, [(length, items of it in each bin), ...]).

    There are at most about twice as many groups as there are lengths, whatever the counts.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    small = sorted((n for n in left if 3 * n <= capacity), reverse=True)
    gaps: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    for n in large:
        while left[n]:
            other = next((m for m in large if m <= min(n, capacity - n) and left[m]), None)
            if other == n and left[n] < 2:
                other = next((m for m in large if m < n and m <= capacity - n and left[m]), None)
            if other is None:
                gaps[capacity - n].append((left[n], [(n, 1)]))
                left[n] = 0
            elif other == n:
                pairs = left[n] // 2
                gaps[capacity - 2 * n].append((pairs, [(n, 2)]))
                left[n] -= 2 * pairs
            else:
                pairs = min(left[n], left[other])
                gaps[capacity - n - other].append((pairs, [(n, 1), (other, 1)]))
                left[n] -= pairs
                left[other] -= pairs
    for n in small:
        todo = left[n]
        for gap in sorted(g for g in gaps if g >= n):
            if not todo:
                break
            each, stay = gap // n, []
            for bins, items in gaps.pop(gap):
                full = min(bins, todo // each)
                if full:
                    gaps[gap - each * n].append((full, [*items, (n, each)]))
                todo -= full * each
                rest = bins - full
                if rest and 0 < todo < each:
                    gaps[gap - todo * n].append((1, [*items, (n, todo)]))
                    rest, todo = rest - 1, 0
                if rest:
                    stay.append((rest, items))
            if stay:
                gaps[gap].extend(stay)
        each = capacity // n
        if todo >= each:
            gaps[capacity - each * n].append((todo // each, [(n, each)]))
        if todo % each:
            gaps[capacity - todo % each * n].append((1, [(n, todo % each)]))
    return [group for gap in sorted(gaps) for group in gaps[gap]]


def plan_table(groups: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each length and range of ranks: first bin, items a bin, and where in the bin the first one starts."""
    ranks: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for bins, items in groups:
        at = 0
        for n, each in items:
            rows.append((n << RANK_BITS | ranks[n], first, each, at))
            ranks[n] += bins * each
            at += n * each
        first += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": table[:, 0], "bin": table[:, 1], "each": table[:, 2], "at": table[:, 3]}


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and its end id, cut only beyond the capacity."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            at = 0
            for n, ids, offsets in code.encode(batch.column(1)):
                out = []
                for i, doc in enumerate(batch.column(0).slice(at, n).to_pylist()):
                    own = np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        some = own[start : start + capacity]
                        out.append((doc, piece, start, len(some), zlib.crc32(some.tobytes())))
                at += n
                columns = list(zip(*out))
                kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, length (1 to ``capacity``) and ids_crc32.

    Ranks within a length come from a distributed running sum, so a length that many items share is no task's burden.
    Only the histogram of lengths, at most ``capacity`` rows, comes to the driver.
    """
    spark = items.sparkSession
    items = materialise(items.withColumn("one", F.lit(1).cast("long")), "pack-items")  # dealing by ranges reads its input twice
    ranked = running_sums(items, ["length", "doc_id", "piece", "ids_crc32"], ["length"], "one", "pack-ranks").drop("one")
    ranked = materialise(ranked, "pack")
    histogram = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_table(plan_bins(histogram, capacity)))
    added = [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    schema = T.StructType([*ranked.drop("before").schema.fields, *added])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("before").to_numpy()
            row = np.searchsorted(table["key"], (length << RANK_BITS) | rank, side="right") - 1
            nth = rank - (table["key"][row] & ((1 << RANK_BITS) - 1)) if len(row) else rank
            each = table["each"][row]
            keep = [c for c in batch.schema.names if c != "before"]
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(table["bin"][row] + nth // each), pa.array(table["at"][row] + nth % each * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are their end id alone. Rows that repeat a doc_id are documents of their own; a null doc_id
    is kept. An empty table gives an empty table.
    """
    return pack(pieces(docs, vocabulary, capacity, end_id), capacity)
