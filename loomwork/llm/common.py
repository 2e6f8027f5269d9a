"""What the corpus operators share: scratch tables, distributed running sums, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators.durable import arrow_store, delete, drop, materialise, scratch  # noqa: F401  the operators take them from here

#: A word in every contract: a run of characters that are neither space nor \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def give_back() -> None:
    """Hands memory that earlier work has freed back to the system: Python workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def reserved(df: DataFrame, *names: str) -> None:
    """Refuses a table with columns that begin with ``__lw_``, the operators' own, or have one of the names, or repeat."""
    lower = [c.lower() for c in df.columns]
    bad = sorted({c for c in lower if c.startswith("__lw_") or c in names or lower.count(c) > 1})
    if bad:
        raise ValueError(f"columns that the operators use themselves or that are ambiguous: {', '.join(bad)}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def count_words(text) -> F.Column:
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(df: DataFrame, order: list[str], group: list[str], value: str, name: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same ``group`` that come earlier in ``order``.

    ``order`` starts with ``group``. Rows are dealt by ranges of ``order``, so a group of any size spreads over many
    tasks; each task sums its own rows in one streaming pass, and one row per task and group carries the offsets.
    Rows that tie in the whole of ``order`` come in any order.
    """
    spark = df.sparkSession
    n = partitions(spark)
    schema = T.StructType([*df.schema.fields, T.StructField("local_before", T.LongType()), T.StructField("part", T.IntegerType())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        key, total = None, 0
        for batch in batches:
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(values):
                continue
            starts = np.zeros(len(values), bool)
            starts[0] = True
            for g in group:
                codes = batch.column(g).dictionary_encode().indices
                codes = codes.fill_null(-1).to_numpy(zero_copy_only=False)
                starts[1:] |= codes[1:] != codes[:-1]
            first = tuple(batch.column(g)[0].as_py() for g in group)
            before = np.cumsum(values) - values
            heads = np.flatnonzero(starts)
            run = np.cumsum(starts) - 1
            base = before[heads].copy()
            if first == key:
                base[0] -= total
            local_before = before - base[run]
            key = tuple(batch.column(g)[-1].as_py() for g in group)
            total = int(local_before[-1] + values[-1])
            columns = [*batch.columns, pa.array(local_before, pa.int64()), pa.array(np.full(len(values), part, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "local_before", "part"])

    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(local, schema)
    rows = materialise(rows, name)
    totals = rows.groupBy("part", *group).agg(F.sum(value).alias("part_total"))
    # one row for each task, and one more for each group at most: bounded by tasks and groups, not by rows
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *group, F.coalesce(F.sum("part_total").over(w), F.lit(0)).alias("part_before"))
    offsets = offsets.select(F.col("part").alias("o_part"), "part_before", *[F.col(g).alias(f"o_{g}") for g in group])
    match = rows["part"] == offsets["o_part"]
    for g in group:
        match = match & rows[g].eqNullSafe(offsets[f"o_{g}"])
    joined = rows.join(offsets, match)
    return joined.withColumn("before", F.col("local_before") + F.col("part_before")).drop(
        "local_before", "part", "o_part", "part_before", *[f"o_{g}" for g in group]
    )


class Forest:
    """Union-find over integers; the smaller root wins."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self.parent[high] = low
            self.parent.setdefault(low, low)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        kids = [(x, self.find(x)) for x in self.parent]
        kids = [(x, r) for x, r in kids if x != r]
        both = np.array(kids, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


#: Vertices that a task holds at once while it thins edges; then it passes on its forest and starts anew.
FOREST_VERTICES = 500_000


def thin_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a task's edges (u, v) by those of a spanning forest."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) > FOREST_VERTICES:
            yield _edge_batch(*forest.edges())
            forest = Forest()
    yield _edge_batch(*forest.edges())


def _edge_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


#: Rows of small tables that a task gets, about: a table of few rows is not spread over as many files as tasks.
SMALL_ROWS = 250_000


def compact(df: DataFrame, rows: int) -> DataFrame:
    """The same rows in as many partitions as ``rows``, a bound of their number, need."""
    return df.coalesce(max(1, -(-rows // SMALL_ROWS)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of ``edges`` (u long, v long): root is the smallest vertex reachable.

    Alternating large-star and small-star steps; each vertex ends up linked to its root only. Minima are aggregated
    before the shuffle, and every step's edges are written to the shared folder, so that the joins read plain
    exchanges (whose hot keys Spark splits) and a lost executor costs one step at most. What a step has read is deleted
    when the next one is written.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    edges = materialise(edges.mapInArrow(thin_edges, "u long, v long"), "edges")
    seen, n = None, edges.count()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        least = materialise(compact(least, 2 * n), "large-min")
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(compact(large.distinct(), 2 * n), "large-star")  # now v < u in every edge
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        low = materialise(compact(low, 2 * n), "small-min")
        small = large.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").union(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        before, edges = edges, materialise(compact(small.distinct(), 4 * n), "small-star")
        drop(before, least, large, low)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen, n = now, now[0]
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return ids.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def by_batch(f: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield f(batch)

    return run
