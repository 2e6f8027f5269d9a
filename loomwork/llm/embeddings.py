"""Embedding near-duplicates from int8 tile products with rigorous error bounds.

A unit vector x is kept as s * q + e: q of int8, s its scale, |e| known. The product of two vectors differs from
s1 * s2 * (q1 . q2) by |e1| |x2^| + |x1^| |e2| + |e1| |e2| at most, where x^ = s * q. Tiles of vectors are multiplied as
whole numbers (exact in single precision up to 1024 dimensions at a time); only pairs whose bound reaches the threshold
are computed again from the full vectors in double precision.

Tiles hold neighbours: vectors are dealt to pivots, a bounded sample of them, and cut into tiles within a pivot, so a
crowded pivot has many tiles. A tile knows its centre and the widest angle to it; two tiles whose angles leave no room
for a pair within the threshold are never paired. Equal vectors are one row with a count.

Tiles are files in the shared folder, read in place by the tasks that pair them; they are never shuffled. A tile's int8
rows lie apart from its full ones, which are read only where a bound reaches the threshold.
A pair of tiles returns a number for each vector with links and the edges of a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import arrow_store, connected_components, delete, drop, materialise, partitions, scratch

THRESHOLD = 0.9
#: Vectors in a tile, at most.
TILE = 2048
#: Pivots, at most: a sample chosen by hash.
PIVOTS = 256
#: Dimensions whose int8 products sum exactly in single precision.
EXACT_DIMS = 1024
#: Slack for rounding in the bounds.
SLACK = 1e-6


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the norms of s * q and of what is left."""
    top = np.abs(x).max(axis=1)
    scale = np.where(top > 0, top, 1.0) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, np.linalg.norm(near, axis=1), np.linalg.norm(x - near, axis=1)


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products of int8 rows."""
    out = None
    for at in range(0, max(a.shape[1], 1), EXACT_DIMS):
        part = a[:, at : at + EXACT_DIMS].astype(np.float32) @ b[:, at : at + EXACT_DIMS].astype(np.float32).T
        out = part if out is None else out.astype(np.float64) + part
    return out


#: int8 rows, their scales, the norms of s * q and of what is left.
Quantised = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def possible_pairs(a: Quantised, b: Quantised, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) whose product may reach the threshold; i < j if both are the same tile."""
    (qa, sa, na, ea), (qb, sb, nb, eb) = a, b
    bound = int8_products(qa, qb) * sa[:, None] * sb[None, :]
    bound += ea[:, None] * (nb + eb)[None, :] + na[:, None] * eb[None, :]
    i, j = np.nonzero(bound >= threshold - SLACK)
    return (i[i < j], j[i < j]) if same else (i, j)


def verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs whose product in double precision reaches the threshold."""
    keep = []
    for at in range(0, len(i), 1 << 16):
        keep.append(np.einsum("ij,ij->i", a[i[at : at + (1 << 16)]], b[j[at : at + (1 << 16)]]) >= threshold)
    good = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[good], j[good]


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of unit vectors with product >= threshold; i < j if both are the same tile."""
    i, j = possible_pairs(quantise(a), quantise(b), threshold, same)
    return verified(a, b, i, j, threshold)


def spanning_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that connects what the edges connect: each root takes the least root it meets, round by round."""
    ids, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = places[: len(u)], places[len(u) :]
    root, out = np.arange(len(ids)), []
    while True:
        high, low = np.maximum(root[u], root[v]), np.minimum(root[u], root[v])
        apart = high != low
        if not apart.any():
            break
        u, v, high, low = u[apart], v[apart], high[apart], low[apart]
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        parent = np.arange(len(ids))
        parent[high[first]] = low[first]
        out.append((high[first], low[first]))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        root = parent[root]
    pairs = np.concatenate([np.stack(x) for x in out], axis=1) if out else np.empty((2, 0), np.int64)
    return ids[pairs[0]], ids[pairs[1]]


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, unit): double-precision unit vectors as bytes; null where a vector links with nothing."""
    for batch in batches:
        units, dims = [], []
        for v in batch.column(1):
            values = v.values if v.is_valid else None
            unit = None
            if values is not None and len(values) and not values.null_count:
                x = values.to_numpy().astype(np.float64)
                if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top
                    unit = (x / math.sqrt(float(x @ x))).tobytes()
            units.append(unit)
            dims.append(len(values) if unit is not None else None)
        columns = [batch.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "unit"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


#: A tile is two batches of a file: what every pair needs, then the full rows.
_TILE = pa.schema([(name, pa.large_binary()) for name in ("rows", "scales", "norms", "errors", "ids", "counts")])


def _tiles(folder: str):
    """From rows sorted by (dim, pivot): tiles, written to files, and one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        store, root = arrow_store(folder)
        store.create_dir(root, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}.arrow"
        heads: list[tuple] = []
        with store.open_output_stream(f"{root}/{name}") as sink, pa.ipc.new_file(sink, _TILE) as writer:

            def tile(rows: pa.Table) -> None:
                nonlocal made
                dim = rows.column("dim")[0].as_py()
                x = _matrix(rows.column("unit"), dim)
                mean = x.mean(axis=0)
                norm = np.linalg.norm(mean)
                centre = mean / norm if norm > 1e-9 else x[0]
                angle = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
                ids, counts = (rows.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "n"))
                light = [v.tobytes() for v in quantise(x)] + [ids, counts]
                for values in (light, [x.tobytes()] + [None] * 5):
                    writer.write_batch(pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _TILE.types)], schema=_TILE))
                heads.append(((part << 40) | made, dim, centre.tobytes(), angle, f"{folder}/{name}", made))
                made += 1

            left = None
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                rows = pa.concat_tables([left, rows]) if left is not None else rows
                while rows.num_rows > TILE or (rows.num_rows and rows.column("dim")[0] != rows.column("dim")[-1]):
                    dims, pivots = rows.column("dim").to_numpy()[: TILE + 1], rows.column("pivot").to_numpy()[: TILE + 1]
                    size = int(np.argmin(dims == dims[0])) if not (dims == dims[0]).all() else TILE
                    # a tile ends with a pivot's rows where that leaves it half full
                    ends = np.flatnonzero(pivots[1 : size + 1] != pivots[:size]) + 1
                    if size == TILE and len(ends) and ends[-1] >= TILE // 2:
                        size = int(ends[-1])
                    tile(rows.slice(0, size))
                    rows = rows.slice(size)
                left = rows if rows.num_rows else None
            if left is not None:
                tile(left)
        kinds = pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.string(), pa.int32()
        columns = [pa.array([h[i] for h in heads], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["tile", "dim", "centre", "angle", "file", "row"])

    return run


class Tile:
    """A tile in its file; the full rows are read when they are asked for."""

    def __init__(self, file: str, row: int, dim: int) -> None:
        self.file, self.row, self.dim = file, row, dim
        rows, *numbers, ids, counts = self._read(2 * row)
        self.quantised = (np.frombuffer(rows, np.int8).reshape(-1, dim), *(np.frombuffer(x, np.float64) for x in numbers))
        self.ids, self.counts, self._rows = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64), None

    def _read(self, batch: int) -> list:
        store, path = arrow_store(self.file)
        with store.open_input_file(path) as source, pa.ipc.open_file(source) as reader:
            found = reader.get_batch(batch)
        return [c[0].as_buffer() for c in found.columns if c[0].is_valid]

    def rows(self) -> np.ndarray:
        if self._rows is None:
            self._rows = np.frombuffer(self._read(2 * self.row + 1)[0], np.float64).reshape(-1, self.dim)
        return self._rows


def _tile_links(threshold: float):
    """From pairs of tiles, sorted by the first: links of each vector (u, null, n) and a forest's edges (u, v, 0).

    What a first tile finds in all its partners is put together before it is passed on.
    """

    def finish(ids: list[np.ndarray], links: list[np.ndarray], edges: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        some, place = np.unique(np.concatenate([np.empty(0, np.int64), *ids]), return_inverse=True)
        n = np.bincount(place, np.concatenate([np.empty(0), *links]), len(some)).astype(np.int64)
        u, v = (np.concatenate([np.empty(0, np.int64), *(e[side] for e in edges)]) for side in (0, 1))
        u, v = spanning_edges(u, v)
        vs = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(v, pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array(np.r_[some, u]), vs, pa.array(np.r_[n, np.zeros(len(u), np.int64)])], names=["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, a, held = None, None, 0
        ids, links, edges = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["tile"] != last:
                    last, a = row["tile"], Tile(row["file"], row["row"], row["dim"])
                same = row["tile"] == row["tile_b"]
                b = a if same else Tile(row["file_b"], row["row_b"], row["dim"])
                i, j = possible_pairs(a.quantised, b.quantised, threshold, same)
                i, j = verified(a.rows(), b.rows(), i, j, threshold) if len(i) else (i, j)
                if not len(i):
                    continue
                for tile, more in ((a, np.bincount(i, b.counts[j], len(a.ids))), (b, np.bincount(j, a.counts[i], len(b.ids)))):
                    met = np.flatnonzero(more)
                    ids.append(tile.ids[met])
                    links.append(more[met])
                    held += len(met)
                edges.append(spanning_edges(a.ids[i], b.ids[j]))
                if held > 200_000:
                    yield finish(ids, links, edges)
                    ids, links, edges, held = [], [], [], 0
        yield finish(ids, links, edges)

    return run


def pair_tiles(tiles: DataFrame, threshold: float) -> DataFrame:
    """(tile, tile_b) of tiles that may hold a pair, tile <= tile_b. Centres and angles alone are compared, in blocks."""
    reach = math.acos(max(-1.0, min(1.0, threshold))) + SLACK
    heads = materialise(tiles.select("tile", "dim", "centre", "angle"), "tile-heads")
    n = heads.count()
    blocks = max(1, math.ceil(n / 2048))
    dealt = heads.withColumn("block", F.pmod(F.xxhash64("tile"), F.lit(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    # a block meets each other block once, as the first or the second of the two
    left = dealt.select("*", other).select("tile", "dim", "centre", "angle", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    def meet(key, pdf):
        import pandas as pd

        first, second = pdf[pdf.block == key[0]], pdf[pdf.block == key[1]]
        found = []
        for dim, a in first.groupby("dim"):
            b = second[second.dim == dim]
            ca, cb = (np.frombuffer(b"".join(t.centre), np.float64).reshape(-1, dim) for t in (a, b))
            for at in range(0, len(a), 256):
                apart = np.arccos(np.clip(ca[at : at + 256] @ cb.T, -1, 1))
                room = apart - a.angle.to_numpy()[at : at + 256, None] - b.angle.to_numpy()[None, :]
                i, j = np.nonzero(room <= reach)
                s, t = a.tile.to_numpy()[at + i], b.tile.to_numpy()[j]
                keep = s <= t if key[0] == key[1] else np.ones(len(s), bool)
                found.append(pd.DataFrame({"tile": s[keep], "tile_b": t[keep]}))
        return pd.concat(found) if found else pd.DataFrame({"tile": [], "tile_b": []}, dtype="int64")

    return left.groupBy("x", "y").applyInPandas(meet, "tile long, tile_b long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Links join rows whose cosine, in double precision, reaches ``threshold``. Vectors that are null, zero, empty or
    hold null or non-finite components link with nothing, as do vectors of different lengths: no links, their own
    component, kept. Rows that repeat a vec_id are vectors of their own, counted as links of each other. An empty table
    gives an empty table.
    """
    spark = vectors.sparkSession
    units = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    units = materialise(units.mapInArrow(_unit, "vec_id long, dim int, unit binary"), "vec-units")
    distinct = units.where("unit is not null").groupBy("dim", "unit").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    distinct = materialise(distinct.withColumn("id", F.monotonically_increasing_id()), "vec-distinct")
    sample = distinct.select("dim", "unit").orderBy(F.xxhash64("unit")).limit(PIVOTS).collect()
    by_dim: dict[int, list[bytes]] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(bytes(r["unit"]))
    shared = spark.sparkContext.broadcast({d: np.frombuffer(b"".join(v), np.float64).reshape(-1, d) for d, v in by_dim.items()})

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            pivot = np.zeros(len(dims), np.int32)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                if d in shared.value:
                    x = _matrix(batch.column("unit").take(pa.array(own)), d)
                    pivot[own] = (x @ shared.value[d].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=[*batch.schema.names, "pivot"])

    near = distinct.select("id", "dim", "unit", "n").mapInArrow(nearest, "id long, dim int, unit binary, n long, pivot int")
    # ranges, not hashes: a crowded pivot spreads over tasks
    n_tasks = max(1, min(partitions(spark), -(-distinct.count() // TILE)))
    near = materialise(near, "vec-pivots")
    near = near.repartitionByRange(n_tasks, "dim", "pivot", F.xxhash64("unit")).sortWithinPartitions("dim", "pivot")
    folder = scratch(spark, "tiles")
    tiles = near.mapInArrow(_tiles(folder), "tile long, dim int, centre binary, angle double, file string, row int")
    tiles = materialise(tiles, "vec-tiles")
    pairs = pair_tiles(tiles, threshold)
    other = tiles.select(F.col("tile").alias("tile_b"), F.col("file").alias("file_b"), F.col("row").alias("row_b"))
    both = materialise(pairs.join(tiles.select("tile", "dim", "file", "row"), "tile").join(other, "tile_b"), "tile-pairs")
    n_pairs = both.count()
    both = both.repartitionByRange(max(1, min(4 * partitions(spark), n_pairs)), "tile", "tile_b").sortWithinPartitions("tile", "tile_b")
    found = materialise(both.mapInArrow(_tile_links(threshold), "u long, v long, n long"), "vec-links")
    delete(spark, folder)
    drop(near, tiles, both)
    links = found.where("v is null").groupBy(F.col("u").alias("link_id")).agg(F.sum("n").alias("links"))
    roots = connected_components(found.where("v is not null").select("u", "v"))
    rows = distinct.join(links, F.col("id") == F.col("link_id"), "left").drop("link_id")
    rows = rows.join(roots.withColumnRenamed("id", "root_of"), F.col("id") == F.col("root_of"), "left")
    rows = rows.select("dim", "unit", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("root"))
    rows = materialise(rows, "vec-rooted")
    least = materialise(rows.groupBy("root").agg(F.min("least").alias("component_id")), "vec-least")
    classes = rows.join(least, "root").select(F.col("dim").alias("d"), F.col("unit").alias("w"), "n_links", "component_id")
    classes = materialise(classes, "vec-classes")
    out = units.join(classes, (units["dim"] == classes["d"]) & (units["unit"] == classes["w"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


OP3_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON reach.r = links.x
), least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN counts USING (vec_id)
"""
