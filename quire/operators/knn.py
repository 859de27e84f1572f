"""Top-k cosine neighbours (VEC-3, VEC-4, JN-13, JN-14, WIN-2, VEC-8, AGG-7).

Queries and candidates meet in a join by cell; neither passes through the driver
and none is sent to all tasks.

1. Every candidate has one cell. ``method="exact"`` has a single cell, so that
   every query meets every candidate. ``method="cells"`` is an inverted file: the
   cells are k-means centres of a sample of about ``CELL_SAMPLE`` vectors, a
   candidate is in its nearest cell, a query is copied to its ``n_probe`` nearest
   cells, and only those cells are read (the index is partitioned by cell).
2. In each cell the candidates are dealt over tiles of at most about ``TILE_ROWS``
   and the queries over blocks of about ``QUERY_ROWS``, both by a hash of the id.
   Every pair of a tile and a block is one piece of work, bounded in rows on both
   sides: when the tables grow there are more pieces. Both sides are shuffled once,
   by the pair; a task has one, by chance of the hash a few.
3. A task holds the block's queries and streams the tile's candidates past them as
   matrix products, keeping the best k of the tile for each query.
4. The tiles' winners are cut to k for each query before and after the last
   shuffle. Ties are broken by candidate id.

The recall of ``cells`` against the exact method is measured in the tests. Its
results are exact for ``n_probe`` = ``n_cells``. Similarities with a zero vector
are 0; rows with a null vector take no part. Thresholds are applied by callers
*after* the top-k, as the reference does.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package, stage, stage_path

BLOCK_ROWS = 1024        # queries scored at once
BATCH_ROWS = 1024        # candidates scored at once
QUERY_ROWS = 16_384      # queries that a task holds
TILE_ROWS = 262_144      # candidates that a task streams
LEAST_TILE_ROWS = 1024   # smaller tiles are not worth their copies of the queries
CELL_SAMPLE = 20_000     # vectors that the cells are fitted on, about


def unit_rows(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return unit(m)


def unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def units_of(column: pa.Array) -> np.ndarray:
    """Unit rows of an Arrow column of number lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1))


class Best:
    """The k best candidates of each query seen so far: rows (query, similarity,
    candidate), and for each query the similarity that a newcomer must reach.
    Candidates are numbers and come in ascending order."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0  # rows taken in since the last cut

    def add(self, sims: np.ndarray, first: int) -> None:
        """Take in the candidates ``first``, ``first + 1``, ...; -inf is no candidate."""
        if sims.shape[1] >= self.k and np.isneginf(self.floor.min()):  # at least k of this batch reach its k-th best
            kth = np.partition(sims, sims.shape[1] - self.k, axis=1)[:, sims.shape[1] - self.k]
            self.floor = np.maximum(self.floor, kth)
        least = np.maximum(self.floor, np.finfo(np.float64).min)
        at = np.flatnonzero(sims >= least[:, None])
        q, c = np.divmod(at, sims.shape[1])
        self.rows.append((q, sims.ravel()[at], first + c))
        self.waiting += len(at)
        if self.waiting >= self.k * len(self.floor):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        rows = tuple(np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        q = rows[0][order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        held = tuple(x[order[place < self.k]] for x in rows)
        last = order[place == self.k - 1]
        # with k held, a later candidate that is only equal comes after them
        self.floor[rows[0][last]] = np.nextafter(rows[1][last], np.inf)
        self.rows, self.waiting = [held], 0
        return held


class Block:
    """The queries of a task, and the best candidates of those streamed past them."""

    def __init__(self, parts: list[pa.RecordBatch], k: int, exclude_self: bool, block_rows: int):
        self.ids = pa.concat_arrays([p.column("id") for p in parts])
        units = np.concatenate([units_of(p.column("vector")) for p in parts])
        self.parts = [(at, units[at:at + block_rows], Best(len(units[at:at + block_rows]), k))
                      for at in range(0, len(units), block_rows)]
        self.void = ~np.isfinite(units).all(axis=1)
        self.own: dict = {}
        if exclude_self:
            for row, i in enumerate(self.ids.to_pylist()):
                self.own.setdefault(i, []).append(row)
        self.seen: list[pa.Array] = []
        self.count = 0

    def add(self, ids: pa.Array, units: np.ndarray) -> None:
        columns, void = units.T, ~np.isfinite(units).all(axis=1)
        own = [(row, col) for col, i in enumerate(ids.to_pylist()) for row in self.own.get(i, ())] if self.own else []
        own_rows, own_cols = np.array(own, np.int64).reshape(-1, 2).T
        for at, queries, best in self.parts:
            sims = queries @ columns
            sims[:, void] = -np.inf
            sims[self.void[at:at + len(queries)]] = -np.inf
            mine = (own_rows >= at) & (own_rows < at + len(queries))
            sims[own_rows[mine] - at, own_cols[mine]] = -np.inf
            best.add(sims, self.count)
        self.seen.append(ids)
        self.count += len(ids)

    def winners(self) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays(self.seen)
        for at, _, best in self.parts:
            q, sim, c = best.cut()
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(at + q)), ids.take(pa.array(c)), pa.array(sim)],
                                             names=["qid", "cid", "sim"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(pair, side, rows) of each stretch of sorted rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(i).to_numpy() for i in range(2)])
        cuts = (np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            pair, side = place[:, a].tolist()
            yield pair, side, batch.slice(a, b - a)


def _scorer(k: int, exclude_self: bool, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, asked, block = None, [], None
        for pair, side, part in _parts(batches):
            if pair != where:
                if block is not None:
                    yield from block.winners()
                where, asked, block = pair, [], None
            if side == 0:  # the block's queries come first
                asked.append(part)
                continue
            if block is None and asked:
                block, asked = Block(asked, k, exclude_self, block_rows), []
            if block is not None:
                for at in range(0, part.num_rows, BATCH_ROWS):
                    rows = part.slice(at, BATCH_ROWS)
                    block.add(rows.column("id"), units_of(rows.column("vector")))
        if block is not None:
            yield from block.winners()
    return run


# -- cells --------------------------------------------------------------------

class CellIndex(NamedTuple):
    """An inverted file: unit centres and ``rows(id, vector, cell)``, one Parquet
    folder for each cell."""
    centres: np.ndarray
    rows: DataFrame


def fit_cells(candidates: DataFrame, n_cells: int, seed: int = 1) -> np.ndarray:
    """Unit centres of ``n_cells`` cells, fitted on a sample by id hash."""
    n = candidates.count()
    sample = candidates.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <
                              F.lit(int((1 << 30) * min(1.0, CELL_SAMPLE / max(1, n)))))
    data = sample.select(array_to_vector(F.col("vector")).alias("features"))
    return unit_rows(KMeans(k=n_cells, seed=seed, maxIter=10).fit(materialize(data)).clusterCenters())


def _with_cells(rows: DataFrame, centres: np.ndarray, n_nearest: int) -> DataFrame:
    """Each row once for each of its nearest cells."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            near = np.argsort(-(unit_rows(pdf["vector"]) @ centres.T), axis=1, kind="stable")[:, :n_nearest] if len(pdf) else []
            yield pdf.assign(cell=list(near)).explode("cell").astype({"cell": "int32"})

    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])
    return rows.mapInPandas(run, schema)


def cell_index(candidates: DataFrame, n_cells: int, id_col: str = "id", vec_col: str = "vector",
               path: str | None = None) -> CellIndex:
    """The candidates by cell, written to ``path`` (default: the session's shared folder)."""
    spark = candidates.sparkSession
    ship_package(spark)
    rows = _pick(candidates, id_col, vec_col)
    if path is None:
        rows = stage(rows, "knn-candidates")  # read for the sample and for the cells
    centres = fit_cells(rows, n_cells)
    path = path or stage_path(spark, "knn-cells")
    placed = _with_cells(rows, centres, 1)
    spread = F.pmod(F.xxhash64("id"), F.lit(max(1, spark.sparkContext.defaultParallelism // 4)))
    # a folder a cell and few files in each
    placed.repartition("cell", spread).write.partitionBy("cell").parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])
    return CellIndex(centres, spark.read.schema(schema).parquet(path))


# -- search -------------------------------------------------------------------

def _pick(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return (df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"))
            .where(F.col("vector").isNotNull()))


def _tiles(rows: int, tasks: int) -> int:
    """Tiles of ``TILE_ROWS``, or smaller ones so that ``tasks`` have work."""
    return max(1, -(-rows // TILE_ROWS), min(tasks, -(-rows // LEAST_TILE_ROWS)))


def _winners(queries: DataFrame, candidates: DataFrame, sizes: dict[int, int], asked: dict[int, int], k: int,
             exclude_self: bool, block_rows: int) -> DataFrame:
    """``(qid, cid, sim)``: the best k of each tile. Both sides have a ``cell``;
    ``sizes`` and ``asked`` are the candidates and the queries of each cell (as many
    numbers as cells)."""
    spark = candidates.sparkSession
    wanted = 3 * spark.sparkContext.defaultParallelism  # pairs, so that all slots have work to the end
    total = max(1, sum(n * asked.get(c, 0) for c, n in sizes.items()))
    share, pairs = [], 0
    for cell, n in sizes.items():
        blocks = max(1, -(-asked.get(cell, 0) // QUERY_ROWS))
        tiles = _tiles(n, -(-wanted * n * asked.get(cell, 0) // (total * blocks)))
        share.append((cell, tiles, blocks, pairs))
        pairs += tiles * blocks
    if len(share) > 1:
        dealt = spark.createDataFrame(share, "cell int, tiles int, blocks int, first int")
        candidates, queries = (df.join(dealt, "cell") for df in (candidates, queries))
        tiles, blocks, first = F.col("tiles"), F.col("blocks"), F.col("first")
    else:
        cell, *numbers = share[0] if share else (-1, 1, 1, 0)
        candidates, queries = (df.where(F.col("cell") == cell) for df in (candidates, queries))
        tiles, blocks, first = (F.lit(n) for n in numbers)
    tile = F.pmod(F.xxhash64("id"), tiles).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(1)), blocks).cast("int")
    sent = queries.select(F.explode(F.transform(F.sequence(F.lit(0), tiles - 1), lambda t: first + t * blocks + block)).alias("tile"),
                          F.lit(0).alias("side"), "id", "vector", "cell")
    mine = candidates.select(F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: first + tile * blocks + b)).alias("tile"),
                             F.lit(1).alias("side"), "id", "vector", "cell")
    # "tile" numbers the pairs; with twice as many partitions, few tasks have several
    dealt = (sent.unionByName(mine).repartition(2 * max(1, pairs), "cell", "tile")
             .sortWithinPartitions("tile", "side", "id"))
    kind = candidates.schema["id"].dataType
    schema = T.StructType([T.StructField("qid", kind), T.StructField("cid", kind), T.StructField("sim", T.DoubleType())])
    return dealt.mapInArrow(_scorer(k, exclude_self, block_rows), schema)


def _ranked(winners: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.col("sim").desc(), F.col("cid").asc())
    return (winners.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("qid", "cid", "sim", "rank"))


def search_cells(queries: DataFrame, index: CellIndex, k: int, n_probe: int, id_col: str = "id",
                 vec_col: str = "vector", exclude_self: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(qid, cid, sim, rank)`` among the candidates in the ``n_probe`` cells
    nearest to each query. Cells that no query probes are not read."""
    probes = stage(_with_cells(_pick(queries, id_col, vec_col), index.centres, n_probe), "knn-probes")
    asked = {r["cell"]: r["count"] for r in probes.groupBy("cell").count().collect()}  # at most one number a cell
    near = index.rows.where(F.col("cell").isin(list(asked)))
    sizes = {r["cell"]: r["count"] for r in near.groupBy("cell").count().collect()}
    return _ranked(_winners(probes, near, sizes, asked, k, exclude_self, block_rows), k)


def top_k_neighbors(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "id",
                    vec_col: str = "vector", exclude_self: bool = True, block_rows: int = BLOCK_ROWS,
                    method: str = "exact", n_cells: int = 64, n_probe: int = 16) -> DataFrame:
    """``(qid, cid, sim, rank)``: the ``k`` most cosine-similar candidates of
    every query (rank 1 = most similar; equal similarities by candidate id)."""
    if method not in ("exact", "cells"):
        raise ValueError(f"unknown method {method!r}")
    ship_package(candidates.sparkSession)
    if method == "cells":
        index = cell_index(candidates, n_cells, id_col, vec_col)
        return search_cells(queries, index, k, n_probe, id_col, vec_col, exclude_self, block_rows)
    one = F.lit(0).alias("cell")
    rows = stage(_pick(candidates, id_col, vec_col), "knn-candidates").select("*", one)
    asked = rows if queries is candidates else stage(_pick(queries, id_col, vec_col), "knn-queries").select("*", one)
    return _ranked(_winners(asked, rows, {0: rows.count()}, {0: asked.count()}, k, exclude_self, block_rows), k)


def neighbor_counts(queries: DataFrame, neighbors: DataFrame, threshold: float,
                    id_col: str = "id") -> DataFrame:
    """Per query, how many of its top-k neighbours reach ``threshold``
    (zero-neighbour queries included)."""
    near = (neighbors.where(F.col("sim") >= F.lit(threshold))
            .groupBy("qid").agg(F.count(F.lit(1)).alias("n_near")))
    return (queries.select(F.col(id_col).alias("qid")).join(near, "qid", "left")
            .select("qid", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))


def neighbor_histogram(counts: DataFrame) -> DataFrame:
    """AGG-7 / ORD-2: how many queries have each neighbour count, least
    frequent first."""
    return (counts.groupBy("n_near").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("count", "n_near"))


# Fixed values of the reference's neighbour-density estimate.
DENSITY_TOPN = 100
DENSITY_THRESHOLD = 0.65
DENSITY_EVERY = 1000


def neighbor_density(vectors: DataFrame, every: int = DENSITY_EVERY, topn: int = DENSITY_TOPN,
                     threshold: float = DENSITY_THRESHOLD, id_col: str = "id",
                     vec_col: str = "vector") -> DataFrame:
    """VEC-8: sample every ``every``-th document (FLT-11, by key hash), find
    its ``topn`` neighbours among *all* documents, count those with
    similarity >= ``threshold`` and return the histogram (AGG-7)."""
    from .filters import systematic_sample
    queries = systematic_sample(vectors, every, id_col) if every > 1 else vectors
    nb = top_k_neighbors(queries, vectors, k=topn, id_col=id_col, vec_col=vec_col)
    return neighbor_histogram(neighbor_counts(queries, nb, threshold, id_col))
