"""Hard negatives: for an anchor and each of its positives, the best rows of
another label whose score lies in a window below the positive's.

Scores are exact inner products of whole numbers, computed in float32 by a
residue number system:

1. Each component x is scaled to floor(``SCALE`` * x). Both sides are reduced
   modulo small primes, to residues around 0. A float32 product of two residue
   matrices is exact, because ``WIDTH`` products of residues of ``PRIMES`` stay
   below 2^24; wider vectors are multiplied ``WIDTH`` components at a time and
   added modulo the prime.
2. As many primes are taken as the Cauchy-Schwarz bound of the two blocks needs,
   and the signed score is rebuilt from its residues by Chinese remaindering in
   mixed radix.
3. *Windowed selection.* A block keeps, for each anchor and positive, the best
   rows between ``low`` and ``high`` percent of the positive's score; the blocks'
   winners are ranked together at the end. Ties go to the smaller key.

Scale. All anchors are compared with all rows (they are the stated queries), in
blocks: the rows are dealt by a hash of the key over tiles of about
``TILE_ROWS``, and every anchor is copied to every tile, in one shuffle. A task
holds one tile's rows and streams the anchors past them, ``BLOCK_ANCHORS`` at a
time; nothing passes through the driver but three counts. Positives are searched
among rows of the anchor's label only: a label's rows are tiles of their own, as
many as its size needs, so a label with a third of all rows is split like any
other data. Winners are cut to the best before the last shuffle as well.

Edge cases: rows with a null key, label or vector, or a null or non-finite
component, take no part; a key that is repeated counts once, with its smallest
(label, vector); components that a shorter vector lacks are 0, and an empty
vector scores 0 with every row; an anchor without another row of its label, and
a positive with a score below 0, have no rows; no rows or no anchors give no
rows; ties by the smaller key; columns besides those named are ignored, whatever
their names. Keys and labels are integers. A vector whose scaled norm reaches
``NORM_LIMIT`` could not be scored exactly in a long: the job ends with an error
that says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import map_rows, quoted

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90              # percent of the positive's score
PRIMES = (1021, 1019, 1013, 1009, 997, 991)  # the largest whose residues fit WIDTH products below 2^24
WIDTH = 64
NORM_LIMIT = float(1 << 27)     # scores below 2^54: half the product of PRIMES, and 100 x fits a long
TILE_ROWS = 16_384              # rows that a task holds
LEAST_TILE_ROWS = 1_024         # smaller tiles than this are not worth their copies of the anchors
BLOCK_ANCHORS, BLOCK_ROWS = 256, 4_096
NONE = np.iinfo(np.int64).min


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo p, between -(p - 1) / 2 and (p - 1) / 2."""
    r = np.fmod(x, p)
    r -= p * np.rint(r / p)
    return r.astype(np.float32)


def primes_for(bound: float) -> tuple[int, ...]:
    """Enough primes to tell scores between -bound and bound apart."""
    product = 1
    for k, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound + 2:
            return PRIMES[:k]
    raise ValueError(f"scores up to {bound:.3g} are beyond the exact range")


class Block:
    """Whole-number vectors with their residues, computed once for each prime."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norm = float(np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0)))
        if not self.norm < NORM_LIMIT:
            raise ValueError(f"a vector of scaled norm {self.norm:.3g} cannot be scored exactly; the limit is "
                             f"{NORM_LIMIT:.3g}")
        self.known: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.known:
            self.known[p] = residues(self.vectors, p)
        return self.known[p]


def scores(a: Block, b: Block) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``."""
    width = min(a.vectors.shape[1], b.vectors.shape[1])
    total, radix = None, 1
    for p in primes_for(a.norm * b.norm):
        ra, rb = a.modulo(p), b.modulo(p)
        rest = np.zeros((len(ra), len(rb)), dtype=np.int64)
        for at in range(0, width, WIDTH):
            to = min(width, at + WIDTH)
            rest += (ra[:, at:to] @ rb[:, at:to].T).astype(np.int64)
        if total is None:
            total = rest % p
        else:
            total += radix * ((rest - total) * pow(radix, -1, p) % p)
        radix *= p
    return np.where(total > radix // 2, total - radix, total)


class Winners:
    """The k best (score, then smaller key) rows of each slot seen so far."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, NONE)
        self.held = (np.empty(0, np.int64),) * 3  # slot, score, key

    def add(self, found: np.ndarray, keys: np.ndarray) -> None:
        """``found``: scores of each slot with ``keys``, NONE where not allowed."""
        if len(keys) >= self.k:
            kth = np.partition(found, len(keys) - self.k, axis=1)[:, len(keys) - self.k]
            self.floor = np.maximum(self.floor, kth)
        slot, at = np.nonzero((found >= self.floor[:, None]) & (found != NONE))
        rows = [np.concatenate(x) for x in zip(self.held, (slot, found[slot, at], keys[at]))]
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        slot = rows[0][order]
        best = order[np.arange(len(slot)) - np.searchsorted(slot, slot) < self.k]
        self.held = tuple(x[best] for x in rows)


def matrix(column: pa.Array) -> np.ndarray:
    """A column of number lists as rows of one matrix, short ones filled with 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def usable(rows: DataFrame, key: str, label: str, vector: str, anchor: Column) -> DataFrame:
    """``(id, label, anchor, vector)`` of the rows that take part, one for each
    key, their vectors in whole numbers."""
    x = F.col("vector")
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    picked = rows.select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(label)).cast("long").alias("label"),
                         F.coalesce(anchor, F.lit(False)).alias("anchor"),
                         F.col(quoted(vector)).cast("array<double>").alias("vector"))
    valid = picked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~broken)
    return (valid.groupBy("id").agg(F.min(F.struct("label", "anchor", "vector")).alias("row"))
            .select("id", "row.label", "row.anchor",
                    F.transform("row.vector", lambda c: F.floor(c * F.lit(float(SCALE))).cast("double")).alias("vector")))


def tile_count(rows: int, tasks: int) -> int:
    """Tiles of about ``TILE_ROWS`` rows, or smaller ones so that ``tasks`` have work."""
    return max(1, -(-rows // TILE_ROWS), min(tasks, -(-rows // LEAST_TILE_ROWS)))


def dealt(rows: DataFrame, anchors: DataFrame, group: Column, tiles: Column, tasks: int) -> DataFrame:
    """Rows and anchors sorted for ``scored``: each row in one tile of its group,
    each anchor in all of them."""
    one = F.pmod(F.xxhash64("id"), tiles).cast("int")
    every = F.explode(F.sequence(F.lit(0), tiles.cast("int") - 1))
    mine = rows.select(group.alias("grp"), one.alias("tile"), F.lit(0).alias("side"), "id", "label", "vector",
                       F.array().cast("array<bigint>").alias("goals"))
    sent = anchors.select(group.alias("grp"), every.alias("tile"), F.lit(1).alias("side"), "id", "label", "vector", "goals")
    return (mine.unionByName(sent).repartition(tasks, "grp", "tile").sortWithinPartitions("grp", "tile", "side", "id"))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """((group, tile), side, rows) of each stretch of sorted rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(i).to_numpy() for i in range(3)])
        cuts = (np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            grp, tile, side = place[:, a].tolist()
            yield (grp, tile), side, batch.slice(a, b - a)


def scored(rows: DataFrame, select, schema: str) -> DataFrame:
    """Runs ``select(anchors, blocks of rows)`` for each block of anchors on the
    rows of each tile that they meet."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, blocks = None, [], None
        for place, side, part in parts(batches):
            if place != tile:
                tile, held, blocks = place, [], None
            if side == 0:
                held.append(part)
                continue
            if blocks is None:  # the tile's rows are complete
                blocks, held = row_blocks(held), []
            for at in range(0, part.num_rows if blocks else 0, BLOCK_ANCHORS):
                out = select(anchor_block(part.slice(at, BLOCK_ANCHORS)), blocks)
                if out.num_rows:
                    yield out

    return map_rows(rows, task, schema)


def anchor_block(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[list[int]], Block]:
    return (part.column("id").to_numpy(), part.column("label").to_numpy(), part.column("goals").to_pylist(),
            Block(matrix(part.column("vector"))))


def row_blocks(held: list[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray, Block]]:
    """(keys, labels, vectors) of a tile's rows, ``BLOCK_ROWS`` at a time."""
    out = []
    for part in held:
        keys, labels, vectors = part.column("id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("vector"))
        for at in range(0, len(keys), BLOCK_ROWS):
            to = at + BLOCK_ROWS
            out.append((keys[at:to], labels[at:to], Block(vectors[at:to])))
    return out


def best_of_label(k: int):
    """Selection of the k best other rows of the anchor's label."""
    def select(anchors: tuple, blocks: list[tuple]) -> pa.RecordBatch:
        ids, labels, _, vectors = anchors
        best = Winners(len(ids), k)
        for keys, kinds, rows in blocks:
            found = scores(vectors, rows)
            best.add(np.where((labels[:, None] == kinds) & (ids[:, None] != keys), found, NONE), keys)
        slot, score, key = best.held
        return pa.RecordBatch.from_arrays([pa.array(ids[slot]), pa.array(key), pa.array(score)],
                                          names=["anchor", "id", "score"])
    return select


def best_in_windows(k: int, low: int, high: int):
    """Selection of the k best rows of another label in the window of each of the
    anchor's distinct positive scores (``goals``)."""
    def select(anchors: tuple, blocks: list[tuple]) -> pa.RecordBatch:
        ids, labels, goals, vectors = anchors
        count = np.array([len(g) for g in goals])
        owner = np.repeat(np.arange(len(ids)), count)
        goal = np.array([g for gs in goals for g in gs], dtype=np.int64)
        least, most = -(-low * goal // 100), high * goal // 100
        best = Winners(len(goal), k)
        for keys, kinds, rows in blocks:
            found = scores(vectors, rows)
            other = np.where(labels[:, None] != kinds, found, NONE)[owner]
            best.add(np.where((other >= least[:, None]) & (other <= most[:, None]), other, NONE), keys)
        slot, score, key = best.held
        return pa.RecordBatch.from_arrays([pa.array(ids[owner[slot]]), pa.array(goal[slot]), pa.array(key),
                                           pa.array(score)], names=["anchor", "goal", "id", "score"])
    return select


def first_rows(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows of each ``by`` with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for each row where ``anchor`` holds and each of its
    ``positives`` best other rows of its label, the ``negatives`` best rows of
    another label with low * positive <= 100 * negative <= high * positive."""
    spark = rows.sparkSession
    data = stage(usable(rows, key, label, vector, anchor), "negatives-rows")
    total, n_anchors = data.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    slots = spark.sparkContext.defaultParallelism
    tiles = tile_count(total, slots)
    tasks = max(tiles, slots) if n_anchors else 1

    # positives: labels of more rows than a tile holds are cut into several
    size = max(LEAST_TILE_ROWS, -(-total // tiles))
    sizes = data.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("tiles"))
    large = stage(sizes.where(F.col("tiles") > 1), "negatives-labels")
    of_label = F.coalesce("tiles", F.lit(1))
    wide = data.join(large, "label", "left")
    anchors = wide.where("anchor").withColumn("goals", F.array().cast("array<bigint>"))
    near = scored(dealt(wide, anchors, F.col("label"), of_label, tasks), best_of_label(positives),
                  "anchor long, id long, score long")
    chosen = stage(first_rows(near, positives, "anchor"), "negatives-positives")

    goals = chosen.groupBy(F.col("anchor").alias("of")).agg(F.array_sort(F.collect_set("score")).alias("goals"))  # ``positives`` at most
    anchors = data.where("anchor").join(goals, F.col("id") == F.col("of")).select("id", "label", "vector", "goals")
    hard = scored(dealt(data, anchors, F.lit(0).cast("long"), F.lit(tiles), tasks),
                  best_in_windows(negatives, low, high), "anchor long, goal long, id long, score long")
    best = first_rows(hard, negatives, "anchor", "goal").withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return (chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("goal"))
            .join(best, ["anchor", "goal"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id",
                    F.col("goal").alias("positive_score"), "negative_score"))
