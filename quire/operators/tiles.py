"""Quadtree tiling of the labelled points (VIZ-3, SNK-10).

Semantics (what the external tiler is used for): points are taken in their
shuffled order; at zoom level z the plane is cut into 2^z x 2^z tiles and
each tile keeps its first ``tile_size`` points; the rest descend to level
z+1, until no tile holds more than ``tile_size``. Points that no zoom level can
part (equal coordinates, or equal up to the last level) stay in their tile on
numbered pages of ``tile_size`` each. Earlier (random) points therefore land in
coarser tiles, so a coarse tile is a uniform sample. Points without coordinates
are in no tile.

Distributed form: a tile can hold most of the data (level 0 holds all of
it), so ranking inside a tile never groups the tile into one task. Rows are
range-partitioned by (tile, order key), each partition numbers its rows, and
per-(partition, tile) offsets -- at most partitions + tiles rows -- turn local
numbers into ranks within the tile. Each level is written once as Parquet in
the shared folder and read by what follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, stage

TILE_SIZE = 25_000
LAST_LEVEL = 30  # tile numbers are 32-bit


def rank_within(df: DataFrame, group: list[str], order: list[Column], name: str = "_rank") -> DataFrame:
    """0-based rank of each row inside its group, in ``order``; exact, with no
    group gathered into a single task (see module docstring)."""
    keys = [F.col(g) for g in group] + order
    # materialised once: the offsets and the join both read it
    keyed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mid", F.monotonically_increasing_id()))
    # one row per (partition, group) run: at most partitions + groups rows
    runs = keyed.groupBy("_pid", *group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (keyed.join(runs, ["_pid", *group])
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_pid", "_mid", "_first", "_off"))


def _tile_index(c: str, lo: float, hi: float, z: int) -> Column:
    n = 1 << z
    span = (hi - lo) or 1.0
    idx = F.floor((F.col(c) - F.lit(lo)) / F.lit(span) * F.lit(n)).cast("int")
    return F.least(F.greatest(idx, F.lit(0)), F.lit(n - 1))


def quadtree_tiles(points: DataFrame, order: Column, key: str = "doc_id", tile_size: int = TILE_SIZE,
                   last_level: int = LAST_LEVEL) -> DataFrame:
    """``points`` with columns ``z, tx, ty, page`` added: the tile (and page of
    it) each point is shown in first. ``order`` is the shuffle order (e.g.
    ``layout.shuffle_key``). No points give no tiles."""
    placed = (F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    remaining = stage(points.withColumn("_ord", order).where(placed), "tiles")
    b = remaining.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    x0, x1, y0, y1 = (0.0 if v is None else float(v) for v in b)
    out = None
    for z in range(last_level + 1):
        level = (remaining.withColumn("z", F.lit(z))
                 .withColumn("tx", _tile_index("x", x0, x1, z))
                 .withColumn("ty", _tile_index("y", y0, y1, z)))
        ranked = stage(rank_within(level, ["tx", "ty"], [F.col("_ord"), F.col(key)]), "tiles")
        # crowded tiles whose points all lie in one place are paged here
        apart = (ranked.groupBy("tx", "ty")
                 .agg(((F.min("x") == F.max("x")) & (F.min("y") == F.max("y"))).alias("_one"),
                      F.count(F.lit(1)).alias("_n")).where(F.col("_n") > tile_size)
                 .select("tx", "ty", (F.col("_one") | F.lit(z == last_level)).alias("_stay")))
        marked = stage(ranked.join(apart, ["tx", "ty"], "left"), "tiles")
        stays = (F.col("_rank") < tile_size) | F.coalesce(F.col("_stay"), F.lit(False))
        shown = (marked.where(stays).withColumn("page", F.floor(F.col("_rank") / F.lit(tile_size)).cast("int"))
                 .drop("_rank", "_ord", "_stay"))
        out = shown if out is None else out.unionByName(shown)
        remaining = marked.where(~stays).drop("_rank", "z", "tx", "ty", "_stay")
        if remaining.isEmpty():
            break
    return out
