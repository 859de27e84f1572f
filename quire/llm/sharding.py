"""Sharding by a permutation-filled lookup table.

Every shard walks the slots of a table of prime size in an order of its own (an
offset and a step, both hashed from its name; a prime size makes that a
permutation). The shards take turns: each claims the next slot of its order that
is still free, until the table is full. A heavier shard takes several turns a
round. A row's key is hashed to a slot, and the slot names the shard: constant
time, nearly equal shards, and little movement when shards come or go.

Scale. The table has ``TABLE_SIZE`` rows at any input size, so it is sent to
every task and rows are placed without a shuffle. ``write`` deals every shard
over a number of tasks taken from its measured row count, so a shard that holds
most rows (one hot key) is written by many tasks.

Edge cases: equal keys share a shard; a null key is hashed like a value of its
own, so null keys share one; no rows give no rows; one shard takes everything;
names must be distinct, weights positive; ``slot`` and ``shard`` replace
columns of those names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed_row, unpacked_row

TABLE_SIZE = 65_537       # prime, and well over 100 times the number of shards
SHARDS = 64
ROWS_PER_FILE = 2_000_000


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> np.ndarray:
    """``table[slot]`` is the number of the shard that claimed the slot."""
    import xxhash

    if not is_prime(size) or not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("the table's size must be prime and the shards distinct, one at least and at most its size")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("one positive weight for each shard")
    offset = [xxhash.xxh64_intdigest(s.encode("utf-8"), 1) % size for s in shards]
    step = [xxhash.xxh64_intdigest(s.encode("utf-8"), 2) % (size - 1) + 1 for s in shards] if size > 1 else [1]
    table, turn, left = [-1] * size, [0] * len(shards), size
    while left:
        for k, times in enumerate(weights):
            for _ in range(min(times, left)):
                while table[slot := (offset[k] + turn[k] * step[k]) % size] >= 0:
                    turn[k] += 1
                table[slot] = k
                left -= 1
            if not left:
                break
    return np.array(table, dtype=np.int32)


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE,
                weights: list[int] | None = None) -> DataFrame:
    """The lookup table as ``(slot, shard)``."""
    names = [shards[k] for k in lookup_table(shards, size, weights).tolist()]
    return spark.createDataFrame(list(enumerate(names)), "slot int, shard string")


def place(rows: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE,
          weights: list[int] | None = None) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` of their key."""
    return unpacked_row(_placed(rows, key, shards, size, weights), rows.columns, slot=F.col("slot"), shard=F.col("shard"))


def _placed(rows: DataFrame, key: str, shards: list[str], size: int, weights: list[int] | None) -> DataFrame:
    """``(row, slot, shard)`` of the packed rows."""
    table = table_frame(rows.sparkSession, shards, size, weights)
    return (packed_row(rows, key=key)
            .select("row", F.pmod(F.xxhash64("key"), F.lit(size)).cast("int").alias("slot"))
            .join(F.broadcast(table), "slot"))  # `size` rows


def write(rows: DataFrame, key: str, path: str, shards: list[str], size: int = TABLE_SIZE,
          weights: list[int] | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write one folder of Parquet files for each shard. A shard's rows are dealt
    over files by a hash of the whole row and its measured count."""
    placed = _placed(rows, key, shards, size, weights)
    counts = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("int").alias("files"))
    dealt = placed.join(F.broadcast(counts), "shard")  # one row for each shard
    part = F.pmod(F.xxhash64("row", F.lit(3)), F.col("files"))
    n = max(1, counts.agg(F.sum("files")).first()[0] or 1)
    dealt = dealt.withColumn("part", part).repartition(n, "shard", "part")
    (unpacked_row(dealt, rows.columns, shard=F.col("shard"))
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
